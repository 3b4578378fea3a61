"""Language-model scoring over the lattice of subword segmentations.

A text is a sequence of lower-cased words and one end.  The pieces of an
existing vocabulary generate it: every word is its marker and bytes, spelled
by any sequence of pieces, and its probability is the sum over all
segmentations of the product of piece probabilities, computed by a forward
recursion in log space.  A document's score is the sum of its words' marginal
log probabilities and the end's; the pieces and the end form one
distribution, so the scores are those of a proper model.

The vocabulary's own scores give the first piece probabilities (public
vocabularies score pieces by merge rank, so a piece of rank r starts at
1 / (r + 1)); ``rounds`` of expectation-maximisation over the words of all
training documents fit them: expected counts come from the forward-backward
recursion, summed in Spark over the distinct words.  Single bytes are pieces,
so every text has a segmentation.

Words are counted once over the corpus, scored once each, and joined back to
the documents.  The ``HOT`` most frequent words are looked up in the tasks
(a bounded broadcast); all others are joined by shuffle, counted within their
document first.

Defined cases: a null or empty text is its end alone; rows with equal text
score equally, repeated rows each; a null doc_id trains (its remainder is not
1); with no training documents the base is uniform and the pieces keep their
first probabilities; an empty table gives an empty result; extra columns are
ignored; words of any length are scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, text_slices, tidy, word_table

HOT = 300_000
HOT_BYTES = 64
BUFFER = 100_000  # words handled at once
MARK = b" "       # begins every word; no word holds white space
_P = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Pieces:
    """Distinct piece strings and a hash table to find them by."""

    texts: list[bytes]
    first: np.ndarray  # first log probabilities

    def __post_init__(self):
        self.longest = max(map(len, self.texts))
        self.hashes = np.array([_hash(x) for x in self.texts], np.uint64)
        bits, size = 21, len(self.texts)
        self.mask = np.uint64((1 << bits) - 1)
        self.table = np.full(1 << bits, size, np.int32)  # `size`: no piece
        self.keys = np.append(self.hashes, np.uint64(0))
        self.probes = 1
        for i in range(size):
            at, k = int(self._slot(self.hashes[i:i + 1])[0]), 1
            while self.table[at] != size:
                at, k = (at + 1) & int(self.mask), k + 1
            self.table[at] = i
            self.probes = max(self.probes, k)

    def _slot(self, h: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(43)

    def find(self, h: np.ndarray) -> np.ndarray:
        at = self._slot(h)
        out = np.full(h.shape, len(self.texts), np.int32)
        for _ in range(self.probes):
            got = self.table[at]
            out = np.where(self.keys[got] == h, got, out)
            at = (at + np.uint64(1)) & self.mask
        return out


def _hash(x: bytes) -> np.uint64:
    h = np.uint64(0)
    with np.errstate(over="ignore"):
        for c in x:
            h = h * _P + np.uint64(c + 1)
    return h


def load_pieces(path: str) -> Pieces:
    """The pieces of a sentencepiece model as bytes after the word marker."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    found = {bytes([c]): None for c in range(256)}
    for i in range(model.get_piece_size()):
        if model.is_unknown(i) or model.is_control(i) or model.is_byte(i):
            continue
        x = model.id_to_piece(i)
        if "▁" not in x[1:] and model.get_score(i) > -1e8:
            found[x.replace("▁", MARK.decode()).encode()] = -model.get_score(i)
    lowest = 1 + max((r for r in found.values() if r is not None), default=0)
    weight = np.array([1 / (1 + (lowest if r is None else r)) for r in found.values()])
    return Pieces(list(found), np.log(weight / weight.sum()))


_PIECES: dict[str, Pieces] = {}


def _pieces(path: str) -> Pieces:
    if path not in _PIECES:
        _PIECES[path] = load_pieces(path)
    return _PIECES[path]


def lattices(words: list[bytes], pieces: Pieces) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, found) for the words of each length: ``found[k, i, l - 1]`` is the
    piece at byte i of l bytes, or the number of pieces."""
    sizes = np.array([len(w) for w in words]) + 1
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        step = max(1, 4_000_000 // (size * min(size, pieces.longest)))
        for k in range(0, len(rows), step):
            part = rows[k:k + step]
            raw = np.frombuffer(b"".join(MARK + words[r] for r in part), np.uint8).reshape(-1, size)
            longest = min(size, pieces.longest)
            found = np.full((len(part), size, longest), len(pieces.texts), np.int32)
            h = np.zeros((len(part), size), np.uint64)
            with np.errstate(over="ignore"):
                for n in range(1, longest + 1):
                    h = h[:, :size - n + 1] * _P + (raw[:, n - 1:].astype(np.uint64) + np.uint64(1))
                    found[:, :size - n + 1, n - 1] = pieces.find(h)
            yield part, found


def _sum_logs(x: np.ndarray) -> np.ndarray:
    top = x.max(axis=1)
    return top + np.log(np.exp(x - top[:, None]).sum(axis=1))


def forward(found: np.ndarray, logp: np.ndarray) -> np.ndarray:
    """Log probability of each prefix over all its segmentations; ``logp`` ends
    with minus infinity for no piece."""
    rows, size, longest = found.shape
    out = np.zeros((rows, size + 1))
    for j in range(1, size + 1):
        n = min(j, longest)
        starts = np.arange(j - 1, j - n - 1, -1)
        out[:, j] = _sum_logs(out[:, starts] + logp[found[:, starts, np.arange(n)]])
    return out


def expected_counts(found: np.ndarray, logp: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Expected uses of every piece, words weighing ``times``."""
    rows, size, longest = found.shape
    ahead = forward(found, logp)
    back = np.full((rows, size + longest + 1), -np.inf)
    back[:, size] = 0
    total = np.zeros(len(logp))
    for i in range(size - 1, -1, -1):
        n = min(size - i, longest)
        paths = logp[found[:, i, :n]] + back[:, i + 1:i + 1 + n]
        back[:, i] = _sum_logs(paths)
        share = np.exp(ahead[:, i, None] + paths - ahead[:, size, None]) * times[:, None]
        total += np.bincount(found[:, i, :n].ravel(), share.ravel(), len(logp))
    return total


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, train, total) of the words of (text, held_out), by slices."""
    for b in tidy(batches):
        for part in text_slices(b, 0):
            starts, index, words = word_table(part.column(0))
            held = np.repeat(part.column(1).to_numpy(zero_copy_only=False).astype(bool), np.diff(starts))
            total = np.bincount(index, minlength=len(words))
            train = np.bincount(index[~held], minlength=len(words))
            low = [w.lower() for w in words.cast(pa.large_binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(low, pa.binary()), pa.array(train), pa.array(total)],
                names=["word", "train", "total"])


def _buffered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, rows = [], 0
    for b in tidy(batches):
        held.append(b)
        rows += b.num_rows
        if rows >= BUFFER:
            yield pa.Table.from_batches(held)
            held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held)


def _expect(batches: Iterator[pa.RecordBatch], path: str, logp: np.ndarray) -> Iterator[pa.RecordBatch]:
    pieces, total = _pieces(path), np.zeros(len(logp))
    for t in _buffered(batches):
        times = t.column(1).to_numpy().astype(float)
        for rows, found in lattices(t.column(0).to_pylist(), pieces):
            total += expected_counts(found, logp, times[rows])
    used = np.flatnonzero(total[:-1])
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["piece", "uses"])


def _score_words(batches: Iterator[pa.RecordBatch], path: str, logp: np.ndarray
                 ) -> Iterator[pa.RecordBatch]:
    pieces = _pieces(path)
    for t in _buffered(batches):
        out = np.zeros(t.num_rows)
        for rows, found in lattices(t.column(0).to_pylist(), pieces):
            out[rows] = forward(found, logp)[:, -1]
        for b in t.append_column("logp", pa.array(out)).combine_chunks().to_batches():
            yield b


_DOC = ("row long, doc_id long, held_out boolean, word binary, n long, n_tokens long, n_known long, "
        "base double, score double")


def _documents(batches: Iterator[pa.RecordBatch], hot: pa.Table) -> Iterator[pa.RecordBatch]:
    """For each document one row with the sums over its hot words (its ``word``
    is one that no text has), and one for each other word it holds."""
    at = {w: i for i, w in enumerate(hot.column("word").to_pylist())}
    known, base, score = (np.append(hot.column(x).to_numpy(), 0)
                          for x in ("train", "base", "logp"))
    for b in tidy(batches):
        for part in text_slices(b, 2):
            starts, index, words = word_table(part.column(2))
            low = [w.lower() for w in words.cast(pa.large_binary()).to_pylist()]
            place = np.array([at.get(w, len(at)) for w in low], np.int64)
            owner = np.repeat(np.arange(part.num_rows), np.diff(starts))
            token = place[index]
            rare = token == len(at)
            sums = [np.bincount(owner, x[token], part.num_rows) for x in (known > 0, base, score)]
            pair, n = np.unique(owner[rare] * len(low) + index[rare], return_counts=True)
            doc, word = pair // max(1, len(low)), pair % max(1, len(low))
            rows = part.column(0).to_numpy()
            docs, m = part.num_rows, len(pair)
            zero = np.zeros(m)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate([rows, rows[doc]])),
                pa.concat_arrays([part.column(1), part.column(1).take(pa.array(doc))]),
                pa.concat_arrays([part.column(3), part.column(3).take(pa.array(doc))]),
                pa.array([b" %d" % r for r in rows] + [low[w] for w in word], pa.binary()),
                pa.array(np.concatenate([np.zeros(docs, np.int64), n])),
                pa.array(np.concatenate([np.diff(starts), zero]).astype(np.int64)),
                pa.array(np.concatenate([sums[0], zero]).astype(np.int64)),
                pa.array(np.concatenate([sums[1], zero])), pa.array(np.concatenate([sums[2], zero])),
            ], names=[x.split()[0] for x in _DOC.split(", ")])


def fit_pieces(words: DataFrame, path: str, ends: int, rounds: int = 2, smoothing: float = 0.1
               ) -> tuple[np.ndarray, float]:
    """Log probabilities of the pieces (minus infinity last) and of the end,
    from ``words`` (word, train) and the number of texts."""
    pieces = _pieces(path)
    logp, end = np.append(pieces.first, -np.inf), np.log(0.5)
    for _ in range(rounds):
        seen = words.filter("train > 0").select("word", "train").mapInArrow(
            lambda it, now=logp: _expect(it, path, now), "piece long, uses double")
        got = seen.groupBy("piece").agg(F.sum("uses").alias("uses")).toPandas()  # a row a piece at most
        uses = np.full(len(pieces.texts), smoothing)
        uses[got["piece"].to_numpy(np.int64)] += got["uses"].to_numpy()
        if not len(got):
            break
        whole = uses.sum() + ends
        logp, end = np.append(np.log(uses / whole), -np.inf), np.log(ends / whole)
    return logp, float(end)


def score_documents(docs: DataFrame, path: str, folds: int = 5, held_fold: int = 1, rounds: int = 2
                    ) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of
    ``docs`` (doc_id, text); documents with crc32(doc_id) mod ``folds`` =
    ``held_fold`` do not train.  ``base_score`` is the word unigram's."""
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == held_fold,
                      F.lit(False))
    docs = docs.select("doc_id", "text", held.alias("held_out"))
    ends = docs.select("held_out").filter("not held_out").count()
    words = materialize(
        docs.select("text", "held_out").mapInArrow(_count, "word binary, train long, total long")
        .groupBy("word").agg(F.sum("train").alias("train"), F.sum("total").alias("total")), "lm-words")
    known = words.agg(F.sum("train"), F.count(F.when(F.col("train") > 0, 1))).first()
    n, v = (known[0] or 0) + ends, known[1] + (ends > 0)
    logp, end = fit_pieces(words, path, ends, rounds)
    below = n + 0.5 * (v + 1)
    base = lambda c: F.log10((c + F.lit(0.5)) / F.lit(below))
    scored = materialize(
        words.mapInArrow(lambda it: _score_words(it, path, logp),
                         "word binary, train long, total long, logp double")
        .withColumn("base", base(F.col("train"))), "lm-scored")
    hot = (scored.filter(F.octet_length("word") <= HOT_BYTES)
           .orderBy(F.desc("total"), "word").limit(HOT).select("word", "train", "base", "logp").toArrow())
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text", "held_out").mapInArrow(
        lambda it: _documents(it, hot), _DOC)
    rare = scored.select(F.col("word").alias("_w"), F.col("train").alias("_c"),
                         F.col("base").alias("_b"), F.col("logp").alias("_p"))
    joined = rows.join(rare, F.col("word") == F.col("_w"), "left")
    times = F.when(F.col("_w").isNotNull(), F.col("n")).otherwise(0)
    ln10 = float(np.log(10.0))
    sums = joined.groupBy("row", "doc_id", "held_out").agg(
        F.sum(F.col("n_tokens")).alias("words"),
        F.sum(F.col("n_known") + F.when(F.col("_c") > 0, times).otherwise(0)).alias("known"),
        F.sum(F.col("base") + F.coalesce(times * F.col("_b"), F.lit(0.0))).alias("base"),
        F.sum(F.col("score") + F.coalesce(times * F.col("_p"), F.lit(0.0))).alias("score"))
    return sums.select(
        "doc_id", "held_out", (F.col("words") + 1).alias("n_tokens"),
        (F.col("known") + int(ends > 0)).alias("n_known"), F.lit(int(n)).cast("long").alias("train_tokens"),
        (F.col("base") + base(F.lit(float(ends)))).alias("base_score"),
        ((F.col("score") + end) / ln10).alias("score"))
