"""Packing token sequences by minimum bin slack.

A document's ids are cut into full windows and a tail.  Tails are packed by
their lengths alone: a window starts with the longest remaining length, and a
bitset subset-sum dynamic programme over the remaining lengths (with their
counts) finds the multiset that fills it closest to its capacity; the counts
are read back by walking the bitsets in reverse.  The pattern found is used
as often as the counts allow.  Where even the best filling leaves more than
``max_slack`` ids free, one more tail is cut to fill the window and its rest
goes back to the lengths.  When less than a window is left in all, windows
shrink to powers of two, which need no padding.

Only the histogram of tail lengths (fewer than ``width`` numbers) reaches the
driver; the plan has a few entries per length and pattern, independent of the
number of documents.  Documents are numbered within their length by
:func:`common.dense_positions` and find their place in the plan by
(length, number).

Defined cases: a null or empty text is its closing id alone; repeated rows
are packed each on its own; an empty table gives an empty result; extra
columns are ignored; a text of any length is cut into windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dense_positions, materialize, text_slices, tidy, word_table

CACHE_WORDS = 1_000_000  # of a worker, about 130 MB
LONG_WORD = 64


class WordEncoder:
    """Ids of a text as little-endian bytes, word by word.

    Equal to encoding the text at once for a tokenizer whose pre-tokenizer
    never lets a token hold white space; frequent words come from a cache."""

    def __init__(self, path: str):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        # words of the last batches, and older ones that drop out unless met again
        self.cache: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def _ids(self, words: list[bytes]) -> list[bytes]:
        made = self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)
        return [np.array(e.ids, self.dtype).tobytes() for e in made]

    def encode(self, texts: pa.Array) -> pa.Array:
        """The texts' ids; distinct words are looked up once a batch and laid
        out word after word, so that a text is a stretch of the result."""
        starts, index, found = word_table(texts)
        words = found.cast(pa.large_binary()).to_pylist()
        if len(self.cache) > CACHE_WORDS // 2:
            self.cache, self.older = {}, self.cache
        known, older = self.cache, self.older
        ids = list(map(known.get, words))
        gaps = []
        for i, x in enumerate(ids):
            if x is None:
                ids[i] = x = older.get(words[i])
                if x is None:
                    gaps.append(i)
                else:
                    known[words[i]] = x
        for k in range(0, len(gaps), 20_000):
            part = gaps[k:k + 20_000]
            for i, x in zip(part, self._ids([words[i] for i in part])):
                ids[i] = x
                if len(words[i]) <= LONG_WORD:
                    known[words[i]] = x
        laid = pa.array(ids, pa.large_binary()).take(pa.array(index))
        _, offsets, data = laid.buffers()
        ends = np.frombuffer(offsets, np.int64)[laid.offset:][starts]
        return pa.Array.from_buffers(pa.large_binary(), len(texts),
                                     [None, pa.py_buffer(ends.astype(np.int64)), data])


_ENCODERS: dict[str, WordEncoder] = {}


def _encode(batches: Iterator[pa.RecordBatch], path: str, close: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, ids, n_ids), with the id ``close`` at the end."""
    if path not in _ENCODERS:  # kept between tasks of one worker, with its word cache
        _ENCODERS[path] = WordEncoder(path)
    enc = _ENCODERS[path]
    size, wide = enc.dtype.itemsize, pa.large_binary()
    end = pa.scalar(close.to_bytes(size, "little"), wide)
    for b in tidy(batches):
        for part in text_slices(b, 1):
            ids = pc.binary_join_element_wise(enc.encode(part.column(1)), end, pa.scalar(b"", wide))
            n_ids = np.asarray(pc.binary_length(ids)).astype(np.int64) // size
            yield pa.RecordBatch.from_arrays([part.column(0), ids.cast(pa.binary()), pa.array(n_ids)],
                                             names=["doc_id", "ids", "n_ids"])


def encode_documents(docs: DataFrame, tokenizer: str, close: int) -> DataFrame:
    """(doc_id, ids, n_ids): ids in the tokenizer's narrowest width, ``close`` last.
    Only tasks load the tokenizer, which would stay in the driver's memory."""
    return docs.select("doc_id", "text").mapInArrow(
        lambda it: _encode(it, tokenizer, int(close)), "doc_id long, ids binary, n_ids long")


def fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset of lengths (length -> times) with the largest sum up to
    ``capacity``: bitset subset sums, one bitset per (length, power-of-two
    share of its count), walked back for the counts."""
    reach, steps = 1, []
    mask = (1 << (capacity + 1)) - 1
    for length in sorted(counts, reverse=True):
        left, share = min(counts[length], capacity // length), 1
        while left > 0 and not reach >> capacity & 1:
            times = min(share, left)
            steps.append((length, times, reach))
            reach |= reach << (length * times) & mask
            left, share = left - times, share * 2
        if reach >> capacity & 1:
            break
    at, used = reach.bit_length() - 1, {}
    for length, times, before in reversed(steps):
        if not before >> at & 1:
            used[length] = used.get(length, 0) + times
            at -= length * times
    return used


def plan(histogram: dict[int, int], width: int, max_slack: int = 32) -> np.ndarray:
    """Entries (length, first number, copies, times, first window, offset, take,
    rest's first number) sorted by (length, first number): the numbers first ..
    first + copies * times - 1 of a length go, ``times`` to a window, to the
    windows from the first on, at ``offset``.  With ``take`` < length only that
    many ids go there; the rest is a tail of its own, numbered from the last
    field on."""
    left = {n: c for n, c in histogram.items() if c > 0}
    taken = dict.fromkeys(left, 0)
    made = dict(left)
    entries, window = [], 0
    total = sum(n * c for n, c in left.items())
    while total:
        size = width
        if total < width - max_slack:
            size = 1 << (total.bit_length() - 1)
        longest = max(left)
        if longest <= size:
            rest = {n: c for n, c in left.items() if n != longest or c > 1}
            if longest in rest:
                rest[longest] -= 1
            used = fill({n: c for n, c in rest.items() if n <= size - longest}, size - longest)
            used[longest] = used.get(longest, 0) + 1
        else:
            used = {}
        slack = size - sum(n * k for n, k in used.items())
        spare = {n: c - used.get(n, 0) for n, c in left.items() if c > used.get(n, 0) and n > slack}
        cut = max(spare) if spare and (slack > max_slack or size < width) and slack else None
        need = dict(used)
        if cut:
            need[cut] = need.get(cut, 0) + 1
        copies = min(left[n] // k for n, k in need.items())
        if size < width:
            copies = 1
        offset = 0
        for n, k in sorted(used.items(), reverse=True):
            entries.append((n, taken[n], copies, k, window, offset, n, 0))
            taken[n] += copies * k
            offset += n * k
        if cut:
            rest_of = cut - slack
            entries.append((cut, taken[cut], copies, 1, window, offset, slack, made.get(rest_of, 0)))
            taken[cut] += copies
            taken.setdefault(rest_of, 0)
            made[rest_of] = made.get(rest_of, 0) + copies
            left[rest_of] = left.get(rest_of, 0) + copies
            total += rest_of * copies
        for n, k in need.items():
            left[n] -= copies * k
            total -= n * copies * k
            if not left[n]:
                del left[n]
        window += copies
    return np.array(sorted(entries), np.int64).reshape(-1, 8)


def _place(batches: Iterator[pa.RecordBatch], entries: np.ndarray, width: int, shift: int
           ) -> Iterator[pa.RecordBatch]:
    """Pieces of (row, cls, n_ids, position): full windows and placed tails."""
    keys = entries[:, 0] << 44 | entries[:, 1]
    for b in batches:
        row, cls, size, number = (c.to_numpy(zero_copy_only=False) for c in b.columns)
        full = cls == width
        times = (size // width)[full]
        step = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        parts = [(np.repeat(row[full], times), step * width, np.full(len(step), width),
                  np.repeat(number[full], times) + step + shift, np.zeros(len(step), np.int64))]
        tail = ~full
        r, n, k = row[tail], cls[tail], number[tail]
        start = size[tail] - n
        while len(r):
            e = entries[np.searchsorted(keys, n << 44 | k, "right") - 1]
            j = k - e[:, 1]
            parts.append((r, start, e[:, 6], e[:, 4] + j // e[:, 3], e[:, 5] + j % e[:, 3] * n))
            on = e[:, 6] < n
            r, start, k, n = r[on], (start + e[:, 6])[on], (e[:, 7] + j)[on], (n - e[:, 6])[on]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*parts)],
            names=["row", "start", "length", "sequence_id", "offset"])


def _widen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``ids`` of ``length`` numbers of any width, in 32 bits."""
    for b in batches:
        at = b.schema.get_field_index("ids")
        wide = [np.frombuffer(x, f"<u{len(x) // n}").astype("<u4").tobytes()
                for x, n in zip(b.column(at).to_pylist(), b.column("length").to_pylist())]
        yield pa.RecordBatch.from_arrays(
            [pa.array(wide, pa.binary()) if i == at else c for i, c in enumerate(b.columns)],
            names=b.schema.names)


def pack(docs: DataFrame, tokenizer: str, close: int, width: int = 4096, max_slack: int = 32
         ) -> DataFrame:
    """Pieces (doc_id, start, length, doc_tokens, sequence_id, offset, ids) of
    ``docs`` (doc_id, text); ``ids`` are little-endian unsigned 32-bit."""
    tokens = materialize(encode_documents(docs, tokenizer, close)
                         .withColumn("row", F.monotonically_increasing_id()), "pack-tokens")
    sizes = tokens.select("row", "n_ids", (F.col("n_ids") % width).alias("tail"))
    histogram = {r["tail"]: r["n"] for r in sizes.groupBy("tail").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    n_rows = sum(histogram.values())
    histogram.pop(0, None)
    entries = plan(histogram, width, max_slack)
    shift = int((entries[:, 4] + entries[:, 2]).max()) if len(entries) else 0
    # a document is an item of its tail's length, and as many of `width` as it has full windows
    items = sizes.select("row", "n_ids", F.explode(F.array(
        F.struct(F.col("tail").alias("cls"), F.lit(1).cast("long").alias("weight")),
        F.struct(F.lit(width).cast("long").alias("cls"),
                 F.floor(F.col("n_ids") / width).alias("weight")))).alias("i")
    ).select("row", "n_ids", "i.*").filter("weight > 0 and cls > 0")
    placed = dense_positions(items, "cls", "row", n_rows, weight="weight").select(
        "row", "cls", "n_ids", "position")
    pieces = placed.mapInArrow(
        lambda it: _place(it, entries, width, shift),
        "row long, start long, length long, sequence_id long, offset long")
    cut = tokens.join(pieces, "row").select(
        "doc_id", "start", "length", F.col("n_ids").alias("doc_tokens"), "sequence_id", "offset",
        F.expr("substring(ids, cast(start * (octet_length(ids) div n_ids) + 1 as int), "
               "cast(length * (octet_length(ids) div n_ids) as int))").alias("ids"))
    return cut.mapInArrow(_widen, cut.schema)
