"""Removal of repeated passages by sliding sentence spans.

A text is cut into sentences (at line ends and after ``. ! ?`` before white
space; a sentence of over ``LONG`` words is cut further after commas, at
words chosen by their hash and at the least hash of every ``LONG`` words in a
row, so that the cuts depend on the words around them only and no part is much
longer).  Two texts that share a passage thus share a cut within ``LONG`` words
of both its ends, and of 51 words 21 are left between them.  The runs of at least two sentences
and ``min_words`` words are the passages.  Hashed are the shortest one from
every sentence on and the shortest one up to every sentence: where a longer
run repeats, those inside it repeat too and cover it from end to end, so
what is removed is what hashing every run would remove.  Runs are joined
globally: a run stays in the document with the smallest id that holds it, at
its first place there; all sentences covered by any other occurrence are removed.

Defined cases: a null text stays null, an empty one empty; A-Z and white
space are not told apart; texts shorter than a run are never touched; an
exact copy keeps only what no run covers; rows with one id count as one
document (runs they share stay in each, but not twice in one row); rows
without an id give way to rows with one and never to each other; an empty
table gives an empty result; extra columns are kept (``n_removed``,
``_id`` and ``_runs`` may not be among them: ValueError).

Texts are taken a slice at a time: cuts, hashes and runs are computed for all
its words and sentences together, as arrays.  A run's first owner is a hash aggregation with map-side partials, and the
runs are joined with it by shuffle, where a run found in a third of the
documents is split by the skew-join rule.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, reserve, text_slices, tidy

LONG = 15
SLICE = 2_000_000  # bytes of text whose words are laid out as arrays at once
_WORD, _MARK, _SPACE, _LINE = range(4)
_KIND = np.zeros(256, np.uint8)
_KIND[list(b".!?")] = _MARK
_KIND[list(b" \t\v\f\r")] = _SPACE
_KIND[list(b"\n")] = _LINE
_COMMA = np.zeros(256, bool)
_COMMA[list(b",;:")] = True
WIDE = 64  # bytes; longer words are hashed one by one
# the step of CRC-32 for a byte: zlib's checksum, its final inversion taken back
_CRC = np.array([zlib.crc32(bytes([i]), 0xFFFFFFFF) ^ 0xFFFFFFFF for i in range(256)], np.uint32)
_GOLD = 0x9E3779B97F4A7C15
_LOW = np.uint64((1 << 32) - 1)


def _mix(hashes: np.ndarray, place: np.ndarray | int) -> np.ndarray:
    """Hashes of (hash, place): their sum over a sequence is its hash."""
    if isinstance(place, int):
        x = hashes + np.uint64(place * _GOLD % (1 << 64))
    else:
        x = hashes + place.astype(np.uint64) * np.uint64(_GOLD)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _by_hand(out: np.ndarray, digest, low: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``out`` with the digests of the words of over ``WIDE`` bytes, one at a
    time; returns the places of the others."""
    for i in np.flatnonzero(size > WIDE).tolist():
        out[i] = digest(low[start[i]:start[i] + size[i]])
    return np.flatnonzero(size <= WIDE)


def _hashes(low: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hashes of words, by 8 bytes at a time of all of them."""
    out = _mix(np.zeros(len(start), np.uint64), size)
    left, k = _by_hand(out, xxhash.xxh64_intdigest, low, start, size), 0
    padded = np.concatenate((low, np.zeros(8, np.uint8)))
    eight = np.ndarray(len(low), "<u8", padded, strides=(1,))  # the 8 bytes from every byte on
    while len(left):
        over = np.maximum(8 * (k + 1) - size[left], 0).astype(np.uint64) * np.uint64(8)
        out[left] += _mix(eight[start[left] + 8 * k] << over, k)
        k += 1
        left = left[size[left] > 8 * k]
    return out


def _crc32(low: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``zlib.crc32`` of words, by a byte at a time of all of them."""
    out = np.zeros(len(start), np.uint32)
    left, k = _by_hand(out, zlib.crc32, low, start, size), 0
    out[left] = ~out[left]
    while len(left):
        crc = out[left]
        crc = _CRC[(crc ^ low[start[left] + k]) & np.uint32(255)] ^ crc >> np.uint32(8)
        k += 1
        more = size[left] > k
        out[left] = np.where(more, crc, ~crc)
        left = left[more]
    return out.astype(np.uint64)


def _cuts(hashes: np.ndarray, comma: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The words after which overlong sentences are cut, given the words of
    these sentences, one after another, and how many each has: words before a
    comma or with a hash for it, and between two of those (or a sentence's
    ends) the last of the least hashes of every ``LONG`` words in a row, the
    last word left out."""
    cut = comma | (hashes % np.uint64(8) == 0)
    last = cut.copy()
    last[np.cumsum(counts) - 1] = True
    least, width = hashes << np.uint64(32) | (_LOW - np.arange(len(hashes), dtype=np.uint64)), 1
    while 2 * width <= LONG:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rows = len(hashes) - LONG + 1
    least = np.minimum(least[:rows], least[LONG - width:])
    before = np.concatenate(([0], np.cumsum(last)))
    least = least[before[LONG:] == before[:-LONG]]
    cut[(_LOW - (least & _LOW)).astype(np.int64)] = True
    return np.flatnonzero(cut)


def _sentences(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(stops, words, hashes, bounds): text i has the sentences from bounds[i]
    to bounds[i + 1]; each starts where the last one of its text stops."""
    low = np.frombuffer(b"\n".join([*texts, b""]).lower(), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes + 1) - 1  # of the texts; a line end follows each
    kind = _KIND[low]
    inside = kind < _SPACE
    edges = np.flatnonzero(np.diff(inside, prepend=False))
    start, stop = edges[::2], edges[1::2]  # of the words

    closes = kind == _LINE  # bytes that end a sentence
    closes[:-1] |= (kind[:-1] == _MARK) & ~inside[1:]
    closes[ends] = False
    closes[ends[sizes > 0] - 1] = True
    counts = np.diff(np.searchsorted(start, np.flatnonzero(closes) + 1), prepend=0)
    long = np.flatnonzero(np.repeat(counts > LONG, counts))
    if len(long):
        cut = _cuts(_crc32(low, start[long], (stop - start)[long]), _COMMA[low[stop[long] - 1]],
                    counts[counts > LONG])
        closes[stop[long[cut]] - 1] = True

    stops = np.flatnonzero(closes) + 1
    before = np.searchsorted(start, stops)
    counts = np.diff(before, prepend=0)
    first = before - counts
    hashes = np.zeros(len(stops), np.uint64)
    if len(start):
        words = _mix(_hashes(low, start, stop - start),
                     np.arange(len(start)) - np.repeat(first, counts))
        hashes[counts > 0] = np.add.reduceat(words, first[counts > 0])
    bounds = np.concatenate(([0], np.searchsorted(stops, ends, "right")))
    return stops - np.repeat(ends - sizes, np.diff(bounds)), counts, hashes, bounds


def _runs(words: np.ndarray, hashes: np.ndarray, bounds: np.ndarray, min_words: int
          ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first sentence, last sentence + 1, bounds) of the runs of texts
    whose sentences are given, in text order: the shortest from every sentence
    on and the shortest up to every sentence.  Sentences without words are
    skipped over and belong to no run's ends."""
    real = np.flatnonzero(words)
    edge = np.searchsorted(real, bounds)
    sums = np.concatenate(([0], np.cumsum(words[real])))
    at = np.arange(len(real))
    z = np.maximum(np.searchsorted(sums, sums[:-1] + min_words), at + 2)
    a = np.minimum(np.searchsorted(sums, sums[1:] - min_words, "right") - 1, at - 1)
    on, up = z <= np.repeat(edge[1:], np.diff(edge)), a >= np.repeat(edge[:-1], np.diff(edge))
    spans = np.sort(np.concatenate((at[on] << 32 | z[on], a[up] << 32 | at[up] + 1)), kind="stable")
    spans = spans[np.diff(spans, prepend=-1) != 0]
    a, z = spans >> 32, spans & (1 << 32) - 1
    mixed, out, left, k = hashes[real], np.zeros(len(a), np.uint64), np.arange(len(a)), 0
    while len(left):
        out[left] += _mix(mixed[a[left] + k], k)
        k += 1
        left = left[a[left] + k < z[left]]
    return out.view(np.int64), real[a], real[z - 1] + 1, np.searchsorted(a, edge)


def sentences(text: bytes) -> list[tuple[int, int, int]]:
    """(stop, words, hash) of a text's sentences."""
    stops, words, hashes, _ = _sentences([text])
    return list(zip(stops.tolist(), words.tolist(), hashes.tolist()))


def runs(units: list[tuple[int, int, int]], min_words: int) -> list[tuple[int, int, int]]:
    """(hash, first sentence, last sentence + 1) of the runs of a text's sentences."""
    words, hashes = np.array([u[1] for u in units], np.int64), np.array([u[2] for u in units], np.uint64)
    found, a, z, _ = _runs(words, hashes, np.array([0, len(units)]), min_words)
    return list(zip(found.tolist(), a.tolist(), z.tolist()))


def _spans(batches: Iterator[pa.RecordBatch], min_words: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, run, again): the runs of each text, once each; ``again``: it
    holds the run more than once."""
    for b in (s for whole in tidy(batches) for s in text_slices(whole, 1, SLICE)):
        texts = [t or b"" for t in b.column(1).cast(pa.binary()).to_pylist()]
        found, _, _, bounds = _runs(*_sentences(texts)[1:], min_words)
        for s, e in zip(bounds.tolist(), bounds[1:].tolist()):
            found[s:e].sort()
        at = np.repeat(np.arange(len(texts)), np.diff(bounds))
        new = np.ones(len(found), bool)
        new[1:] = (found[1:] != found[:-1]) | (at[1:] != at[:-1])
        first = np.flatnonzero(new)
        again = np.diff(first, append=len(found)) > 1
        yield pa.RecordBatch.from_arrays(
            [b.column(0).take(pa.array(at[first])), pa.array(found[first]), pa.array(again)],
            names=["doc_id", "run", "again"])


def _without(text: bytes, stops: list[int], found: Iterator[tuple[int, int, int]],
             own: dict[int, bool]) -> tuple[bytes, int]:
    """The text without the sentences that listed runs cover, and their number."""
    covered, seen = bytearray(len(stops)), set()
    for h, a, z in found:
        if h in own:
            if not own[h] or h in seen:
                covered[a:z] = b"\1" * (z - a)
            seen.add(h)
    return (b"".join(text[s:e] for s, e, c in zip([0, *stops], stops, covered) if not c),
            sum(covered))


def _rewrite(batches: Iterator[pa.RecordBatch], text_at: int, runs_at: int, min_words: int
             ) -> Iterator[pa.RecordBatch]:
    for b in (s for whole in tidy(batches) for s in text_slices(whole, text_at, SLICE)):
        new, listed = b.column(text_at).cast(pa.binary()).to_pylist(), b.column(runs_at).to_pylist()
        removed = np.zeros(len(new), np.int32)
        rows = [i for i, (text, found) in enumerate(zip(new, listed)) if text and found]
        if rows:
            stops, words, hashes, units = _sentences([new[i] for i in rows])
            found, a, z, bounds = _runs(words, hashes, units, min_words)
            for k, i in enumerate(rows):
                mine, base = slice(bounds[k], bounds[k + 1]), units[k]
                new[i], removed[i] = _without(
                    new[i], stops[base:units[k + 1]].tolist(),
                    zip(found[mine].tolist(), (a[mine] - base).tolist(), (z[mine] - base).tolist()),
                    {x["run"]: x["own"] for x in listed[i]})
        cols = [pa.array(new, pa.binary()).cast(pa.string()) if i == text_at else c
                for i, c in enumerate(b.columns) if i != runs_at]
        names = [n for i, n in enumerate(b.schema.names) if i != runs_at]
        yield pa.RecordBatch.from_arrays([*cols, pa.array(removed)], names=[*names, "n_removed"])


def repeated_runs(docs: DataFrame, min_words: int = 20) -> DataFrame:
    """(doc_id, runs): the runs that each document has from another one
    (``own`` false) or holds more than once itself (``own`` true: the first
    stays)."""
    found = materialize(docs.select("doc_id", "text").mapInArrow(
        lambda it: _spans(it, min_words), "doc_id long, run long, again boolean"), "span-runs")
    owners = (found.groupBy("run").agg(F.min("doc_id").alias("owner"),
                                       F.sum(F.when(F.col("again"), 2).otherwise(1)).alias("n"))
              .filter("n > 1").select(F.col("run").alias("_run"), "owner"))
    other = F.col("owner").isNotNull() & (F.col("doc_id").isNull() | (F.col("doc_id") > F.col("owner")))
    return (found.join(owners, F.col("run") == F.col("_run")).filter(other | F.col("again"))
            .groupBy("doc_id", "run").agg(F.min(~other).alias("own"))
            .groupBy("doc_id").agg(F.collect_list(F.struct("run", "own")).alias("runs")))


def remove_repeats(docs: DataFrame, min_words: int = 20) -> DataFrame:
    """``docs`` (doc_id, text and any others) with the repeated passages taken
    out of ``text``, and ``n_removed`` sentences."""
    reserve(docs, "n_removed", "_id", "_runs")
    drop = repeated_runs(docs, min_words).select(F.col("doc_id").alias("_id"), F.col("runs").alias("_runs"))
    joined = docs.join(drop, F.col("doc_id").eqNullSafe(F.col("_id")), "left").drop("_id")
    names = joined.columns
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields),
                        "n_removed int"])
    text_at, runs_at = names.index("text"), names.index("_runs")
    return joined.mapInArrow(lambda it: _rewrite(it, text_at, runs_at, min_words), schema)
