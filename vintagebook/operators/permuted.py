"""Counts of the bins of permuted rows, for models that look at bins only.

For every (feature, repeat) each row is met by the value of another row, which a
bijection of all rows names (:func:`model.shuffled_position`; here the same one on
arrays).  Positions are cut into blocks; a task sends the bins and label of its rows
to the blocks of the rows they meet, sorted by block and packed, so that one record
holds many rows.  Where a block is, its rows' bins take the sent rows' place, and what
comes out is counted by (feature and repeat, bins, label): densely if the bins'
combinations are few, else row by row.  Only counts are scored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import task_slots
from .boosting import _binary, _joined
from .forest import bin_columns, binned

CHUNK = 1 << 17      # rows that a task deals to the blocks at a time
SLICE = 1 << 16      # rows whose places are computed at a time
BLOCK_BITS = 16, 22  # a block has 2^16 rows, more (up to 2^22) where there would be over 1,024 blocks
PIECE = 1 << 14      # dense counts of a record
DENSE, DENSE_ALL = 1 << 19, 1 << 24  # combinations of bins and label that are counted densely, for one permutation and all

# ------------------------------------------------------------------ xxhash64 of Spark, on arrays
_MASK = (1 << 64) - 1
_P1, _P2, _P3, _P4, _P5 = (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63,
                           0x27D4EB2F165667C5)


@lru_cache(1 << 16)
def _number(x: int) -> np.ndarray:
    return np.array(x, np.uint64)


def _turned(x: int, k: int) -> int:
    return (x << k | x >> (64 - k)) & _MASK


def _turn(h: np.ndarray, t: np.ndarray, k: int) -> None:
    np.right_shift(h, _number(64 - k), out=t)
    np.left_shift(h, _number(k), out=h)
    np.bitwise_or(h, t, out=h)


def _times(h: np.ndarray, by: int, plus: int = 0) -> None:
    np.multiply(h, _number(by), out=h)
    if plus:
        np.add(h, _number(plus), out=h)


def _finish(h: np.ndarray, t: np.ndarray) -> None:
    for shift, by in ((33, _P2), (29, _P3), (32, 1)):
        np.right_shift(h, _number(shift), out=t)
        np.bitwise_xor(h, t, out=h)
        if by != 1:
            _times(h, by)


def _hash_longs(h: np.ndarray, t: np.ndarray) -> None:
    """The values become their hashes, as the first argument of ``xxhash64``."""
    _times(h, _P2)
    _turn(h, t, 31)
    _times(h, _P1)
    np.bitwise_xor(h, _number(42 + _P5 + 8 & _MASK), out=h)
    _turn(h, t, 27)
    _times(h, _P1, _P4)
    _finish(h, t)


def _word(w: int) -> tuple[int, int, int, int]:
    return _turned(w * _P2 & _MASK, 31) * _P1 & _MASK, 27, _P1, _P4


@lru_cache(1 << 12)
def _steps(value: int | str) -> tuple[int, list[tuple[int, int, int, int]]]:
    """(number to add, [(number to xor, turn, factor, addend)]) of a further argument."""
    if isinstance(value, int):
        if -(1 << 31) <= value < 1 << 31:
            return _P5 + 4, [((value & 0xFFFFFFFF) * _P1 & _MASK, 23, _P2, _P3)]
        return _P5 + 8, [_word(value & _MASK)]
    b, steps, i = value.encode(), [], len(value.encode()) // 32 * 32
    for i in range(i, len(b) - 7, 8):
        steps.append(_word(int.from_bytes(b[i:i + 8], "little")))
    i = len(b) // 8 * 8
    if len(b) - i >= 4:
        steps.append((int.from_bytes(b[i:i + 4], "little") * _P1 & _MASK, 23, _P2, _P3))
        i += 4
    return len(b) + (_P5 if len(b) < 32 else 0), steps + [(c * _P5 & _MASK, 11, _P1, 0) for c in b[i:]]


def _stripes(h: np.ndarray, t: np.ndarray, b: bytes) -> None:
    """The words of a text of 32 bytes or more, up to the last whole 32."""
    four = [h + _number(x & _MASK) for x in (_P1 + _P2, _P2, 0, -_P1)]
    for i in range(0, len(b) // 32 * 32, 8):
        v = four[i // 8 % 4]
        np.add(v, _number(int.from_bytes(b[i:i + 8], "little") * _P2 & _MASK), out=v)
        _turn(v, t, 31)
        _times(v, _P1)
    h[:] = 0
    for v, k in zip(four, (1, 7, 12, 18)):
        w = v.copy()
        _turn(w, t, k)
        np.add(h, w, out=h)
    for v in four:
        _times(v, _P2)
        _turn(v, t, 31)
        _times(v, _P1)
        np.bitwise_xor(h, v, out=h)
        _times(h, _P1, _P4)


def _hash_on(h: np.ndarray, t: np.ndarray, values: Sequence[int | str]) -> None:
    """Hashes go on with further arguments."""
    for value in values:
        add, steps = _steps(value)
        if isinstance(value, str) and len(value.encode()) >= 32:
            _stripes(h, t, value.encode())
        np.add(h, _number(add & _MASK), out=h)
        for x, k, by, plus in steps:
            np.bitwise_xor(h, _number(x), out=h)
            _turn(h, t, k)
            _times(h, by, plus)
        _finish(h, t)


def shuffled_positions(pos: np.ndarray, n: int, key: Sequence[int | str], rounds: int = 24) -> np.ndarray:
    """:func:`model.shuffled_position` of an array."""
    n, out = max(n, 1), pos.astype(np.int64)
    mirrors = []
    for i in range(1, rounds + 1):
        h = np.array([42], np.uint64)
        _hash_on(h, np.empty_like(h), [i, *key])
        mirrors.append(int(h.view(np.int64)[0]) % n)
    for a in range(0, len(out), SLICE):
        x = out[a:a + SLICE]
        h, t, mirror = np.empty(len(x), np.uint64), np.empty(len(x), np.uint64), np.empty(len(x), np.int64)
        for i, at in enumerate(mirrors, 1):
            np.subtract(at, x, out=mirror)
            mirror += (mirror < 0) * n
            np.maximum(x, mirror, out=h.view(np.int64))
            _hash_longs(h, t)
            _hash_on(h, t, [i, *key])
            np.copyto(x, mirror, where=(h & _number(1)).astype(bool))
    return out


# ------------------------------------------------------------------ exchange
_SENT = "block int, what int, at binary, codes binary, label binary"
_COUNTED = "perm int, piece int, counts binary, codes binary, label double, n long"


def _sent(batches: Iterator[pa.RecordBatch], k: int, kind: str, n: int, bits: int, keys: Sequence[Sequence]) -> Iterator[pa.RecordBatch]:
    """Rows (pos, label, k bins) to blocks, by ``what``: -1, the block's own bins; 2 p,
    rows of label 0 or 1 that permutation p (0: none) sends there; 2 p + 1, of other labels."""
    blocks = (n >> bits) + 1

    def dealt(q: np.ndarray, what: int, codes: np.ndarray, label: np.ndarray) -> pa.RecordBatch:
        block = (q >> bits).astype(np.uint16 if blocks <= 1 << 16 else np.uint32)
        order = np.argsort(block, kind="stable")
        sizes = np.bincount(block, minlength=blocks)
        some = np.flatnonzero(sizes)
        ends = np.append(0, np.cumsum(sizes[some]))
        at = (q & ((1 << bits) - 1)).astype(np.uint16 if bits <= 16 else np.uint32)[order]
        return pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array(np.full(len(some), what, np.int32)), _binary(at, ends),
             _binary(codes[order].reshape(-1), ends * k), _binary(label[order], ends if len(label) else ends * 0)],
            names=["block", "what", "at", "codes", "label"])

    def of_chunk(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        b = pa.Table.from_batches(held).combine_chunks()
        col = lambda i: b.column(i).to_numpy()
        pos, label, known = col(0), col(1), b.column(1).is_valid().to_numpy()
        codes = np.stack([col(2 + i) for i in range(k)], axis=1).astype(kind) if k else np.zeros((len(pos), 0), kind)
        yield dealt(pos, -1, codes, label)
        two = (label == 0) | (label == 1)
        own = [(x, codes[x], y) for x, y in ((known & two, label[known & two].astype(np.uint8)),
                                            (known & ~two, label[known & ~two].astype(np.float64))) if x.any()]
        for p, key in enumerate([None, *keys]):
            q = pos if key is None else shuffled_positions(pos, n, key)
            for x, c, y in own:
                yield dealt(q[x], 2 * p + (y.dtype != np.uint8), c, y)

    held: list[pa.RecordBatch] = []
    for b in batches:
        held.append(b)
        if sum(x.num_rows for x in held) >= CHUNK:
            yield from of_chunk(held)
            held = []
    if sum(x.num_rows for x in held):
        yield from of_chunk(held)


def _met(batches: Iterator[pa.RecordBatch], k: int, kind: str, bits: int, columns: Sequence[int], sizes: Sequence[int]
         ) -> Iterator[pa.RecordBatch]:
    """Counts of what was sent, sorted by (block, what): permutation p takes its bins in
    column ``columns[p]`` (-1: none) from the rows it meets."""
    places, steps = _dense(sizes)
    dense, values = {}, np.zeros((1 << bits, k), kind)
    for b in batches:
        block, what = (b.column(i).to_numpy() for i in (0, 1))
        starts = np.flatnonzero(np.concatenate([[True], (block[1:] != block[:-1]) | (what[1:] != what[:-1])])[:len(what)])
        for a, z in zip(starts, [*starts[1:], len(what)]):
            run, w = b.slice(a, z - a), int(what[a])
            at = _joined(run.column(2), np.uint16 if bits <= 16 else np.uint32)
            codes = _joined(run.column(3), np.dtype(kind)).reshape(-1, k)
            if w < 0:
                values[at] = codes
                continue
            p, label = w >> 1, _joined(run.column(4), np.float64 if w & 1 else np.uint8)
            if (j := columns[p]) >= 0:
                codes = codes.copy()
                codes[:, j] = values[:, j].take(at)
            if w & 1 or not places or places * len(columns) > DENSE_ALL:
                yield _counted_rows(p, int(block[a]), codes, label.astype(np.float64))
            else:
                place = label.astype(np.int64)
                for i, step in enumerate(steps):
                    place += codes[:, i] * step
                found = np.bincount(place, minlength=places)
                dense[p] = dense[p] + found if p in dense else found
    for p, counts in dense.items():
        pieces = [(i, counts[i * PIECE:(i + 1) * PIECE]) for i in range(-(-places // PIECE))]
        pieces = [(i, x.tobytes()) for i, x in pieces if x.any()]
        m = len(pieces)
        yield pa.RecordBatch.from_arrays(
            [pa.array([p] * m, pa.int32()), pa.array([i for i, _ in pieces], pa.int32()), pa.array([x for _, x in pieces], pa.binary()),
             pa.nulls(m, pa.binary()), pa.nulls(m, pa.float64()), pa.nulls(m, pa.int64())],
            names=["perm", "piece", "counts", "codes", "label", "n"])


def _dense(sizes: Sequence[int]) -> tuple[int, list[np.int64]]:
    """How many places the combinations of bins and label (0, 1) have (0: too many),
    and a bin's step in them by feature."""
    places = 2 * math.prod(sizes)
    steps = [2 * math.prod(sizes[:i]) for i in range(len(sizes))]
    return (places, [np.int64(s) for s in steps]) if places <= DENSE else (0, [])


def _counted_rows(p: int, block: int, codes: np.ndarray, label: np.ndarray) -> pa.RecordBatch:
    m, width = len(codes), codes.shape[1] * codes.itemsize
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(m, p, np.int32)), pa.array(np.full(m, block, np.int32)), pa.nulls(m, pa.binary()),
         _binary(codes.reshape(-1).view(np.uint8), np.arange(m + 1) * width), pa.array(label), pa.array(np.ones(m, np.int64))],
        names=["perm", "piece", "counts", "codes", "label", "n"])


def _summed(batches: Iterator[pa.RecordBatch], k: int, kind: str, sizes: Sequence[int]) -> Iterator[pa.RecordBatch]:
    """(perm, bins..., label, n) of the counts in a task."""
    _, steps = _dense(sizes)
    sums: dict[tuple[int, int], np.ndarray] = {}

    def rows(perm: np.ndarray, codes: np.ndarray, label: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(perm, pa.int32()), *[pa.array(codes[:, i].astype(np.float64)) for i in range(k)],
             pa.array(label, pa.float64()), pa.array(n, pa.int64())], names=["perm", *bin_columns(sizes), "label", "n"])

    for b in batches:
        whole = b.column(2).is_valid().to_numpy(zero_copy_only=False)
        for p, piece, counts in zip(*(b.column(i).filter(pa.array(whole)).to_pylist() for i in range(3))):
            found = np.frombuffer(counts, np.int64)
            sums[p, piece] = sums[p, piece] + found if (p, piece) in sums else found
        if not whole.all():
            one = b.filter(pa.array(~whole))
            yield rows(one.column(0).to_numpy(), _joined(one.column(3), np.dtype(kind)).reshape(one.num_rows, k),
                       one.column(4).to_numpy(), one.column(5).to_numpy())
    for (p, piece), counts in sums.items():
        some = np.flatnonzero(counts)
        place = some + piece * PIECE
        codes = np.stack([place // s % size for s, size in zip(steps, sizes)], axis=1) if k else np.zeros((len(some), 0))
        yield rows(np.full(len(some), p, np.int32), codes, (place % 2).astype(np.float64), counts[some])


def permuted_counts(rows: DataFrame, n: int, model, features: Sequence[str], label: str, n_repeats: int, seed: int
                    ) -> DataFrame:
    """(perm, bins..., label, n) of the ``n`` ``rows`` with gapless positions ``_pos``: as
    they are (perm 0), and with ``features[f]`` permuted for the r-th time (perm
    1 + f * n_repeats + r).  The bins are those of the ``model``; rows without a label
    lend their values only."""
    k, sizes = len(model.cuts), [len(c) + 1 for c in model.cuts]
    kind = "u1" if max(sizes, default=1) <= 256 else "u2"
    keys = [(f, r, seed) for f in features for r in range(n_repeats)]
    columns = [-1, *(model.features.index(f) if f in model.features else -1 for f, _, _ in keys)]
    low, high = BLOCK_BITS
    bits = min(high, max(low, (n >> 10).bit_length()))
    spark = rows.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), task_slots(spark))
    in_bins = binned(rows, model.features, model.cuts).select("_pos", F.col(label).cast("double").alias("label"), *bin_columns(sizes))
    sent = in_bins.mapInArrow(lambda it: _sent(it, k, kind, n, bits, keys), _SENT)
    met = sent.repartition(tasks, "block").sortWithinPartitions("block", "what").mapInArrow(
        lambda it: _met(it, k, kind, bits, columns, sizes), _COUNTED)
    bins = ", ".join(f"{c} double" for c in bin_columns(sizes))
    counts = met.repartition(tasks, "perm", "piece").mapInArrow(
        lambda it: _summed(it, k, kind, sizes), f"perm int, {bins + ', ' if bins else ''}label double, n long")
    return counts.groupBy("perm", *bin_columns(sizes), "label").agg(F.sum("n").alias("n"))
