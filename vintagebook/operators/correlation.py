"""Pearson correlations of many columns in one scan.

Every pair's count, means and centred sums over the rows where both columns
are set are one mergeable state: a task folds its batches into it (matrix
products per batch, merged by the parallel-variance identity, so large means
cost no digits), and the tasks' states are added per column by one shuffle of
(columns x columns) numbers a task, whatever the rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Columns on one side of a block of pairs: six matrices of this many squared
# doubles (48 MB) are a task's state.  More columns take a scan per two blocks.
BLOCK = 1000
# Cells of a batch turned into a matrix at a time.
CELLS = 2_000_000
PARTS = ("n", "ma", "mb", "caa", "cbb", "cab")
# A standard deviation below this share of the mean is rounding.
FLAT = 1e-14


def _moments(a: np.ndarray, b: np.ndarray) -> list[np.ndarray]:
    """Counts, means and centred sums of the pairs (column of a, column of b);
    NaN is a missing value, a pair that meets an infinity has no sum."""
    def shifted(x):
        there = ~np.isnan(x)
        huge = np.isinf(x)
        from_ = np.take_along_axis(np.where(huge, 0.0, x), there.argmax(0)[None, :], 0)[0]
        from_ = np.nan_to_num(from_)
        return np.where(there & ~huge, x - from_, 0.0), there.astype(np.float64), huge, from_

    (xa, ia, ha, fa), (xb, ib, hb, fb) = shifted(a), shifted(b)
    n = ia.T @ ib
    some = np.maximum(n, 1)
    sa, sb = xa.T @ ib, ia.T @ xb
    qa, qb = (xa * xa).T @ ib, ia.T @ (xb * xb)
    tiny = 64 * np.finfo(float).eps
    caa, cbb = qa - sa * sa / some, qb - sb * sb / some
    caa[caa <= tiny * qa] = 0.0
    cbb[cbb <= tiny * qb] = 0.0
    cab = xa.T @ xb - sa * sb / some
    if ha.any() or hb.any():
        cab[(ha.astype(float).T @ ib + ia.T @ hb.astype(float)) > 0] = np.nan
    return [n, np.where(n > 0, fa[:, None] + sa / some, 0.0),
            np.where(n > 0, fb[None, :] + sb / some, 0.0), caa, cbb, cab]


def _merge(x: list[np.ndarray], y: list[np.ndarray]) -> list[np.ndarray]:
    n = x[0] + y[0]
    share = y[0] / np.maximum(n, 1)
    da = np.where((x[0] > 0) & (y[0] > 0), y[1] - x[1], 0.0)
    db = np.where((x[0] > 0) & (y[0] > 0), y[2] - x[2], 0.0)
    w = x[0] * share
    return [n, np.where(x[0] > 0, x[1] + da * share, y[1]), np.where(x[0] > 0, x[2] + db * share, y[2]),
            x[3] + y[3] + da * da * w, x[4] + y[4] + db * db * w, x[5] + y[5] + da * db * w]


def _rows(at: Sequence[int], state: list[np.ndarray]) -> pa.RecordBatch:
    width = state[0].shape[1]
    ends = pa.array(np.arange(len(at) + 1) * width, pa.int32())
    return pa.RecordBatch.from_arrays(
        [pa.array(at, pa.int32()), *[pa.ListArray.from_arrays(ends, pa.array(m.ravel())) for m in state]],
        names=["i", *PARTS])


def _fold(batches: Iterator[pa.RecordBatch], left: int) -> Iterator[pa.RecordBatch]:
    """A task's state, one row per column of the left block."""
    state = None
    for whole in batches:
        step = max(1, CELLS // whole.num_columns)
        for b in (whole.slice(s, step) for s in range(0, whole.num_rows, step)):
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in b.columns]).astype(float)
            part = _moments(x[:, :left], x[:, left:] if x.shape[1] > left else x)
            state = part if state is None else _merge(state, part)
    if state is not None:
        for s in range(0, left, 64):
            yield _rows(range(s, min(s + 64, left)), [m[s:s + 64] for m in state])


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The tasks' states of each column, merged."""
    states: dict[int, list[np.ndarray]] = {}
    for b in batches:
        for r in range(b.num_rows):
            part = [b.column(1 + k)[r].values.to_numpy(zero_copy_only=False)[None, :]
                    for k in range(len(PARTS))]
            i = b.column(0)[r].as_py()
            states[i] = _merge(states[i], part) if i in states else [m.copy() for m in part]
    for i, state in states.items():
        yield _rows([i], state)


def _block(df: DataFrame, a: Sequence[str], b: Sequence[str], tasks: int) -> DataFrame:
    """(a, b, corr) of the pairs between two column blocks, or within one."""
    cols = list(a) if a == b else [*a, *b]
    left = len(a)
    schema = "i int, " + ", ".join(f"{p} array<double>" for p in PARTS)
    cells = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    states = (cells.coalesce(tasks).mapInArrow(lambda it: _fold(it, left), schema)
              .repartition("i").mapInArrow(_add, schema))
    pairs = states.select("i", F.posexplode(F.arrays_zip(*PARTS)).alias("j", "s")).select("i", "j", "s.*")
    if a == b:
        pairs = pairs.filter("i < j")

    def flat(c: str, m: str):
        return F.col(c) <= F.col("n") * F.pow(FLAT * F.abs(F.col(m)), F.lit(2))

    corr = F.col("cab") / F.sqrt(F.col("caa")) / F.sqrt(F.col("cbb"))
    corr = F.least(F.greatest(corr, F.lit(-1.0)), F.lit(1.0))
    corr = F.when(flat("caa", "ma") | flat("cbb", "mb") | F.isnan("cab"), None).otherwise(corr)

    def names(block: Sequence[str], at: str):
        return F.get(F.array(*[F.lit(c) for c in block]), F.col(at))

    return pairs.select(names(a, "i").alias("a"), names(b, "j").alias("b"),
                        corr.alias("corr"))


def correlation_pairs(df: DataFrame, cols: Sequence[str], block: int = BLOCK, tasks: int = 4096
                      ) -> DataFrame:
    """(a, b, corr) for every pair a before b, over the rows where both are set
    (pairwise, as pandas does; NaN is missing); NULL when either is constant
    there, when no row has both, or when one is infinite there.

    One scan for up to ``block`` columns, else one for every two blocks.
    ``tasks`` bounds the states that are shuffled (input splits beyond it share
    a task, without a shuffle)."""
    blocks = [list(cols[k:k + block]) for k in range(0, len(cols), block)]
    parts = [_block(df, a, b, tasks) for i, a in enumerate(blocks) for b in blocks[i:]]
    if not parts:
        return df.sparkSession.createDataFrame([], "a string, b string, corr double")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
