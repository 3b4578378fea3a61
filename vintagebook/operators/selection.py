"""The first n rows in the order of a hash, without merging n rows of every task.

``orderBy().limit(n)`` lets each task send n rows to one.  Here rows are counted
per prefix of their hash and the prefix that holds the n-th row is cut further,
until the hash of the n-th row is known; the result is a filter on it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 16
# Rows with the cut's own prefix that one task may order.
CUT_ROWS = 100_000


def first_by_hash(df: DataFrame, n: int, key: Sequence[str], seed: int = 42) -> DataFrame:
    """The ``n`` rows of ``df`` with the smallest (hash of ``key``, hash of the whole
    row); all of them when there are no more.  The same rows on every run, in no
    order; of equal rows any.

    Every pass tells 16 more bits apart and returns at most 65,536 counts; up to
    10^9 rows one is enough, up to 10^14 two.  A hot key's rows are cut by the hash of
    the row.  No task orders more than ``CUT_ROWS`` rows, and only where more than
    that are equal does ``limit`` merge them.  The result is one scan, no shuffle."""
    if n <= 0:
        return df.limit(0)
    h1 = F.xxhash64(*[F.col(f"`{k}`") for k in key], F.lit(seed))
    h2 = F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])), F.lit(seed))
    cut, left, count = df.select(h1.alias("h1"), h2.alias("h2")), n, None
    for h in ("h1", "h2"):
        for shift in range(64 - BITS, -1, -BITS):
            if count is not None and count <= CUT_ROWS:
                break
            at = F.shiftright(h, shift)
            cell = None
            for cell, count in sorted(cut.groupBy(at.alias("at")).agg(F.count(F.lit(1))).collect()):
                if count >= left:
                    break
                left -= count
            else:
                return df  # no more than n rows
            cut = cut.filter(at == cell)
    if count <= CUT_ROWS:
        top = cut.orderBy("h1", "h2").limit(left).groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("rows"))
        t1, t2, left = top.agg(F.max(F.struct("h1", "h2", "rows")).alias("s")).select("s.*").first()
        count = cut.filter((F.col("h1") == t1) & (F.col("h2") == t2)).count()
    else:
        t1, t2 = cut.first()
    if count == left:
        return df.filter((h1 < t1) | ((h1 == t1) & (h2 <= t2)))
    return (df.filter((h1 < t1) | ((h1 == t1) & (h2 < t2)))
            .unionAll(df.filter((h1 == t1) & (h2 == t2)).limit(left)))
