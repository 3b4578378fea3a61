"""Broadcast only what is proven small; otherwise let the planner shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows above which a lookup/fit table is joined by shuffle instead of broadcast.
DEFAULT_MAX_BROADCAST_ROWS = 100_000


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast when it has at most ``max_rows`` rows.

    The check runs ``limit(max_rows + 1).count()``: it reads at most
    ``max_rows + 1`` rows, so it stays cheap however large ``df`` is.  Above
    the bound the plain DataFrame is returned and Catalyst/AQE pick a
    shuffle join.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def with_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Append the columns of a one-row DataFrame (a global aggregate) to every
    row of ``df``.

    The row is a single scalar subquery: computed once, its size bound is
    enforced by Spark (more than one row is a runtime error), and ``df`` is
    neither joined nor shuffled.
    """
    row = one_row.select(F.struct(*[F.col(c) for c in one_row.columns]).alias("_row")).scalar()
    return df.select("*", row.alias("_row")).select(*[F.col(c) for c in df.columns], "_row.*")
