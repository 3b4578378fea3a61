"""Keep one row per key: the latest by an ordering (DESC NULLS LAST)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _order_spec(order: Sequence[str | tuple[str, str]]) -> list[tuple[str, str]]:
    out = []
    for o in order:
        if isinstance(o, str):
            out.append((o, "desc"))
        else:
            out.append((o[0], o[1].lower()))
    return out


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str | tuple[str, str]],
                 method: str = "aggregate") -> DataFrame:
    """One row per ``keys``: the first under ``ORDER BY order DESC NULLS LAST``.

    ``method="aggregate"`` (default) keeps the winner with ``max(struct(order,
    rest))`` in a ``groupBy``: struct order puts NULL lowest, so ``max`` is
    exactly DESC NULLS LAST, ties on the order columns are broken by the
    remaining columns (deterministic), and partial aggregation runs
    map-side, so a key holding a third of the table never reaches one task
    as raw rows.  ``method="window"`` is the ``row_number()`` form (needed
    for ascending orders).
    """
    spec = _order_spec(order)
    if method == "window" or any(d != "desc" for _, d in spec):
        w = Window.partitionBy(*keys).orderBy(
            *[F.col(c).desc_nulls_last() if d == "desc" else F.col(c).asc_nulls_first()
              for c, d in spec])
        return (df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1)
                .drop("_rn"))
    order_cols = [c for c, _ in spec]
    rest = [c for c in df.columns if c not in keys and c not in order_cols]
    packed = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order_cols)],
                      *[F.col(c) for c in rest])
    win = df.groupBy(*keys).agg(F.max(packed).alias("_w"))
    return win.select(*[F.col(k) for k in keys],
                      *[F.col(f"_w._o{i}").alias(c) for i, c in enumerate(order_cols)],
                      *[F.col(f"_w.{c}") for c in rest]).select(*df.columns)


def drop_duplicates_keep_last(df: DataFrame, subset: Sequence[str],
                              order: Sequence[str | tuple[str, str]]) -> DataFrame:
    """pandas ``drop_duplicates(keep='last')`` with an explicit order (no row index)."""
    return dedup_latest(df, subset, order)
