"""Inactivity label: was the entity silent in the months after the reference safra?"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import month_index, shift_safra_value
from ..functions.hashing import row_hash


def inactivity_target(fact: DataFrame, entity: str, safra_col: str = "safra",
                      safra: int | None = None, horizon: int = 2,
                      safras: Sequence[int] | None = None,
                      flag_name: str = "flag_sem_venda_2m", with_hash: bool = True) -> DataFrame:
    """(entity, safra, flag): flag 1 when the entity, active in ``safra``, has
    no activity in the ``horizon`` following months (safra, safra + horizon].

    * one ``safra``: the rows of [safra, safra + horizon] are grouped once by
      entity; "active in safra" and "active later" are two conditional
      maxima of the same aggregation (no join).
    * every safra at once (``safra=None``): distinct (entity, month) pairs,
      then ``lead`` of the month index per entity; the window sees at most
      one row per month per entity, so a hot entity stays small.
    ``safras`` restricts the output to those reference months.
    """
    e, s = F.col(entity), F.col(safra_col)
    if safra is not None:
        hi = shift_safra_value(safra, horizon)
        g = (fact.filter(s.between(safra, hi)).groupBy(entity)
             .agg(F.max(F.when(s == safra, 1).otherwise(0)).alias("_now"),
                  F.max(F.when(s > safra, 1).otherwise(0)).alias("_later")))
        out = g.filter(F.col("_now") == 1).select(
            e, F.lit(safra).cast("int").alias(safra_col),
            (F.lit(1) - F.col("_later")).cast("int").alias(flag_name))
    else:
        pairs = fact.select(entity, s.cast("int").alias(safra_col)).distinct()
        if safras is not None:
            lo, hi = min(safras), shift_safra_value(max(safras), horizon)
            pairs = pairs.filter(F.col(safra_col).between(lo, hi))
        idx = month_index(safra_col)
        nxt = F.lead(idx).over(Window.partitionBy(entity).orderBy(safra_col))
        out = pairs.select(e, F.col(safra_col), (nxt - idx).alias("_gap"))
        out = out.select(e, F.col(safra_col),
                         F.when(F.col("_gap").isNotNull() & (F.col("_gap") <= horizon), 0)
                         .otherwise(1).cast("int").alias(flag_name))
        if safras is not None:
            out = out.filter(F.col(safra_col).isin([int(x) for x in safras]))
    if with_hash:
        out = out.withColumn("row_hash", row_hash([entity, safra_col, flag_name], out))
    return out
