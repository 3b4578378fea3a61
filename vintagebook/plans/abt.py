"""Analytical base table: label LEFT JOIN feature books, split out of time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..operators.joins import abt_join
from ..operators.select import partition_range, time_split


def build_abt(target: DataFrame, books: Sequence[DataFrame], safra_range: tuple[int, int],
              keys: Sequence[str] = ("seller_id", "safra")) -> DataFrame:
    """Books and label restricted to the vintage range (literal bounds reach
    the partitioned scans), joined on (entity, safra)."""
    t = partition_range(target, "safra", *safra_range)
    bs = [partition_range(b, "safra", *safra_range) for b in books]
    return abt_join(t, bs, keys)


def abt_train_test(abt: DataFrame, train: tuple[int, int], test: tuple[int, int]
                   ) -> tuple[DataFrame, DataFrame]:
    return time_split(abt, "safra", train, test)
