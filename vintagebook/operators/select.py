"""Projections, filters and column bookkeeping."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


def filter_not_null_key(df: DataFrame, key: str) -> DataFrame:
    return df.filter(F.col(key).isNotNull())


def incremental_window(df: DataFrame, ts_col: str, as_of, days: int = 90) -> DataFrame:
    """Rows ingested in the last ``days`` days before ``as_of`` (a batch filter).

    ``as_of`` is a parameter (date/datetime/string), never the wall clock, so
    reruns select the same rows.
    """
    if isinstance(as_of, (_dt.date, _dt.datetime)):
        as_of = as_of.isoformat(sep=" ") if isinstance(as_of, _dt.datetime) else as_of.isoformat()
    return df.filter(F.col(ts_col) >= F.date_sub(F.to_date(F.lit(str(as_of))), int(days)))


def filter_status_range(df: DataFrame, status_col: str | None = None, status=None,
                        safra_col: str = "safra", safras: Iterable[int] | None = None,
                        between: tuple[int, int] | None = None) -> DataFrame:
    """Equality / IN / BETWEEN filters with literal values (pushed to the scan)."""
    if status_col is not None and status is not None:
        df = df.filter(F.col(status_col) == F.lit(status))
    if safras is not None:
        df = df.filter(F.col(safra_col).isin([int(s) for s in safras]))
    if between is not None:
        df = df.filter(F.col(safra_col).between(int(between[0]), int(between[1])))
    return df


def partition_range(df: DataFrame, col: str, lo, hi) -> DataFrame:
    """Conjunctive ``lo <= col <= hi``; on a partition column this prunes directories."""
    return df.filter((F.col(col) >= F.lit(lo)) & (F.col(col) <= F.lit(hi)))


def time_split(df: DataFrame, safra_col: str, train: tuple[int, int], test: tuple[int, int]
               ) -> tuple[DataFrame, DataFrame]:
    """Out-of-time split with integer vintage bounds (inclusive)."""
    return partition_range(df, safra_col, *train), partition_range(df, safra_col, *test)


def drop_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Drop by name, case-insensitive, ignoring names that are absent."""
    low = {c.lower() for c in cols}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in low])


def rename_as_var(df: DataFrame, target: str, prefix: str = "VAR_"
                  ) -> tuple[DataFrame, DataFrame]:
    """Rename every feature to VAR_1..VAR_n (target kept); returns (df, mapping)."""
    names, pairs, i = [], [], 0
    for c in df.columns:
        if c == target:
            names.append(c)
        else:
            i += 1
            names.append(f"{prefix}{i}")
            pairs.append((c, f"{prefix}{i}"))
    mapping = df.sparkSession.createDataFrame(pairs, "original string, renamed string")
    return df.toDF(*names), mapping


def split_features(df: DataFrame, exclude: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """(numeric columns, other columns) from the schema; no job runs."""
    num, cat = [], []
    for f in df.schema.fields:
        if f.name in exclude:
            continue
        (num if isinstance(f.dataType, NumericType) else cat).append(f.name)
    return num, cat


def split_by_cardinality(profile: DataFrame, threshold: int = 20) -> DataFrame:
    """Label columns of a :func:`column_profile` as numeric / low / high cardinality."""
    is_num = F.col("dtype").rlike("^(tinyint|smallint|int|bigint|float|double|decimal)")
    return profile.select(
        "variable",
        F.when(is_num, F.lit("numeric"))
        .when(F.col("cardinality") < threshold, F.lit("low_cardinality"))
        .otherwise(F.lit("high_cardinality")).alias("group"))
