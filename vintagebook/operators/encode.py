"""Encoders, scalers and feature selection with fitted state as small tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .bounded import bounded_broadcast, with_row
from .correlation import correlation_pairs
from .prefix import exact_quantiles


# ---------------------------------------------------------------- one-hot
def one_hot_fit(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(variable, value): sorted distinct non-null categories per column."""
    long = (df.select(*[F.col(c).cast("string").alias(c) for c in cols])
            .unpivot([], list(cols), "variable", "value").filter(F.col("value").isNotNull()))
    return long.distinct()


def one_hot_apply(df: DataFrame, fit: DataFrame | Mapping[str, Sequence[str]],
                  cols: Sequence[str] | None = None, drop_first: bool = False,
                  keep_original: bool = False, dtype: str = "int") -> DataFrame:
    """``col_value`` 0/1 columns from fitted categories; unknown/NULL -> all 0.
    Fails when a fitted column is missing from ``df``."""
    if isinstance(fit, DataFrame):
        cats: dict[str, list[str]] = {}
        for r in fit.orderBy("variable", "value").collect():  # one row per category
            cats.setdefault(r["variable"], []).append(r["value"])
    else:
        cats = {k: sorted(v) for k, v in fit.items()}
    cols = list(cols or cats)
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"columns expected by the encoder are missing: {missing}")
    dummies = []
    for c in cols:
        values = cats.get(c, [])
        if drop_first:
            values = values[1:]
        for v in values:
            dummies.append(F.when(F.col(c).cast("string") == F.lit(v), 1).otherwise(0)
                           .cast(dtype).alias(f"{c}_{v}"))
    base = [F.col(f"`{c}`") for c in df.columns if keep_original or c not in cols]
    return df.select(*base, *dummies)


# ---------------------------------------------------------------- ordinal
def ordinal_encode(df: DataFrame, orders: Mapping[str, Sequence[str]],
                   unknown: str = "error") -> DataFrame:
    """Position of the value in its given order (0-based); unknown values raise
    (``unknown='error'``) or give NULL."""
    out = []
    for c in df.columns:
        if c in orders:
            arr = F.array(*[F.lit(str(v)) for v in orders[c]])
            pos = F.array_position(arr, F.col(c).cast("string"))
            code = pos - 1
            if unknown == "error":
                code = F.when(F.col(c).isNull() | (pos > 0), F.when(pos > 0, pos - 1)).otherwise(
                    F.raise_error(F.concat(F.lit(f"unknown category in {c}: "), F.col(c).cast("string"))))
            else:
                code = F.when(pos > 0, code)
            out.append(code.cast("int").alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


# ---------------------------------------------------------------- target encoding
def target_encode_fit(df: DataFrame, cols: Sequence[str], target: str,
                      min_samples_leaf: int = 20, smoothing: float = 10.0) -> DataFrame:
    """(variable, value, encoding, prior): sigmoid-smoothed category mean.

    weight = 1 / (1 + exp(-(n - min_samples_leaf) / smoothing));
    encoding = prior * (1 - weight) + mean * weight; categories seen once get
    the prior.  One groupBy over the long (variable, value) form."""
    y = F.col(target).cast("double")
    prior = df.agg(F.avg(y).alias("prior"))
    long = (df.select(y.alias("_y"), *[F.col(c).cast("string").alias(c) for c in cols])
            .unpivot(["_y"], list(cols), "variable", "value").filter(F.col("value").isNotNull()))
    st = long.groupBy("variable", "value").agg(F.count(F.lit(1)).alias("n"), F.avg("_y").alias("mean"))
    st = with_row(st, prior)
    w = 1 / (1 + F.exp(-(F.col("n") - min_samples_leaf) / F.lit(float(smoothing))))
    enc = F.col("prior") * (1 - w) + F.col("mean") * w
    return st.select("variable", "value", F.when(F.col("n") == 1, F.col("prior")).otherwise(enc)
                     .alias("encoding"), "prior", "n")


def target_encode_apply(df: DataFrame, fit: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Replace each column by its encoding; unknown and NULL -> prior.  The fit
    table is joined per column (broadcast when it is small)."""
    prior = fit.agg(F.max("prior").alias("_prior"))  # one value repeated on every fit row
    out = df
    for c in cols:
        m = fit.filter(F.col("variable") == c).select(F.col("value").alias(f"_k_{c}"),
                                                      F.col("encoding").alias(f"_e_{c}"))
        out = out.join(bounded_broadcast(m), F.col(c).cast("string") == F.col(f"_k_{c}"), "left")
    out = with_row(out, prior)
    sel = []
    for col in df.columns:
        if col in cols:
            sel.append(F.coalesce(F.col(f"_e_{col}"), F.col("_prior")).alias(col))
        else:
            sel.append(F.col(f"`{col}`"))
    return out.select(*sel)


# ---------------------------------------------------------------- scalers
def standard_scale_fit(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(variable, mean, scale) with population std (scale 1 for constant columns)."""
    a = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m_{i}") for i, c in enumerate(cols)],
               *[F.stddev_pop(F.col(c).cast("double")).alias(f"s_{i}") for i, c in enumerate(cols)])
    return a.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("variable"), F.col(f"m_{i}").alias("mean"),
                 F.when(F.col(f"s_{i}") == 0, 1.0).otherwise(F.col(f"s_{i}")).alias("scale"))
        for i, c in enumerate(cols)])).alias("s")).select("s.*")


def robust_scale_fit(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(variable, mean=median, scale=IQR) with exact quantiles (scale 1 when IQR = 0)."""
    long = (df.select(*[F.col(c).cast("double").alias(c) for c in cols])
            .unpivot([], list(cols), "variable", "value").filter(F.col("value").isNotNull()))
    q = exact_quantiles(long, "value", [0.25, 0.5, 0.75], ["variable"])
    w = q.groupBy("variable").agg(*[F.max(F.when(F.col("q_index") == i, F.col("value"))).alias(n)
                                    for i, n in enumerate(("q1", "median", "q3"))])
    iqr = F.col("q3") - F.col("q1")
    return w.select("variable", F.col("median").alias("mean"),
                    F.when(iqr == 0, 1.0).otherwise(iqr).alias("scale"))


def scale_apply(df: DataFrame, fit: DataFrame | Mapping[str, tuple[float, float]]) -> DataFrame:
    if isinstance(fit, DataFrame):
        fit = {r["variable"]: (r["mean"], r["scale"]) for r in fit.collect()}
    return df.select(*[((F.col(c).cast("double") - F.lit(fit[c][0])) / F.lit(fit[c][1])).alias(c)
                       if c in fit else F.col(f"`{c}`") for c in df.columns])


# ---------------------------------------------------------------- selection
def column_variances(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    a = df.agg(*[F.var_samp(F.col(c).cast("double")).alias(c) for c in cols])
    return a.unpivot([], list(cols), "variable", "variance")


def low_variance_columns(df: DataFrame, cols: Sequence[str], min_var: float = 0.1) -> DataFrame:
    return column_variances(df, cols).filter(F.col("variance") < min_var)


def correlated_to_drop(df: DataFrame, cols: Sequence[str], threshold: float = 0.5) -> list[str]:
    """Column b is dropped when any earlier column (dropped ones included) has
    |corr| above ``threshold`` with it."""
    pairs = correlation_pairs(df, cols).filter(F.abs("corr") > threshold).select("b").distinct()
    hit = {r["b"] for r in pairs.collect()}
    return [c for c in cols if c in hit]


def drop_correlated(train: DataFrame, test: DataFrame, cols: Sequence[str], threshold: float = 0.5
                    ) -> tuple[DataFrame, DataFrame, list[str]]:
    drop = correlated_to_drop(train, cols, threshold)
    return train.drop(*drop), test.drop(*drop), drop


def split_numeric_categorical(df: DataFrame, exclude: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    num, cat = [], []
    for f in df.schema.fields:
        if f.name in exclude:
            continue
        (num if isinstance(f.dataType, T.NumericType) else cat).append(f.name)
    return num, cat
