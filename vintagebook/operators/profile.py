"""Column profiles, missing values, distributions and type narrowing.

Each profile is one wide aggregation (null counts, min/max, moments) plus,
for cardinalities and modes, one ``groupBy(variable, value)`` over the long
form; fitted state (means, modes, edges) is a table with one row per column.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .prefix import exact_quantiles

# Profile role labels and the fill text when a column has no mode.
ROLE_ID, ROLE_TARGET, ROLE_FEATURE = "ID", "Target", "Explicativa"
NO_MODE_FILL = "VERIFICAR"


def _long_text(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return (df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in cols])
            .unpivot([], list(cols), "variable", "value"))


def column_profile(df: DataFrame, ids: Sequence[str] = (), targets: Sequence[str] = (),
                   approx: bool = False) -> DataFrame:
    """(variable, role, n_nulls, pct_nulls (2 dp), cardinality (non-null distinct), dtype)."""
    cols = df.columns
    nulls = df.agg(F.count(F.lit(1)).alias("_n"),
                   *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"_z{i}") for i, c in enumerate(cols)])
    nl = nulls.select("_n", F.explode(F.array(*[
        F.struct(F.lit(c).alias("variable"), F.col(f"_z{i}").alias("n_nulls"))
        for i, c in enumerate(cols)])).alias("s")).select("_n", "s.*")
    if approx:
        card = df.agg(*[F.approx_count_distinct(F.col(f"`{c}`")).alias(c) for c in cols]) \
            .unpivot([], cols, "variable", "cardinality")
    else:
        card = (_long_text(df, cols).filter(F.col("value").isNotNull()).distinct()
                .groupBy("variable").agg(F.count(F.lit(1)).alias("cardinality")))
    types = df.sparkSession.createDataFrame(
        [(f.name, f.dataType.simpleString()) for f in df.schema.fields], "variable string, dtype string")
    role = (F.when(F.col("variable").isin(list(ids)), ROLE_ID)
            .when(F.col("variable").isin(list(targets)), ROLE_TARGET).otherwise(ROLE_FEATURE))
    out = nl.join(card, "variable", "left").join(F.broadcast(types), "variable")
    return out.select("variable", role.alias("role"), F.col("n_nulls").cast("bigint").alias("n_nulls"),
                      F.round(F.try_divide(F.col("n_nulls"), F.col("_n")) * 100, 2).alias("pct_nulls"),
                      F.coalesce(F.col("cardinality"), F.lit(0)).cast("bigint").alias("cardinality"),
                      "dtype")


def null_heavy_columns(profile: DataFrame, pct: float = 70.0, inclusive: bool = False) -> DataFrame:
    """Columns whose % of nulls is above ``pct`` (``inclusive``: at or above)."""
    c = F.col("pct_nulls") >= pct if inclusive else F.col("pct_nulls") > pct
    return profile.filter(c).select("variable", "pct_nulls")


def sentinel_to_null(df: DataFrame, cols: Sequence[str] | None = None, sentinel=-1) -> DataFrame:
    num = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
    cols = [c for c in (cols or df.columns) if c in num]
    return df.select(*[F.nullif(F.col(c), F.lit(sentinel)).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def column_modes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(variable, mode): most frequent non-null value; ties -> smallest value."""
    long = _long_text(df, cols).filter(F.col("value").isNotNull())
    c = long.groupBy("variable", "value").agg(F.count(F.lit(1)).alias("n"))
    # ties: largest count first, then the smallest value.  min(struct(-n, value))
    # aggregates partially per partition, so a column with many distinct values
    # is never gathered into one task.
    best = c.groupBy("variable").agg(F.min(F.struct(F.negative("n").alias("nn"), "value")).alias("b"))
    return best.select("variable", F.col("b.value").alias("mode"))


def impute_fit(df: DataFrame, numeric: Sequence[str] | None = None,
               categorical: Sequence[str] | None = None, strategy: str = "mean") -> DataFrame:
    """Fit table (variable, num_fill, cat_fill): mean (or median) of numerics,
    mode of text columns ('VERIFICAR' when a column has no value)."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    numeric = list(numeric if numeric is not None else
                   [c for c, t in fields.items() if isinstance(t, T.NumericType)])
    categorical = list(categorical if categorical is not None else
                       [c for c, t in fields.items() if isinstance(t, T.StringType)])
    spark = df.sparkSession
    parts = []
    if numeric:
        if strategy == "median":
            long = df.select(*numeric).unpivot([], numeric, "variable", "value")
            q = exact_quantiles(long.select("variable", F.col("value").cast("double").alias("value")),
                                "value", [0.5], ["variable"])
            nf = q.select("variable", F.col("value").alias("num_fill"))
        else:
            means = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in numeric])
            nf = means.unpivot([], numeric, "variable", "num_fill")
        names = spark.createDataFrame([(c,) for c in numeric], "variable string")
        parts.append(names.join(nf, "variable", "left")
                     .select("variable", "num_fill", F.lit(None).cast("string").alias("cat_fill")))
    if categorical:
        m = column_modes(df, categorical)
        names = spark.createDataFrame([(c,) for c in categorical], "variable string")
        parts.append(names.join(m, "variable", "left").select(
            "variable", F.lit(None).cast("double").alias("num_fill"),
            F.coalesce(F.col("mode"), F.lit(NO_MODE_FILL)).alias("cat_fill")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def impute_apply(df: DataFrame, fit: DataFrame | dict, sentinel=None) -> DataFrame:
    """Fill NULLs from a fit table (collected: one row per column).  Columns the
    fit does not know are left alone; text columns missing from the fit get
    'VERIFICAR' only when ``fit`` says so."""
    if sentinel is not None:
        df = sentinel_to_null(df, sentinel=sentinel)
    if isinstance(fit, DataFrame):
        fit = {r["variable"]: (r["num_fill"] if r["num_fill"] is not None else r["cat_fill"])
               for r in fit.collect()}
    out = []
    for f in df.schema.fields:
        v = fit.get(f.name)
        if v is None:
            out.append(F.col(f"`{f.name}`"))
        elif isinstance(f.dataType, T.NumericType):
            out.append(F.coalesce(F.col(f"`{f.name}`").cast("double"), F.lit(float(v))).alias(f.name))
        else:
            out.append(F.coalesce(F.col(f"`{f.name}`"), F.lit(str(v))).alias(f.name))
    return df.select(*out)


def impute_train_test(train: DataFrame, test: DataFrame, numeric: Sequence[str],
                      categorical: Sequence[str], strategy: str = "mean"
                      ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Fit on train only, apply to both; returns (train, test, fit table)."""
    fit = impute_fit(train, numeric, categorical, strategy)
    fitted = {r["variable"]: (r["num_fill"] if r["num_fill"] is not None else r["cat_fill"])
              for r in fit.collect()}
    return impute_apply(train, fitted), impute_apply(test, fitted), fit


def numeric_histogram(df: DataFrame, cols: Sequence[str], bins: int = 30,
                      by: str | None = None) -> DataFrame:
    """numpy-style histogram counts: equal-width [a, b) bins, the last one closed."""
    keep = [by] if by else []
    long = (df.select(*keep, *[F.col(c).cast("double").alias(c) for c in cols])
            .unpivot(keep, list(cols), "variable", "value").filter(F.col("value").isNotNull()))
    mm = long.groupBy("variable").agg(F.min("value").alias("mn"), F.max("value").alias("mx"))
    j = long.join(F.broadcast(mm), "variable")
    width = (F.col("mx") - F.col("mn")) / bins
    raw = F.floor(F.try_divide(F.col("value") - F.col("mn"), width))
    b = F.when(F.col("mx") == F.col("mn"), F.lit(0)).otherwise(F.least(raw, F.lit(bins - 1))).cast("int")
    g = j.groupBy("variable", *keep, b.alias("bin"), "mn", "mx").agg(F.count(F.lit(1)).alias("count"))
    return g.select("variable", *keep, "bin",
                    (F.col("mn") + F.col("bin") * (F.col("mx") - F.col("mn")) / bins).alias("bin_low"),
                    (F.col("mn") + (F.col("bin") + 1) * (F.col("mx") - F.col("mn")) / bins).alias("bin_high"),
                    "count")


def box_stats(df: DataFrame, cols: Sequence[str], by: str | None = None) -> DataFrame:
    """Quartiles (linear), IQR, Tukey whiskers (most extreme values within
    1.5 IQR) and outlier counts, per variable (and per ``by`` value)."""
    keep = [by] if by else []
    long = (df.select(*keep, *[F.col(c).cast("double").alias(c) for c in cols])
            .unpivot(keep, list(cols), "variable", "value").filter(F.col("value").isNotNull()))
    g = ["variable", *keep]
    q = exact_quantiles(long, "value", [0.25, 0.5, 0.75], g)
    qw = q.groupBy(*g).agg(*[F.max(F.when(F.col("q_index") == i, F.col("value"))).alias(n)
                             for i, n in enumerate(("q1", "median", "q3"))])
    qw = qw.withColumn("iqr", F.col("q3") - F.col("q1"))
    j = long.join(qw, g)
    lo = F.col("q1") - 1.5 * F.col("iqr")
    hi = F.col("q3") + 1.5 * F.col("iqr")
    return j.groupBy(*g, "q1", "median", "q3", "iqr").agg(
        F.min(F.when(F.col("value") >= lo, F.col("value"))).alias("whisker_low"),
        F.max(F.when(F.col("value") <= hi, F.col("value"))).alias("whisker_high"),
        F.count_if((F.col("value") < lo) | (F.col("value") > hi)).alias("n_outliers"),
        F.count(F.lit(1)).alias("n"))


def kde_by_target(df: DataFrame, cols: Sequence[str], target: str, grid: int = 200,
                  fine_bins: int = 1024, cut: float = 3.0) -> DataFrame:
    """Gaussian KDE (Scott bandwidth) per (variable, class) on a ``grid``-point
    axis.  Raw values are first reduced to ``fine_bins`` histogram centres, so
    the kernel sum costs grid x fine_bins per (variable, class) whatever the
    row count; classes with one value only have no density and are left out; the binning shifts each value by at most half a fine bin."""
    long = (df.select(F.col(target).alias("cls"), *[F.col(c).cast("double").alias(c) for c in cols])
            .unpivot(["cls"], list(cols), "variable", "value").filter(F.col("value").isNotNull()))
    st = long.groupBy("variable", "cls").agg(
        F.count(F.lit(1)).alias("n"), F.stddev_samp("value").alias("sd"),
        F.min("value").alias("mn"), F.max("value").alias("mx"))
    st = st.withColumn("bw", F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2)))
    st = st.filter("bw > 0")  # a constant class has no density
    j = long.join(F.broadcast(st), ["variable", "cls"])
    width = (F.col("mx") - F.col("mn")) / fine_bins
    fb = F.least(F.floor(F.try_divide(F.col("value") - F.col("mn"), width)), F.lit(fine_bins - 1))
    hist = (j.groupBy("variable", "cls", F.coalesce(fb, F.lit(0)).alias("fb"), "mn", "mx", "bw", "n")
            .agg(F.count(F.lit(1)).alias("w")))
    hist = hist.withColumn("center", F.col("mn") + (F.col("fb") + 0.5) * (F.col("mx") - F.col("mn")) / fine_bins)
    pts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(grid - 1).cast("long")))
    axis = st.select("*", pts.alias("g")).select(
        "variable", "cls", "g",
        (F.col("mn") - cut * F.col("bw") + F.col("g") * ((F.col("mx") - F.col("mn")) + 2 * cut * F.col("bw"))
         / (grid - 1)).alias("x"))
    k = axis.join(hist.select("variable", "cls", "center", "w", "bw", "n"), ["variable", "cls"])
    z = (F.col("x") - F.col("center")) / F.col("bw")
    dens = F.col("w") * F.exp(-0.5 * z * z) / (F.col("n") * F.col("bw") * math.sqrt(2 * math.pi))
    return k.groupBy("variable", "cls", "g", "x").agg(F.sum(dens).alias("density"))


# Integer candidates, narrowest first: (name, min, max, Spark type).  Unsigned
# ranges map to the next wider signed Spark type.
_INT_CANDIDATES = (
    ("int8", -128, 127, T.ByteType()),
    ("uint8", 0, 255, T.ShortType()),
    ("int16", -32768, 32767, T.ShortType()),
    ("uint16", 0, 65535, T.IntegerType()),
    ("int32", -2147483648, 2147483647, T.IntegerType()),
    ("uint32", 0, 4294967295, T.LongType()),
    ("int64", -9223372036854775808, 9223372036854775807, T.LongType()),
)
_FLOAT_CANDIDATES = (
    ("float16", -65504.0, 65504.0, T.FloatType()),
    ("float32", -3.4028234663852886e38, 3.4028234663852886e38, T.FloatType()),
    ("float64", -1.7976931348623157e308, 1.7976931348623157e308, T.DoubleType()),
)


def narrow_types(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """Cast each numeric column to the narrowest type whose range strictly
    contains [min, max]; one aggregation for all columns, one select."""
    ints = [f.name for f in df.schema.fields
            if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))]
    flts = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    cols = ints + flts
    if not cols:
        return df, {}
    row = df.agg(*[F.min(c).alias(f"mn_{i}") for i, c in enumerate(cols)],
                 *[F.max(c).alias(f"mx_{i}") for i, c in enumerate(cols)]).first()
    chosen: dict[str, T.DataType] = {}
    for i, c in enumerate(cols):
        mn, mx = row[f"mn_{i}"], row[f"mx_{i}"]
        if mn is None:
            continue
        for _, lo, hi, t in (_INT_CANDIDATES if c in ints else _FLOAT_CANDIDATES):
            if mn > lo and mx < hi:
                chosen[c] = t
                break
    out = df.select(*[F.col(c).cast(chosen[c]).alias(c) if c in chosen else F.col(c) for c in df.columns])
    return out, {c: t.simpleString() for c, t in chosen.items()}


def normalize_dtypes(df: DataFrame) -> DataFrame:
    """Small integers -> INT, floats stay FLOAT, everything else unchanged."""
    return df.select(*[F.col(f.name).cast("int").alias(f.name)
                       if isinstance(f.dataType, (T.ByteType, T.ShortType)) else F.col(f.name)
                       for f in df.schema.fields])
