"""Two-level feature books: monthly partial statistics, then window folds.

Level 1 reads the raw rows once and keeps, per (entity, month) and value,
five partial statistics: count, exact sum (unscaled LONG for decimals),
min, max and M2 (sum of squared deviations).  That is a narrow, fully
hash-aggregatable ``groupBy`` whose map-side partial aggregation makes a
hot entity cost one buffer per input partition.

Level 2 pairs each monthly row with the reference safras whose history
contains it (a filter over the literal safra list), collects the at most
``max(months) + 1`` monthly partials of each (entity, safra) and folds them
into every window with array functions.  Windows are unions of months, so
counts, sums, minima and maxima combine exactly, and M2 combines with the
parallel-variance identity  M2 = sum M2_i + sum S_i^2/n_i - S^2/N.
Decimal means reproduce Spark's ``avg`` on DECIMAL exactly (same sum and
result types, same division), so results equal the one-level aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import month_index, shift_safra_value
from .book import AGGREGATES, DEFAULT_WINDOWS, temporal_ratios, window_names


def _kind(dt: T.DataType) -> str:
    # decimals whose unscaled value fits a LONG are summed exactly; wider ones
    # (e.g. DECIMAL(38, 20) quotients) are aggregated as DOUBLE
    if isinstance(dt, T.DecimalType) and dt.scale <= 6:
        return "decimal"
    if isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "integral"
    return "double"


def _unscaled(v: Column, dt: T.DecimalType) -> Column:
    """Exact unscaled LONG of a decimal: through a double when it is exactly
    representable (|v| * 10^s < 2^52), else through decimal arithmetic."""
    scale = 10 ** dt.scale
    fast = F.rint(v.cast("double") * scale).cast("long")
    slow = (v * F.lit(scale)).cast("long")
    return F.when(F.abs(v) < F.lit(float(2 ** 52) / scale), fast).otherwise(slow)


def monthly_partials(fact: DataFrame, keys: Sequence[str], month_col: str,
                     values: Sequence[str]) -> DataFrame:
    """(keys..., month, n_i, s_i, mn_i, mx_i, m2_i per value i)."""
    types = {f.name: f.dataType for f in fact.schema.fields}
    aggs = []
    for i, v in enumerate(values):
        c, dt = F.col(v), types[v]
        kind = _kind(dt)
        if kind == "decimal":
            s = F.sum(_unscaled(c, dt))
            # min/max buffers of DECIMAL wider than 18 digits are not mutable in
            # place; the extremes are only rounded to 2 dp, so DOUBLE is enough
            ext = c if dt.precision <= 18 else c.cast("double")
        elif kind == "integral":
            s, ext = F.sum(c.cast("long")), c
        else:
            s, ext = F.sum(c.cast("double")), c.cast("double")
        aggs += [F.count(c).alias(f"n_{i}"), s.alias(f"s_{i}"), F.min(ext).alias(f"mn_{i}"),
                 F.max(ext).alias(f"mx_{i}"),
                 (F.coalesce(F.var_pop(c.cast("double")), F.lit(0.0)) * F.count(c)).alias(f"m2_{i}")]
    return fact.groupBy(*keys, month_col).agg(*aggs)


def _double_sum_sql(s: str, dt: T.DataType) -> str:
    if _kind(dt) == "decimal":
        return f"(CAST({s} AS DOUBLE) / {float(10 ** dt.scale)!r}D)"
    return f"CAST({s} AS DOUBLE)"


def _exact_decimal_avg_sql(total: str, n: str, dt: T.DecimalType) -> str:
    """Spark's avg(DECIMAL(p, s)) from the unscaled sum and the count."""
    p, s = dt.precision, dt.scale
    dec_sum = (f"CAST(CAST({total} AS DECIMAL(38,0)) / CAST({10 ** s} AS DECIMAL(38,0))"
               f" AS DECIMAL({min(38, p + 10)},{s}))")
    return (f"CASE WHEN {n} > 0 THEN CAST({dec_sum} / CAST({n} AS DECIMAL(20,0))"
            f" AS DECIMAL({min(38, p + 4)},{min(38, s + 4)})) END")


def book_from_partials(partials: DataFrame, keys: Sequence[str], month_col: str,
                       values: Sequence[str], value_types: dict, safras: Sequence[int],
                       suffix: str = "", months: Sequence[int] = DEFAULT_WINDOWS,
                       ref_col: str = "safra", ratios: bool = True, layout: str = "array"
                       ) -> DataFrame:
    """Books of every entity active in each reference safra, from monthly partials.

    Each monthly row is paired with the reference safras whose history holds
    it (a filter over the literal parameter list), repeated once per window that
    contains it (at most ``len(months)`` copies of a small table), merged by
    (entity, safra, window), and the windows of one (entity, safra) are
    laid side by side from a sorted list of exactly ``len(months)`` rows
    (every window of an active entity contains its reference month).  One
    repartition of the monthly rows by the entity serves both merges: the copies
    are made behind it and never shuffled.
    """
    span = max(months)
    # the reference safras are a parameter list: each monthly row is expanded
    # by the safras whose history holds it (no join, no nested loop)
    refs = F.array(*[F.struct(F.lit(int(s)).alias("_ref"),
                              F.lit(shift_safra_value(int(s), -span)).alias("_lo"))
                     for s in safras])
    # as many tasks as the session asks for: the copies make them larger than they look
    tasks = int(partials.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = partials.repartition(tasks, *[F.col(k) for k in keys])
    paired = dealt.select("*", F.inline(
        F.filter(refs, lambda r: F.col(month_col).between(r["_lo"], r["_ref"]))))
    d = (month_index("_ref") - month_index(month_col)).cast("int")
    wins = F.array(*[F.lit(int(k)) for k in months])
    exploded = (paired.withColumn("_d", d)
                .withColumn("_w", F.explode(F.filter(wins, lambda k: F.col("_d") <= k))))
    # expressions are SQL text: one parse on the JVM per column instead of a
    # py4j round trip per nested Column call (hundreds of columns per book)
    aggs = [F.expr("max(CAST(_d = 0 AS INT))").alias("_active")]
    for i, v in enumerate(values):
        sd = _double_sum_sql(f"s_{i}", value_types[v])
        aggs += [F.expr(f"sum(n_{i})").alias(f"N_{i}"), F.expr(f"sum(s_{i})").alias(f"S_{i}"),
                 F.expr(f"min(mn_{i})").alias(f"MN_{i}"), F.expr(f"max(mx_{i})").alias(f"MX_{i}"),
                 F.expr(f"sum(m2_{i})").alias(f"M2_{i}"),
                 F.expr(f"sum(CASE WHEN n_{i} > 0 THEN {sd} * {sd} / n_{i} END)").alias(f"SQ_{i}")]
    per_window = exploded.groupBy(*keys, "_ref", "_w").agg(*aggs)
    fields = [c for c in per_window.columns if c not in (*keys, "_ref", "_w", "_active")]
    if layout == "pivot":
        # every window of an active entity holds its reference month, so the
        # five pivot cells of an (entity, safra) are all present
        grouped = per_window.groupBy(*keys, "_ref").pivot("_w", [int(k) for k in months]).agg(
            *[F.first(c).alias(c) for c in fields], F.max("_active").alias("_active"))
        act = F.greatest(*[F.col(f"{k}__active") for k in months])
        grouped = grouped.filter(act == 1)

        def get(j, k, name):
            return f"`{k}_{name}`"
    else:
        grouped = per_window.groupBy(*keys, "_ref").agg(
            F.array_sort(F.collect_list(F.struct("_w", *fields))).alias("_a"),  # len(months) rows
            F.max("_active").alias("_active"))
        grouped = grouped.filter(F.col("_active") == 1)

        def get(j, k, name):
            return f"element_at(_a, {j + 1}).{name}"

    out = []
    for j, k in enumerate(months):
        for i, v in enumerate(values):
            dt = value_types[v]
            n, s_ = get(j, k, f"N_{i}"), get(j, k, f"S_{i}")
            if _kind(dt) == "decimal":
                med = _exact_decimal_avg_sql(s_, n, dt)
            else:
                med = f"CASE WHEN {n} > 0 THEN CAST({s_} AS DOUBLE) / CAST({n} AS DOUBLE) END"
            sd = _double_sum_sql(s_, dt)
            m2 = (f"coalesce({get(j, k, f'M2_{i}')}, 0.0D) + coalesce({get(j, k, f'SQ_{i}')}, 0.0D)"
                  f" - CASE WHEN {n} > 0 THEN {sd} * {sd} / {n} ELSE 0.0D END")
            std = f"CASE WHEN {n} >= 2 THEN sqrt(greatest({m2}, 0.0D) / ({n} - 1)) END"
            cols = {
                "med": f"CAST(round({med}, 2) AS DOUBLE)",
                "max": f"CAST(round({get(j, k, f'MX_{i}')}, 2) AS DOUBLE)",
                "min": f"CAST(round({get(j, k, f'MN_{i}')}, 2) AS DOUBLE)",
                "std": f"CAST(round({std}, 2) AS DOUBLE)",
                "qtd": f"CAST(coalesce({n}, 0) AS BIGINT)",
            }
            out += [f"{cols[a]} AS `vl_{a}_u{k}m_{v}{suffix}`" for a in AGGREGATES]
    key_cols = [f"`{k}`" for k in keys]
    book = grouped.selectExpr(*key_cols, f"CAST(_ref AS INT) AS `{ref_col}`", *out)
    if ratios:
        book = temporal_ratios(book, windows=window_names(months), suffix=suffix)
    return book


def book_two_level(fact: DataFrame, entity: str, safra_col: str, safras: Sequence[int],
                   values: Sequence[str], suffix: str, group_extra: Sequence[str] = (),
                   months: Sequence[int] = DEFAULT_WINDOWS, ratios: bool = True) -> DataFrame:
    span = max(months)
    lo = min(shift_safra_value(int(s), -span) for s in safras)
    hi = max(int(s) for s in safras)
    hist = fact.filter(F.col(safra_col).between(lo, hi))
    keys = [entity, *group_extra]
    types = {f.name: f.dataType for f in fact.schema.fields}
    parts = monthly_partials(hist, keys, safra_col, values)
    return book_from_partials(parts, keys, safra_col, values, types, safras, suffix, months,
                              ref_col=safra_col, ratios=ratios)
