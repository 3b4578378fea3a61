"""Event rates, volumes, frequency and cross tables (small outputs from one
aggregation each; shares come from windows over the aggregated rows)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from .bounded import with_row


def _as_category(df: DataFrame, var: str, digits: int = 4):
    f = df.schema[var]
    if isinstance(f.dataType, NumericType):
        return F.round(F.col(var).cast("double"), digits).cast("string")
    return F.col(var).cast("string")


def event_rate_by_vintage(df: DataFrame, target: str, safra: str) -> DataFrame:
    """(safra, event rate, volume)."""
    return df.groupBy(safra).agg(F.avg(F.col(target).cast("double")).alias("taxa_de_evento"),
                                 F.count(F.col(safra)).alias("volume"))


def event_rate_by_category(df: DataFrame, var: str, target: str) -> DataFrame:
    """(value, event rate, volume); numerics rounded to 4 dp and used as text."""
    cat = _as_category(df, var)
    return (df.select(cat.alias(var), F.col(target).cast("double").alias("_t"))
            .filter(F.col(var).isNotNull())
            .groupBy(var).agg(F.avg("_t").alias("taxa_de_evento"),
                              F.count(F.lit(1)).alias("volume")))


def event_rate_grid(df: DataFrame, target: str, max_unique: int = 20,
                    variables: Sequence[str] | None = None) -> DataFrame:
    """Event rate per (variable, value) for text columns and numerics with at
    most ``max_unique`` distinct values; one unpivot, one aggregation."""
    variables = list(variables or [c for c in df.columns if c != target])
    long = (df.select(F.col(target).cast("double").alias("_t"),
                      *[_as_category(df, v, 4).alias(v) for v in variables])
            .unpivot(["_t"], variables, "variable", "value")
            .filter(F.col("value").isNotNull()))
    types = {f.name: f.dataType for f in df.schema.fields}
    num = [v for v in variables if isinstance(types[v], NumericType)]
    if num:
        nd = (long.filter(F.col("variable").isin(num)).groupBy("variable")
              .agg(F.count_distinct("value").alias("nd")).filter(F.col("nd") > max_unique))
        long = long.join(F.broadcast(nd.select("variable")), "variable", "left_anti")
    return long.groupBy("variable", "value").agg(F.avg("_t").alias("taxa_de_evento"),
                                                 F.count(F.lit(1)).alias("volume"))


def event_rate_by_vintage_category(df: DataFrame, safra: str, var: str, target: str
                                   ) -> DataFrame:
    """(safra, value, event rate, volume, total volume of the safra)."""
    cat = _as_category(df, var)
    g = (df.select(F.col(safra), cat.alias(var), F.col(target).cast("double").alias("_t"))
         .filter(F.col(var).isNotNull())
         .groupBy(safra, var).agg(F.avg("_t").alias("taxa_de_evento"),
                                  F.count(F.lit(1)).alias("volume")))
    return g.withColumn("volume_safra", F.sum("volume").over(Window.partitionBy(safra)))


def volume_by_vintage(rates: DataFrame, safra: str) -> DataFrame:
    return rates.groupBy(safra).agg(F.sum("volume").alias("volume"))


def domain_mapping(df: DataFrame, var: str, mapping: DataFrame, safra: str, target: str
                   ) -> tuple[DataFrame, DataFrame]:
    """Recode ``var`` through ``mapping`` (var, new), then rates per (safra, new
    value); also returns the distinct old -> new table."""
    from .joins import apply_grouping
    rec = apply_grouping(df, mapping, var, keep_original=True)
    new = f"TFB_{var}"
    rates = event_rate_by_vintage_category(rec, safra, new, target)
    table = rec.select(var, new).distinct()
    return rates, table


def category_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(variable, value, count, pct) per column plus a 'Total' row per column."""
    long = (df.select(*[F.col(c).cast("string").alias(c) for c in cols])
            .unpivot([], list(cols), "variable", "value"))
    g = long.groupBy("variable", "value").agg(F.count(F.lit(1)).alias("count"))
    g = share_of_total(g, "count", ["variable"], "pct").withColumn("pct", F.round(F.col("pct") * 100, 2))
    tot = g.groupBy("variable").agg(F.lit("Total").alias("value"), F.sum("count").alias("count"),
                                    F.lit(100.0).alias("pct"))
    return g.unionByName(tot)


def crosstab_normalized(df: DataFrame, col: str, target: str, classes: Sequence = (0, 1)
                        ) -> DataFrame:
    """Row-normalised cross table: each listed class's share of all rows of the
    value (rows of other classes count in the total)."""
    p = df.filter(F.col(col).isNotNull() & F.col(target).isNotNull()).groupBy(col).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(F.col(target) == F.lit(c)).alias(f"_{i}") for i, c in enumerate(classes)])
    return p.select(col, *[(F.col(f"_{i}") / F.col("_n")).alias(f"share_{c}")
                           for i, c in enumerate(classes)])


def pivot_count(df: DataFrame, index: str, target: str, values: Sequence) -> DataFrame:
    """Count pivot with explicit class values (no extra distinct job), NULL -> 0."""
    p = df.groupBy(index).pivot(target, list(values)).count()
    return p.fillna(0)


def category_frequency(df: DataFrame, max_card: int = 30,
                       cols: Sequence[str] | None = None) -> DataFrame:
    """Value counts of text columns with at most ``max_card`` distinct values."""
    cols = list(cols or [f.name for f in df.schema.fields if not isinstance(f.dataType, NumericType)])
    long = (df.select(*[F.col(c).cast("string").alias(c) for c in cols])
            .unpivot([], cols, "variable", "value"))
    g = long.groupBy("variable", "value").agg(F.count(F.lit(1)).alias("count"))
    card = g.filter(F.col("value").isNotNull()).groupBy("variable").agg(F.count(F.lit(1)).alias("nd"))
    keep = card.filter(F.col("nd") <= max_card).select("variable")
    return g.join(F.broadcast(keep), "variable", "left_semi")


def share_of_total(df: DataFrame, col: str, by: Sequence[str] = (), name: str | None = None
                   ) -> DataFrame:
    """``col`` divided by its total (within ``by``; over all rows as one scalar)."""
    name = name or f"share_{col}"
    if not by:
        t = with_row(df, df.agg(F.sum(col).alias("_total")))
    else:
        sums = df.groupBy(*[F.col(c).alias(f"_by_{c}") for c in by]).agg(F.sum(col).alias("_total"))
        on = None
        for c in by:
            e = F.col(c).eqNullSafe(F.col(f"_by_{c}"))
            on = e if on is None else on & e
        t = df.join(sums, on).drop(*[f"_by_{c}" for c in by])
    return t.withColumn(name, F.try_divide(F.col(col), F.col("_total"))).drop("_total")
