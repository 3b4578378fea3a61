"""pandas-compatible binning (qcut / cut) computed on Spark.

Edges are fitted per variable on the long (variable, value) form, so many
columns are binned by one quantile job; fitted edges are arrays of at most
``bins + 1`` numbers per variable.

Semantics (right-closed intervals):
* qcut: edges are the exact linear-interpolation quantiles at
  ``linspace(0, 1, q + 1)``, duplicates dropped; the lowest edge is
  included.  A column with fewer than two distinct edges (constant) falls
  back to ``cut``.
* cut: ``linspace(min, max, bins + 1)`` with the first edge lowered by
  0.1 % of the range; a constant column is widened by 0.1 % of its value on
  each side (0.001 when the value is 0).
NULL values get a NULL bin.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from .bounded import bounded_broadcast, with_row
from .prefix import exact_quantiles
from ..session import checkpointed


def linspace_probs(q: int) -> list[float]:
    step = 1.0 / q
    return [i * step for i in range(q)] + [1.0]


def to_long(df: DataFrame, cols: Sequence[str], id_cols: Sequence[str] = (),
            cast: str | None = "double") -> DataFrame:
    """(ids..., variable, value) for ``cols`` (one unpivot, no per-column jobs)."""
    vals = [F.col(c).cast(cast).alias(c) if cast else F.col(c) for c in cols]
    base = df.select(*id_cols, *vals)
    return base.unpivot(list(id_cols), list(cols), "variable", "value")


def qcut_edges(long_df: DataFrame, q: int, group: str = "variable") -> DataFrame:
    """(variable, edges): distinct sorted quantile edges per variable."""
    qs = exact_quantiles(long_df, "value", linspace_probs(q), [group])
    return qs.groupBy(group).agg(
        F.array_sort(F.array_distinct(F.collect_list("value"))).alias("edges"))


def cut_edges(long_df: DataFrame, bins: int, group: str = "variable") -> DataFrame:
    """(variable, edges) of pandas ``cut(x, bins)``."""
    mm = long_df.groupBy(group).agg(F.min("value").alias("mn"), F.max("value").alias("mx"))
    same = F.col("mn") == F.col("mx")
    wid = F.when(F.col("mn") == 0, F.lit(0.001)).otherwise(F.abs(F.col("mn")) * 0.001)
    lo = F.when(same, F.col("mn") - wid).otherwise(F.col("mn"))
    hi = F.when(same, F.col("mx") + wid).otherwise(F.col("mx"))
    step = (hi - lo) / bins
    idx = F.sequence(F.lit(0), F.lit(bins))
    raw = F.transform(idx, lambda i: F.when(i == bins, hi).otherwise(i.cast("double") * step + lo))
    adj = (F.col("mx") - F.col("mn")) * 0.001
    edges = F.transform(raw, lambda e, i: F.when((i == 0) & ~same, e - adj).otherwise(e))
    return mm.select(group, F.when(F.col("mn").isNotNull(), edges).alias("edges"))


def fit_bins(long_df: DataFrame, bins: int = 10, method: str = "qcut",
             group: str = "variable") -> DataFrame:
    """(variable, edges, method): qcut edges with the cut fallback, or cut edges."""
    ce = cut_edges(long_df, bins, group).withColumnRenamed("edges", "_cut")
    if method == "cut":
        return checkpointed(ce.select(group, F.col("_cut").alias("edges"),
                                      F.lit("cut").alias("method")))
    qe = qcut_edges(long_df, bins, group)
    j = ce.join(qe, group, "left")
    use_q = F.size(F.coalesce(F.col("edges"), F.array())) >= 2
    fitted = j.select(group, F.when(use_q, F.col("edges")).otherwise(F.col("_cut")).alias("edges"),
                      F.when(use_q, F.lit("qcut")).otherwise(F.lit("cut")).alias("method"))
    # one short row per variable: materialised once, then broadcast by every user
    return checkpointed(fitted)


def bin_index(value: Column, edges: Column) -> Column:
    """Right-closed bin of ``value`` in sorted ``edges``; the lowest edge is included."""
    k = F.size(F.filter(edges, lambda e: e < value)) - 1
    return F.when(value.isNotNull(), F.greatest(k, F.lit(0)))


def apply_bins(long_df: DataFrame, fitted: DataFrame, group: str = "variable") -> DataFrame:
    """Add ``bin``, ``bin_low``, ``bin_high`` to the long form (edges broadcast:
    one short array per variable)."""
    j = long_df.join(bounded_broadcast(fitted.select(group, "edges")), group, "left")
    return _with_bin_columns(j)


def apply_single_bins(df: DataFrame, fitted: DataFrame) -> DataFrame:
    """``apply_bins`` for a frame holding one variable: its edges arrive as a
    scalar subquery (one row, checked by Spark), no join."""
    return _with_bin_columns(with_row(df, fitted.select("edges")))


def _with_bin_columns(j: DataFrame) -> DataFrame:
    b = bin_index(F.col("value"), F.col("edges"))
    n = F.size("edges")
    b = F.when(b > n - 2, n - 2).otherwise(b)
    return (j.withColumn("bin", b)
            .withColumn("bin_low", F.element_at("edges", F.col("bin") + 1))
            .withColumn("bin_high", F.element_at("edges", F.col("bin") + 2))
            .drop("edges"))


def fitted_edges(fitted: DataFrame) -> dict[str, list[float]]:
    """Small fitted state to the driver: at most bins + 1 numbers per variable."""
    return {r["variable"]: list(r["edges"] or []) for r in fitted.collect()}


def bins_from_edges(c: str | Column, edges: Sequence[float]) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    arr = F.array(*[F.lit(float(e)) for e in edges])
    b = bin_index(col.cast("double"), arr)
    return F.least(b, F.lit(max(len(edges) - 2, 0)))


def qcut(df: DataFrame, col: str, q: int = 10, out: str | None = None) -> DataFrame:
    fitted = fit_bins(to_long(df, [col]), q, "qcut")
    edges = fitted_edges(fitted).get(col, [])
    return df.withColumn(out or f"{col}_bin", bins_from_edges(col, edges))


def cut(df: DataFrame, col: str, bins: int = 10, out: str | None = None) -> DataFrame:
    fitted = fit_bins(to_long(df, [col]), bins, "cut")
    edges = fitted_edges(fitted).get(col, [])
    return df.withColumn(out or f"{col}_bin", bins_from_edges(col, edges))


def categorize_numericals(df: DataFrame, bins: int = 10, prefix: str = "BIN_",
                          target: str | None = None, keep: Sequence[str] = ()
                          ) -> tuple[DataFrame, dict[str, list[float]]]:
    """Every numeric column except ``target`` (and ``keep``, e.g. ids) replaced by
    ``{prefix}{col}`` (bin index); other columns kept.  One quantile job fits
    all columns."""
    num = [f.name for f in df.schema.fields
           if isinstance(f.dataType, NumericType) and f.name != target and f.name not in keep]
    if not num:
        return df, {}
    edges = fitted_edges(fit_bins(to_long(df, num), bins, "qcut"))
    out = []
    for c in df.columns:
        if c in num:
            out.append(bins_from_edges(c, edges.get(c, [])).alias(f"{prefix}{c}"))
        else:
            out.append(F.col(c))
    return df.select(*out), edges


def tree_bins_apply(df: DataFrame, col: str, uppers: Sequence[float], out: str) -> DataFrame:
    """Bin by sorted upper bounds as numpy ``digitize`` does: a value equal to a
    bound goes to the bin above it."""
    arr = F.array(*[F.lit(float(u)) for u in uppers])
    v = F.col(col).cast("double")
    return df.withColumn(out, F.when(v.isNotNull(), F.size(F.filter(arr, lambda u: u <= v))))


def noise_jitter(c: str | Column, seed: int = 42, scale: float = 1e-4,
                 keys: Sequence[str] = ()) -> Column:
    """Deterministic jitter in [0, scale) from a hash of the row key (or the
    value) and the seed; breaks ties before quantile binning, reproducibly."""
    col = F.col(c) if isinstance(c, str) else c
    parts = [F.col(k) for k in keys] or [col]
    u = (F.abs(F.xxhash64(*parts, F.lit(seed))) % F.lit(1_000_003)).cast("double") / 1_000_003
    return col.cast("double") + u * scale

