"""Weight of evidence and information value, for every feature in one pass.

Features go to the long (variable, bin) form: numeric columns are binned by
quantiles (one fitted edge array per variable), categorical values are
their own bins.  A single ``groupBy(variable, bin)`` then counts goods and
bads; shares, WoE and IV are windows over that small table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from .binning import apply_bins, fit_bins, to_long

# IV predictiveness cut points and labels.
IV_LABELS: tuple[tuple[float, str], ...] = (
    (0.02, "Inútil para a predição"),
    (0.1, "Preditor Fraco"),
    (0.3, "Preditor Moderado"),
)
IV_TOP_LABEL = "Preditor Forte"
ZERO_SHARE = 1e-6


def _binned_long(df: DataFrame, target: str, features: Sequence[str], bins: int,
                 method: str = "qcut") -> DataFrame:
    """(variable, bin_key, target) with NULL features and targets dropped."""
    types = {f.name: f.dataType for f in df.schema.fields}
    num = [c for c in features if isinstance(types[c], NumericType)]
    cat = [c for c in features if c not in num]
    parts = []
    if num:
        ln = to_long(df, num, [target]).filter(F.col("value").isNotNull() & F.col(target).isNotNull())
        b = apply_bins(ln, fit_bins(ln, bins, method))
        parts.append(b.select("variable", F.col("bin").cast("string").alias("bin_key"), target))
    if cat:
        lc = to_long(df, cat, [target], cast="string")
        parts.append(lc.filter(F.col("value").isNotNull() & F.col(target).isNotNull())
                     .select("variable", F.col("value").alias("bin_key"), target))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def woe_table(df: DataFrame, target: str, features: Sequence[str] | None = None,
              bins: int = 10, method: str = "qcut") -> DataFrame:
    """Per (variable, bin): all, good (target 1), bad (target 0), shares (0 -> 1e-6), WoE, IV part."""
    features = list(features or [c for c in df.columns if c != target])
    long = _binned_long(df, target, features, bins, method)
    t = F.col(target)
    counts = long.groupBy("variable", "bin_key").agg(
        F.count(F.lit(1)).alias("all"),
        F.sum(F.when(t == 1, 1).otherwise(0)).alias("good"),
        F.sum(F.when(t == 0, 1).otherwise(0)).alias("bad"))
    w = Window.partitionBy("variable")
    dg = F.try_divide(F.col("good"), F.sum("good").over(w))
    db = F.try_divide(F.col("bad"), F.sum("bad").over(w))
    shares = counts.select("*", F.when(dg == 0, ZERO_SHARE).otherwise(dg).alias("distr_good"),
                           F.when(db == 0, ZERO_SHARE).otherwise(db).alias("distr_bad"))
    woe = F.log(F.col("distr_good") / F.col("distr_bad"))
    return shares.select("*", woe.alias("woe"),
                         ((F.col("distr_good") - F.col("distr_bad")) * woe).alias("iv"))


def woe_iv(df: DataFrame, feature: str, target: str, bins: int = 10) -> DataFrame:
    """WoE table of one feature (the reference returns only its IV sum)."""
    return woe_table(df, target, [feature], bins)


def iv_label(iv) -> F.Column:
    out = None
    for cut, label in IV_LABELS:
        out = F.when(iv < cut, label) if out is None else out.when(iv < cut, label)
    return out.otherwise(IV_TOP_LABEL)


def iv_table(df: DataFrame, target: str, features: Sequence[str] | None = None,
             bins: int = 10) -> DataFrame:
    """(variable, iv, predictiveness) for every feature."""
    wt = woe_table(df, target, features, bins)
    s = wt.groupBy("variable").agg(F.sum("iv").alias("iv"))
    return s.select("variable", "iv", iv_label(F.col("iv")).alias("predictiveness"))


def iv_sim_nao(df: DataFrame, target: str, variable: str, yes: str = "Sim", no: str = "Não"
               ) -> DataFrame:
    """Cross table of a Sim/Não target: counts, % of each class (2 dp), row event
    %, WoE = %Sim / %Não, IV = (%Sim - %Não)/100 * ln(WoE) with +-inf -> 0."""
    t = F.col(target)
    c = df.filter(F.col(variable).isNotNull() & t.isNotNull()).groupBy(variable).agg(
        F.sum(F.when(t == yes, 1).otherwise(0)).alias("Sim"),
        F.sum(F.when(t == no, 1).otherwise(0)).alias("Nao"))
    # class totals as scalar subqueries (partial sums, one row), not a window
    # without partitionBy that would move every category into one task
    ps = F.round(F.try_divide(F.col("Sim"), c.select(F.sum("Sim")).scalar()) * 100, 2)
    pn = F.round(F.try_divide(F.col("Nao"), c.select(F.sum("Nao")).scalar()) * 100, 2)
    out = c.select("*", ps.alias("pct_sim"), pn.alias("pct_nao"),
                   F.round(F.col("Sim") / (F.col("Nao") + F.col("Sim")) * 100, 2).alias("pct_freq_linha"))
    ratio = F.try_divide(F.col("pct_sim"), F.col("pct_nao"))
    ln = F.when((F.col("pct_sim") > 0) & (F.col("pct_nao") > 0), F.log(ratio)).otherwise(F.lit(0.0))
    return out.select("*", ratio.alias("woe"),
                      ((F.col("pct_sim") / 100 - F.col("pct_nao") / 100) * ln).alias("iv"))


def iv_category(df: DataFrame, target: str, variable: str) -> DataFrame:
    return iv_sim_nao(df, target, variable)


def iv_bin(df: DataFrame, target: str, variable: str, bins: int = 10) -> DataFrame:
    from .binning import cut
    b = cut(df, variable, bins, out=f"{variable}_bin")
    return iv_sim_nao(b, target, f"{variable}_bin")


def bivariate_table(df: DataFrame, target: str, nbins: int = 10,
                    features: Sequence[str] | None = None) -> DataFrame:
    """Per (variable, range): #1, #0, total, %freq, %T1, %T0 (0 -> 0.01), event %,
    odds (0 -> 0.01), ln(odds), IV; each rounded to 2 dp in sequence, as the
    report defines them (later columns use the rounded earlier ones); IV is
    0 where odds was forced to 0.01."""
    features = list(features or [c for c in df.columns if c != target])
    long = _binned_long(df, target, features, nbins)
    t = F.col(target)
    c = long.groupBy("variable", "bin_key").agg(
        F.sum(F.when(t == 1, 1).otherwise(0)).alias("n_target_1"),
        F.sum(F.when(t == 0, 1).otherwise(0)).alias("n_target_0"))
    w = Window.partitionBy("variable")
    tot = F.col("n_target_1") + F.col("n_target_0")
    c = c.select("*", tot.alias("total"))
    p1 = F.round(F.try_divide(F.col("n_target_1"), F.sum("n_target_1").over(w)) * 100, 2)
    p0 = F.round(F.try_divide(F.col("n_target_0"), F.sum("n_target_0").over(w)) * 100, 2)
    c = c.select("*", F.round(F.col("total") / F.sum("total").over(w) * 100, 2).alias("pct_freq"),
                 p1.alias("pct_target_1"), p0.alias("_p0"))
    c = c.withColumn("pct_target_0", F.when(F.col("_p0") == 0, 0.01).otherwise(F.col("_p0"))).drop("_p0")
    c = c.withColumn("taxa_target_1", F.round(F.col("n_target_1") / F.col("total") * 100, 2))
    odds = F.round(F.col("pct_target_1") / F.col("pct_target_0"), 2)
    c = c.withColumn("odds", F.when(odds == 0, 0.01).otherwise(odds))
    c = c.withColumn("ln_odds", F.round(F.log("odds"), 2))
    iv = F.round((F.col("pct_target_1") / 100 - F.col("pct_target_0") / 100) * F.col("ln_odds"), 2)
    return c.withColumn("iv", F.when(F.col("odds") == 0.01, 0.0).otherwise(iv))


def iv_ranking(bivariate: DataFrame) -> DataFrame:
    return bivariate.groupBy("variable").agg(F.sum("iv").alias("iv"))


# Log-odds linearity decision labels.
LINEAR_LABEL = "Usar como contínua"
CATEGORIZE_LABEL = "Categorizar"


def logodds_linearity(df: DataFrame, target: str, variables: Sequence[str],
                      threshold: float = 0.85, max_bins: int = 10,
                      clip: float | None = None) -> DataFrame:
    """R^2 of the per-bin mean of x against the bin's log-odds.

    Numeric variables: equal-width bins, ``min(max_bins, distinct)`` of them.
    Text variables: a bin per value, x its position in sorted order among
    the values kept.  Bins whose log-odds are infinite are dropped (``clip=None``) or the event rate is
    clipped to [clip, 1 - clip].  Variables with one distinct value are
    skipped.  One job bins every variable (bin count via one distinct-count
    aggregation), one groupBy computes bin means, one ``regr_r2``.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    texts = [v for v in variables if isinstance(kinds[v], StringType)]
    long = to_long(df, [v for v in variables if v not in texts], [target]).filter(
        F.col("value").isNotNull()) if len(texts) < len(variables) else None
    g = _numeric_bins(long, target, max_bins) if long is not None else None
    if texts:
        values = (df.select(F.col(target), *texts).unpivot([target], texts, "variable", "value")
                  .filter(F.col("value").isNotNull()))
        t = values.groupBy("variable", "value").agg(F.avg(F.col(target).cast("double")).alias("rate"))
        several = t.groupBy("variable").agg(F.count(F.lit(1)).alias("nd")).filter("nd > 1").select("variable")
        t = t.join(several, "variable", "left_semi")
    rate = F.col("rate")
    if clip is not None:
        rate = F.least(F.greatest(rate, F.lit(clip)), F.lit(1 - clip))

    def finite(binned: DataFrame) -> DataFrame:
        x = binned.withColumn("log_odds", F.log(F.try_divide(rate, 1 - rate)))
        return x.filter(F.col("log_odds").isNotNull() & ~F.isnan("log_odds")
                        & (F.abs("log_odds") != float("inf")))

    points = finite(g).select("variable", "x", "log_odds") if g is not None else None
    if texts:  # one row a value: positions over the aggregated table only
        place = F.row_number().over(Window.partitionBy("variable").orderBy("value")).cast("double")
        placed = finite(t).select("variable", (place - 1).alias("x"), "log_odds")
        points = placed if points is None else points.unionByName(placed)
    r = points.groupBy("variable").agg(F.regr_r2("log_odds", "x").alias("r2"))
    return r.select("variable", "r2", F.when(F.col("r2") > threshold, LINEAR_LABEL)
                    .otherwise(CATEGORIZE_LABEL).alias("feat_eng"))


def _numeric_bins(long: DataFrame, target: str, max_bins: int) -> DataFrame:
    """(variable, bin, x, rate) of equal-width bins."""
    nd = long.groupBy("variable").agg(F.count_distinct("value").alias("nd"),
                                      F.min("value").alias("mn"), F.max("value").alias("mx"))
    nd = nd.filter(F.col("nd") > 1)
    nb = F.least(F.col("nd"), F.lit(max_bins))
    step = (F.col("mx") - F.col("mn")) / nb
    edges = F.transform(F.sequence(F.lit(0), nb.cast("int")),
                        lambda i: F.when(i == nb, F.col("mx")).otherwise(i.cast("double") * step + F.col("mn")))
    adj = (F.col("mx") - F.col("mn")) * 0.001
    edges = F.transform(edges, lambda e, i: F.when(i == 0, e - adj).otherwise(e))
    fitted = nd.select("variable", edges.alias("edges"))
    j = long.join(F.broadcast(fitted), "variable")
    b = j.withColumn("bin", F.size(F.filter("edges", lambda e: e < F.col("value"))) - 1)
    return b.groupBy("variable", "bin").agg(F.avg("value").alias("x"),
                                            F.avg(F.col(target).cast("double")).alias("rate"))
