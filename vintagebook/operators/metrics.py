"""Model evaluation on scored DataFrames (score, label[, group columns]).

Everything starts from one row per (group, distinct score) with positive /
negative counts, so ties are handled exactly (tied rows move together) and
the running sums come from :func:`prefix_sums` (no single-task window).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .binning import fit_bins, linspace_probs
from ..session import checkpointed
from .prefix import prefix_sums
from .bounded import with_row

LOG_LOSS_EPS = 2.220446049250313e-16  # float64 machine epsilon


def score_counts(df: DataFrame, score: str, label: str, group_cols: Sequence[str] = ()
                 ) -> DataFrame:
    """(group..., score, n, pos, neg) for non-null score and label."""
    y = F.col(label).cast("double")
    return (df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
            .groupBy(*group_cols, F.col(score).cast("double").alias("score"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum(y).alias("pos"),
                 F.sum(1 - y).alias("neg")))


def cumulative_counts(df: DataFrame, score: str, label: str, group_cols: Sequence[str] = (),
                      descending: bool = True) -> DataFrame:
    """Score counts with inclusive running sums (highest score first) and group totals."""
    return running_counts(score_counts(df, score, label, group_cols), group_cols, descending)


def running_counts(sc: DataFrame, group_cols: Sequence[str] = (), descending: bool = True) -> DataFrame:
    """``sc`` (group..., score, n, pos, neg; one row per score) with running sums and group totals."""
    g = list(group_cols)
    sc = checkpointed(sc)  # read for the sums and for the totals
    cum = prefix_sums(sc, "score", ["n", "pos", "neg"], g, descending=descending, materialize=False)
    tot = sc.groupBy(*g).agg(F.sum("n").alias("n_total"), F.sum("pos").alias("pos_total"),
                             F.sum("neg").alias("neg_total"))
    return cum.join(tot, g) if g else with_row(cum, tot)


def ks_curve(df: DataFrame, score: str, label: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """Cumulative event / non-event shares by score, highest first."""
    return _ks_curve(cumulative_counts(df, score, label, group_cols), group_cols)


def _ks_curve(c: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    ev = F.try_divide(F.col("cum_pos"), F.col("pos_total"))
    ne = F.try_divide(F.col("cum_neg"), F.col("neg_total"))
    return c.select(*group_cols, "score", ev.alias("cum_events_pct"),
                    ne.alias("cum_non_events_pct"), F.abs(ev - ne).alias("ks"))


def ks_statistic(df: DataFrame, score: str, label: str, group_cols: Sequence[str] = ()
                 ) -> DataFrame:
    """max |cum event share - cum non-event share| (evaluated between distinct scores)."""
    return ks_curve(df, score, label, group_cols).groupBy(*group_cols).agg(F.max("ks").alias("ks"))


def ks_from_roc(df: DataFrame, score: str, label: str, group_cols: Sequence[str] = ()
                ) -> DataFrame:
    """100 * max(tpr - fpr) over ROC thresholds (the (0, 0) point included)."""
    c = ks_curve(df, score, label, group_cols)
    d = F.col("cum_events_pct") - F.col("cum_non_events_pct")
    return c.groupBy(*group_cols).agg((F.greatest(F.max(d), F.lit(0.0)) * 100).alias("ks"))


def roc_auc(df: DataFrame, score: str, label: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """Exact ROC AUC (ties count 1/2) and Gini = 2 AUC - 1."""
    return auc_of_counts(score_counts(df, score, label, group_cols), group_cols)


def auc_of_counts(counts: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """:func:`roc_auc` of (group..., score, n, pos, neg), one row per score."""
    return _auc(running_counts(counts, group_cols), group_cols)


def _auc(c: DataFrame, group_cols: Sequence[str]) -> DataFrame:
    below = F.col("neg_total") - F.col("cum_neg")
    part = F.col("pos") * (below + 0.5 * F.col("neg"))
    a = c.groupBy(*group_cols).agg(
        F.try_divide(F.sum(part), F.first("pos_total") * F.first("neg_total")).alias("auc"))
    return a.withColumn("gini", 2 * F.col("auc") - 1)


def gini_normalized(df: DataFrame, actual: str, pred: str, group_cols: Sequence[str] = ()
                    ) -> DataFrame:
    """Lorenz-curve Gini of ``pred`` divided by that of the perfect ordering.

    Rows tied on the sort key count with their expected Lorenz value under
    a random order within the tie, so the result does not depend on sort
    stability."""
    g = list(group_cols)

    def lorenz_gap(sort_col: str) -> DataFrame:
        y = F.col(actual).cast("double")
        st = (df.filter(F.col(pred).isNotNull() & F.col(actual).isNotNull())
              .groupBy(*g, F.col(sort_col).cast("double").alias("key"))
              .agg(F.count(F.lit(1)).cast("double").alias("m"), F.sum(y).alias("p")))
        cum = prefix_sums(st, "key", ["m", "p"], g, descending=True)
        before = F.col("cum_p") - F.col("p")
        part = F.col("m") * before + F.col("p") * (F.col("m") + 1) / 2
        return cum.groupBy(*g).agg(F.sum("m").alias("n"), F.sum("p").alias("tp"),
                                   F.sum(part).alias("lsum"))

    def gap(t: DataFrame, name: str) -> DataFrame:
        return t.select(*g, ((F.col("n") + 1) / 2 - F.try_divide(F.col("lsum"), F.col("tp")))
                        .alias(name))

    gp = gap(lorenz_gap(pred), "g_pred")
    gt = gap(lorenz_gap(actual), "g_true")
    j = gp.join(gt, g) if g else with_row(gp, gt)
    return j.select(*g, F.try_divide(F.col("g_pred"), F.col("g_true")).alias("gini_normalized"))


def confusion_metrics(df: DataFrame, score: str, label: str, threshold: float = 0.5,
                      group_cols: Sequence[str] = (), pred_col: str | None = None) -> DataFrame:
    """tp/fp/tn/fn, accuracy, precision, recall, F1 (0 when undefined).
    Predicted class = score > threshold (argmax of two probabilities)."""
    p = F.col(pred_col) if pred_col else (F.col(score) > threshold).cast("int")
    y = F.col(label).cast("int")
    c = df.groupBy(*group_cols).agg(
        F.sum(((p == 1) & (y == 1)).cast("long")).alias("tp"),
        F.sum(((p == 1) & (y == 0)).cast("long")).alias("fp"),
        F.sum(((p == 0) & (y == 0)).cast("long")).alias("tn"),
        F.sum(((p == 0) & (y == 1)).cast("long")).alias("fn"))
    tp, fp, tn, fn = (F.col(x) for x in ("tp", "fp", "tn", "fn"))
    prec = F.coalesce(F.try_divide(tp, tp + fp), F.lit(0.0))
    rec = F.coalesce(F.try_divide(tp, tp + fn), F.lit(0.0))
    c = c.select("*", F.try_divide(tp + tn, tp + fp + tn + fn).alias("accuracy"),
                 prec.alias("precision"), rec.alias("recall"))
    f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"),
                                 F.col("precision") + F.col("recall")), F.lit(0.0))
    return c.withColumn("f1", f1)


def probability_metrics(df: DataFrame, score: str, label: str, group_cols: Sequence[str] = ()
                        ) -> DataFrame:
    """Brier score, log loss (probabilities clipped to [eps, 1 - eps]) and
    average precision (sum over thresholds of recall step x precision)."""
    s, y = F.col(score).cast("double"), F.col(label).cast("double")
    ps = F.least(F.greatest(s, F.lit(LOG_LOSS_EPS)), F.lit(1 - LOG_LOSS_EPS))
    base = df.filter(F.col(score).isNotNull() & F.col(label).isNotNull()).groupBy(*group_cols).agg(
        F.avg((s - y) * (s - y)).alias("brier"),
        F.avg(-(y * F.log(ps) + (1 - y) * F.log(1 - ps))).alias("log_loss"))
    ap = average_precision(df, score, label, group_cols)
    return base.join(ap, list(group_cols)) if group_cols else with_row(base, ap)


def _curve(cum: DataFrame, group_cols: Sequence[str], point: Column, start: Column) -> DataFrame:
    """A curve's points; the row of the highest score also gives the ``start``."""
    points = F.when(F.col("cum_n") == F.col("n"), F.array(start, point)).otherwise(F.array(point))
    return cum.select(*group_cols, F.inline(points))


def average_precision(df: DataFrame, score: str, label: str, group_cols: Sequence[str] = ()) -> DataFrame:
    """Sum over thresholds of recall step x precision."""
    return average_precision_of_counts(score_counts(df, score, label, group_cols), group_cols)


def average_precision_of_counts(counts: DataFrame, group_cols: Sequence[str] = ()) -> DataFrame:
    """:func:`average_precision` of (group..., score, n, pos, neg), one row per score."""
    c = running_counts(counts, group_cols)
    return c.groupBy(*group_cols).agg(
        F.sum(F.try_divide(F.col("pos"), F.col("pos_total")) *
              F.try_divide(F.col("cum_pos"), F.col("cum_n"))).alias("average_precision"))


def roc_curve_table(df: DataFrame, score: str, label: str, group_cols: Sequence[str] = ()
                    ) -> DataFrame:
    """(threshold, fpr, tpr) per distinct score, from (0, 0) at threshold infinity."""
    c = cumulative_counts(df, score, label, group_cols)
    point = F.struct(F.col("score").alias("threshold"),
                     F.try_divide(F.col("cum_neg"), F.col("neg_total")).alias("fpr"),
                     F.try_divide(F.col("cum_pos"), F.col("pos_total")).alias("tpr"))
    start = F.struct(F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return _curve(c, group_cols, point, start)


def pr_curve_table(df: DataFrame, score: str, label: str, group_cols: Sequence[str] = ()
                   ) -> DataFrame:
    """(threshold, precision, recall) per distinct score, from precision 1 at
    recall 0, which has no threshold."""
    c = cumulative_counts(df, score, label, group_cols)
    point = F.struct(F.col("score").alias("threshold"),
                     F.try_divide(F.col("cum_pos"), F.col("cum_n")).alias("precision"),
                     F.try_divide(F.col("cum_pos"), F.col("pos_total")).alias("recall"))
    start = F.struct(F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return _curve(c, group_cols, point, start)


def calibration_table(df: DataFrame, score: str, label: str, bins: int = 10,
                      group_cols: Sequence[str] = ()) -> DataFrame:
    """Uniform bins on [0, 1]: mean predicted probability and observed rate per
    non-empty bin (bin = number of inner edges below the score)."""
    inner = linspace_probs(bins)[1:-1]
    arr = F.array(*[F.lit(e) for e in inner])
    s = F.col(score).cast("double")
    b = F.size(F.filter(arr, lambda e: e < s))
    return (df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
            .groupBy(*group_cols, b.alias("bin"))
            .agg(F.avg(s).alias("prob_pred"), F.avg(F.col(label).cast("double")).alias("prob_true"),
                 F.count(F.lit(1)).alias("volume")))


def decile_table(df: DataFrame, score: str, target: str, bins: int = 10, mode: str = "qcut",
                 scale: float = 1000.0, group_cols: Sequence[str] = ()) -> DataFrame:
    """Per score bin: min/max score (x ``scale``), event rate, volume, bads and
    share of all bads.  ``mode`` = 'qcut' (quantile bins) or 'cut' (equal width)."""
    g = list(group_cols)
    key = [*g] if g else []
    long = df.select(*g, F.col(target).alias("_y"), F.col(score).cast("double").alias("value"))
    long = long.withColumn("variable", F.lit("score") if not g else F.to_json(F.struct(*g)))
    fitted = fit_bins(long.filter(F.col("value").isNotNull()), bins, mode)
    from .binning import apply_bins, apply_single_bins
    present = long.filter(F.col("value").isNotNull())
    b = apply_bins(present, fitted) if g else apply_single_bins(present, fitted)
    y = F.col("_y").cast("double")
    t = b.groupBy(*key, F.col("bin").alias("decile")).agg(
        (F.min("value") * scale).alias("min_score"), (F.max("value") * scale).alias("max_score"),
        F.avg(y).alias("event_rate"), F.count(F.lit(1)).alias("volume"),
        F.sum((F.col("_y") == 1).cast("long")).alias("qt_bads"))
    if not g:  # the total is one scalar, not a window without partitionBy
        tot = t.agg(F.sum("qt_bads").alias("_tot_bads"))
        return (with_row(t, tot).withColumn("perc_total_bads", F.try_divide(F.col("qt_bads"), F.col("_tot_bads")))
                .drop("_tot_bads"))
    w = Window.partitionBy(*key)
    return t.withColumn("perc_total_bads", F.try_divide(F.col("qt_bads"), F.sum("qt_bads").over(w)))


def decile_train_test_summary(train: DataFrame, test: DataFrame, score: str, target: str,
                              bins: int = 10) -> DataFrame:
    a = decile_table(train, score, target, bins).select(
        "decile", F.col("event_rate").alias("event_rate_train"),
        F.col("perc_total_bads").alias("perc_total_bads_train"), F.col("volume").alias("volume_train"))
    b = decile_table(test, score, target, bins).select(
        "decile", F.col("event_rate").alias("event_rate_test"),
        F.col("perc_total_bads").alias("perc_total_bads_test"), F.col("volume").alias("volume_test"))
    return a.join(b, "decile")


def ks_gini_by_vintage(df: DataFrame, score: str, label: str, safra: str) -> DataFrame:
    """Per safra: KS (x100, from the ROC) and Gini (x100)."""
    ks = ks_from_roc(df, score, label, [safra])
    auc = roc_auc(df, score, label, [safra]).select(safra, (F.col("gini") * 100).alias("gini"))
    return ks.join(auc, safra)


def classification_report(df: DataFrame, score: str, label: str,
                          group_cols: Sequence[str] = ("model", "split"),
                          threshold: float = 0.5) -> DataFrame:
    """Model x split table of accuracy, precision, recall, AUC, Gini, KS."""
    g = list(group_cols)
    cm = confusion_metrics(df, score, label, threshold, g).select(*g, "accuracy", "precision", "recall")
    c = cumulative_counts(df, score, label, g)  # the rows are scored for it once
    auc, ks = _auc(c, g), _ks_curve(c, g).groupBy(*g).agg(F.max("ks").alias("ks"))
    return cm.join(auc, g).join(ks, g)


def score_report(train: DataFrame, test: DataFrame, score: str, target: str, bins: int = 10
                 ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(KS/AUC/Gini per split, equal-width decile table of train, of test)."""
    both = (train.select(F.lit("train").alias("split"), score, target)
            .unionByName(test.select(F.lit("test").alias("split"), score, target)))
    m = roc_auc(both, score, target, ["split"]).join(ks_statistic(both, score, target, ["split"]), "split")
    return (m, decile_table(train, score, target, bins, "cut", scale=1.0),
            decile_table(test, score, target, bins, "cut", scale=1.0))


def regression_metrics(df: DataFrame, label: str, pred: str, group_cols: Sequence[str] = ()
                       ) -> DataFrame:
    """R2, MAE, MSE, RMSE, MAPE (%) in one aggregation."""
    y, p = F.col(label).cast("double"), F.col(pred).cast("double")
    e = y - p
    a = df.groupBy(*group_cols).agg(
        F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"),
        F.avg(F.abs(F.try_divide(e, y))).alias("_mape"),
        F.sum(e * e).alias("_sse"), F.var_pop(y).alias("_var"), F.count(F.lit(1)).alias("_n"))
    return a.select(*group_cols, (1 - F.try_divide(F.col("_sse"), F.col("_var") * F.col("_n"))).alias("r2"),
                    "mae", "mse", F.sqrt("mse").alias("rmse"), (F.col("_mape") * 100).alias("mape"))
