"""Registered queries: model training/selection/scoring, compositions, sources."""

from __future__ import annotations

import uuid
import zlib

from pyspark.sql import functions as F

from ..operators import boosting
from ..operators import metrics as M
from ..operators import model as ML
from ..operators import woe as W
from ..sources.files import scan_csv_strings, write_csv
from ..session import checkpointed, scratch_path
from . import modelling as MD
from . import oracle as O
from . import roles as R
from .registry import register
from .registry_tools import _WOE_BINNED, FEATURES, NUMERIC, rounded, with_lab

_IV_SQL = with_lab(_WOE_BINNED,
                   "ivt AS (SELECT variable AS feature, sum(iv) AS importance FROM woe GROUP BY variable)")


def _iv_importances(spark, d):
    t = W.iv_table(R.labelled(spark, d), "target", FEATURES)
    return rounded(t.select(F.col("variable").alias("feature"), F.col("iv").alias("importance")))


@register("top_k_features", _IV_SQL + f"""
SELECT feature, {O.rnd('importance')} AS importance FROM ivt ORDER BY importance DESC, feature LIMIT 3""")
def q_top_k(spark, d):
    return ML.top_k_features(_iv_importances(spark, d), 3)


@register("threshold_by_max", _IV_SQL + f"""
SELECT feature, {O.rnd('importance')} AS importance FROM ivt WHERE importance > 0.2 * (SELECT max(importance) FROM ivt)""")
def q_threshold(spark, d):
    return ML.threshold_by_max(_iv_importances(spark, d), 0.2)


@register("sample_rows")
def q_sample(spark, d):
    return ML.sample_rows(R.labelled(spark, d), 1000, ["l_orderkey", "l_linenumber", "l_partkey"])


def _split(spark, d):
    lab = R.labelled(spark, d)
    return (lab.filter(F.col("safra") < R.TEST_FROM_SAFRA), lab.filter(F.col("safra") >= R.TEST_FROM_SAFRA))


@register("fit_tree_models")
def q_fit_trees(spark, d):
    tr, te = _split(spark, d)
    models = ML.fit_tree_models(tr, NUMERIC, "target")
    parts = []
    for name, m in models.items():
        s = ML.score(m, te, NUMERIC).select(F.lit(name).alias("model"), F.lit("test").alias("split"),
                                            "score", "target")
        parts.append(s)
    stacked = parts[0]
    for p in parts[1:]:
        stacked = stacked.unionByName(p)
    return M.classification_report(stacked, "score", "target")


@register("rf_feature_selection")
def q_rf_select(spark, d):
    tr, _ = _split(spark, d)
    return ML.rf_feature_selection(tr, NUMERIC, "target", "max_ratio", 0.2)


@register("rf_feature_selection_top_k")
def q_rf_top(spark, d):
    tr, _ = _split(spark, d)
    return ML.rf_feature_selection(tr, NUMERIC, "target", "top_k", k=20)


KEY = ["l_orderkey", "l_linenumber", "l_partkey"]
# the finished searches of this application: a few hundred parameter rows
_SEARCHED: dict[tuple[str, str], list] = {}


def _searched(spark, d):
    at = (spark.sparkContext.applicationId, d)
    if at not in _SEARCHED:
        _SEARCHED[at] = ML.cv_search(_split(spark, d)[0], NUMERIC, "target", KEY).collect()
    return spark.createDataFrame(_SEARCHED[at], "trial int, params string, mean_auc double, fold_auc array<double>")


@register("cv_search")
def q_cv(spark, d):
    return _searched(spark, d)


@register("fit_best_score")
def q_fit_best(spark, d):
    """Refit with the search's best row, saved and read again, on the test side."""
    tr, te = _split(spark, d)
    model = boosting.fit(tr, NUMERIC, "target", KEY, ML.best_params(_searched(spark, d)))
    path = scratch_path(spark, f"fit_best-{uuid.uuid4().hex}")
    model.save(spark, path)
    scored = boosting.BoostedTrees.load(spark, path).score(te.select("l_orderkey", "l_linenumber", *NUMERIC, "target"))
    return scored.select("l_orderkey", "l_linenumber", "score", "target")


@register("logit_scorecard")
def q_logit(spark, d):
    return ML.logit_scorecard(R.labelled(spark, d), NUMERIC, "target")


@register("permutation_importance")
def q_perm(spark, d):
    tr, te = _split(spark, d)
    m = ML.fit_tree_models(tr, NUMERIC, "target", ["decision_tree"])["decision_tree"]
    return ML.permutation_importance(m, te, NUMERIC, "target")


@register("tree_bins")
def q_tree_bins(spark, d):
    return ML.tree_bins_fit(R.labelled(spark, d), "l_extendedprice", "target", 5)


@register("noise_jitter_deciles")
def q_jitter(spark, d):
    return ML.noise_jitter_deciles(R.labelled(spark, d), "score", "target", 10,
                                   keys=["l_orderkey", "l_linenumber", "l_partkey"])


def _report(spark, d):
    lab = R.labelled(spark, d)
    split = F.when(F.col("safra") < R.TEST_FROM_SAFRA, "train").otherwise("test")
    return MD.model_report(lab.withColumn("split", split), "score", "target")


_SPLIT_CUM = f"""
sp AS (SELECT *, CASE WHEN safra < {R.TEST_FROM_SAFRA} THEN 'train' ELSE 'test' END AS split FROM r_lab),
sc AS (SELECT split, score, count(*) AS n, sum(CAST(target AS DOUBLE)) AS pos, sum(1 - CAST(target AS DOUBLE)) AS neg
       FROM sp WHERE score IS NOT NULL AND target IS NOT NULL GROUP BY split, score),
cum AS (SELECT *, sum(n) OVER w AS cum_n, sum(pos) OVER w AS cum_pos, sum(neg) OVER w AS cum_neg,
               sum(pos) OVER (PARTITION BY split) AS pos_total, sum(neg) OVER (PARTITION BY split) AS neg_total
        FROM sc WINDOW w AS (PARTITION BY split ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
auc AS (SELECT split, sum(pos * (neg_total - cum_neg + 0.5 * neg)) / (max(pos_total) * max(neg_total)) AS auc,
               max(abs(cum_pos / pos_total - cum_neg / neg_total)) AS ks FROM cum GROUP BY split),
cm AS (SELECT split, count(*) FILTER (score > 0.5 AND target = 1) AS tp, count(*) FILTER (score > 0.5 AND target = 0) AS fp,
              count(*) FILTER (score <= 0.5 AND target = 0) AS tn, count(*) FILTER (score <= 0.5 AND target = 1) AS fn
       FROM sp GROUP BY split),
rates AS (SELECT *, (tp + tn) / (tp + fp + tn + fn) AS accuracy, coalesce(tp / nullif(tp + fp, 0), 0) AS precision,
                 coalesce(tp / nullif(tp + fn, 0), 0) AS recall FROM cm)"""


@register("model_report", with_lab(_SPLIT_CUM) + f"""
SELECT split, {O.rnd('auc')} AS auc, {O.rnd('2 * auc - 1')} AS gini, {O.rnd('ks')} AS ks, tp, fp, tn, fn,
       {O.rnd('accuracy')} AS accuracy, {O.rnd('precision')} AS precision, {O.rnd('recall')} AS recall,
       {O.rnd('coalesce(2 * precision * recall / nullif(precision + recall, 0), 0)')} AS f1
FROM auc JOIN rates USING (split)""")
def q_report(spark, d):
    rep = _report(spark, d)
    return rounded(rep["auc"].join(rep["ks"], "split").join(rep["confusion"], "split"))


@register("model_report_curves", with_lab(_SPLIT_CUM) + f"""
SELECT split, score AS threshold, {O.rnd('cum_neg / neg_total')} AS fpr, {O.rnd('cum_pos / pos_total')} AS tpr, 'roc' AS curve,
       NULL::DOUBLE AS precision, NULL::DOUBLE AS recall FROM cum
UNION ALL SELECT DISTINCT split, 'inf'::DOUBLE, 0::DOUBLE, 0::DOUBLE, 'roc', NULL::DOUBLE, NULL::DOUBLE FROM cum
UNION ALL SELECT split, score, NULL, NULL, 'pr', {O.rnd('cum_pos / cum_n')}, {O.rnd('cum_pos / pos_total')} FROM cum
UNION ALL SELECT DISTINCT split, NULL::DOUBLE, NULL::DOUBLE, NULL::DOUBLE, 'pr', 1::DOUBLE, 0::DOUBLE FROM cum""")
def q_report_curves(spark, d):
    """The report's ROC and precision-recall curves per split."""
    rep = _report(spark, d)
    return rounded(rep["roc"].withColumn("curve", F.lit("roc")).unionByName(
        rep["pr"].withColumn("curve", F.lit("pr")), allowMissingColumns=True))


@register("model_report_event_rate", with_lab(_SPLIT_CUM) + f"""
SELECT split, {O.rnd('avg(CAST(target AS DOUBLE))')} AS taxa_de_evento, count(*) AS volume FROM sp GROUP BY split""")
def q_report_event_rate(spark, d):
    return rounded(_report(spark, d)["event_rate"])


@register("model_report_deciles")
def q_report_deciles(spark, d):
    """The report's jittered decile ordering."""
    return _report(spark, d)["deciles"]


@register("preprocess_select")
def q_preprocess(spark, d):
    # joined once: every fit reads all rows
    df = checkpointed(R.items_with_parts(spark, d).select(
        "l_orderkey", "l_linenumber", "l_partkey", "target", *NUMERIC, "p_brand", "p_type", "p_size"))
    out, _, _ = MD.preprocess_select(df, "target", ["l_orderkey", "l_linenumber", "l_partkey"])
    return out


@register("dataprep")
def q_dataprep(spark, d):
    ip = checkpointed(R.items_with_parts(spark, d).select("l_orderkey", "l_linenumber", "l_partkey", "safra",
                                                          "target", *NUMERIC, "p_brand", "p_type"))
    tr = ip.filter(F.col("safra") < R.TEST_FROM_SAFRA).drop("safra")
    te = ip.filter(F.col("safra") >= R.TEST_FROM_SAFRA).drop("safra")
    tr_out, te_out, _ = MD.dataprep(tr, te, "target", ["l_orderkey", "l_linenumber", "l_partkey"])
    return tr_out.withColumn("split", F.lit("train")).unionByName(
        te_out.withColumn("split", F.lit("test")))


@register("column_transformer")
def q_column_transformer(spark, d):
    ip = checkpointed(R.items_with_parts(spark, d))
    tr = ip.filter(F.col("safra") < R.TEST_FROM_SAFRA)
    te = ip.filter(F.col("safra") >= R.TEST_FROM_SAFRA)
    tr_out, te_out = MD.column_transformer(tr, te, "target", ["l_orderkey", "l_linenumber"],
                                           ["l_linestatus"], ["p_brand", "p_type"], NUMERIC)
    return tr_out.withColumn("split", F.lit("train")).unionByName(
        te_out.withColumn("split", F.lit("test")))


# ---------------------------------------------------------------- sources
_CUSTOMER_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


@register("scan_csv_strings", "SELECT " + ", ".join(
    f"CAST({c} AS VARCHAR) AS {c}" if c != "c_acctbal" else
    "CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS c_acctbal" for c in _CUSTOMER_COLS) + " FROM customer")
def q_scan_csv(spark, d):
    """Landing round trip: customers written as quoted CSV, read back all-STRING."""
    c = R.table(spark, d, "customer").select(
        *[F.col(x).cast("decimal(18,2)").cast("string").alias(x) if x == "c_acctbal" else F.col(x).cast("string")
          for x in _CUSTOMER_COLS])
    path = scratch_path(spark, f"landing_customer_{zlib.crc32(d.encode())}")
    write_csv(c, path)
    return scan_csv_strings(spark, path, _CUSTOMER_COLS)
