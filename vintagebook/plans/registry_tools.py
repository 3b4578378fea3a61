"""Registered queries of the scorecard toolbox (rates, binning, WoE/IV, metrics)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..operators import binning as BN
from ..operators import metrics as M
from ..operators import rates as RT
from ..operators import woe as W
from . import oracle as O
from . import roles as R
from .registry import register

FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linestatus"]
NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
# The status recoding used by the domain-mapping query.
STATUS_MAP = [("O", "OPEN"), ("F", "FILLED")]


def rounded(df: DataFrame, digits: int = 10) -> DataFrame:
    """Round every DOUBLE column (sums of doubles differ in the last bits between engines)."""
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name)
                       if isinstance(f.dataType, DoubleType) else F.col(f.name)
                       for f in df.schema.fields])


def lab(spark, d):
    return R.labelled(spark, d)


def with_lab(*ctes: str) -> str:
    return "WITH " + ",".join([O.LABELLED, *ctes])


def dbl(cols, digits=10):
    return ", ".join(f"{O.rnd(c, digits)} AS {c}" for c in cols)


# ---------------------------------------------------------------- WoE / IV
_NUM_LONG = O.unpivot_sql("r_lab", NUMERIC, ["target"])
_WOE_BINNED = f"""
nl AS ({_NUM_LONG}),
ed AS ({O.fit_bins_sql('nl', 10)}),
bl AS (SELECT nl.variable, CAST({O.bin_sql('nl.value', 'ed.edges')} AS VARCHAR) AS bin_key, target
       FROM nl JOIN ed ON nl.variable = ed.variable WHERE nl.value IS NOT NULL AND target IS NOT NULL
       UNION ALL
       SELECT 'l_linestatus', l_linestatus, target FROM r_lab WHERE l_linestatus IS NOT NULL AND target IS NOT NULL),
cnt AS (SELECT variable, bin_key, count(*) AS "all", sum(CASE WHEN target = 1 THEN 1 ELSE 0 END) AS good,
               sum(CASE WHEN target = 0 THEN 1 ELSE 0 END) AS bad FROM bl GROUP BY variable, bin_key),
sh AS (SELECT *, good / sum(good) OVER (PARTITION BY variable) AS dg, bad / sum(bad) OVER (PARTITION BY variable) AS db FROM cnt),
wt AS (SELECT variable, bin_key, "all", good, bad,
              CASE WHEN dg = 0 THEN 1e-6 ELSE dg END AS distr_good, CASE WHEN db = 0 THEN 1e-6 ELSE db END AS distr_bad FROM sh),
woe AS (SELECT *, ln(distr_good / distr_bad) AS woe, (distr_good - distr_bad) * ln(distr_good / distr_bad) AS iv FROM wt)"""


@register("woe_iv", with_lab(_WOE_BINNED) + f"""
SELECT variable, bin_key, CAST("all" AS BIGINT) AS "all", CAST(good AS BIGINT) AS good, CAST(bad AS BIGINT) AS bad,
       {dbl(['distr_good', 'distr_bad', 'woe', 'iv'])} FROM woe""")
def q_woe(spark, d):
    t = W.woe_table(lab(spark, d), "target", FEATURES)
    return rounded(t.select("variable", "bin_key", F.col("all").cast("bigint").alias("all"),
                            F.col("good").cast("bigint").alias("good"),
                            F.col("bad").cast("bigint").alias("bad"),
                            "distr_good", "distr_bad", "woe", "iv"))


@register("iv_table", with_lab(_WOE_BINNED) + f"""
SELECT variable, {O.rnd('sum(iv)')} AS iv,
       CASE WHEN sum(iv) < 0.02 THEN 'Inútil para a predição' WHEN sum(iv) < 0.1 THEN 'Preditor Fraco'
            WHEN sum(iv) < 0.3 THEN 'Preditor Moderado' ELSE 'Preditor Forte' END AS predictiveness
FROM woe GROUP BY variable""")
def q_iv_table(spark, d):
    return rounded(W.iv_table(lab(spark, d), "target", FEATURES))


def _r2(x):
    return O.r2(x, 2)


_BIV = with_lab(_WOE_BINNED.split("cnt AS")[0].rstrip().rstrip(","), f"""
c AS (SELECT variable, bin_key, sum(CASE WHEN target = 1 THEN 1 ELSE 0 END) AS n_target_1,
             sum(CASE WHEN target = 0 THEN 1 ELSE 0 END) AS n_target_0 FROM bl GROUP BY variable, bin_key),
c1 AS (SELECT *, n_target_1 + n_target_0 AS total FROM c),
c2 AS (SELECT *, {_r2('total / sum(total) OVER (PARTITION BY variable) * 100')} AS pct_freq,
              {_r2('n_target_1 / sum(n_target_1) OVER (PARTITION BY variable) * 100')} AS pct_target_1,
              {_r2('n_target_0 / sum(n_target_0) OVER (PARTITION BY variable) * 100')} AS p0 FROM c1),
c3 AS (SELECT * EXCLUDE (p0), CASE WHEN p0 = 0 THEN 0.01 ELSE p0 END AS pct_target_0,
              {_r2('n_target_1 / total * 100')} AS taxa_target_1 FROM c2),
c4 AS (SELECT *, CASE WHEN {_r2('pct_target_1 / pct_target_0')} = 0 THEN 0.01 ELSE {_r2('pct_target_1 / pct_target_0')} END AS odds FROM c3),
c5 AS (SELECT *, {_r2('ln(odds)')} AS ln_odds FROM c4),
biv AS (SELECT variable, bin_key, CAST(n_target_1 AS BIGINT) AS n_target_1, CAST(n_target_0 AS BIGINT) AS n_target_0,
               CAST(total AS BIGINT) AS total, pct_freq, pct_target_1, pct_target_0, taxa_target_1, odds, ln_odds,
               CASE WHEN odds = 0.01 THEN 0.0 ELSE {_r2('(pct_target_1 / 100 - pct_target_0 / 100) * ln_odds')} END AS iv
        FROM c5)""")


def _biv(spark, d):
    b = W.bivariate_table(lab(spark, d), "target", 10, FEATURES)
    return b.select("variable", "bin_key", *[F.col(c).cast("bigint").alias(c) for c in
                                             ("n_target_1", "n_target_0", "total")],
                    *[F.col(c).cast("double").alias(c) for c in
                      ("pct_freq", "pct_target_1", "pct_target_0", "taxa_target_1", "odds", "ln_odds", "iv")])


@register("bivariate_table", _BIV + "\nSELECT * FROM biv")
def q_biv(spark, d):
    return _biv(spark, d)


@register("iv_ranking", _BIV + f"\nSELECT variable, {O.rnd('sum(iv)', 6)} AS iv FROM biv GROUP BY variable")
def q_iv_rank(spark, d):
    return W.iv_ranking(_biv(spark, d)).select("variable", F.round("iv", 6).alias("iv"))


_SIMNAO = with_lab("""
sn AS (SELECT l_linestatus, l_discount, CASE WHEN l_returnflag = 'R' THEN 'Sim' ELSE 'Não' END AS resp FROM r_lab)""")


def _simnao(spark, d):
    return lab(spark, d).select("l_linestatus", "l_discount",
                                F.when(F.col("l_returnflag") == "R", "Sim").otherwise("Não").alias("resp"))


def _iv_simnao_sql(var: str, src: str) -> str:
    return f"""
c AS (SELECT {var}, sum(CASE WHEN resp = 'Sim' THEN 1 ELSE 0 END) AS Sim, sum(CASE WHEN resp = 'Não' THEN 1 ELSE 0 END) AS Nao
      FROM {src} WHERE {var} IS NOT NULL AND resp IS NOT NULL GROUP BY {var}),
p AS (SELECT *, {_r2('Sim / sum(Sim) OVER () * 100')} AS pct_sim, {_r2('Nao / sum(Nao) OVER () * 100')} AS pct_nao,
             {_r2('Sim / (Nao + Sim) * 100')} AS pct_freq_linha FROM c)
SELECT {var}, CAST(Sim AS BIGINT) AS Sim, CAST(Nao AS BIGINT) AS Nao, pct_sim, pct_nao, pct_freq_linha,
       {O.rnd('pct_sim / NULLIF(pct_nao, 0)')} AS woe,
       {O.rnd('(pct_sim / 100 - pct_nao / 100) * CASE WHEN pct_sim > 0 AND pct_nao > 0 THEN ln(pct_sim / pct_nao) ELSE 0 END')} AS iv
FROM p"""


def _simnao_out(df):
    return rounded(df.select(*[F.col(c).cast("bigint").alias(c) if c in ("Sim", "Nao") else F.col(c)
                               for c in df.columns]))


@register("iv_category", _SIMNAO + "," + _iv_simnao_sql("l_linestatus", "sn"))
def q_iv_cat(spark, d):
    return _simnao_out(W.iv_category(_simnao(spark, d), "resp", "l_linestatus"))


@register("iv_bin", _SIMNAO + f""",
lv AS (SELECT 'l_discount' AS variable, l_discount AS value FROM sn),
ed AS ({O.fit_bins_sql('lv', 5, 'cut')}),
sb AS (SELECT CAST({O.bin_sql('l_discount', 'ed.edges')} AS INTEGER) AS l_discount_bin, resp FROM sn CROSS JOIN ed),""" +
          _iv_simnao_sql("l_discount_bin", "sb"))
def q_iv_bin(spark, d):
    return _simnao_out(W.iv_bin(_simnao(spark, d), "resp", "l_discount", 5))


@register("logodds_linearity", with_lab(f"""
nl AS ({O.unpivot_sql('r_lab', NUMERIC, ['target'])}),
st AS (SELECT variable, count(DISTINCT value) AS nd, min(value) AS mn, max(value) AS mx FROM nl WHERE value IS NOT NULL
       GROUP BY variable HAVING count(DISTINCT value) > 1),
ed AS (SELECT variable, list_transform(list_transform(range(0, least(nd, 10) + 1), lambda i: CASE WHEN i = least(nd, 10) THEN mx
              ELSE CAST(i AS DOUBLE) * ((mx - mn) / least(nd, 10)) + mn END), lambda e, i: CASE WHEN i = 1 THEN e - (mx - mn) * 0.001 ELSE e END) AS edges FROM st),
b AS (SELECT nl.variable, len(list_filter(edges, lambda e: e < value)) - 1 AS bin, value, target
      FROM nl JOIN ed ON nl.variable = ed.variable WHERE value IS NOT NULL),
g AS (SELECT variable, bin, avg(value) AS x, avg(CAST(target AS DOUBLE)) AS rate FROM b GROUP BY variable, bin),
lo AS (SELECT *, ln(rate / (1 - rate)) AS log_odds FROM g WHERE rate > 0 AND rate < 1)""") + f"""
SELECT variable, {O.rnd('regr_r2(log_odds, x)')} AS r2,
       CASE WHEN regr_r2(log_odds, x) > 0.85 THEN 'Usar como contínua' ELSE 'Categorizar' END AS feat_eng
FROM lo GROUP BY variable""")
def q_logodds(spark, d):
    return rounded(W.logodds_linearity(lab(spark, d), "target", NUMERIC, 0.85))


# ---------------------------------------------------------------- event rates
@register("event_rate_by_vintage", with_lab() .rstrip(",") + f"""
SELECT safra, {O.rnd('avg(CAST(target AS DOUBLE))')} AS taxa_de_evento, count(safra) AS volume FROM r_lab GROUP BY safra""")
def q_er_vintage(spark, d):
    return rounded(RT.event_rate_by_vintage(lab(spark, d), "target", "safra"))


@register("event_rate_by_category", with_lab() + f"""
SELECT CAST(round(l_discount, 4) AS VARCHAR) AS l_discount, {O.rnd('avg(CAST(target AS DOUBLE))')} AS taxa_de_evento,
       count(*) AS volume FROM r_lab WHERE l_discount IS NOT NULL GROUP BY 1""")
def q_er_cat(spark, d):
    return rounded(RT.event_rate_by_category(lab(spark, d), "l_discount", "target"))


@register("event_rate_grid", with_lab(f"""
g AS (SELECT 'l_linestatus' AS variable, l_linestatus AS value, target FROM r_lab
      UNION ALL SELECT 'l_discount', CAST(round(l_discount, 4) AS VARCHAR), target FROM r_lab
      UNION ALL SELECT 'l_tax', CAST(round(l_tax, 4) AS VARCHAR), target FROM r_lab
      UNION ALL SELECT 'l_quantity', CAST(round(l_quantity, 4) AS VARCHAR), target FROM r_lab),
keep AS (SELECT variable FROM g WHERE value IS NOT NULL GROUP BY variable
         HAVING variable = 'l_linestatus' OR count(DISTINCT value) <= 20)""") + f"""
SELECT variable, value, {O.rnd('avg(CAST(target AS DOUBLE))')} AS taxa_de_evento, count(*) AS volume
FROM g WHERE value IS NOT NULL AND variable IN (SELECT variable FROM keep) GROUP BY variable, value""")
def q_er_grid(spark, d):
    df = lab(spark, d).select("target", "l_linestatus", "l_discount", "l_tax", "l_quantity")
    return rounded(RT.event_rate_grid(df, "target", 20))


@register("event_rate_by_vintage_category", with_lab() + f"""
SELECT *, CAST(sum(volume) OVER (PARTITION BY safra) AS BIGINT) AS volume_safra FROM (
  SELECT safra, l_linestatus, {O.rnd('avg(CAST(target AS DOUBLE))')} AS taxa_de_evento, count(*) AS volume
  FROM r_lab WHERE l_linestatus IS NOT NULL GROUP BY safra, l_linestatus)""")
def q_er_vc(spark, d):
    return rounded(RT.event_rate_by_vintage_category(lab(spark, d), "safra", "l_linestatus", "target"))


@register("volume_by_vintage", with_lab() + """
SELECT safra, CAST(sum(volume) AS BIGINT) AS volume FROM (SELECT safra, l_linestatus, count(*) AS volume FROM r_lab
WHERE l_linestatus IS NOT NULL GROUP BY safra, l_linestatus) GROUP BY safra""")
def q_vol_vintage(spark, d):
    r = RT.event_rate_by_vintage_category(lab(spark, d), "safra", "l_linestatus", "target")
    return RT.volume_by_vintage(r, "safra")


_MAP_SQL = " UNION ALL ".join(f"SELECT '{a}' AS l_linestatus, '{b}' AS mapped" for a, b in STATUS_MAP)


@register("domain_mapping", with_lab(f"m AS ({_MAP_SQL})") + f"""
SELECT *, CAST(sum(volume) OVER (PARTITION BY safra) AS BIGINT) AS volume_safra FROM (
  SELECT safra, coalesce(m.mapped, r.l_linestatus) AS TFB_l_linestatus, {O.rnd('avg(CAST(target AS DOUBLE))')} AS taxa_de_evento,
         count(*) AS volume
  FROM r_lab r LEFT JOIN m ON r.l_linestatus = m.l_linestatus
  WHERE coalesce(m.mapped, r.l_linestatus) IS NOT NULL GROUP BY 1, 2)""")
def q_domain(spark, d):
    m = spark.createDataFrame(STATUS_MAP, "l_linestatus string, mapped string")
    return rounded(RT.domain_mapping(lab(spark, d), "l_linestatus", m, "safra", "target")[0])


@register("category_counts", with_lab(f"""
g AS (SELECT variable, value, count(*) AS count FROM (
        SELECT 'l_returnflag' AS variable, l_returnflag AS value FROM r_lab
        UNION ALL SELECT 'l_linestatus', l_linestatus FROM r_lab) GROUP BY variable, value)""") + f"""
SELECT variable, value, count, {O.r2('count / sum(count) OVER (PARTITION BY variable) * 100')} AS pct FROM g
UNION ALL SELECT variable, 'Total', CAST(sum(count) AS BIGINT), 100.0 FROM g GROUP BY variable""")
def q_cat_counts(spark, d):
    return RT.category_counts(lab(spark, d), ["l_returnflag", "l_linestatus"])


@register("crosstab_normalized", with_lab() + f"""
SELECT l_linestatus, {O.rnd('sum(CASE WHEN target = 0 THEN 1 ELSE 0 END) / count(*)')} AS share_0,
       {O.rnd('sum(CASE WHEN target = 1 THEN 1 ELSE 0 END) / count(*)')} AS share_1
FROM r_lab WHERE l_linestatus IS NOT NULL AND target IS NOT NULL GROUP BY l_linestatus""")
def q_crosstab(spark, d):
    return rounded(RT.crosstab_normalized(lab(spark, d), "l_linestatus", "target"))


@register("pivot_count", """
SELECT l_linestatus, count(*) FILTER (WHERE l_returnflag = 'A') AS A, count(*) FILTER (WHERE l_returnflag = 'N') AS N,
       count(*) FILTER (WHERE l_returnflag = 'R') AS R FROM lineitem GROUP BY l_linestatus""")
def q_pivot(spark, d):
    return RT.pivot_count(R.table(spark, d, "lineitem"), "l_linestatus", "l_returnflag", ["A", "N", "R"])


@register("category_frequency", """
WITH g AS (SELECT variable, value, count(*) AS count FROM (
  SELECT 'o_orderstatus' AS variable, o_orderstatus AS value FROM orders
  UNION ALL SELECT 'o_orderpriority', o_orderpriority FROM orders) GROUP BY variable, value),
k AS (SELECT variable FROM g WHERE value IS NOT NULL GROUP BY variable HAVING count(*) <= 30)
SELECT * FROM g WHERE variable IN (SELECT variable FROM k)""")
def q_cat_freq(spark, d):
    return RT.category_frequency(R.table(spark, d, "orders"), 30)


@register("share_of_total", """
SELECT l_returnflag, count(*) AS n, count(*) / sum(count(*)) OVER () AS share_n FROM lineitem GROUP BY l_returnflag""")
def q_share(spark, d):
    g = R.table(spark, d, "lineitem").groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))
    return RT.share_of_total(g, "n")


# ---------------------------------------------------------------- binning
@register("qcut", with_lab(f"""
lv AS (SELECT 'l_extendedprice' AS variable, l_extendedprice AS value FROM r_lab),
ed AS ({O.fit_bins_sql('lv', 10)})""") + f"""
SELECT l_orderkey, l_linenumber, l_extendedprice, CAST({O.bin_sql('l_extendedprice', 'edges')} AS INTEGER) AS l_extendedprice_bin
FROM r_lab CROSS JOIN ed""")
def q_qcut(spark, d):
    df = lab(spark, d).select("l_orderkey", "l_linenumber", "l_extendedprice")
    return BN.qcut(df, "l_extendedprice", 10)


@register("cut", with_lab(f"""
lv AS (SELECT 'l_extendedprice' AS variable, l_extendedprice AS value FROM r_lab),
ed AS ({O.fit_bins_sql('lv', 10, 'cut')})""") + f"""
SELECT l_orderkey, l_linenumber, l_extendedprice, CAST({O.bin_sql('l_extendedprice', 'edges')} AS INTEGER) AS l_extendedprice_bin
FROM r_lab CROSS JOIN ed""")
def q_cut(spark, d):
    df = lab(spark, d).select("l_orderkey", "l_linenumber", "l_extendedprice")
    return BN.cut(df, "l_extendedprice", 10)


@register("categorize_numericals", with_lab(f"""
nl AS ({O.unpivot_sql('r_lab', ['l_quantity', 'l_discount', 'l_tax'])}),
ed AS ({O.fit_bins_sql('nl', 10)})""") + f"""
SELECT l_orderkey, l_linenumber, l_linestatus, target,
  """ + ", ".join(f"CAST({O.bin_sql(c, f'(SELECT edges FROM ed WHERE variable = {chr(39)}{c}{chr(39)})')} AS INTEGER) AS BIN_{c}"
                  for c in ["l_quantity", "l_discount", "l_tax"]) + " FROM r_lab")
def q_categorize(spark, d):
    df = lab(spark, d).select("l_orderkey", "l_linenumber", "l_linestatus", "target",
                              "l_quantity", "l_discount", "l_tax")
    out, _ = BN.categorize_numericals(df, 10, target="target", keep=["l_orderkey", "l_linenumber"])
    return out


_DEC_SQL = f"""
lv AS (SELECT 'score' AS variable, score AS value, target FROM r_lab),
ed AS ({O.fit_bins_sql('lv', 10)}),
b AS (SELECT {O.bin_sql('value', 'edges')} AS decile, value, target FROM lv CROSS JOIN ed WHERE value IS NOT NULL),
t AS (SELECT decile, min(value) * 1000 AS min_score, max(value) * 1000 AS max_score, avg(CAST(target AS DOUBLE)) AS event_rate,
             count(*) AS volume, sum(CASE WHEN target = 1 THEN 1 ELSE 0 END) AS qt_bads FROM b GROUP BY decile)"""


@register("decile_table", with_lab(_DEC_SQL) + f"""
SELECT CAST(decile AS INTEGER) AS decile, {dbl(['min_score', 'max_score', 'event_rate'])}, volume,
       CAST(qt_bads AS BIGINT) AS qt_bads, {O.rnd('qt_bads / sum(qt_bads) OVER ()')} AS perc_total_bads FROM t""")
def q_decile(spark, d):
    return rounded(M.decile_table(lab(spark, d), "score", "target", 10, "qcut"))


# ---------------------------------------------------------------- evaluation
_SC = """
sc AS (SELECT score, count(*) AS n, sum(CAST(target AS DOUBLE)) AS pos, sum(1 - CAST(target AS DOUBLE)) AS neg
       FROM r_lab WHERE score IS NOT NULL AND target IS NOT NULL GROUP BY score),
cum AS (SELECT *, sum(n) OVER w AS cum_n, sum(pos) OVER w AS cum_pos, sum(neg) OVER w AS cum_neg,
               sum(n) OVER () AS n_total, sum(pos) OVER () AS pos_total, sum(neg) OVER () AS neg_total
        FROM sc WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


@register("ks_statistic", with_lab(_SC) + f"""
SELECT {O.rnd('max(abs(cum_pos / pos_total - cum_neg / neg_total))')} AS ks FROM cum""")
def q_ks(spark, d):
    return rounded(M.ks_statistic(lab(spark, d), "score", "target"))


@register("ks_curve", with_lab(_SC) + f"""
SELECT score, {O.rnd('cum_pos / pos_total')} AS cum_events_pct, {O.rnd('cum_neg / neg_total')} AS cum_non_events_pct,
       {O.rnd('abs(cum_pos / pos_total - cum_neg / neg_total)')} AS ks FROM cum""")
def q_ks_curve(spark, d):
    return rounded(M.ks_curve(lab(spark, d), "score", "target"))


@register("ks_from_roc", with_lab(_SC) + f"""
SELECT {O.rnd('greatest(max(cum_pos / pos_total - cum_neg / neg_total), 0.0) * 100')} AS ks FROM cum""")
def q_ks_roc(spark, d):
    return rounded(M.ks_from_roc(lab(spark, d), "score", "target"))


@register("roc_auc", with_lab(_SC) + f"""
SELECT {O.rnd('sum(pos * (neg_total - cum_neg + 0.5 * neg)) / (max(pos_total) * max(neg_total))')} AS auc,
       {O.rnd('2 * sum(pos * (neg_total - cum_neg + 0.5 * neg)) / (max(pos_total) * max(neg_total)) - 1')} AS gini FROM cum""")
def q_auc(spark, d):
    return rounded(M.roc_auc(lab(spark, d), "score", "target"))


def _lorenz_sql(name: str, key: str) -> str:
    return f"""
{name}_g AS (SELECT CAST({key} AS DOUBLE) AS key, CAST(count(*) AS DOUBLE) AS m, sum(CAST(target AS DOUBLE)) AS p
             FROM r_lab WHERE score IS NOT NULL AND target IS NOT NULL GROUP BY 1),
{name}_c AS (SELECT *, sum(p) OVER (ORDER BY key DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_p FROM {name}_g),
{name} AS (SELECT (sum(m) + 1) / 2 - sum(m * (cum_p - p) + p * (m + 1) / 2) / sum(p) AS gap FROM {name}_c)"""


@register("gini_normalized", with_lab(_lorenz_sql("gp", "score"), _lorenz_sql("gt", "target")) + f"""
SELECT {O.rnd('gp.gap / gt.gap')} AS gini_normalized FROM gp, gt""")
def q_gini_norm(spark, d):
    return rounded(M.gini_normalized(lab(spark, d), "target", "score"))


@register("confusion_metrics", with_lab() + f""",
c AS (SELECT sum(CASE WHEN p = 1 AND y = 1 THEN 1 ELSE 0 END) AS tp, sum(CASE WHEN p = 1 AND y = 0 THEN 1 ELSE 0 END) AS fp,
             sum(CASE WHEN p = 0 AND y = 0 THEN 1 ELSE 0 END) AS tn, sum(CASE WHEN p = 0 AND y = 1 THEN 1 ELSE 0 END) AS fn
      FROM (SELECT CAST(score > 0.5 AS INTEGER) AS p, target AS y FROM r_lab))
SELECT CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(tn AS BIGINT) AS tn, CAST(fn AS BIGINT) AS fn,
       {O.rnd('(tp + tn) / (tp + fp + tn + fn)')} AS accuracy, {O.rnd('coalesce(tp / NULLIF(tp + fp, 0), 0)')} AS precision,
       {O.rnd('coalesce(tp / NULLIF(tp + fn, 0), 0)')} AS recall,
       {O.rnd('coalesce(2 * (tp / NULLIF(tp + fp, 0)) * (tp / NULLIF(tp + fn, 0)) / NULLIF(tp / NULLIF(tp + fp, 0) + tp / NULLIF(tp + fn, 0), 0), 0)')} AS f1
FROM c""")
def q_confusion(spark, d):
    return rounded(M.confusion_metrics(lab(spark, d), "score", "target", 0.5))


@register("probability_metrics", with_lab(_SC) + f""",
base AS (SELECT avg((score - target) * (score - target)) AS brier,
                avg(-(target * ln(least(greatest(score, {M.LOG_LOSS_EPS!r}), 1 - {M.LOG_LOSS_EPS!r}))
                      + (1 - target) * ln(1 - least(greatest(score, {M.LOG_LOSS_EPS!r}), 1 - {M.LOG_LOSS_EPS!r})))) AS log_loss
         FROM r_lab WHERE score IS NOT NULL AND target IS NOT NULL),
ap AS (SELECT sum(pos / pos_total * (cum_pos / cum_n)) AS average_precision FROM cum)
SELECT {O.rnd('brier')} AS brier, {O.rnd('log_loss')} AS log_loss, {O.rnd('average_precision')} AS average_precision FROM base, ap""")
def q_prob_metrics(spark, d):
    return rounded(M.probability_metrics(lab(spark, d), "score", "target"))


@register("roc_curve_table", with_lab(_SC) + f"""
SELECT score AS threshold, {O.rnd('cum_neg / neg_total')} AS fpr, {O.rnd('cum_pos / pos_total')} AS tpr FROM cum
UNION ALL SELECT 'inf'::DOUBLE, 0::DOUBLE, 0::DOUBLE WHERE EXISTS (SELECT 1 FROM cum)""")
def q_roc_curve(spark, d):
    return rounded(M.roc_curve_table(lab(spark, d), "score", "target"))


@register("pr_curve_table", with_lab(_SC) + f"""
SELECT score AS threshold, {O.rnd('cum_pos / cum_n')} AS precision, {O.rnd('cum_pos / pos_total')} AS recall FROM cum
UNION ALL SELECT NULL, 1::DOUBLE, 0::DOUBLE WHERE EXISTS (SELECT 1 FROM cum)""")
def q_pr_curve(spark, d):
    return rounded(M.pr_curve_table(lab(spark, d), "score", "target"))


@register("calibration_table", with_lab() + f"""
SELECT CAST(len(list_filter([{', '.join(repr(e) + '::DOUBLE' for e in BN.linspace_probs(10)[1:-1])}], lambda e: e < score)) AS INTEGER) AS bin,
       {O.rnd('avg(score)')} AS prob_pred, {O.rnd('avg(CAST(target AS DOUBLE))')} AS prob_true, count(*) AS volume
FROM r_lab WHERE score IS NOT NULL AND target IS NOT NULL GROUP BY 1""")
def q_calibration(spark, d):
    return rounded(M.calibration_table(lab(spark, d), "score", "target", 10))


_SCG = """
sc AS (SELECT safra, score, count(*) AS n, sum(CAST(target AS DOUBLE)) AS pos, sum(1 - CAST(target AS DOUBLE)) AS neg
       FROM r_lab WHERE score IS NOT NULL AND target IS NOT NULL GROUP BY safra, score),
cum AS (SELECT *, sum(pos) OVER w AS cum_pos, sum(neg) OVER w AS cum_neg,
               sum(pos) OVER (PARTITION BY safra) AS pos_total, sum(neg) OVER (PARTITION BY safra) AS neg_total
        FROM sc WINDOW w AS (PARTITION BY safra ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


@register("ks_gini_by_vintage", with_lab(_SCG) + f"""
SELECT safra, {O.rnd('greatest(max(cum_pos / pos_total - cum_neg / neg_total), 0.0) * 100')} AS ks,
       {O.rnd('(2 * sum(pos * (neg_total - cum_neg + 0.5 * neg)) / NULLIF(max(pos_total) * max(neg_total), 0) - 1) * 100')} AS gini
FROM cum GROUP BY safra""")
def q_ks_gini_vintage(spark, d):
    return rounded(M.ks_gini_by_vintage(lab(spark, d), "score", "target", "safra"))


# Two scores (quantity, discount) x two splits (ship year < 1998 or not), stacked.
_STACK_SQL = """
st AS (SELECT 'quantity' AS model, CASE WHEN safra < 199801 THEN 'train' ELSE 'test' END AS split, score, target FROM r_lab
       UNION ALL SELECT 'discount', CASE WHEN safra < 199801 THEN 'train' ELSE 'test' END, l_discount * 10, target FROM r_lab)"""


def _stacked(spark, d):
    df = lab(spark, d)
    split = F.when(F.col("safra") < 199801, "train").otherwise("test")
    return (df.select(F.lit("quantity").alias("model"), split.alias("split"), "score", "target")
            .unionByName(df.select(F.lit("discount").alias("model"), split.alias("split"),
                                   (F.col("l_discount") * 10).alias("score"), "target")))


@register("train_test_metrics", with_lab(_STACK_SQL, """
sc AS (SELECT model, split, score, count(*) AS n, sum(CAST(target AS DOUBLE)) AS pos, sum(1 - CAST(target AS DOUBLE)) AS neg
       FROM st WHERE score IS NOT NULL AND target IS NOT NULL GROUP BY model, split, score),
cum AS (SELECT *, sum(pos) OVER w AS cum_pos, sum(neg) OVER w AS cum_neg,
               sum(pos) OVER (PARTITION BY model, split) AS pos_total, sum(neg) OVER (PARTITION BY model, split) AS neg_total
        FROM sc WINDOW w AS (PARTITION BY model, split ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
m AS (SELECT model, split, sum(pos * (neg_total - cum_neg + 0.5 * neg)) / (max(pos_total) * max(neg_total)) AS auc,
             max(abs(cum_pos / pos_total - cum_neg / neg_total)) AS ks FROM cum GROUP BY model, split),
c AS (SELECT model, split, sum(CASE WHEN score > 0.5 AND target = 1 THEN 1 ELSE 0 END) AS tp,
             sum(CASE WHEN score > 0.5 AND target = 0 THEN 1 ELSE 0 END) AS fp,
             sum(CASE WHEN score <= 0.5 AND target = 0 THEN 1 ELSE 0 END) AS tn,
             sum(CASE WHEN score <= 0.5 AND target = 1 THEN 1 ELSE 0 END) AS fn FROM st GROUP BY model, split)""") + f"""
SELECT c.model, c.split, {O.rnd('(tp + tn) / (tp + fp + tn + fn)')} AS accuracy,
       {O.rnd('coalesce(tp / NULLIF(tp + fp, 0), 0)')} AS precision, {O.rnd('coalesce(tp / NULLIF(tp + fn, 0), 0)')} AS recall,
       {O.rnd('auc')} AS auc, {O.rnd('2 * auc - 1')} AS gini, {O.rnd('ks')} AS ks
FROM c JOIN m ON c.model = m.model AND c.split = m.split""")
def q_train_test(spark, d):
    return rounded(M.classification_report(_stacked(spark, d), "score", "target"))


@register("score_report", with_lab(_STACK_SQL.replace("UNION ALL SELECT 'discount'", "UNION ALL SELECT 'discount_unused'"), """
sc AS (SELECT split, score, sum(CAST(target AS DOUBLE)) AS pos, sum(1 - CAST(target AS DOUBLE)) AS neg
       FROM st WHERE model = 'quantity' GROUP BY split, score),
cum AS (SELECT *, sum(pos) OVER w AS cum_pos, sum(neg) OVER w AS cum_neg,
               sum(pos) OVER (PARTITION BY split) AS pos_total, sum(neg) OVER (PARTITION BY split) AS neg_total
        FROM sc WINDOW w AS (PARTITION BY split ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""") + f"""
SELECT split, {O.rnd('sum(pos * (neg_total - cum_neg + 0.5 * neg)) / (max(pos_total) * max(neg_total))')} AS auc,
       {O.rnd('2 * sum(pos * (neg_total - cum_neg + 0.5 * neg)) / (max(pos_total) * max(neg_total)) - 1')} AS gini,
       {O.rnd('max(abs(cum_pos / pos_total - cum_neg / neg_total))')} AS ks FROM cum GROUP BY split""")
def q_score_report(spark, d):
    st = _stacked(spark, d).filter(F.col("model") == "quantity")
    tr, te = st.filter(F.col("split") == "train"), st.filter(F.col("split") == "test")
    return rounded(M.score_report(tr, te, "score", "target")[0])


@register("score_report_deciles")
def q_score_report_deciles(spark, d):
    """The report's decile tables of both splits."""
    st = _stacked(spark, d).filter(F.col("model") == "quantity")
    tr, te = st.filter(F.col("split") == "train"), st.filter(F.col("split") == "test")
    _, train, test = M.score_report(tr, te, "score", "target")
    return rounded(train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test"))))


@register("regression_metrics", f"""
WITH p AS (SELECT l_orderkey, sum(l_extendedprice) AS pred FROM lineitem GROUP BY l_orderkey),
j AS (SELECT o_totalprice AS y, pred AS p FROM orders JOIN p ON o_orderkey = l_orderkey)
SELECT {O.rnd('1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*))', 6)} AS r2, {O.rnd('avg(abs(y - p))', 4)} AS mae,
       {O.rnd('avg((y - p) * (y - p))', 0)} AS mse, {O.rnd('sqrt(avg((y - p) * (y - p)))', 4)} AS rmse,
       {O.rnd('avg(abs((y - p) / y)) * 100', 6)} AS mape FROM j""")
def q_regression(spark, d):
    li = R.table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.sum("l_extendedprice").alias("pred"))
    o = R.table(spark, d, "orders")
    j = o.join(li, o.o_orderkey == li.l_orderkey).select(F.col("o_totalprice").alias("y"), "pred")
    m = M.regression_metrics(j, "y", "pred")
    return m.select(F.round("r2", 6).alias("r2"), F.round("mae", 4).alias("mae"), F.round("mse", 0).alias("mse"),
                    F.round("rmse", 4).alias("rmse"), F.round("mape", 6).alias("mape"))
