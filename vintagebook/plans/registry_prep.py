"""Registered queries: profiling, missing values, types, encoders, scalers, selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import encode as E
from ..operators import profile as PF
from ..operators import select as S
from . import oracle as O
from . import roles as R
from .registry import register
from .registry_tools import rounded

DOC_TYPES = [("doc_id", "bigint"), ("lang", "string"), ("source", "string"), ("n_chars", "bigint"),
             ("quality", "int"), ("toxic", "int")]
TRAIN_SOURCES = 14  # documents of sources src0..src13 train, the rest test


def docs(spark, d):
    return R.documents_labelled(spark, d)


def _doc_split(df):
    idx = F.substring("source", 4, 10).cast("int")
    return df.filter(idx < TRAIN_SOURCES), df.filter(idx >= TRAIN_SOURCES)


def with_docs(*ctes):
    return "WITH " + ",".join([O.DOCS, *ctes])


_PROFILE_SQL = with_docs("""
n AS (SELECT count(*) AS n FROM r_docs),
z AS (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS variable, count(*) FILTER (WHERE {c} IS NULL) AS n_nulls, count(DISTINCT {c}) AS cardinality, "
    f"'{t}' AS dtype FROM r_docs" for c, t in DOC_TYPES) + ")") + f"""
SELECT variable, CASE WHEN variable IN ('doc_id') THEN 'ID' WHEN variable IN ('quality') THEN 'Target' ELSE 'Explicativa' END AS role,
       CAST(n_nulls AS BIGINT) AS n_nulls, {O.r2('n_nulls / n * 100')} AS pct_nulls, CAST(cardinality AS BIGINT) AS cardinality, dtype
FROM z, n"""


@register("column_profile", _PROFILE_SQL)
def q_profile(spark, d):
    return PF.column_profile(docs(spark, d), ids=["doc_id"], targets=["quality"])


@register("null_heavy_columns", f"SELECT variable, pct_nulls FROM ({_PROFILE_SQL}) WHERE pct_nulls > 50")
def q_null_heavy(spark, d):
    return PF.null_heavy_columns(PF.column_profile(docs(spark, d), ["doc_id"], ["quality"]), 50)


@register("split_by_cardinality", f"""
SELECT variable, CASE WHEN regexp_matches(dtype, '^(tinyint|smallint|int|bigint|float|double|decimal)') THEN 'numeric'
                      WHEN cardinality < 20 THEN 'low_cardinality' ELSE 'high_cardinality' END AS "group"
FROM ({_PROFILE_SQL})""")
def q_split_card(spark, d):
    return S.split_by_cardinality(PF.column_profile(docs(spark, d), ["doc_id"], ["quality"]), 20)


def _mode_sql(col, src="r_docs"):
    return (f"(SELECT CAST({col} AS VARCHAR) FROM {src} WHERE {col} IS NOT NULL GROUP BY {col} "
            f"ORDER BY count(*) DESC, CAST({col} AS VARCHAR) ASC LIMIT 1)")


_FIT_SQL = with_docs() + f"""
SELECT 'n_chars' AS variable, {O.rnd('avg(CAST(n_chars AS DOUBLE))')} AS num_fill, CAST(NULL AS VARCHAR) AS cat_fill FROM r_docs
UNION ALL SELECT 'quality', {O.rnd('avg(CAST(quality AS DOUBLE))')}, NULL FROM r_docs
UNION ALL SELECT 'toxic', {O.rnd('avg(CAST(toxic AS DOUBLE))')}, NULL FROM r_docs
UNION ALL SELECT 'lang', NULL, coalesce({_mode_sql('lang')}, 'VERIFICAR')
UNION ALL SELECT 'source', NULL, coalesce({_mode_sql('source')}, 'VERIFICAR')"""


@register("impute_fit", _FIT_SQL)
def q_impute_fit(spark, d):
    df = docs(spark, d)
    return rounded(PF.impute_fit(df, ["n_chars", "quality", "toxic"], ["lang", "source"]))


@register("impute_apply", with_docs("""
m AS (SELECT avg(CAST(n_chars AS DOUBLE)) AS a, avg(CAST(quality AS DOUBLE)) AS q, avg(CAST(toxic AS DOUBLE)) AS t FROM r_docs)""") + f"""
SELECT doc_id, lang, source, {O.rnd('coalesce(CAST(n_chars AS DOUBLE), a)')} AS n_chars,
       {O.rnd('coalesce(CAST(quality AS DOUBLE), q)')} AS quality, {O.rnd('coalesce(CAST(toxic AS DOUBLE), t)')} AS toxic
FROM r_docs, m""")
def q_impute_apply(spark, d):
    df = docs(spark, d)
    fit = PF.impute_fit(df, ["n_chars", "quality", "toxic"], ["lang", "source"])
    return rounded(PF.impute_apply(df, fit))


@register("sentinel_to_null", with_docs() + """
SELECT doc_id, NULLIF(coalesce(quality, -1), -1) AS quality, NULLIF(coalesce(toxic, -1), -1) AS toxic FROM r_docs""")
def q_sentinel(spark, d):
    df = docs(spark, d).select("doc_id", F.coalesce("quality", F.lit(-1)).alias("quality"),
                               F.coalesce("toxic", F.lit(-1)).alias("toxic"))
    return PF.sentinel_to_null(df, ["quality", "toxic"])


_TR = f"CAST(substr(source, 4) AS INTEGER) < {TRAIN_SOURCES}"


@register("impute_train_test", with_docs(f"""
tr AS (SELECT * FROM r_docs WHERE {_TR}),
te AS (SELECT * FROM r_docs WHERE NOT ({_TR})),
m AS (SELECT avg(CAST(n_chars AS DOUBLE)) AS a, avg(CAST(quality AS DOUBLE)) AS q, avg(CAST(toxic AS DOUBLE)) AS t FROM tr)""") + f"""
SELECT doc_id, coalesce(lang, {_mode_sql('lang', 'tr')}) AS lang, source, {O.rnd('coalesce(CAST(n_chars AS DOUBLE), a)')} AS n_chars,
       {O.rnd('coalesce(CAST(quality AS DOUBLE), q)')} AS quality, {O.rnd('coalesce(CAST(toxic AS DOUBLE), t)')} AS toxic
FROM te, m""")
def q_impute_tt(spark, d):
    tr, te = _doc_split(docs(spark, d))
    _, out, _ = PF.impute_train_test(tr, te, ["n_chars", "quality", "toxic"], ["lang"])
    return rounded(out)


@register("impute_train_side")
def q_impute_train(spark, d):
    """The imputed train side of impute_train_test."""
    tr, te = _doc_split(docs(spark, d))
    out, _, _ = PF.impute_train_test(tr, te, ["n_chars", "quality", "toxic"], ["lang"])
    return rounded(out)


@register("median_impute", with_docs() + f"""
SELECT 'n_chars' AS variable, {O.rnd('quantile_cont(CAST(n_chars AS DOUBLE), 0.5)')} AS num_fill FROM r_docs
UNION ALL SELECT 'quality', {O.rnd('quantile_cont(CAST(quality AS DOUBLE), 0.5)')} FROM r_docs
UNION ALL SELECT 'toxic', {O.rnd('quantile_cont(CAST(toxic AS DOUBLE), 0.5)')} FROM r_docs""")
def q_median(spark, d):
    f = PF.impute_fit(docs(spark, d), ["n_chars", "quality", "toxic"], [], strategy="median")
    return rounded(f.select("variable", "num_fill"))


@register("numeric_histogram", """
WITH l AS (SELECT 'l_extendedprice' AS variable, l_extendedprice AS value FROM lineitem
           UNION ALL SELECT 'l_quantity', l_quantity FROM lineitem),
m AS (SELECT variable, min(value) AS mn, max(value) AS mx FROM l GROUP BY variable),
b AS (SELECT l.variable, mn, mx, CAST(CASE WHEN mx = mn THEN 0 ELSE least(floor((value - mn) / ((mx - mn) / 30)), 29) END AS INTEGER) AS bin
      FROM l JOIN m ON l.variable = m.variable WHERE value IS NOT NULL)""" + f"""
SELECT variable, bin, {O.rnd('mn + bin * (mx - mn) / 30', 6)} AS bin_low, {O.rnd('mn + (bin + 1) * (mx - mn) / 30', 6)} AS bin_high,
       count(*) AS count FROM b GROUP BY variable, bin, mn, mx""")
def q_hist(spark, d):
    h = PF.numeric_histogram(R.table(spark, d, "lineitem"), ["l_extendedprice", "l_quantity"], 30)
    return h.select("variable", "bin", F.round("bin_low", 6).alias("bin_low"),
                    F.round("bin_high", 6).alias("bin_high"), "count")


@register("box_stats", """
WITH l AS (SELECT l_returnflag, 'l_extendedprice' AS variable, l_extendedprice AS value FROM lineitem
           UNION ALL SELECT l_returnflag, 'l_quantity', l_quantity FROM lineitem),
q AS (SELECT variable, l_returnflag, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
             quantile_cont(value, 0.75) AS q3 FROM l WHERE value IS NOT NULL GROUP BY ALL)""" + f"""
SELECT q.variable, q.l_returnflag, {O.rnd('q1')} AS q1, {O.rnd('median')} AS median, {O.rnd('q3')} AS q3, {O.rnd('q3 - q1')} AS iqr,
       min(value) FILTER (WHERE value >= q1 - 1.5 * (q3 - q1)) AS whisker_low,
       max(value) FILTER (WHERE value <= q3 + 1.5 * (q3 - q1)) AS whisker_high,
       count(*) FILTER (WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS n_outliers, count(*) AS n
FROM l JOIN q ON l.variable = q.variable AND l.l_returnflag = q.l_returnflag WHERE value IS NOT NULL
GROUP BY q.variable, q.l_returnflag, q1, median, q3""")
def q_box(spark, d):
    b = PF.box_stats(R.table(spark, d, "lineitem"), ["l_extendedprice", "l_quantity"], by="l_returnflag")
    return rounded(b)


@register("kde_by_target")
def q_kde(spark, d):
    return PF.kde_by_target(R.labelled(spark, d), ["l_extendedprice", "l_quantity"], "target")


@register("narrow_types", """
SELECT CAST(p_partkey AS SMALLINT) AS p_partkey, p_name, p_brand, p_type, CAST(p_size AS TINYINT) AS p_size,
       CAST(p_retailprice AS FLOAT) AS p_retailprice FROM part""")
def q_narrow(spark, d):
    return PF.narrow_types(R.table(spark, d, "part"))[0]


@register("normalize_dtypes", """
SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_brand, p_type, CAST(p_size AS INTEGER) AS p_size,
       CAST(p_retailprice AS FLOAT) AS p_retailprice FROM part""")
def q_normalize_dtypes(spark, d):
    return PF.normalize_dtypes(PF.narrow_types(R.table(spark, d, "part"))[0])


# ---------------------------------------------------------------- encoders
def _lab(spark, d):
    return R.labelled(spark, d)


@register("one_hot", """
SELECT l_orderkey, l_linenumber, CAST(l_linestatus = 'F' AS INTEGER) AS l_linestatus_F, CAST(l_linestatus = 'O' AS INTEGER) AS l_linestatus_O,
       CAST(l_returnflag = 'A' AS INTEGER) AS l_returnflag_A, CAST(l_returnflag = 'N' AS INTEGER) AS l_returnflag_N,
       CAST(l_returnflag = 'R' AS INTEGER) AS l_returnflag_R FROM lineitem""")
def q_one_hot(spark, d):
    li = R.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_linestatus", "l_returnflag")
    fit = E.one_hot_fit(li, ["l_linestatus", "l_returnflag"])
    return E.one_hot_apply(li, fit)


@register("one_hot_drop_first", """
SELECT l_orderkey, l_linenumber, CAST(l_linestatus = 'O' AS INTEGER) AS l_linestatus_O,
       CAST(l_returnflag = 'N' AS INTEGER) AS l_returnflag_N, CAST(l_returnflag = 'R' AS INTEGER) AS l_returnflag_R FROM lineitem""")
def q_one_hot_df(spark, d):
    li = R.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_linestatus", "l_returnflag")
    fit = E.one_hot_fit(li, ["l_linestatus", "l_returnflag"])
    return E.one_hot_apply(li, fit, drop_first=True)


@register("ordinal_encode", """
SELECT l_orderkey, l_linenumber, CAST(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 WHEN 'R' THEN 2 END AS INTEGER) AS l_returnflag,
       CAST(CASE l_linestatus WHEN 'O' THEN 0 WHEN 'F' THEN 1 END AS INTEGER) AS l_linestatus FROM lineitem""")
def q_ordinal(spark, d):
    li = R.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    return E.ordinal_encode(li, {"l_returnflag": ["A", "N", "R"], "l_linestatus": ["O", "F"]})


def _ip_split(spark, d):
    ip = R.items_with_parts(spark, d)
    return (ip.filter(F.col("safra") < R.TEST_FROM_SAFRA), ip.filter(F.col("safra") >= R.TEST_FROM_SAFRA))


_TE_SQL = "WITH " + ",".join([O.LABELLED, O.ITEMS_PARTS, f"""
tr AS (SELECT * FROM r_ip WHERE safra < {R.TEST_FROM_SAFRA}),
te AS (SELECT * FROM r_ip WHERE safra >= {R.TEST_FROM_SAFRA}),
pr AS (SELECT avg(CAST(target AS DOUBLE)) AS prior FROM tr),
st AS (SELECT 'p_brand' AS variable, p_brand AS value, count(*) AS n, avg(CAST(target AS DOUBLE)) AS mean FROM tr WHERE p_brand IS NOT NULL GROUP BY p_brand
       UNION ALL SELECT 'p_type', p_type, count(*), avg(CAST(target AS DOUBLE)) FROM tr WHERE p_type IS NOT NULL GROUP BY p_type),
enc AS (SELECT variable, value, CASE WHEN n = 1 THEN prior ELSE prior * (1 - 1 / (1 + exp(-(n - 20) / 10.0)))
                                     + mean * (1 / (1 + exp(-(n - 20) / 10.0))) END AS encoding FROM st, pr)"""])


@register("target_encode", _TE_SQL + f"""
SELECT l_orderkey, l_linenumber, {O.rnd("coalesce(b.encoding, prior)")} AS p_brand, {O.rnd("coalesce(t.encoding, prior)")} AS p_type
FROM te LEFT JOIN enc b ON b.variable = 'p_brand' AND te.p_brand = b.value
        LEFT JOIN enc t ON t.variable = 'p_type' AND te.p_type = t.value, pr""")
def q_target_encode(spark, d):
    tr, te = _ip_split(spark, d)
    fit = E.target_encode_fit(tr, ["p_brand", "p_type"], "target")
    out = E.target_encode_apply(te.select("l_orderkey", "l_linenumber", "p_brand", "p_type"), fit,
                                ["p_brand", "p_type"])
    return rounded(out)


_SCALE_COLS = ["l_quantity", "l_extendedprice", "l_discount"]


@register("standard_scale", "SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"{O.rnd(f'({c} - avg({c}) OVER ()) / CASE WHEN stddev_pop({c}) OVER () = 0 THEN 1 ELSE stddev_pop({c}) OVER () END', 8)} AS {c}"
    for c in _SCALE_COLS) + " FROM lineitem")
def q_standard(spark, d):
    li = R.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *_SCALE_COLS)
    return rounded(E.scale_apply(li, E.standard_scale_fit(li, _SCALE_COLS)), 8)


@register("robust_scale", "WITH q AS (SELECT " + ", ".join(
    f"quantile_cont({c}, 0.5) AS m_{c}, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) AS i_{c}" for c in _SCALE_COLS)
    + " FROM lineitem) SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"{O.rnd(f'({c} - m_{c}) / CASE WHEN i_{c} = 0 THEN 1 ELSE i_{c} END', 8)} AS {c}" for c in _SCALE_COLS)
    + " FROM lineitem, q")
def q_robust(spark, d):
    li = R.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", *_SCALE_COLS)
    return rounded(E.scale_apply(li, E.robust_scale_fit(li, _SCALE_COLS)), 8)


_VAR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("low_variance_columns", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS variable, {O.rnd(f'var_samp({c})', 8)} AS variance FROM lineitem" for c in _VAR_COLS)
    + ") WHERE variance < 0.1")
def q_low_var(spark, d):
    return rounded(E.low_variance_columns(R.table(spark, d, "lineitem"), _VAR_COLS, 0.1), 8)


_CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "o_totalprice"]
_CORR_SRC = "(SELECT l_quantity, l_extendedprice, l_discount, l_tax, o_totalprice FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"


def _corr_frame(spark, d):
    li, o = R.table(spark, d, "lineitem"), R.table(spark, d, "orders")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(*_CORR_COLS)


@register("correlation_pairs", " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, {O.rnd(f'corr({a}, {b})', 8)} AS corr FROM {_CORR_SRC}"
    for i, a in enumerate(_CORR_COLS) for b in _CORR_COLS[i + 1:]))
def q_corr(spark, d):
    return rounded(E.correlation_pairs(_corr_frame(spark, d), _CORR_COLS), 8)


@register("drop_correlated", "SELECT DISTINCT b AS variable FROM (" + " UNION ALL ".join(
    f"SELECT '{b}' AS b, corr({a}, {b}) AS c FROM {_CORR_SRC}"
    for i, a in enumerate(_CORR_COLS) for b in _CORR_COLS[i + 1:]) + ") WHERE abs(c) > 0.5")
def q_drop_corr(spark, d):
    drop = E.correlated_to_drop(_corr_frame(spark, d), _CORR_COLS, 0.5)
    return spark.createDataFrame([(c,) for c in drop], "variable string")
