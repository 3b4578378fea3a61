"""Registered queries for sources, filters, joins, windows and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions.hashing import row_hash
from ..functions.logistics import same_group_flag, zip_distance_proxy
from ..functions.mapping import BRAZIL_STATE_REGIONS, state_to_region
from ..functions.text import normalize_text, safe_cast
from ..operators import book as B
from ..operators import select as S
from ..operators.dedup import dedup_latest
from ..operators.joins import (apply_grouping, order_fact_join, population_left_join_features,
                               review_fact_join)
from ..sources.files import ingest_bronze
from ..sources.upsert import upsert_hash_gated
from . import oracle as O
from . import roles as R
from .registry import register

# Incremental-load parameters over the test tables.
SNAPSHOT_END = "2000-01-01"       # target snapshot holds orders before this day
INCREMENT_START = "1999-07-01"    # the increment re-delivers orders from this day
NULL_HASH_MONTH = 199909          # target rows of this month carry a NULL hash
EVENTS_AS_OF = "2024-01-31"
EVENTS_DAYS = 14


# ---------------------------------------------------------------- upsert
def _order_snapshot(spark, d, snapshot: bool):
    o = R.table(spark, d, "orders")
    dt = F.col("o_orderdate")
    status = (F.when(dt >= F.lit(INCREMENT_START).cast("timestamp"), F.lit("P"))
              .otherwise(F.col("o_orderstatus"))) if snapshot else F.col("o_orderstatus")
    df = o.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
                  status.alias("order_status"), dt.alias("order_purchase_timestamp"),
                  D.safra_of(dt).alias("safra"))
    if snapshot:
        df = df.filter(dt < F.lit(SNAPSHOT_END).cast("timestamp"))
    else:
        df = df.filter(dt >= F.lit(INCREMENT_START).cast("timestamp"))
    h = row_hash(["order_id", "order_purchase_timestamp", "order_status"], df)
    if snapshot:
        h = F.when(F.col("safra") != NULL_HASH_MONTH, h)
    return df.withColumn("row_hash", h)


def _order_snapshot_sql(snapshot: bool) -> str:
    status = (f"CASE WHEN o_orderdate >= TIMESTAMP '{INCREMENT_START}' THEN 'P' ELSE o_orderstatus END"
              if snapshot else "o_orderstatus")
    where = (f"o_orderdate < TIMESTAMP '{SNAPSHOT_END}'" if snapshot
             else f"o_orderdate >= TIMESTAMP '{INCREMENT_START}'")
    h = ("sha256(concat_ws('||', coalesce(CAST(order_id AS VARCHAR), ''), "
         "coalesce(strftime(order_purchase_timestamp, '%Y-%m-%d'), ''), coalesce(order_status, '')))")
    if snapshot:
        h = f"CASE WHEN safra <> {NULL_HASH_MONTH} THEN {h} END"
    return f"""(SELECT *, {h} AS row_hash FROM (
      SELECT o_orderkey AS order_id, o_custkey AS customer_id, {status} AS order_status,
             o_orderdate AS order_purchase_timestamp, {O.safra_sql('o_orderdate')} AS safra
      FROM orders WHERE {where}))"""


UPSERT_COLS = ["order_id", "customer_id", "order_status", "order_purchase_timestamp", "safra",
               "row_hash"]


@register("upsert_hash_gated", f"""
WITH t AS {_order_snapshot_sql(True)}, s AS {_order_snapshot_sql(False)}
SELECT {', '.join(f"CASE WHEN s.order_id IS NOT NULL AND (t.order_id IS NULL OR t.row_hash IS NULL OR t.row_hash <> s.row_hash) THEN s.{c} ELSE t.{c} END AS {c}" for c in UPSERT_COLS)}
FROM t FULL OUTER JOIN s ON t.order_id = s.order_id""")
def q_upsert(spark, d):
    return upsert_hash_gated(_order_snapshot(spark, d, True), _order_snapshot(spark, d, False),
                             ["order_id"])


# ---------------------------------------------------------------- dedup
@register("dedup_latest", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST) AS rn
  FROM lineitem) WHERE rn = 1""")
def q_dedup(spark, d):
    return dedup_latest(R.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"],
                        ["l_shipdate", "l_partkey"])


@register("dedup_latest_window", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST) AS rn
  FROM lineitem) WHERE rn = 1""")
def q_dedup_window(spark, d):
    return dedup_latest(R.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"],
                        ["l_shipdate", "l_partkey"], method="window")


# ---------------------------------------------------------------- filters
@register("filter_not_null_key", """
SELECT * FROM (SELECT CAST(l_orderkey AS VARCHAR) AS order_id, TRY_CAST(NULLIF(l_suppkey % 7, 0) AS BIGINT) AS seller_id,
  l_linenumber FROM lineitem) WHERE seller_id IS NOT NULL""")
def q_not_null(spark, d):
    li = R.table(spark, d, "lineitem")
    df = li.select(F.col("l_orderkey").cast("string").alias("order_id"),
                   F.nullif(F.col("l_suppkey") % 7, F.lit(0)).cast("bigint").alias("seller_id"),
                   "l_linenumber")
    return S.filter_not_null_key(df, "seller_id")


@register("incremental_window", f"""
SELECT * FROM events WHERE ts >= CAST(DATE '{EVENTS_AS_OF}' - INTERVAL {EVENTS_DAYS} DAY AS DATE)""")
def q_incremental(spark, d):
    return S.incremental_window(R.table(spark, d, "events"), "ts", EVENTS_AS_OF, EVENTS_DAYS)


@register("filter_status_range", f"""
WITH {O.ROLE_VIEWS.strip()}
SELECT * FROM r_orders WHERE order_status = '{R.DELIVERED_STATUS}' AND safra IN (200005, 200006)""")
def q_filter_status(spark, d):
    return S.filter_status_range(R.orders(spark, d), "order_status", R.DELIVERED_STATUS,
                                 safras=[200005, 200006])


@register("time_split_train", f"""
WITH {O.ROLE_VIEWS.strip()}
SELECT * FROM r_orders WHERE safra >= 199701 AND safra <= 199912""")
def q_time_split_train(spark, d):
    return S.time_split(R.orders(spark, d), "safra", (199701, 199912), (200001, 200012))[0]


@register("time_split_test", f"""
WITH {O.ROLE_VIEWS.strip()}
SELECT * FROM r_orders WHERE safra >= 200001 AND safra <= 200012""")
def q_time_split_test(spark, d):
    return S.time_split(R.orders(spark, d), "safra", (199701, 199912), (200001, 200012))[1]


@register("drop_columns", "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, "
          "l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus FROM lineitem")
def q_drop(spark, d):
    return S.drop_columns(R.table(spark, d, "lineitem"), ["L_SHIPDATE", "not_there"])


@register("rename_as_var", "SELECT l_returnflag, l_quantity AS VAR_1, l_extendedprice AS VAR_2, "
          "l_discount AS VAR_3 FROM lineitem")
def q_rename(spark, d):
    li = R.table(spark, d, "lineitem").select("l_returnflag", "l_quantity", "l_extendedprice",
                                              "l_discount")
    return S.rename_as_var(li, "l_returnflag")[0]


# ---------------------------------------------------------------- scalar functions
@register("parse_timestamp_multi", f"""
WITH b AS ({O.BRONZE_SQL['orders']})
SELECT order_id, order_purchase_timestamp AS raw, {O.parse_ts_sql('order_purchase_timestamp')} AS parsed,
       {O.safra_sql(O.parse_ts_sql('order_purchase_timestamp'))} AS safra FROM b""")
def q_parse(spark, d):
    b = R.bronze_orders(spark, d)
    p = D.parse_timestamp_multi("order_purchase_timestamp")
    return b.select("order_id", F.col("order_purchase_timestamp").alias("raw"),
                    p.alias("parsed"), D.safra_of(p).alias("safra"))


@register("safe_cast", """
SELECT CAST(l_orderkey AS VARCHAR) AS k,
       TRY_CAST(trim(CAST(l_linenumber AS VARCHAR)) AS INTEGER) AS as_int,
       TRY_CAST(trim(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR)) AS DECIMAL(18,2)) AS as_dec,
       TRY_CAST(trim(l_returnflag) AS INTEGER) AS junk_int
FROM lineitem""")
def q_safe_cast(spark, d):
    li = R.table(spark, d, "lineitem")
    return li.select(F.col("l_orderkey").cast("string").alias("k"),
                     safe_cast(F.col("l_linenumber").cast("string"), "int").alias("as_int"),
                     safe_cast(F.col("l_extendedprice").cast("decimal(18,2)").cast("string"),
                               "decimal(18,2)").alias("as_dec"),
                     safe_cast("l_returnflag", "int").alias("junk_int"))


@register("normalize_text", """
SELECT c_custkey, upper(trim(concat(' ', lower(c_mktsegment), ' '))) AS segment FROM customer""")
def q_normalize(spark, d):
    c = R.table(spark, d, "customer")
    return c.select("c_custkey",
                    normalize_text(F.concat(F.lit(" "), F.lower("c_mktsegment"), F.lit(" ")))
                    .alias("segment"))


@register("safra_functions", f"""
WITH s AS (SELECT DISTINCT {O.safra_sql('o_orderdate')} AS safra FROM orders)
SELECT safra,
       CAST(make_date(CAST(safra // 100 AS INTEGER), CAST(safra % 100 AS INTEGER), 1) AS TIMESTAMP) AS safra_date,
       CAST(safra // 100 * 12 + safra % 100 AS INTEGER) AS month_index,
       CAST(strftime(make_date(CAST(safra // 100 AS INTEGER), CAST(safra % 100 AS INTEGER), 1) + INTERVAL 2 MONTH, '%Y%m') AS INTEGER) AS safra_plus_2,
       CAST(strftime(make_date(CAST(safra // 100 AS INTEGER), CAST(safra % 100 AS INTEGER), 1) - INTERVAL 12 MONTH, '%Y%m') AS INTEGER) AS safra_minus_12
FROM s""")
def q_safra_functions(spark, d):
    s = R.table(spark, d, "orders").select(D.safra_of("o_orderdate").alias("safra")).distinct()
    return s.select("safra", D.safra_to_date("safra").cast("timestamp").alias("safra_date"),
                    D.month_index("safra").cast("int").alias("month_index"),
                    D.safra_shift("safra", 2).alias("safra_plus_2"),
                    D.safra_shift("safra", -12).alias("safra_minus_12"))


@register("row_hash", """
SELECT o_orderkey, sha256(concat_ws('||', coalesce(CAST(o_orderkey AS VARCHAR), ''),
       coalesce(strftime(o_orderdate, '%Y-%m-%d'), ''), coalesce(o_orderstatus, ''),
       coalesce(CAST(o_custkey AS VARCHAR), ''))) AS row_hash FROM orders""")
def q_row_hash(spark, d):
    o = R.table(spark, d, "orders")
    return o.select("o_orderkey",
                    row_hash(["o_orderkey", "o_orderdate", "o_orderstatus", "o_custkey"], o)
                    .alias("row_hash"))


@register("state_to_region", """
WITH s AS (SELECT CAST(s_suppkey AS VARCHAR) AS seller_id,
  CASE s_nationkey % 10 WHEN 0 THEN 'SP' WHEN 1 THEN 'RS' WHEN 2 THEN 'GO' WHEN 3 THEN 'BA'
    WHEN 4 THEN 'AM' WHEN 5 THEN 'RJ' WHEN 6 THEN 'PE' WHEN 7 THEN 'TO' WHEN 8 THEN 'DF' ELSE 'XX' END AS seller_state
  FROM supplier)
SELECT seller_id, seller_state,
  CASE WHEN seller_state IN ('SP','RJ','MG','ES') THEN 'SUDESTE'
       WHEN seller_state IN ('RS','SC','PR') THEN 'SUL'
       WHEN seller_state IN ('GO','MT','MS','DF') THEN 'CENTRO_OESTE'
       WHEN seller_state IN ('BA','PE','CE','PB','RN','AL','SE','PI','MA') THEN 'NORDESTE'
       WHEN seller_state IN ('AM','PA','AC','RO','RR','AP','TO') THEN 'NORTE' END AS seller_region
FROM s""")
def q_state_region(spark, d):
    codes = ["SP", "RS", "GO", "BA", "AM", "RJ", "PE", "TO", "DF", "XX"]
    s = R.table(spark, d, "supplier")
    state = F.element_at(F.array(*[F.lit(c) for c in codes]), (F.col("s_nationkey") % 10 + 1).cast("int"))
    df = s.select(F.col("s_suppkey").cast("string").alias("seller_id"), state.alias("seller_state"))
    return df.withColumn("seller_region", state_to_region("seller_state", BRAZIL_STATE_REGIONS))


def _fact(spark, d):
    return order_fact_join(R.orders(spark, d), R.items(spark, d), R.sellers(spark, d),
                           R.customers(spark, d), regions=R.regions(spark, d),
                           status=R.DELIVERED_STATUS)


_FACT_COLS = ["seller_id", "customer_id", "product_id", "total_price", "dias_atraso", "fl_atraso",
              "leadtime_total", "dias_ate_envio", "dias_transporte", "dias_aprovacao",
              "seller_region", "customer_region", "fl_mesmo_estado", "fl_mesma_regiao",
              "zip_distance_proxy", "safra"]


@register("order_fact_join", O.with_roles(O.ORDER_FACT) + f"""
SELECT {', '.join(_FACT_COLS)}, CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE) AS freight_value,
       {O.r2('freight_percentage', 6)} AS freight_percentage, {O.r2('eficiencia_logistica', 6)} AS eficiencia_logistica
FROM r_order_fact WHERE order_status = '{R.DELIVERED_STATUS}'""")
def q_order_fact(spark, d):
    f = _fact(spark, d)
    return f.select(*_FACT_COLS, F.col("price").cast("double").alias("price"),
                    F.col("freight_value").cast("double").alias("freight_value"),
                    F.round("freight_percentage", 6).alias("freight_percentage"),
                    F.round("eficiencia_logistica", 6).alias("eficiencia_logistica"))


@register("review_fact_join", O.with_roles(O.REVIEW_FACT) + """
SELECT seller_id, review_score, CAST(review_creation_date AS TIMESTAMP) AS review_creation_date, safra
FROM r_review_fact""")
def q_review_fact(spark, d):
    f = review_fact_join(R.reviews(spark, d), R.items(spark, d))
    return f.withColumn("review_creation_date", F.col("review_creation_date").cast("timestamp"))


@register("same_group_flags", """
SELECT s_suppkey, c_custkey, CASE WHEN s_nationkey = c_nationkey THEN 1 ELSE 0 END AS fl_mesmo_estado,
       abs(TRY_CAST(CAST(s_nationkey * 1000 + s_suppkey % 1000 AS VARCHAR) AS DOUBLE)
           - TRY_CAST(CAST(c_nationkey * 1000 + c_custkey % 1000 AS VARCHAR) AS DOUBLE)) AS zip_distance_proxy
FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN supplier ON l_suppkey = s_suppkey
JOIN customer ON o_custkey = c_custkey""")
def q_same_group(spark, d):
    o, li = R.table(spark, d, "orders"), R.table(spark, d, "lineitem")
    s, c = R.table(spark, d, "supplier"), R.table(spark, d, "customer")
    j = (o.join(li, o.o_orderkey == li.l_orderkey).join(s, li.l_suppkey == s.s_suppkey)
         .join(c, o.o_custkey == c.c_custkey))
    sz = (F.col("s_nationkey") * 1000 + F.col("s_suppkey") % 1000).cast("string")
    cz = (F.col("c_nationkey") * 1000 + F.col("c_custkey") % 1000).cast("string")
    return j.select("s_suppkey", "c_custkey",
                    same_group_flag("s_nationkey", "c_nationkey").alias("fl_mesmo_estado"),
                    zip_distance_proxy(sz, cz).alias("zip_distance_proxy"))


# ---------------------------------------------------------------- book pieces
@register("distinct_population", O.with_roles(O.ORDER_FACT) + f"""
SELECT DISTINCT seller_id, safra FROM r_order_fact
WHERE order_status = '{R.DELIVERED_STATUS}' AND safra = {R.REFERENCE_SAFRA}""")
def q_population(spark, d):
    return B.distinct_population(_fact(spark, d), "seller_id", "safra", R.REFERENCE_SAFRA)


@register("recency_flags", O.with_roles(O.ORDER_FACT) + """,
h AS (SELECT seller_id, customer_id, product_id, safra,
             make_date(CAST(safra // 100 AS INTEGER), CAST(safra % 100 AS INTEGER), 1) AS data_dt
      FROM r_order_fact WHERE order_status = 'F')
SELECT seller_id, customer_id, product_id, safra, """ + ", ".join(
    f"CASE WHEN data_dt BETWEEN CAST(max(data_dt) OVER (PARTITION BY seller_id) - INTERVAL {m} MONTH AS DATE) "
    f"AND max(data_dt) OVER (PARTITION BY seller_id) THEN 1 ELSE 0 END AS u{m}m" for m in B.DEFAULT_WINDOWS)
    + " FROM h")
def q_recency(spark, d):
    f = _fact(spark, d).select("seller_id", "customer_id", "product_id", "safra")
    return B.recency_flags(f, "seller_id", "safra")


_BOOK_LI_VALUES = ["l_quantity", "l_discount"]


def _li_monthly(spark, d):
    li = R.table(spark, d, "lineitem")
    return li.select("l_suppkey", "l_returnflag", "l_quantity", "l_discount",
                     D.safra_of("l_shipdate").alias("safra"))


@register("feature_book", f"""
WITH h AS (SELECT *, {O.safra_sql('l_shipdate')} AS safra FROM lineitem),
f AS (SELECT *, """ + ", ".join(
    f"CASE WHEN safra BETWEEN {D.shift_safra_value(R.REFERENCE_SAFRA, -m)} AND {R.REFERENCE_SAFRA} THEN 1 ELSE 0 END AS u{m}m"
    for m in (1, 3)) + f""" FROM h WHERE safra BETWEEN {D.shift_safra_value(R.REFERENCE_SAFRA, -3)} AND {R.REFERENCE_SAFRA})
SELECT l_suppkey, """ + ", ".join(
    f"{O._agg_sql(k, f'CASE WHEN u{m}m = 1 THEN {v} END')} AS vl_{k}_u{m}m_{v}"
    for m in (1, 3) for v in _BOOK_LI_VALUES for k in B.AGGREGATES) + """
FROM f GROUP BY l_suppkey""")
def q_feature_book(spark, d):
    h = S.filter_status_range(_li_monthly(spark, d), between=(D.shift_safra_value(R.REFERENCE_SAFRA, -3),
                                                              R.REFERENCE_SAFRA))
    f = B.recency_flags(h, "l_suppkey", "safra", (1, 3), anchor=R.REFERENCE_SAFRA)
    return B.feature_book(f, ["l_suppkey"], ["u1m", "u3m"], _BOOK_LI_VALUES)


@register("feature_book_by_indicator", f"""
WITH h AS (SELECT *, {O.safra_sql('l_shipdate')} AS safra FROM lineitem),
f AS (SELECT *, """ + ", ".join(
    f"CASE WHEN safra BETWEEN {D.shift_safra_value(R.REFERENCE_SAFRA, -m)} AND {R.REFERENCE_SAFRA} THEN 1 ELSE 0 END AS u{m}m"
    for m in (1, 3)) + f""" FROM h WHERE safra BETWEEN {D.shift_safra_value(R.REFERENCE_SAFRA, -3)} AND {R.REFERENCE_SAFRA})
SELECT l_suppkey, """ + ", ".join(
    f"{O._agg_sql(k, f'CASE WHEN u{m}m = 1 AND l_returnflag = {chr(39)}{a}{chr(39)} THEN l_quantity END')} AS vl_{k}_u{m}m_RF_{a}_l_quantity"
    for a in ("R", "A") for m in (1, 3) for k in B.AGGREGATES) + """
FROM f GROUP BY l_suppkey""")
def q_feature_book_ind(spark, d):
    h = S.filter_status_range(_li_monthly(spark, d), between=(D.shift_safra_value(R.REFERENCE_SAFRA, -3),
                                                              R.REFERENCE_SAFRA))
    f = B.recency_flags(h, "l_suppkey", "safra", (1, 3), anchor=R.REFERENCE_SAFRA)
    exprs = B.feature_book_exprs(["u1m", "u3m"], ["l_quantity"],
                                 indicators={"l_returnflag": ("RF", ["R", "A"])})
    # only the indicator-restricted columns
    exprs = [e for e in exprs if "_RF_" in str(e)]
    return f.groupBy("l_suppkey").agg(*exprs)


@register("temporal_ratios", O.book_orders_sql().replace(
    "SELECT * FROM bk_final",
    "SELECT seller_id, safra, " + ", ".join(
        f"raz_med_{a}_{b}_{v}_orders" for a, b in [("u1m", "u3m"), ("u3m", "u6m"), ("u6m", "u9m"), ("u9m", "u12m")]
        for v in ("price", "dias_atraso")) + " FROM bk_final"))
def q_ratios(spark, d):
    from .books import book_orders
    b = book_orders(R.orders(spark, d), R.items(spark, d), R.sellers(spark, d), R.customers(spark, d),
                    R.REFERENCE_SAFRA, regions=R.regions(spark, d), status=R.DELIVERED_STATUS,
                    values=["price", "dias_atraso"])
    return b.select("seller_id", "safra", *[c for c in b.columns if c.startswith("raz_med_")])


@register("population_left_join_features", O.with_roles(O.ORDER_FACT) + f""",
pop AS (SELECT DISTINCT seller_id, safra FROM r_order_fact WHERE order_status = 'F' AND safra = {R.REFERENCE_SAFRA}),
feat AS (SELECT seller_id, CAST(count(*) AS BIGINT) AS n_items, {O.r2('avg(price)', exact=True)} AS avg_price
         FROM r_order_fact WHERE order_status = 'F' AND safra BETWEEN {D.shift_safra_value(R.REFERENCE_SAFRA, -12)} AND {R.REFERENCE_SAFRA}
         GROUP BY seller_id)
SELECT p.seller_id, p.safra, f.n_items, f.avg_price FROM pop p LEFT JOIN feat f ON p.seller_id = f.seller_id""")
def q_pop_join(spark, d):
    f = _fact(spark, d)
    pop = B.distinct_population(f, "seller_id", "safra", R.REFERENCE_SAFRA)
    feat = (B.history_range(f, "safra", R.REFERENCE_SAFRA).groupBy("seller_id")
            .agg(F.count(F.lit(1)).cast("bigint").alias("n_items"),
                 F.round(F.avg("price"), 2).cast("double").alias("avg_price")))
    return population_left_join_features(pop, feat, "seller_id")


@register("apply_grouping", """
WITH m AS (SELECT n_name AS c_nationkey_name, r_name AS mapped FROM nation JOIN region ON n_regionkey = r_regionkey
           WHERE r_name <> 'ASIA')
SELECT c.c_custkey, coalesce(m.mapped, c.c_nationkey_name) AS TFB_c_nationkey_name
FROM (SELECT c_custkey, n_name AS c_nationkey_name FROM customer JOIN nation ON c_nationkey = n_nationkey) c
LEFT JOIN m ON c.c_nationkey_name = m.c_nationkey_name""")
def q_apply_grouping(spark, d):
    n, r = R.table(spark, d, "nation"), R.table(spark, d, "region")
    c = R.table(spark, d, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    df = c.select("c_custkey", F.col("n_name").alias("c_nationkey_name"))
    m = (n.join(r, n.n_regionkey == r.r_regionkey).filter(F.col("r_name") != "ASIA")
         .select("n_name", "r_name"))
    return apply_grouping(df, m, "c_nationkey_name")


@register("ingest_bronze", f"SELECT * FROM ({O.BRONZE_SQL['sellers']})")
def q_ingest(spark, d):
    b = R.bronze_sellers(spark, d)
    return ingest_bronze(b, b.columns).drop("datproc")
