"""Registered queries for the remaining inventory rows (U2, J5, J7, A13 cut, P4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics as M
from ..operators import select as S
from ..operators.dedup import drop_duplicates_keep_last
from ..operators.joins import existence_flag
from . import oracle as O
from . import roles as R
from .registry import register
from .registry_tools import dbl, lab, rounded, with_lab


@register("drop_duplicates_keep_last", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC NULLS LAST) AS rn
  FROM orders) WHERE rn = 1""")
def q_keep_last(spark, d):
    return drop_duplicates_keep_last(R.table(spark, d, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"])


@register("existence_flag", """
SELECT c_custkey, c_mktsegment,
       CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') THEN 1 ELSE 0 END AS has_delivered
FROM customer""")
def q_exists(spark, d):
    c = R.table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    o = R.table(spark, d, "orders").filter(F.col("o_orderstatus") == "F").select(F.col("o_custkey").alias("c_custkey"))
    return existence_flag(c, o, "c_custkey", "has_delivered")


@register("partition_range", f"""
WITH {O.ROLE_VIEWS.strip()}
SELECT * FROM r_orders WHERE safra >= 199801 AND safra <= 199806""")
def q_partition_range(spark, d):
    return S.partition_range(R.orders(spark, d), "safra", 199801, 199806)


def _dec_split_sql(split: str, cond: str, mode: str = "qcut") -> str:
    return f"""
lv_{split} AS (SELECT 'score' AS variable, score AS value, target FROM r_lab WHERE {cond}),
ed_{split} AS ({O.fit_bins_sql(f'lv_{split}', 10, mode)}),
b_{split} AS (SELECT {O.bin_sql('value', 'edges')} AS decile, target FROM lv_{split} CROSS JOIN ed_{split} WHERE value IS NOT NULL),
t_{split} AS (SELECT decile, avg(CAST(target AS DOUBLE)) AS event_rate, count(*) AS volume,
                     sum(CASE WHEN target = 1 THEN 1 ELSE 0 END) AS qt_bads FROM b_{split} GROUP BY decile),
s_{split} AS (SELECT decile, event_rate AS event_rate_{split}, qt_bads / sum(qt_bads) OVER () AS perc_total_bads_{split},
                     volume AS volume_{split} FROM t_{split})"""


_TRAIN = f"safra < {R.TEST_FROM_SAFRA}"
_TEST = f"safra >= {R.TEST_FROM_SAFRA}"


@register("decile_train_test_summary", with_lab(_dec_split_sql("train", _TRAIN), _dec_split_sql("test", _TEST)) + f"""
SELECT CAST(a.decile AS INTEGER) AS decile, {dbl(['event_rate_train', 'perc_total_bads_train'])}, volume_train,
       {dbl(['event_rate_test', 'perc_total_bads_test'])}, volume_test
FROM s_train a JOIN s_test b ON a.decile = b.decile""")
def q_dec_summary(spark, d):
    df = lab(spark, d)
    tr, te = df.filter(F.col("safra") < R.TEST_FROM_SAFRA), df.filter(F.col("safra") >= R.TEST_FROM_SAFRA)
    return rounded(M.decile_train_test_summary(tr, te, "score", "target", 10))


@register("decile_table_cut", with_lab(f"""
lv AS (SELECT 'score' AS variable, score AS value, target FROM r_lab),
ed AS ({O.fit_bins_sql('lv', 10, 'cut')}),
b AS (SELECT {O.bin_sql('value', 'edges')} AS decile, value, target FROM lv CROSS JOIN ed WHERE value IS NOT NULL),
t AS (SELECT decile, min(value) AS min_score, max(value) AS max_score, avg(CAST(target AS DOUBLE)) AS event_rate,
             count(*) AS volume, sum(CASE WHEN target = 1 THEN 1 ELSE 0 END) AS qt_bads FROM b GROUP BY decile)""") + f"""
SELECT CAST(decile AS INTEGER) AS decile, {dbl(['min_score', 'max_score', 'event_rate'])}, volume,
       CAST(qt_bads AS BIGINT) AS qt_bads, {O.rnd('qt_bads / sum(qt_bads) OVER ()')} AS perc_total_bads FROM t""")
def q_decile_cut(spark, d):
    return rounded(M.decile_table(lab(spark, d), "score", "target", 10, "cut", scale=1.0))


# ---------------------------------------------------------------- F8 / F9 on their own
from ..functions.logistics import delivery_metrics, price_metrics  # noqa: E402

_DELIVERY_COLS = ["dias_atraso", "fl_atraso", "leadtime_total", "dias_ate_envio",
                  "dias_transporte", "dias_aprovacao"]


def _order_items(spark, d):
    return R.orders(spark, d).join(R.items(spark, d), "order_id")


@register("delivery_metrics", O.with_roles() + f"""
SELECT order_id, order_item_id, {', '.join(_DELIVERY_COLS)},
       {O.r2('eficiencia_logistica', 6)} AS eficiencia_logistica
FROM (SELECT o.order_id, it.order_item_id,
        {O._dd('it.order_delivered_customer_date', 'o.order_estimated_delivery_date')} AS dias_atraso,
        CASE WHEN it.order_delivered_customer_date > o.order_estimated_delivery_date THEN 1 ELSE 0 END AS fl_atraso,
        {O._dd('it.order_delivered_customer_date', 'o.order_purchase_timestamp')} AS leadtime_total,
        {O._dd('o.order_delivered_carrier_date', 'o.order_purchase_timestamp')} AS dias_ate_envio,
        {O._dd('it.order_delivered_customer_date', 'o.order_delivered_carrier_date')} AS dias_transporte,
        {O._dd('o.order_approved_at', 'o.order_purchase_timestamp')} AS dias_aprovacao,
        {O._dd('it.order_delivered_customer_date', 'o.order_purchase_timestamp')}
          / NULLIF({O._dd('it.order_delivered_customer_date', 'o.order_delivered_carrier_date')}, 0)
          AS eficiencia_logistica
      FROM r_orders o JOIN r_items it ON o.order_id = it.order_id)""")
def q_delivery_metrics(spark, d):
    m = _order_items(spark, d).select("order_id", "order_item_id", *delivery_metrics())
    return m.select("order_id", "order_item_id", *_DELIVERY_COLS,
                    F.round("eficiencia_logistica", 6).alias("eficiencia_logistica"))


@register("price_metrics", O.with_roles() + f"""
SELECT order_id, order_item_id, CAST(price + freight_value AS DOUBLE) AS total_price,
       {O.r2('CAST(freight_value AS DOUBLE) / NULLIF(CAST(price + freight_value AS DOUBLE), 0)', 6)}
         AS freight_percentage
FROM r_items""")
def q_price_metrics(spark, d):
    m = R.items(spark, d).select("order_id", "order_item_id", *price_metrics())
    return m.select("order_id", "order_item_id", F.col("total_price").cast("double").alias("total_price"),
                    F.round("freight_percentage", 6).alias("freight_percentage"))
