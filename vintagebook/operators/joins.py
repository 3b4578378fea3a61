"""Fact joins of orders, items, sellers, customers and reviews; ABT joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.logistics import (delivery_metrics, price_metrics, same_group_flag,
                                   zip_distance_proxy)
from ..functions.mapping import BRAZIL_STATE_REGIONS, case_map
from .bounded import bounded_broadcast

# The per-item order metrics aggregated by the orders book, in order.
ORDER_VALUES: tuple[str, ...] = (
    "price", "freight_value", "total_price", "freight_percentage", "dias_atraso", "fl_atraso",
    "leadtime_total", "dias_ate_envio", "dias_transporte", "dias_aprovacao",
    "eficiencia_logistica", "fl_mesmo_estado", "fl_mesma_regiao", "zip_distance_proxy",
)


def with_region(df: DataFrame, state_col: str, region_col: str,
                regions: Mapping[str, Sequence[str]] | DataFrame = BRAZIL_STATE_REGIONS
                ) -> DataFrame:
    """Attach a region to a dimension table, from a CASE map or a (state, region) table."""
    if region_col in df.columns:
        return df
    if isinstance(regions, DataFrame):
        lookup = regions.toDF("_state", region_col)
        return (df.join(bounded_broadcast(lookup), F.col(state_col) == F.col("_state"), "left")
                .drop("_state"))
    return df.withColumn(region_col, case_map(state_col, regions))


def safra_ts_range(df: DataFrame, ts_col: str, lo: int, hi: int) -> DataFrame:
    """``lo <= safra_of(ts) <= hi`` written as literal timestamp bounds on the
    stored column, so the scan can skip row groups / files."""
    from ..functions.dates import shift_safra_value
    t = df.schema[ts_col].dataType
    end = shift_safra_value(hi, 1)
    start_lit = F.lit(f"{lo // 100:04d}-{lo % 100:02d}-01 00:00:00").cast(t)
    end_lit = F.lit(f"{end // 100:04d}-{end % 100:02d}-01 00:00:00").cast(t)
    return df.filter((F.col(ts_col) >= start_lit) & (F.col(ts_col) < end_lit))


# Dimension tables up to this many rows are broadcast; larger ones are shuffled.
MAX_DIMENSION_BROADCAST_ROWS = 5_000_000


def order_fact_join(orders: DataFrame, items: DataFrame, sellers: DataFrame,
                    customers: DataFrame,
                    regions: Mapping[str, Sequence[str]] | DataFrame = BRAZIL_STATE_REGIONS,
                    status: str | None = "DELIVERED", status_col: str = "order_status",
                    safra_range: tuple[int, int] | None = None,
                    ts_col: str | None = "order_purchase_timestamp") -> DataFrame:
    """One row per order item with price, delivery and geography metrics.

    Plan: filtered orders LEFT JOIN customers (the narrow order table is what
    gets shuffled by customer when customers are too large to broadcast),
    then JOIN items on order_id (the LEFT join + ``seller_id IS NOT NULL`` of
    the reference is an inner join), then LEFT JOIN sellers, broadcast when
    the seller dimension is within the bound.  ``safra_range`` is applied to
    orders before any join, also as a timestamp range on ``ts_col`` (the
    vintage is derived from it) so it reaches the scan.
    """
    o = orders
    if status is not None:
        o = o.filter(F.col(status_col) == F.lit(status))
    if safra_range is not None:
        o = o.filter(F.col("safra").between(*safra_range))
        if ts_col is not None and ts_col in o.columns:
            o = safra_ts_range(o, ts_col, *safra_range)
    it = items.filter(F.col("seller_id").isNotNull())
    s = with_region(sellers, "seller_state", "seller_region", regions)
    c = with_region(customers, "customer_state", "customer_region", regions)
    oc = o.join(bounded_broadcast(c, MAX_DIMENSION_BROADCAST_ROWS), "customer_id", "left")
    f = oc.join(it, "order_id").join(bounded_broadcast(s, MAX_DIMENSION_BROADCAST_ROWS),
                                     "seller_id", "left")
    return f.select(
        "seller_id", "customer_id", "product_id", "price", "freight_value",
        *price_metrics(),
        *delivery_metrics(),
        "seller_region", "customer_region",
        same_group_flag("seller_state", "customer_state").alias("fl_mesmo_estado"),
        same_group_flag("seller_region", "customer_region").alias("fl_mesma_regiao"),
        zip_distance_proxy("seller_zip_code_prefix", "customer_zip_code_prefix")
        .alias("zip_distance_proxy"),
        "safra", "order_purchase_timestamp",
    )


def _in_range(df: DataFrame, safra_range: tuple[int, int] | None, ts_col: str) -> DataFrame:
    """Rows of the vintages, bounded on the timestamp too so that it reaches the scan."""
    if safra_range is None:
        return df
    df = df.filter(F.col("safra").between(*safra_range))
    return safra_ts_range(df, ts_col, *safra_range) if ts_col in df.columns else df


def review_fact_join(reviews: DataFrame, items: DataFrame, safra_range: tuple[int, int] | None = None,
                     ts_col: str = "review_creation_date") -> DataFrame:
    """reviews -> items on order_id, seller known.  The sellers table adds no
    column the reviews book reads, so it is left out of the plan."""
    reviews = _in_range(reviews, safra_range, ts_col)
    it = items.filter(F.col("seller_id").isNotNull()).select("order_id", "seller_id")
    return (reviews.join(it, "order_id")
            .select("seller_id", "review_score", "review_creation_date", "safra"))


def target_fact_join(orders: DataFrame, items: DataFrame, status: str | None = "DELIVERED",
                     status_col: str = "order_status", safra_range: tuple[int, int] | None = None,
                     ts_col: str = "order_purchase_timestamp") -> DataFrame:
    """(seller_id, price, safra) for every sold item; only orders and items are read."""
    orders = _in_range(orders, safra_range, ts_col)
    o = orders if status is None else orders.filter(F.col(status_col) == F.lit(status))
    it = items.filter(F.col("seller_id").isNotNull()).select("order_id", "seller_id", "price")
    return o.select("order_id", "safra").join(it, "order_id").select("seller_id", "price", "safra")


def population_left_join_features(population: DataFrame, features: DataFrame,
                                  on: str | Sequence[str] = "seller_id") -> DataFrame:
    return population.join(features, on, "left")


def abt_join(target: DataFrame, books: Sequence[DataFrame],
             keys: Sequence[str] = ("seller_id", "safra"),
             drop: Sequence[str] = ("datproc", "row_hash")) -> DataFrame:
    """target LEFT JOIN every book USING keys; bookkeeping columns dropped first."""
    def _clean(df: DataFrame) -> DataFrame:
        lower = {d.lower() for d in drop}
        return df.select(*[c for c in df.columns if c.lower() not in lower])
    out = _clean(target)
    for b in books:
        out = out.join(_clean(b), list(keys), "left")
    return out


def apply_grouping(df: DataFrame, mapping: DataFrame, var: str, new_col: str | None = None,
                   keep_original: bool = False) -> DataFrame:
    """Recode ``var`` through a (``var``, new value) mapping; unmapped values keep
    their original text.  The result column is ``TFB_<var>``.

    A number is rounded to 4 places first and meets the mapping's keys, numbers or
    their texts, as a number; unmapped ones keep the text of the rounded value."""
    new_col = new_col or f"TFB_{var}"
    m = mapping.toDF("_key", "_mapped")
    own = key = F.col(var)
    if isinstance(df.schema[var].dataType, T.NumericType):
        own = F.round(own, 4)
        key = F.round(own.cast("double"), 4)
        m = m.withColumn("_key", F.round(F.col("_key").try_cast("double"), 4))
    m = m.dropDuplicates(["_key"])
    out = (df.join(bounded_broadcast(m), key == F.col("_key"), "left")
           .withColumn(new_col, F.coalesce(F.col("_mapped").cast("string"), own.cast("string")))
           .drop("_key", "_mapped"))
    return out if keep_original else out.drop(var)


def semi_join_keys(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return df.join(keys, on, "left_semi")


def existence_flag(df: DataFrame, keys: DataFrame, on: str, name: str,
                   present: Column | int = 1, absent: Column | int = 0) -> DataFrame:
    """1/0 flag for 'key exists in ``keys``' as a left join on the distinct keys."""
    k = keys.select(on).distinct().withColumn("_hit", F.lit(True))
    return (df.join(k, on, "left")
            .withColumn(name, F.when(F.col("_hit").isNotNull(), present).otherwise(absent))
            .drop("_hit"))
