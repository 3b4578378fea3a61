"""Registered queries (Spark callables) and their DuckDB oracle SQL.

Each query reads the driver's tables through :mod:`vintagebook.plans.roles`
and runs one operator (or composition) over the whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import oracle as O
from . import roles as R
from .books import book_orders, book_reviews

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


@register("book_orders", O.book_orders_sql())
def q_book_orders(spark, d):
    return book_orders(R.orders(spark, d), R.items(spark, d), R.sellers(spark, d),
                       R.customers(spark, d), R.REFERENCE_SAFRA, regions=R.regions(spark, d),
                       status=R.DELIVERED_STATUS)


@register("book_reviews", O.book_reviews_sql())
def q_book_reviews(spark, d):
    return book_reviews(R.reviews(spark, d), R.items(spark, d), R.REFERENCE_SAFRA)


# ---------------------------------------------------------------- silver layer
from .silver import SPECS, silver_table  # noqa: E402


def dates_as_timestamps(df: DataFrame) -> DataFrame:
    """Present DATE columns as midnight TIMESTAMPs (same values, one pandas type)."""
    from pyspark.sql import functions as F
    from pyspark.sql.types import DateType
    return df.select(*[F.col(f.name).cast("timestamp").alias(f.name)
                       if isinstance(f.dataType, DateType) else F.col(f.name)
                       for f in df.schema.fields])


def _silver_query(table_name: str, keys=None):
    def q(spark, d):
        return dates_as_timestamps(
            silver_table(R.BRONZE[table_name](spark, d), SPECS[table_name], keys=keys))
    return q


for _name, _key in [("orders", "silver_orders"), ("order_items", "silver_items"),
                    ("order_reviews", "silver_reviews"), ("sellers", "silver_sellers"),
                    ("customers", "silver_customers"), ("products", "silver_products")]:
    register(_key, O.silver_sql(_name))(_silver_query(_name))

# The reference merges order items on the order alone: one item per order survives.
register("silver_items_by_order", O.silver_sql("order_items", keys=("order_id",)))(
    _silver_query("order_items", keys=("order_id",)))


# ---------------------------------------------------------------- backfill, label, ABT
from ..functions.dates import shift_safra_value  # noqa: E402
from ..operators.joins import target_fact_join  # noqa: E402
from .abt import abt_train_test, build_abt  # noqa: E402
from .books import book_orders_backfill, book_reviews_backfill  # noqa: E402
from .target import inactivity_target  # noqa: E402

# Twelve reference months ending at the reference safra; the
# first eight train, the last four test.
ABT_SAFRAS = [shift_safra_value(R.REFERENCE_SAFRA, -i) for i in range(11, -1, -1)]
ABT_TRAIN = (ABT_SAFRAS[0], ABT_SAFRAS[7])
ABT_TEST = (ABT_SAFRAS[8], ABT_SAFRAS[11])


def _order_roles(spark, d):
    return dict(orders=R.orders(spark, d), items=R.items(spark, d), sellers=R.sellers(spark, d),
                customers=R.customers(spark, d), regions=R.regions(spark, d),
                status=R.DELIVERED_STATUS)


@register("book_orders_backfill", O.book_orders_sql(ABT_SAFRAS))
def q_book_orders_backfill(spark, d):
    return book_orders_backfill(safras=ABT_SAFRAS, **_order_roles(spark, d))


@register("book_reviews_backfill", O.book_reviews_sql(ABT_SAFRAS))
def q_book_reviews_backfill(spark, d):
    return book_reviews_backfill(R.reviews(spark, d), R.items(spark, d), ABT_SAFRAS)


def _seller_fact(spark, d, safra_range=None):
    return target_fact_join(R.orders(spark, d), R.items(spark, d), status=R.DELIVERED_STATUS,
                            safra_range=safra_range)


@register("inactivity_target", O.target_sql(O.TARGET_FACT, "r_target_fact", "seller_id",
                                            safra=R.REFERENCE_SAFRA))
def q_inactivity_target(spark, d):
    bounds = (R.REFERENCE_SAFRA, shift_safra_value(R.REFERENCE_SAFRA, 2))
    return inactivity_target(_seller_fact(spark, d, bounds), "seller_id", safra=R.REFERENCE_SAFRA)


@register("inactivity_target_all_safras",
          O.target_sql(O.TARGET_FACT, "r_target_fact", "seller_id"))
def q_inactivity_target_all(spark, d):
    return inactivity_target(_seller_fact(spark, d), "seller_id")


@register("inactivity_target_customers",
          O.target_sql(O.CUSTOMER_FACT, "r_customer_fact", "customer_id"))
def q_inactivity_target_customers(spark, d):
    return inactivity_target(R.orders(spark, d).select("customer_id", "safra"), "customer_id")


def _abt(spark, d):
    roles = _order_roles(spark, d)
    bo = book_orders_backfill(safras=ABT_SAFRAS, **roles)
    br = book_reviews_backfill(R.reviews(spark, d), roles["items"], ABT_SAFRAS)
    bounds = (ABT_SAFRAS[0], shift_safra_value(ABT_SAFRAS[-1], 2))
    tg = inactivity_target(_seller_fact(spark, d, bounds), "seller_id", safras=ABT_SAFRAS)
    return build_abt(tg, [bo, br], (ABT_SAFRAS[0], ABT_SAFRAS[-1]))


@register("abt_train", O.abt_sql(ABT_SAFRAS, *ABT_TRAIN))
def q_abt_train(spark, d):
    return abt_train_test(_abt(spark, d), ABT_TRAIN, ABT_TEST)[0]


@register("abt_test", O.abt_sql(ABT_SAFRAS, *ABT_TEST))
def q_abt_test(spark, d):
    return abt_train_test(_abt(spark, d), ABT_TRAIN, ABT_TEST)[1]
from . import registry_core  # noqa: E402,F401
from . import registry_tools  # noqa: E402,F401
from . import registry_prep  # noqa: E402,F401
from . import registry_model  # noqa: E402,F401
from . import registry_extra  # noqa: E402,F401
