"""Reference-shaped silver tables derived from the driver's star-schema tables.

The marketplace roles (orders, order items, sellers, customers, reviews)
are expressions over ``orders``, ``lineitem``, ``supplier``, ``customer``,
``nation`` and ``region``; every derived table grows with its source.
The same expressions are written as SQL in :mod:`vintagebook.plans.oracle`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import safra_of

# Role parameters of the test tables.
DELIVERED_STATUS = "F"          # o_orderstatus playing 'DELIVERED'
ESTIMATED_DAYS = 20             # estimated delivery = order date + 20 days
REVIEW_DAYS = 30                # review created 30 days after the order
REFERENCE_SAFRA = 200006        # book / target reference month


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    d = F.col("o_orderdate")
    k = F.col("o_orderkey")
    return o.select(
        k.alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        d.alias("order_purchase_timestamp"),
        F.date_add(d, (k % 3).cast("int")).cast("timestamp").alias("order_approved_at"),
        F.date_add(d, (k % 5).cast("int")).cast("timestamp").alias("order_delivered_carrier_date"),
        F.date_add(d, ESTIMATED_DAYS).cast("timestamp").alias("order_estimated_delivery_date"),
        safra_of(d).alias("safra"),
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order items; the item's ship date plays the customer delivery date."""
    li = table(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        price.alias("price"),
        (price * F.col("l_tax").cast("decimal(18,2)")).cast("decimal(18,2)").alias("freight_value"),
        F.col("l_shipdate").alias("order_delivered_customer_date"),
    )


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(state, region) lookup: nation key as text -> region name."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return (n.join(r, n.n_regionkey == r.r_regionkey)
            .select(F.col("n_nationkey").cast("string").alias("state"),
                    F.col("r_name").alias("region")))


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(
        F.col("s_suppkey").alias("seller_id"),
        (F.col("s_nationkey") * 1000 + F.col("s_suppkey") % 1000).cast("string")
        .alias("seller_zip_code_prefix"),
        F.col("s_name").alias("seller_city"),
        F.col("s_nationkey").cast("string").alias("seller_state"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_unique_id"),
        (F.col("c_nationkey") * 1000 + F.col("c_custkey") % 1000).cast("string")
        .alias("customer_zip_code_prefix"),
        F.col("c_mktsegment").alias("customer_city"),
        F.col("c_nationkey").cast("string").alias("customer_state"),
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    created = F.date_add(F.col("o_orderdate"), REVIEW_DAYS)
    return o.select(
        F.col("o_orderkey").alias("review_id"),
        F.col("o_orderkey").alias("order_id"),
        (F.lit(1) + F.col("o_orderkey") % 5).cast("int").alias("review_score"),
        created.alias("review_creation_date"),
        safra_of(created).alias("safra"),
    )


# ---------------------------------------------------------------- bronze roles
# Landing/bronze tables are all STRING.  Dates are written in one of the eight
# accepted patterns, chosen per row from its key, so parsing is exercised on
# every pattern across the whole table.

def _fmt(d, idx):
    from ..functions.dates import DATE_FORMATS
    out = None
    for i, f in enumerate(DATE_FORMATS):
        e = F.date_format(d, f)
        out = F.when(idx == i, e) if out is None else out.when(idx == i, e)
    return out


def _dec_text(c):
    return c.cast("decimal(18,2)").cast("string")


def bronze_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    d, k = F.col("o_orderdate"), F.col("o_orderkey")
    return o.select(
        k.cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.lower(F.col("o_orderstatus")).alias("order_status"),
        _fmt(d, k % 8).alias("order_purchase_timestamp"),
        _fmt(F.date_add(d, (k % 3).cast("int")), (k + 1) % 8).alias("order_approved_at"),
        _fmt(F.date_add(d, (k % 5).cast("int")), (k + 2) % 8).alias("order_delivered_carrier_date"),
        _fmt(F.date_add(d, (k % 11 + 10).cast("int")), (k + 3) % 8)
        .alias("order_delivered_customer_date"),
        _fmt(F.date_add(d, ESTIMATED_DAYS), (k + 4) % 8).alias("order_estimated_delivery_date"),
    )


def bronze_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    return li.select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").cast("string").alias("order_item_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_suppkey").cast("string").alias("seller_id"),
        _fmt(F.col("l_shipdate"), (F.col("l_orderkey") + F.col("l_linenumber")) % 8)
        .alias("shipping_limit_date"),
        price.cast("string").alias("price"),
        (price * F.col("l_tax").cast("decimal(18,2)")).cast("decimal(18,2)").cast("string")
        .alias("freight_value"),
    )


def bronze_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    d, k = F.col("o_orderdate"), F.col("o_orderkey")
    return o.select(
        k.cast("string").alias("review_id"),
        k.cast("string").alias("order_id"),
        (F.lit(1) + k % 5).cast("string").alias("review_score"),
        F.col("o_orderpriority").alias("review_comment_title"),
        F.col("o_orderstatus").alias("review_comment_message"),
        _fmt(F.date_add(d, REVIEW_DAYS), k % 8).alias("review_creation_date"),
        _fmt(F.date_add(d, REVIEW_DAYS + 1), (k + 5) % 8).alias("review_answer_timestamp"),
    )


def bronze_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(
        F.col("s_suppkey").cast("string").alias("seller_id"),
        (F.col("s_nationkey") * 1000 + F.col("s_suppkey") % 1000).cast("string")
        .alias("seller_zip_code_prefix"),
        F.lower(F.col("s_name")).alias("seller_city"),
        F.col("s_nationkey").cast("string").alias("seller_state"),
    )


def bronze_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_name").alias("customer_unique_id"),
        (F.col("c_nationkey") * 1000 + F.col("c_custkey") % 1000).cast("string")
        .alias("customer_zip_code_prefix"),
        F.lower(F.col("c_mktsegment")).alias("customer_city"),
        F.col("c_nationkey").cast("string").alias("customer_state"),
    )


def bronze_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_type").alias("product_category_name"),
        F.length("p_name").cast("string").alias("product_name_lenght"),
        F.length("p_type").cast("string").alias("product_description_lenght"),
        F.col("p_size").cast("string").alias("product_photos_qty"),
        F.floor(F.col("p_retailprice")).cast("string").alias("product_weight_g"),
        F.col("p_size").cast("string").alias("product_length_cm"),
        F.length("p_brand").cast("string").alias("product_height_cm"),
        (F.col("p_partkey") % 100).cast("string").alias("product_width_cm"),
    )


BRONZE = {
    "orders": bronze_orders, "order_items": bronze_items, "order_reviews": bronze_reviews,
    "sellers": bronze_sellers, "customers": bronze_customers, "products": bronze_products,
}


# ---------------------------------------------------------------- toolbox frames
def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled / vintage / scored frame over lineitem: target = returned item,
    score = quantity / 50 (50 distinct values, so ties are exercised)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_discount",
        "l_tax", "l_linestatus", "l_returnflag",
        (F.col("l_returnflag") == "R").cast("int").alias("target"),
        safra_of("l_shipdate").alias("safra"),
        (F.col("l_quantity") / 50).alias("score"),
    )


def documents_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents LEFT JOIN labels (the text itself is not projected)."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    lb = table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic")
    return d.join(lb, "doc_id", "left")


# Vintage that starts the out-of-time test split of the item frames.
TEST_FROM_SAFRA = 199801


def items_with_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled item frame with the part's brand and type (high-cardinality text).
    Parts grow with the items: the join is shuffled, none of them go through the driver."""
    li = labelled(spark, sf_dir)
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    return li.join(p.hint("merge"), li.l_partkey == p.p_partkey, "left").drop("p_partkey")
