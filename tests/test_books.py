"""Two-level books equal the one-level wide aggregation, cell by cell."""

from pyspark.sql import functions as F

from vintagebook.operators import book as B
from vintagebook.operators.joins import ORDER_VALUES, order_fact_join
from vintagebook.plans import roles as R

from .conftest import SF_SMALL

SAFRA = 200006


def _fact(spark):
    return order_fact_join(R.orders(spark, SF_SMALL), R.items(spark, SF_SMALL),
                           R.sellers(spark, SF_SMALL), R.customers(spark, SF_SMALL),
                           regions=R.regions(spark, SF_SMALL), status=R.DELIVERED_STATUS)


def _one_level(fact, safra):
    hist = B.history_range(fact, "safra", safra)
    flagged = B.recency_flags(hist, "seller_id", "safra")          # per-entity anchor (window)
    active = F.max((F.col("safra") == safra).cast("int")).alias("_active")
    agg = B.feature_book(flagged, ["seller_id", "seller_region"], B.window_names(), ORDER_VALUES,
                         "_orders", extra_aggs=[active])
    return agg.filter("_active = 1").drop("_active")


def _rows(df):
    return {r["seller_id"]: r.asDict() for r in df.collect()}


def _same(a, b):
    assert a.keys() == b.keys()
    for k in a:
        for c, v in b[k].items():
            w = a[k][c]
            assert (v is None and w is None) or abs(v - w) < 1e-9 if isinstance(v, float) else v == w, (k, c, v, w)


def test_two_level_equals_one_level(spark):
    fact = _fact(spark)
    two = B.book_for_safra(fact, "seller_id", "safra", SAFRA, ORDER_VALUES, "_orders",
                           ["seller_region"], ratios=False).drop("safra")
    one = _one_level(fact, SAFRA)
    assert len(one.columns) == len(two.columns)
    _same(_rows(two), _rows(one.select(*two.columns)))


def test_backfill_equals_single_safras(spark):
    fact = _fact(spark)
    safras = [200004, 200006]
    bf = B.book_backfill(fact, "seller_id", "safra", safras, ORDER_VALUES, "_orders", ["seller_region"])
    for s in safras:
        single = B.book_for_safra(fact, "seller_id", "safra", s, ORDER_VALUES, "_orders", ["seller_region"])
        _same(_rows(bf.filter(F.col("safra") == s)), _rows(single))


def test_months_are_shuffled_before_they_are_copied(spark):
    """A month goes into many (reference month, window)s: its copies stay where it is."""
    from vintagebook.operators.book_partials import book_two_level
    fact = spark.range(200).selectExpr("id % 5 e", "cast(199801 + id % 12 as int) safra", "cast(id as double) v")
    book = book_two_level(fact, "e", "safra", [199806, 199812], ["v"], "")
    plan = book._jdf.queryExecution().optimizedPlan().toString()
    assert plan.rindex("RepartitionByExpression") > plan.rindex("Generate")
    assert book.count() == len({(i % 5, i % 12) for i in range(200) if i % 12 in (5, 11)})
