"""Cases that earlier versions got wrong."""

import pytest
from pyspark.sql import functions as F


def test_constant_column_does_not_drop_others(spark):
    from vintagebook.operators.encode import correlated_to_drop
    df = spark.range(200).select(F.lit(1.0).alias("const"), F.col("id").alias("a"),
                                 F.pmod(F.xxhash64("id"), F.lit(97)).alias("b"))
    assert correlated_to_drop(df, ["const", "a", "b"]) == []


def test_correlation_is_pairwise(spark):
    from vintagebook.operators.encode import correlation_pairs
    df = spark.range(100).select(F.col("id").alias("a"), (F.col("id") * 2).alias("b"),
                                 F.when(F.col("id") < 3, -F.col("id")).alias("c"))
    got = {(r.a, r.b): r["corr"] for r in correlation_pairs(df, ["a", "b", "c"]).collect()}
    assert got["a", "b"] == pytest.approx(1.0) and got["a", "c"] == pytest.approx(-1.0)


def test_tree_bins_split_by_gain(spark):
    from vintagebook.operators.model import tree_bins_fit
    rates = [0.9, 0.2, 0.8, 0.3, 0.7]
    df = spark.createDataFrame([(p * 10.0 + i % 40 / 100, int(i // 40 * 2 + i % 2 < r * 10)) for p, r in enumerate(rates)
                                for i in range(200)], "v double, y int")
    got = tree_bins_fit(df, "v", "y", 5).collect()
    assert [round(r.event_rate, 6) for r in got] == rates
    assert sum(r.volume for r in got) == 1000


def test_tree_bins_apply_like_digitize(spark):
    from vintagebook.operators.binning import tree_bins_apply
    df = spark.createDataFrame([(0.5,), (1.0,), (1.5,), (2.0,)], "v double")
    assert [r.b for r in tree_bins_apply(df, "v", [1.0, 2.0], "b").collect()] == [0, 1, 1, 2]


def test_grouped_deciles_keep_groups_apart(spark):
    from vintagebook.operators.metrics import decile_table
    rows = [("a", None, float(i), i % 2) for i in range(20)] + [
        (None, "a", float(i + 1000), i % 2) for i in range(20)]
    df = spark.createDataFrame(rows, "g string, h string, s double, y int")
    got = decile_table(df, "s", "y", 2, group_cols=["g", "h"]).groupBy("g", "h").count().collect()
    assert sorted(r["count"] for r in got) == [2, 2]


def test_kde_leaves_out_constant_classes(spark):
    from vintagebook.operators.profile import kde_by_target
    df = spark.createDataFrame([(3.0, 0)] * 5 + [(float(i), 1) for i in range(5)], "v double, y int")
    got = kde_by_target(df, ["v"], "y", grid=10).collect()
    assert {r.cls for r in got} == {1} and len(got) == 10


def test_text_variables_have_log_odds(spark):
    from vintagebook.operators.woe import logodds_linearity
    rows = [(v, float(i), int(i % 10 < k)) for k, v in ((2, "a"), (5, "b"), (8, "c")) for i in range(100)]
    df = spark.createDataFrame(rows, "t string, x double, y int")
    got = {r.variable: r.r2 for r in logodds_linearity(df, "y", ["t", "x"], clip=1e-6).collect()}
    assert got["t"] == pytest.approx(1.0) and "x" in got


def test_running_sum_keeps_null_order_values(spark):
    from vintagebook.operators.prefix import prefix_sums
    df = spark.createDataFrame([(None, 1), (1.0, 2), (2.0, 3)], "v double, n int")
    got = {r.v: r.cum_n for r in prefix_sums(df, "v", ["n"]).collect()}
    assert got == {None: 1, 1.0: 3, 2.0: 6}


def test_crosstab_counts_other_classes(spark):
    from vintagebook.operators.rates import crosstab_normalized
    df = spark.createDataFrame([("a", 0), ("a", 1), ("a", 2), ("a", 2)], "v string, y int")
    assert crosstab_normalized(df, "v", "y").first().asDict() == {"v": "a", "share_0": 0.25, "share_1": 0.25}


def test_moved_row_leaves_its_old_partition(spark, tmp_path):
    from vintagebook.sources.upsert import merge_into_path, write_table
    path = str(tmp_path / "t")
    schema = "id int, v string, row_hash string, safra int"
    write_table(spark.createDataFrame([(1, "a", "h1", 201801), (2, "b", "h2", 201801),
                                       (3, "c", "h3", 201803)], schema), path, partition_by=["safra"])
    for moved, want in (((1, "a2", "h9", 201802), {(1, 201802), (2, 201801), (3, 201803)}),
                        ((3, "c2", "h8", 201802), {(1, 201802), (2, 201801), (3, 201802)})):
        merge_into_path(spark, path, spark.createDataFrame([moved], schema), ["id"], partition_by=["safra"])
        got = spark.read.schema(schema).parquet(path).collect()
        assert {(r.id, r.safra) for r in got} == want and len(got) == 3


def test_duplicate_source_keys_fail(spark, tmp_path):
    from vintagebook.sources.upsert import merge_into_path, write_table
    path = str(tmp_path / "t")
    one = spark.createDataFrame([(1, "h")], "id int, row_hash string")
    write_table(one, path)
    with pytest.raises(ValueError):
        merge_into_path(spark, path, one.union(one), ["id"])


def test_backfills_push_vintage_bounds(spark):
    from vintagebook.plans.registry import QUERIES
    from .conftest import SF_SMALL
    from .test_plans import _formatted
    for name in ("book_orders_backfill", "inactivity_target"):
        scans = [x for x in _formatted(QUERIES[name](spark, SF_SMALL)).splitlines()
                 if "PushedFilters" in x and "o_order" in x]
        assert scans and all("GreaterThanOrEqual(o_orderdate" in x for x in scans), name


def test_preprocess_select_returns_every_row(spark):
    from vintagebook.plans.registry import QUERIES
    from .conftest import SF_SMALL
    assert QUERIES["preprocess_select"](spark, SF_SMALL).count() == spark.read.parquet(
        f"{SF_SMALL}/lineitem.parquet").count()
