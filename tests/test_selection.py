"""Hash-threshold samples against sorting by the hash."""

import pytest
from pyspark.sql import functions as F

from vintagebook.operators import selection
from vintagebook.operators.selection import first_by_hash


def _sorted_head(df, n, key, seed=42):
    h = F.xxhash64(*key, F.lit(seed))
    whole = F.xxhash64(F.to_json(F.struct(*df.columns)), F.lit(seed))
    return sorted(map(tuple, df.orderBy(h, whole).limit(n).collect()), key=repr)


@pytest.fixture(params=[100_000, 50, 0])
def cut_rows(request, monkeypatch):
    monkeypatch.setattr(selection, "CUT_ROWS", request.param)


@pytest.mark.parametrize("n", [1, 700, 3000, 5000])
def test_the_rows_of_the_sorted_head(spark, cut_rows, n):
    df = spark.range(3000).select("id", (F.col("id") % 7).alias("g"), F.lit(None).cast("string").alias("t"))
    got = first_by_hash(df, n, ["id"])
    assert sorted(map(tuple, got.collect()), key=repr) == _sorted_head(df, n, ["id"])
    assert got.columns == df.columns


def test_hot_keys_null_keys_and_equal_rows(spark, cut_rows):
    rows = [(1, f"t{i}") for i in range(900)] + [(None, "n")] * 40 + [(2, "same")] * 300 + [(3, None)]
    df = spark.createDataFrame(rows, "k int, t string").repartition(5)
    for n in (41, 340, 942, 1240):
        got = first_by_hash(df, n, ["k"])
        assert sorted(map(tuple, got.collect()), key=repr) == _sorted_head(df, n, ["k"])


def test_nothing_asked_and_nothing_there(spark):
    df = spark.range(10)
    assert first_by_hash(df, 0, ["id"]).count() == 0
    assert first_by_hash(df.limit(0), 5, ["id"]).count() == 0


def test_result_is_a_filter(spark):
    plan = first_by_hash(spark.range(5000), 100, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "TakeOrdered" not in plan
