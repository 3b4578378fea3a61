"""Feature selection by forests."""

import pytest
from pyspark.sql import functions as F

from vintagebook.operators import model as ML


@pytest.fixture(scope="module")
def rare(spark):
    """One label in ten; ``a`` tells it, ``b`` half of it, ``c`` nothing."""
    h = F.pmod(F.xxhash64("id"), F.lit(100))
    df = spark.range(2000).select("id", (F.col("id") % 10 == 0).cast("int").alias("y"), h.alias("c"))
    return df.select("*", (F.col("y") * 3 + F.col("c") / 100).alias("a"),
                     (F.col("y") * 0.5 + F.col("c") / 100).alias("b"))


def test_balanced_weights(rare):
    got = ML.balanced_weights(rare, "y").groupBy("y").agg(F.sum("weight").alias("w"), F.count("*").alias("n"))
    assert {r.y: (round(r.w, 6), r.n) for r in got.collect()} == {0: (1000.0, 1800), 1: (1000.0, 200)}


def test_both_modes_find_the_telling_feature(rare):
    ratio = ML.rf_feature_selection(rare, ["a", "b", "c"], "y", "max_ratio", 0.2).collect()
    assert "a" in {r.feature for r in ratio} and "c" not in {r.feature for r in ratio}
    top = ML.rf_feature_selection(rare, ["a", "b", "c"], "y", "top_k", k=2).collect()
    assert [r.feature for r in top][0] == "a" and len(top) == 2
    with pytest.raises(ValueError):
        ML.rf_feature_selection(rare, ["a"], "y", "best")
