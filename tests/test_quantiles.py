"""Exact quantiles by brackets, against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from vintagebook.operators import prefix
from vintagebook.operators.prefix import exact_quantiles

PROBS = [0.0, 0.001, 0.25, 0.4999, 0.5, 0.777, 0.99, 1.0]


@pytest.fixture(scope="module")
def skewed(spark):
    """One group holds most rows, one value a third of it; negative zero and large ties."""
    rng = np.random.default_rng(3)
    big = np.concatenate([np.full(10_000, 7.25), rng.gamma(0.5, 40, 20_000), [0.0, -0.0, -3.5]])
    groups = {"big": big, "small": rng.normal(0, 1, 37), "one": np.array([4.0]), "same": np.full(500, 2.0)}
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs]
    rows += [("small", None), ("none", None), (None, 1.0)]
    return spark.createDataFrame(rows, "g string, v double").repartition(6), groups


def _check(got, groups):
    by = {(r.g, r.q_index): r.value for r in got.collect()}
    assert len(by) == len(groups) * len(PROBS)
    for g, vs in groups.items():
        assert [by[g, i] for i in range(len(PROBS))] == pytest.approx(np.quantile(vs, PROBS), abs=1e-12)


@pytest.mark.parametrize("accuracy", [20, 100, 10_000])
def test_groups_equal_numpy_at_any_accuracy(skewed, accuracy):
    df, groups = skewed
    _check(exact_quantiles(df, "v", PROBS, ["g"], accuracy=accuracy), groups)


def test_without_groups_and_without_rows(skewed):
    df, groups = skewed
    got = exact_quantiles(df.filter("g is not null"), "v", PROBS, accuracy=50).orderBy("q_index").collect()
    every = np.concatenate(list(groups.values()))
    assert [r.value for r in got] == pytest.approx(np.quantile(every, PROBS), abs=1e-12)
    assert exact_quantiles(df.limit(0), "v", PROBS).count() == 0
    assert exact_quantiles(df.limit(0), "v", PROBS, ["g"]).count() == 0


def test_a_sketch_that_is_off_costs_a_pass_but_no_rank(skewed, monkeypatch):
    df, groups = skewed
    real = prefix._brackets

    def off(base, probs, group_cols, accuracy):
        cuts = real(base, probs, group_cols, accuracy)
        return cuts.select(*group_cols, F.lit([-1.0, 1e6]).cast("array<double>").alias("_cuts"),
                           F.array(*[F.lit(i % 2 == 1) for i in range(5)]).alias("_fine"))

    monkeypatch.setattr(prefix, "_brackets", off)
    _check(exact_quantiles(df, "v", PROBS, ["g"]), groups)


def test_large_brackets_are_cut_into_ranges(skewed, monkeypatch):
    df, groups = skewed
    monkeypatch.setattr(prefix, "BRACKET_ROWS", 10)
    _check(exact_quantiles(df, "v", PROBS, ["g"], accuracy=20), groups)


def test_only_the_brackets_are_kept(spark, monkeypatch):
    """Of 200,000 distinct values few per thousand reach the checkpoint."""
    kept = []
    real = prefix.checkpointed

    def seen(df):
        out = real(df)
        kept.append(out.count())
        return out

    monkeypatch.setattr(prefix, "checkpointed", seen)
    df = spark.range(200_000).select((F.col("id") * 0.5).alias("v"))
    got = exact_quantiles(df, "v", [0.25, 0.5, 0.75])
    assert [r.value for r in got.orderBy("q_index").collect()] == pytest.approx([24999.875, 49999.75, 74999.625])
    assert kept[0] == 1 and max(kept) < 1500


def test_cuts_below_are_found_by_halving(spark):
    from vintagebook.operators.prefix import count_below
    cuts = [float(c) for c in (-3, -1, 0, 0.5, 2, 2.5, 7)]
    values = [-9.0, -3.0, -2.9, 0.0, 0.5, 2.2, 7.0, 7.1, float("nan"), float("inf")]
    df = spark.createDataFrame([(v, cuts[:k]) for v in values for k in range(len(cuts) + 1)], "v double, c array<double>")
    got = count_below(df, "c", "v", len(cuts), "k").selectExpr("k", "size(filter(c, x -> x < v)) want").collect()
    assert all(r.k == r.want for r in got) and len(got) == 80
