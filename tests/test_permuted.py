"""Permuted rows counted by their bins equal the rows themselves."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from vintagebook.operators import model as ML
from vintagebook.operators import permuted as P
from vintagebook.operators.forest import bin_columns, binned


@pytest.mark.parametrize("name", ["", "x", "abcd", "l_extendedprice", "ação", "a name of exactly thirty-two b..", "n" * 31,
                                  "vl_med_u1m_freight_percentage_orders", "q" * 77])
def test_places_equal_those_of_the_column(spark, name):
    for n, seed in ((1, 42), (1009, -7), (70_000, 1 << 40)):
        got = spark.range(n).select("id", ML.shuffled_position(F.col("id"), n, F.lit(name), F.lit(3), F.lit(seed)).alias("q"))
        got = got.filter("id < 200 or id > 69000").toPandas().sort_values("id")
        assert (P.shuffled_positions(got["id"].to_numpy(), n, (name, 3, seed)) == got["q"]).all()


@pytest.fixture(scope="module")
def frame(spark):
    # null and NaN values, labels that are null or neither 0 nor 1, columns apart from the model's
    return spark.range(3000).selectExpr(
        "if(id % 17 = 0, null, cast(hash(id) % 40 as double)) as x", "if(id % 19 = 0, double('NaN'), cast(id % 7 as double)) as z",
        "id % 5 as w", "if(id % 23 = 0, null, if(id % 29 = 0, 0.5, cast(hash(id) % 40 > id % 9 as double))) as y").repartition(5)


@pytest.fixture(scope="module")
def models(spark):
    train = spark.range(2000).selectExpr("cast(hash(id) % 40 as double) as x", "cast(id % 7 as double) as z",
                                         "cast(hash(id) % 40 > id % 9 as int) as y")
    return ML.fit_tree_models(train, ["z", "x"], "y", ["decision_tree", "random_forest"])


@pytest.mark.parametrize("dense", [1 << 19, 10])
def test_counts_equal_the_permuted_rows(spark, frame, models, monkeypatch, dense):
    model, features = models["decision_tree"], ["x", "z", "w"]
    monkeypatch.setattr(P, "DENSE", dense)
    monkeypatch.setattr(P, "_met", _with_dense(P._met, dense))
    bins = bin_columns(model.cuts)
    rows, n = ML.row_positions(frame)
    got = P.permuted_counts(rows, n, model, features, "y", 2, 42).select("perm", *bins, "label", "n").collect()
    many = ML.permuted_frames(frame, features, 2, 42)
    which = F.array_position(F.array(*[F.lit(f) for f in features]), F.col("feature")).cast("int") - 1
    own = frame.select(F.lit(0).alias("perm"), *frame.columns)
    many = own.unionByName(many.select((1 + which * 2 + F.col("repeat")).alias("perm"), *frame.columns).withColumn("w", F.col("w").cast("long")))
    want = binned(many, model.features, model.cuts).filter("y is not null").groupBy("perm", *bins, F.col("y").alias("label")).agg(
        F.count(F.lit(1)).alias("n")).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len({r.perm for r in got}) == 7


def _with_dense(met, dense):
    def run(*args):  # the bound of the driver's module, in tasks too
        import vintagebook.operators.permuted as p
        kept, p.DENSE = p.DENSE, dense
        try:
            yield from met(*args)
        finally:
            p.DENSE = kept
    return run


@pytest.mark.parametrize("metric", ["average_precision", "auc"])
def test_importance_equals_that_of_scored_rows(spark, frame, models, monkeypatch, metric):
    frame = frame.withColumn("y", F.when(F.col("y") != 0.5, F.col("y")))
    for model in models.values():
        got = ML.permutation_importance(model, frame, ["x", "z", "w"], "y", 2, metric=metric).collect()
        with monkeypatch.context() as m:
            m.setattr(ML, "Binned", ())
            m.setattr(ML, "Forest", ())
            m.setattr(ML, "score", lambda own, df, features, out="score": own.with_probability(df, out, 1))
            want = ML.permutation_importance(model, frame, ["x", "z", "w"], "y", 2, metric=metric).collect()
        assert [r.feature for r in got] == [r.feature for r in want] and got[0].importance > 0.05
        for a, b in zip(got, want):
            assert np.allclose(a[1:], b[1:], atol=1e-12)
        assert {r.feature: r.importance for r in got}["w"] == 0


def test_permuted_rows_are_not_joined_row_by_row(spark, frame, models, monkeypatch):
    def refused(*_):
        raise AssertionError("rows are joined")

    monkeypatch.setattr(ML, "permuted_frames", refused)
    assert ML.permutation_importance(models["decision_tree"], frame, ["x", "z"], "y", 2).count() == 2
