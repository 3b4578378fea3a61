"""Trees that are grown on cells instead of rows."""

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier
from pyspark.sql import functions as F

from vintagebook.operators import forest as FO
from vintagebook.operators import model as ML

FEATURES = ["a", "b"]


@pytest.fixture(scope="module")
def rows(spark):
    """3000 rows of 7 x 3 values; the label goes with ``a`` and a little with ``b``."""
    h = F.pmod(F.xxhash64("id"), F.lit(100))
    df = spark.range(3000).select("id", (F.col("id") % 7).alias("a"), (F.col("id") % 3).alias("b"), h.alias("_h"))
    return df.select("id", "a", "b", (F.col("_h") < 15 * F.col("a") + 5 * F.col("b")).cast("int").alias("y")).cache()


def test_cells_hold_all_rows(rows):
    cuts = FO.tree_cuts(rows, FEATURES)
    assert cuts == [[0.5, 1.5, 2.5, 3.5, 4.5, 5.5], [0.5, 1.5]]
    got = FO.cells(rows, FEATURES, "y", cuts).collect()
    assert sum(r.n for r in got) == 3000 and len(got) <= 7 * 3 * 2


@pytest.mark.parametrize("name, plain", [
    ("decision_tree", lambda **kw: DecisionTreeClassifier(maxDepth=7, **kw)),
    ("gbt", lambda **kw: GBTClassifier(maxIter=50, maxDepth=5, **kw))])
def test_trees_of_cells_are_those_of_rows(rows, name, plain):
    mine = ML.fit_tree_models(rows, FEATURES, "y", [name])[name]
    other = plain(minInstancesPerNode=3, labelCol="y", seed=42).fit(ML.assemble(rows, FEATURES).select("features", F.col("y").cast("double").alias("y")))
    assert np.allclose(mine.featureImportances.toArray(), other.featureImportances.toArray(), atol=1e-9)
    both = ML.score(other, ML.score(mine, rows, FEATURES, "mine"), FEATURES, "other")
    assert both.filter(F.abs(F.col("mine") - F.col("other")) > 1e-9).count() == 0


def test_a_cell_is_drawn_as_its_rows_are():
    n = np.full(20000, 50)
    w = FO.draws(n, 42, 0, 0, True)
    assert abs(w.mean() - 50) < 0.3 and abs(w.var() - 50) < 3


def test_forest_does_not_depend_on_the_partitioning(rows, spark):
    def fit(df):
        cuts = FO.tree_cuts(df, FEATURES)
        return FO.grow_forest(FO.cells(df, FEATURES, "y", cuts), FEATURES, cuts, 20, 4, 3, 7)
    one, two = fit(rows), fit(rows.repartition(5, "id"))
    assert np.array_equal(one.featureImportances.toArray(), two.featureImportances.toArray())
    scored = ML.score(one, rows.withColumn("score", F.lit(-1.0)), FEATURES)
    assert scored.columns == ["id", "a", "b", "y", "score"]
    means = {r.a: r.s for r in scored.groupBy("a").agg(F.avg("score").alias("s")).collect()}
    real = {r.a: r.s for r in rows.groupBy("a").agg(F.avg("y").alias("s")).collect()}
    assert all(abs(means[a] - real[a]) < 0.3 for a in real) and means[6] > means[3] > means[0] >= 0


def test_leaves_hold_enough_drawn_rows_and_nulls_are_the_largest(rows):
    counts = np.array([[[1.0, 0.0], [0.0, 4.0], [5.0, 0.0]]])
    assert FO.best_cut(counts, np.ones(2), 1)[2] == 1 and FO.best_cut(counts, np.ones(2), 6)[0] == 0
    bins = FO.binned(rows.select(F.when(F.col("a") < 6, F.col("a")).alias("a"), "b"), FEATURES, [[0.5, 1.5], []])
    assert {r.a: r._bin0 for r in bins.collect()} == {0: 0, 1: 1, 2: 2, 3: 2, 4: 2, 5: 2, None: 2}
    with pytest.raises(ValueError):
        cuts = FO.tree_cuts(rows, FEATURES)
        FO.grow_forest(FO.cells(rows.withColumn("y", F.lit(None).cast("int")), FEATURES, "y", cuts), FEATURES, cuts, 2, 2, 1, 1)


@pytest.mark.parametrize("bad", ["cast(null as double)", "double('nan')", "double('inf')"])
def test_training_rows_have_all_features(rows, bad):
    df = rows.withColumn("a", F.expr(f"if(id = 17, {bad}, cast(a as double))"))
    with pytest.raises(Exception, match="MUST NOT"):
        ML.rf_feature_selection(df, FEATURES, "y")
