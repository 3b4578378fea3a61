"""Joint boosting against a fold-by-fold version, and the global permutation."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vintagebook.operators import boosting as B
from vintagebook.operators import model as ML

PARAMS = {"n_estimators": 6, "learning_rate": 0.3, "max_depth": 4, "num_leaves": 6, "reg_alpha": 0.2, "reg_lambda": 0.5,
          "subsample": 0.8, "colsample_bytree": 0.7, "scale_pos_weight": 3.0}


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(7)
    rows = []
    for i in range(1500):
        x = [rng.gauss(0, 1) for _ in range(4)]
        y = int(rng.random() < 1 / (1 + math.exp(-(1.5 * x[0] - x[1] * x[2]))))
        rows.append((i, *(None if rng.random() < 0.05 else v for v in x[:3]), float("nan") if i % 9 == 0 else x[3], y, i % 5))
    return spark.createDataFrame(rows, "id long, a double, b double, c double, d double, y int, f int")


def plain_scores(codes, y, fold, h, left_out, number, p):
    """Raw scores of one model, grown node by node."""
    n_features = codes.shape[1]
    use = fold != left_out
    pos, neg = (y[use] > 0).sum() * p["scale_pos_weight"], (y[use] <= 0).sum()
    raw = np.full(len(y), math.log(pos / neg))
    cut_g = lambda g: math.copysign(max(abs(g) - p["reg_alpha"], 0), g)
    part = lambda g, hh: cut_g(g) ** 2 / (hh + p["reg_lambda"] + 1e-12)
    for it in range(p["n_estimators"]):
        prob = 1 / (1 + np.exp(-raw))
        w = np.where(y > 0, p["scale_pos_weight"], 1.0)
        g, hess = w * (prob - y), w * prob * (1 - prob)
        seen = use & B.sampled(h, number, it, p["subsample"])
        level, leaves, delta = [(np.ones(len(y), bool), 0.0)], 1, np.zeros(len(y))
        for _ in range(p["max_depth"]):
            found = []
            for k, (rows, _) in enumerate(level):
                inside, best = rows & seen, (0.0, None)
                for c in B.columns_of(n_features, number, it, p["colsample_bytree"]):
                    for cut in range(int(codes[:, c].max())):
                        a, z = inside & (codes[:, c] <= cut), inside & (codes[:, c] > cut)
                        if min(a.sum(), z.sum()) >= B.MIN_ROWS and min(hess[a].sum(), hess[z].sum()) >= B.MIN_HESSIAN:
                            gain = part(g[a].sum(), hess[a].sum()) + part(g[z].sum(), hess[z].sum()) - part(
                                g[inside].sum(), hess[inside].sum())
                            if gain > best[0] + 1e-9:
                                values = [-p["learning_rate"] * cut_g(g[x].sum()) / (hess[x].sum() + p["reg_lambda"] + 1e-12)
                                          for x in (a, z)]
                                best = (gain, (rows & (codes[:, c] <= cut), rows & (codes[:, c] > cut), values))
                if best[1]:
                    found.append((-best[0], k, best[1]))
            level = []
            for _, _, (a, z, values) in sorted(found, key=lambda x: x[:2])[:max(0, p["num_leaves"] - leaves)]:
                for rows, v in ((a, values[0]), (z, values[1])):
                    delta[rows] = v
                    level.append((rows, v))
                leaves += 1
        raw += delta
    return raw


def auc(s, y):
    pos, neg = s[y > 0], s[y <= 0]
    return float(((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg)))


def test_models_grown_together_equal_fold_by_fold_ones(frame):
    boost = B.Booster(frame, ["a", "b", "c", "d"], "y", ["id"], "f")
    settings = [(3, PARAMS), (4, {**PARAMS, "n_estimators": 2, "max_depth": 3, "subsample": 1.0, "num_leaves": 100})]
    trials, rows = boost.grow(settings, [0, 1, 2, 3, 4])
    got = {}
    for r in boost.held_out(rows, trials).collect():
        got.setdefault((r.trial, r.fold), []).append((round(r.score, 9), r.y))
    table = boost.rows.collect()
    codes = np.array([list(r.codes) for r in table], np.uint8)
    y, fold, h = np.array([r.y for r in table]), np.array([r.fold for r in table]), np.array([r.h for r in table], np.int64)
    assert codes[:, 0].min() == 0 and codes[:, 3].min() == 0  # null and NaN
    for number, p in settings:
        for f in range(5):
            raw = plain_scores(codes, y, fold, h, f, number, p)
            want = sorted((round(float(s), 9), float(v)) for s, v, g in zip(raw, y, fold) if g == f)
            assert np.allclose([s for s, _ in sorted(got[number, f])], [s for s, _ in want], atol=1e-7)


def test_search_stops_by_patience_and_finds_signal(frame):
    out = B.search(frame, ["a", "b", "c", "d"], "y", ["id"], {"n_estimators": ("int", 2, 4), "max_depth": ("int", 2, 3)},
                   n_trials=12, patience=3, batch=6)
    best = max(range(len(out)), key=lambda i: (out[i][2], -i))
    assert len(out) in (12, best + 4) and out[best][2] > 0.7
    assert all(len(per_fold) == 5 for *_, per_fold in out)


def test_suggestions_follow_the_good_trials():
    rng = random.Random(1)
    space = {"x": ("float", 0.0, 1.0), "k": ("int", 1, 9), "r": ("log", 0.001, 1.0)}
    past = [({"x": i / 40, "k": 1 + i % 9, "r": 0.001 * 10 ** (3 * i / 40)}, -abs(i / 40 - 0.75)) for i in range(40)]
    drawn = [B.suggest(space, past, rng) for _ in range(60)]
    assert abs(np.median([d["x"] for d in drawn]) - 0.75) < 0.15
    assert all(0.001 <= d["r"] <= 1 and d["k"] in range(1, 10) for d in drawn)


def test_model_survives_saving(spark, frame, tmp_path):
    m = B.fit(frame, ["a", "b", "c", "d"], "y", ["id"], PARAMS)
    m.save(spark, f"{tmp_path}/model")
    again = B.BoostedTrees.load(spark, f"{tmp_path}/model")
    one, two = (x.score(frame).orderBy("id").select("score", "y").collect() for x in (m, again))
    assert one == two
    assert auc(np.array([r.score for r in one]), np.array([r.y for r in one])) > 0.75


def test_bijection_moves_values_across_the_whole_table(spark):
    n = 1003
    for key in (1, 2):
        q = [r.q for r in spark.range(n).select(ML.shuffled_position(F.col("id"), n, F.lit(key)).alias("q")).collect()]
        assert sorted(q) == list(range(n))
        assert abs(np.corrcoef(np.arange(n), q)[0, 1]) < 0.1
    df = spark.range(n).selectExpr("cast(id as double) as x", "cast(id as double) * 2 as z", "id % 2 as y").repartition(7)
    got = ML.permuted_frames(df, ["x", "z"], 2).toPandas()
    for (f, _), part in got.groupby(["feature", "repeat"]):
        other = "z" if f == "x" else "x"
        assert sorted(part[f]) == sorted(range(0, n * (2 if f == "z" else 1), 2 if f == "z" else 1))
        assert abs(np.corrcoef(part[f], part[other])[0, 1]) < 0.1


def test_importance_of_a_table_sorted_by_the_feature(spark):
    df = spark.range(2000).selectExpr("cast(id as double) as x", "cast(id % 7 as double) as noise", "cast(id >= 1000 as int) as y")
    m = ML.fit_tree_models(df, ["x", "noise"], "y", ["decision_tree"])["decision_tree"]
    got = []
    for size in ("10000", "50"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        got.append({r.feature: r.importance for r in ML.permutation_importance(m, df, ["x", "noise"], "y", 3, metric="auc").collect()})
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got[0] == got[1] and abs(got[0]["x"] - 0.5) < 0.05 and got[0]["noise"] == 0


def test_rows_with_equal_codes_share_a_cell(spark):
    """The sums run over cells: few codes make few of them, and none holds too many rows."""
    df = spark.range(3000).selectExpr("id", "id % 3 a", "cast(id % 7 = 0 as int) y", "cast(id % 5 as int) f")
    boost = B.Booster(df, ["a"], "y", ["id"], "f")
    cells = boost.cells.select("n").collect()
    assert sum(c.n for c in cells) == 3000 and max(c.n for c in cells) <= B.CELL_ROWS
    assert len(cells) <= 3000 / B.CELL_ROWS + 3 * boost.cells.rdd.getNumPartitions() + 3
    assert boost.rows.count() == 3000 and boost.rows.select("h").distinct().count() == 3000
    trials, scored = boost.grow([(0, {**PARAMS, "n_estimators": 2})], [0, 1, 2, 3, 4])
    rows = boost.held_out(scored, trials).groupBy("trial", "fold", "score").agg(
        F.count("*").alias("n"), F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg"))
    counts = boost.held_out_counts(scored, trials).select(rows.columns)
    assert sorted(counts.collect()) == sorted(rows.collect())


def test_average_precision_by_itself(spark):
    from vintagebook.operators.metrics import average_precision, probability_metrics
    df = spark.range(200).selectExpr("id % 2 g", "id % 17 / 17 s", "cast(id % 3 = 0 as int) y")
    got = {r.g: r.average_precision for r in average_precision(df, "s", "y", ["g"]).collect()}
    assert len(got) == 2 and got == {r.g: r.average_precision for r in probability_metrics(df, "s", "y", ["g"]).collect()}
