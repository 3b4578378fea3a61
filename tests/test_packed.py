"""Models that grow whole in a task equal those grown level by level, in a bounded number of jobs."""

import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.test_boosting import PARAMS
from vintagebook.operators import boosting as B
from vintagebook.operators import packed as P


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(3)
    rows = []
    for i in range(4000):
        x = [rng.randrange(30), rng.randrange(9), rng.gauss(0, 1)]
        y = int(rng.random() < (0.7 if x[0] > 14 and x[1] % 2 else 0.3))
        rows.append((i, None if i % 11 == 0 else float(x[0]), float(x[1]), float("nan") if i % 13 == 0 else round(x[2], 1), y, i % 5))
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y int, f int")


def jobs_of(spark, name, run):
    sc = spark.sparkContext
    sc.setJobGroup(name, name)
    try:
        run()
        return len(sc.statusTracker().getJobIdsForGroup(name))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


SETTINGS = [(3, PARAMS), (7, {**PARAMS, "n_estimators": 3, "max_depth": 9, "subsample": 1.0, "num_leaves": 40, "reg_alpha": 0.0}),
            (8, {**PARAMS, "n_estimators": 2, "subsample": 0.5, "num_leaves": 3})]


def test_whole_models_equal_those_grown_by_levels(frame):
    boost, folds = B.Booster(frame, ["a", "b", "c"], "y", ["id"], "f"), [0, 1, 2, 3, 4]
    assert boost.few_cells and sum(boost.counts.values()) == 4000
    trials, parts = boost.grow(SETTINGS, folds)
    want = {(t.number, f): t.done[j] for t in trials for j, f in enumerate(folds)}
    got = {}
    for r in boost.grown(SETTINGS, folds, True).collect():
        got.setdefault((r.trial, r.fold), []).append(B.Tree(**json.loads(r.tree)))
    assert got.keys() == want.keys()
    for k, trees in want.items():
        assert [(t.feature, t.cut, t.child) for t in got[k]] == [(t.feature, t.cut, t.child) for t in trees]
        assert all(np.allclose(a.value, b.value, atol=1e-9) for a, b in zip(got[k], trees))

    def key(d):
        return sorted((r.trial, r.fold, round(r.score, 8), r.n, r.pos, r.neg) for r in d.collect())

    assert key(boost.grown(SETTINGS, folds, False)) == key(boost.held_out_counts(parts, trials).select(
        "trial", "fold", "score", "n", "pos", "neg"))


def test_a_search_runs_no_job_per_level(spark, frame):
    def search(n):
        return lambda: B.search(frame, ["a", "b", "c"], "y", ["id"], {"n_estimators": ("int", n, n + 1)}, n_trials=3, folds=3)

    few, many = (jobs_of(spark, f"search {n}", search(n)) for n in (1, 12))
    assert 0 < few == many


def test_a_fit_runs_no_job_per_level(spark, frame):
    few, many = (jobs_of(spark, f"fit {n}", lambda: B.fit(frame, ["a", "b", "c"], "y", ["id"], {**PARAMS, "n_estimators": n}))
                 for n in (1, 12))
    assert 0 < few == many


def test_many_cells_and_other_labels_grow_by_levels(spark, frame, monkeypatch):
    own = B.fit(frame, ["a", "b", "c"], "y", ["id"], PARAMS)
    double = frame.withColumn("y", F.col("y") * 2)
    assert not B.Booster(double, ["a", "b", "c"], "y", ["id"], "f").few_cells
    monkeypatch.setattr(P, "MOST_CODES", 10)
    levels = B.fit(frame, ["a", "b", "c"], "y", ["id"], PARAMS)
    assert own.base == levels.base and [t.feature for t in own.trees] == [t.feature for t in levels.trees]


def test_sums_are_exact_in_any_order():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 5, (400, 2)).astype(np.uint8)
    n = rng.integers(0, 300, (2, 400))
    params = {**B.DEFAULTS, "max_depth": 6, "scale_pos_weight": 7.3, "learning_rate": 0.3}
    grown = []
    for order in (np.arange(400), rng.permutation(400)):
        m = P._Model(codes[order], 8, 0.1, 5, params)
        for _ in range(4):
            m.add_tree(n[:, order])
        grown.append((m.trees, m.scores[np.argsort(order)]))
    assert grown[0][0] == grown[1][0] and (grown[0][1] == grown[1][1]).all()
