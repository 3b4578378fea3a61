"""Binning, prefix sums, metrics and encoders against pandas/numpy and invariants."""

import numpy as np
import pandas as pd
import pytest

from vintagebook.operators import binning as BN
from vintagebook.operators import encode as E
from vintagebook.operators import metrics as M
from vintagebook.operators.prefix import exact_quantiles, prefix_sums


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(7)
    n = 3000
    pdf = pd.DataFrame({"k": np.arange(n), "x": np.round(rng.normal(50, 20, n), 1),
                        "g": rng.choice(["a", "b", "c"], n), "y": rng.integers(0, 2, n)})
    pdf["s"] = np.round(1 / (1 + np.exp(-(pdf.x - 50) / 20)), 2)
    return spark.createDataFrame(pdf), pdf


def test_prefix_sums_matches_cumsum(spark, frame):
    df, pdf = frame
    out = prefix_sums(df.select("k", "x"), "k", ["x"], buckets=7).toPandas().sort_values("k")
    assert np.allclose(out["cum_x"].to_numpy(), pdf.sort_values("k")["x"].cumsum().to_numpy())
    g = prefix_sums(df.select("k", "g", "x"), "k", ["x"], ["g"], descending=True, buckets=5).toPandas()
    for key, part in pdf.groupby("g"):
        exp = part.sort_values("k", ascending=False)["x"].cumsum().to_numpy()
        got = g[g.g == key].sort_values("k", ascending=False)["cum_x"].to_numpy()
        assert np.allclose(exp, got)


def test_exact_quantiles_match_numpy(spark, frame):
    df, pdf = frame
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    q = exact_quantiles(df, "x", probs, ["g"]).toPandas()
    for key, part in pdf.groupby("g"):
        exp = np.quantile(part["x"], probs)
        got = q[q.g == key].sort_values("q_index")["value"].to_numpy()
        assert np.allclose(exp, got)


def test_qcut_cut_match_pandas(spark, frame):
    df, pdf = frame
    got = BN.qcut(df, "x", 10).select("k", "x_bin").toPandas().sort_values("k")["x_bin"].to_numpy()
    exp = pd.qcut(pdf.sort_values("k")["x"], 10, labels=False, duplicates="drop").to_numpy()
    assert (got == exp).all()
    got = BN.cut(df, "x", 7).select("k", "x_bin").toPandas().sort_values("k")["x_bin"].to_numpy()
    exp = pd.cut(pdf.sort_values("k")["x"], 7, labels=False).to_numpy()
    assert (got == exp).all()


def test_constant_column_falls_back_to_cut(spark):
    df = spark.createDataFrame([(i, 5.0) for i in range(20)], "k int, x double")
    b = BN.qcut(df, "x", 10).select("x_bin").distinct().collect()
    assert len(b) == 1


def test_auc_gini_ks(spark, frame):
    df, pdf = frame
    a = M.roc_auc(df, "s", "y").first()
    from itertools import product  # noqa: F401
    pos, neg = pdf[pdf.y == 1]["s"].to_numpy(), pdf[pdf.y == 0]["s"].to_numpy()
    exp = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert abs(a.auc - exp) < 1e-12
    assert abs(a.gini - (2 * a.auc - 1)) < 1e-12
    ks = M.ks_statistic(df, "s", "y").first().ks
    assert 0 <= ks <= 1


def test_all_ties_and_one_class(spark):
    ties = spark.createDataFrame([(0.3, i % 2) for i in range(10)], "s double, y int")
    assert abs(M.roc_auc(ties, "s", "y").first().auc - 0.5) < 1e-12
    one = spark.createDataFrame([(0.1 * i, 0) for i in range(10)], "s double, y int")
    assert M.roc_auc(one, "s", "y").first().auc is None


def test_encoders_unseen(spark):
    tr = spark.createDataFrame([("a", 1), ("a", 0), ("b", 1)], "c string, y int")
    te = spark.createDataFrame([("a", 0), ("z", 1), (None, 1)], "c string, y int")
    oh = E.one_hot_apply(te, E.one_hot_fit(tr, ["c"]), ["c"]).collect()
    assert [(r.c_a, r.c_b) for r in oh] == [(1, 0), (0, 0), (0, 0)]
    fit = E.target_encode_fit(tr, ["c"], "y")
    out = E.target_encode_apply(te, fit, ["c"]).collect()
    prior = 2 / 3
    assert abs(out[1].c - prior) < 1e-12 and abs(out[2].c - prior) < 1e-12
    with pytest.raises(Exception):
        E.ordinal_encode(te, {"c": ["a", "b"]}).collect()


def test_book_one_row_group_and_zero_den(spark):
    from vintagebook.operators.book import book_for_safra
    rows = [("s1", 201808, 10.0), ("s2", 201808, 0.0), ("s2", 201801, 0.0), ("s2", 201706, 5.0)]
    df = spark.createDataFrame(rows, "seller_id string, safra int, v double")
    b = {r.seller_id: r for r in book_for_safra(df, "seller_id", "safra", 201808, ["v"], "_t").collect()}
    assert b["s1"].vl_std_u1m_v_t is None and b["s1"].vl_qtd_u1m_v_t == 1
    assert b["s2"].raz_med_u1m_u3m_v_t is None          # 0 / 0 -> NULL
    assert b["s2"].vl_qtd_u12m_v_t == 2                  # 201706 is outside the 13-month history


def test_quantile_ranks_are_looked_up_by_range(spark):
    """No nested loop without groups, and equal to numpy with and without them."""
    rng = np.random.default_rng(8)
    values = np.round(rng.gamma(1.5, 20, 5000), 1)
    rows = [(int(i % 3), float(v)) for i, v in enumerate(values)] + [(5, 1.0), (6, None)]
    df = spark.createDataFrame(rows, "g int, v double")
    probs = [0.0, 0.013, 0.25, 0.5, 0.777, 0.99, 1.0]
    got = exact_quantiles(df.filter("g < 3"), "v", probs)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert [r.value for r in got.orderBy("q_index").collect()] == pytest.approx(np.quantile(values, probs))
    by = {(r.g, r.q_index): r.value for r in exact_quantiles(df, "v", probs, ["g"]).collect()}
    assert len(by) == 4 * len(probs) and all(by[5, i] == 1.0 for i in range(len(probs)))
    for g in range(3):
        assert [by[g, i] for i in range(len(probs))] == pytest.approx(np.quantile(values[g::3], probs))
