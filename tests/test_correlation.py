"""Correlations of many columns in one scan, against pandas."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from vintagebook.operators.correlation import correlation_pairs


def _expected(pdf):
    c = pdf.assign(far=pdf["far"] - 1e9).corr()  # pandas loses digits of large means
    cols = list(pdf.columns)
    return {(a, b): c.loc[a, b] for i, a in enumerate(cols) for b in cols[i + 1:]}


def _same(got, want):
    got = {(r.a, r.b): r["corr"] for r in got.collect()}
    assert set(got) == set(want)
    for k, w in want.items():
        if np.isnan(w):
            assert got[k] is None, k
        else:
            # a mean of 1e9 is only known to 1e-7, of a standard deviation of 1
            assert got[k] == pytest.approx(w, abs=1e-8 if "far" in k else 1e-10), k


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(5)
    n = 4000
    x = rng.normal(0, 1, n)
    pdf = pd.DataFrame({
        "x": x, "far": 1e9 + x, "mix": 0.6 * x + rng.normal(0, 1, n), "tenth": np.full(n, 0.1),
        "holes": np.where(rng.random(n) < 0.4, np.nan, x + rng.normal(0, 2, n)),
        "empty": np.full(n, np.nan), "pair": np.where(np.arange(n) % 2 == 0, 0.3, rng.normal(0, 1, n)),
        "even": np.where(np.arange(n) % 2 == 0, rng.normal(0, 1, n), np.nan),
        "skew": rng.gamma(0.1, 1e6, n)})
    nulls = [F.when(~F.isnan(c), F.col(c)).alias(c) if c == "holes" else F.col(c) for c in pdf.columns]
    return spark.createDataFrame(pdf).select(*nulls).repartition(5), pdf


def test_equal_to_pandas_with_nulls_and_constants(frame):
    df, pdf = frame
    want = _expected(pdf)
    want["pair", "even"] = np.nan  # constant where both are set
    for other in set(pdf.columns) - {"tenth"}:
        want[tuple(sorted(("tenth", other), key=list(pdf.columns).index))] = np.nan
    _same(correlation_pairs(df, list(pdf.columns)), want)
    assert want["x", "far"] == pytest.approx(1.0, abs=1e-6)


def test_blocks_and_batches_change_nothing(spark, frame, monkeypatch):
    df, pdf = frame
    cols = [c for c in pdf.columns if c not in ("tenth", "pair", "even")]
    want = _expected(pdf[cols])
    _same(correlation_pairs(df, cols, block=2), want)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        _same(correlation_pairs(df, cols, tasks=1), want)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_infinite_values_touch_only_their_pairs(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (2.0, 4.0, 1.0), (3.0, 6.5, 2.5), (float("inf"), 8.0, None)],
                               "a double, b double, c double")
    got = {(r.a, r.b): r["corr"] for r in correlation_pairs(df, ["a", "b", "c"]).collect()}
    assert got["a", "b"] is None
    assert got["a", "c"] == pytest.approx(1.0) and got["b", "c"] == pytest.approx(1.0)


def test_no_rows_no_columns(spark):
    df = spark.createDataFrame([], "a double, b int")
    assert correlation_pairs(df, ["a", "b"]).count() == 0
    assert correlation_pairs(df, ["a"]).count() == 0
    assert correlation_pairs(df, []).count() == 0


def test_one_scan_for_many_columns(spark):
    wide = spark.range(300).select(*[(F.xxhash64("id", F.lit(i)) % 1000).alias(f"c{i}") for i in range(60)])
    out = correlation_pairs(wide, wide.columns)
    assert out.count() == 60 * 59 // 2
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (0, 300") == 1
