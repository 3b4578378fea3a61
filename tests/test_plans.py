"""Physical-plan properties that matter at scale (checked on the small tables)."""

import re


from vintagebook.operators import metrics as M
from vintagebook.operators.dedup import dedup_latest
from vintagebook.plans import roles as R

from .conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df) -> str:
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_book_vintage_range_reaches_the_orders_scan(spark):
    from __spark_entry__ import queries
    plan = _formatted(queries()["book_orders"](spark, SF_SMALL))
    scan = [line for line in plan.splitlines() if "PushedFilters" in line and "o_orderdate" in line]
    assert scan and "GreaterThanOrEqual(o_orderdate" in scan[0] and "LessThan(o_orderdate" in scan[0]


def test_book_has_no_window_over_raw_rows(spark):
    from __spark_entry__ import queries
    plan = _plan(queries()["book_orders"](spark, SF_SMALL))
    assert "Window" not in plan  # windows come from the monthly partials, not a per-entity window


def test_running_sums_are_partitioned(spark):
    df = R.labelled(spark, SF_SMALL)
    plan = _plan(M.cumulative_counts(df, "score", "target"))
    for m in re.finditer(r"Window \[.*?\], \[(.*?)\], \[", plan):
        assert m.group(1).strip(), "a window without partitionBy sends every row to one task"


def test_dedup_aggregates_before_the_shuffle(spark):
    li = R.table(spark, SF_SMALL, "lineitem")
    plan = _plan(dedup_latest(li, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey"]))
    lines = plan.splitlines()
    ex = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)
    below = "\n".join(lines[ex:])
    assert "partial_max" in below  # map-side partial aggregation feeds the exchange


def test_scans_prune_columns(spark):
    df = R.labelled(spark, SF_SMALL).select("score", "target")
    plan = _plan(M.roc_auc(df, "score", "target"))
    for m in re.finditer(r"ReadSchema: struct<([^>]*)>", plan):
        assert "l_comment" not in m.group(1)
        assert len(m.group(1).split(",")) <= 3


def test_global_totals_need_no_cross_join(spark):
    from __spark_entry__ import queries
    for name in ("roc_auc", "gini_normalized", "probability_metrics", "qcut", "target_encode",
                 "kde_by_target", "iv_category", "decile_table", "decile_train_test_summary"):
        plan = _plan(queries()[name](spark, SF_SMALL))
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan, name


def test_book_projection_is_built_without_a_round_trip_per_column(spark, monkeypatch):
    from __spark_entry__ import queries
    client = spark.sparkContext._gateway._gateway_client
    send, calls = client.send_command, []

    def counted(command, *args, **kwargs):
        calls.append(1)
        return send(command, *args, **kwargs)

    monkeypatch.setattr(client, "send_command", counted)
    df = queries()["book_orders"](spark, SF_SMALL)
    assert len(df.columns) > 400
    assert 0 < len(calls) < 10_000, "building the book plan should not cost a py4j call per Column node"


def test_books_pair_months_with_safras_without_a_join(spark):
    from __spark_entry__ import queries
    for name in ("book_orders", "book_reviews_backfill"):
        plan = _plan(queries()[name](spark, SF_SMALL))
        assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan, name
