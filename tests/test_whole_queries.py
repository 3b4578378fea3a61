"""Registered queries do the whole job of their operators."""

import json

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from vintagebook.operators import boosting


def test_cv_search_and_refit_run_whole(spark):
    from __spark_entry__ import queries
    got = queries()["cv_search"](spark, SF_SMALL).orderBy("trial").collect()
    assert [r.trial for r in got] == list(range(len(got)))
    best = max(range(len(got)), key=lambda i: (got[i].mean_auc, -i))
    assert len(got) == 100 or len(got) == best + 11  # the budget, or ten trials after the best one
    for r in got:
        assert len(r.fold_auc) == 5 and abs(sum(r.fold_auc) / 5 - r.mean_auc) < 1e-12
        for name, (_, lo, hi) in boosting.SPACE.items():
            assert lo <= json.loads(r.params)[name] <= hi
    test = queries()["fit_best_score"](spark, SF_SMALL)
    assert test.filter("score > 0 and score < 1").count() == test.count() > 0


def test_report_and_imputation_return_both_sides(spark):
    from __spark_entry__ import queries
    deciles = queries()["score_report_deciles"](spark, SF_SMALL)
    assert {r.split for r in deciles.select("split").distinct().collect()} == {"train", "test"}
    train, test = (queries()[n](spark, SF_SMALL) for n in ("impute_train_side", "impute_train_test"))
    both = train.unionByName(test)
    assert both.count() == spark.read.parquet(f"{SF_SMALL}/documents.parquet").count() and train.count() > 0
    assert both.filter(F.col("quality").isNull() | F.col("n_chars").isNull() | F.col("lang").isNull()).count() == 0


def test_entry_stands_without_the_corpus_operators(monkeypatch):
    import importlib
    import sys

    import __spark_entry__ as entry
    for missing in ("vintagebook.llm.queries", "corpus_pipeline"):
        monkeypatch.setitem(sys.modules, missing, None)  # its import raises ImportError
        names = set(importlib.reload(entry).queries())
        assert "book_orders" in names and "pipeline" not in names
        assert any(n.startswith("op1_") for n in names) == (missing == "corpus_pipeline")
        monkeypatch.undo()
    assert "pipeline" in importlib.reload(entry).queries()


def test_report_tables_are_whole(spark):
    from __spark_entry__ import queries
    curves = queries()["model_report_curves"](spark, SF_SMALL)
    ends = curves.filter("(curve = 'roc' and fpr = 0 and tpr = 0) or (curve = 'pr' and recall = 0 and precision = 1)")
    assert ends.select("split", "curve").distinct().count() == 4
    assert curves.filter("curve = 'roc' and fpr = 1 and tpr = 1").count() == 2
    deciles = queries()["model_report_deciles"](spark, SF_SMALL)
    assert deciles.count() == 10 and deciles.agg(F.sum("volume")).first()[0] == spark.read.parquet(
        f"{SF_SMALL}/lineitem.parquet").count()


def test_parts_do_not_go_through_the_driver(spark, capsys):
    from vintagebook.plans.roles import items_with_parts
    items_with_parts(spark, SF_SMALL).explain()
    assert "BroadcastExchange" not in capsys.readouterr().out
