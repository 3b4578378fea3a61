"""The pipeline against a plain version of its stages."""

from collections import Counter

import corpus_pipeline as P
import pytest
from pyspark.sql import functions as F

from tests.llm.test_filters import brute_counts, brute_scores
from tests.llm.test_models import brute_components
from vintagebook.llm import substring_dedup as S


def plain_passages(rows, min_words=20):
    owner = {}
    for i, t in sorted(rows):
        for h, _, _ in S.runs(S.sentences(t.encode()), min_words):
            owner.setdefault(h, i)
    out = []
    for i, t in rows:
        units, gone, seen = S.sentences(t.encode()), set(), set()
        for h, a, z in S.runs(units, min_words):
            if owner[h] < i or h in seen:
                gone |= set(range(a, z))
            seen.add(h)
        starts = [0, *(u[0] for u in units)]
        left = b"".join(t.encode()[starts[k]:u[0]] for k, u in enumerate(units) if k not in gone).decode()
        if left.split() or not gone:
            out.append((i, left))
    return out


@pytest.fixture(scope="module")
def stages(spark, sf, tmp_path_factory):
    base, out = tmp_path_factory.mktemp("stages"), []
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for i, (_, stage) in enumerate(P.STAGES):
        stage(spark, docs, sf).write.parquet(f"{base}/{i}")
        docs = spark.read.parquet(f"{base}/{i}")
        out.append(docs)
    return out


def test_stages_equal_plain_ones(spark, sf, stages):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    good = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").filter("quality = 1 and toxic = 0").collect()}
    scores, cut = brute_scores(rows, good)
    rows = [x for x, s in zip(rows, scores) if not brute_counts(x[1])[-1] and s >= cut]
    assert Counter((r.doc_id, r.text) for r in stages[0].collect()) == Counter(rows)
    first = {i for i, _, c in brute_components(rows) if i == c}
    rows = [x for x in rows if x[0] in first]
    assert Counter((r.doc_id, r.text) for r in stages[1].collect()) == Counter(rows)
    rows = plain_passages(rows)
    assert Counter((r.doc_id, r.text) for r in stages[2].collect()) == Counter(rows)
    assert all(r.n_chars == len(r.text) for r in stages[2].collect() if r.n_chars is not None)
    left = {r.doc_id for r in stages[3].collect()}
    assert left < {i for i, _ in rows}
    assert {r.doc_id for r in stages[4].select("doc_id").distinct().collect()} == left
    for s in stages[:4]:
        assert s.columns == docs.columns


def test_run_equals_its_stages(spark, sf, stages):
    got = P.run(spark, sf)
    assert got.columns == stages[4].columns
    assert sorted(map(tuple, got.select("doc_id", "start", "length", F.crc32("ids")).collect())) == sorted(
        map(tuple, stages[4].select("doc_id", "start", "length", F.crc32("ids")).collect()))


def test_stages_take_messy_and_empty_documents(spark, sf, messy):
    docs = messy.select("doc_id", "text", "lang", "source", "n_chars")
    left = [stage(spark, docs, sf).count() for _, stage in P.STAGES]
    assert left[0] <= 2 and left[1] == docs.count() - 3 and left[3] == docs.count() <= left[4]
    for _, stage in P.STAGES:
        assert stage(spark, docs.limit(0), sf).count() == 0
    assert P.repeated_passages(spark, docs, sf).filter("doc_id in (1, 2, 3)").count() == 3


def test_near_duplicates_go_by_row(spark, sf, tmp_path):
    same = " ".join(f"a{i}" for i in range(60))
    near = same + " more"
    other = "other text that nobody else has at all here"
    rows = [(3, same), (7, near), (7, other), (8, same), (8, same), (9, "x y z"), (9, "x y z"), (None, None), (None, None),
            (None, near), (None, "only here without an id"), (None, "only here without an id"), (1, ""), (1, ""),
            (None, "q r s t u v w"), (12, "q r s t u v w")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/docs")
    got = P.near_duplicates(spark, spark.read.parquet(f"{tmp_path}/docs"), sf).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter(
        [(3, same), (7, other), (9, "x y z"), (None, None), (None, None), (None, "only here without an id"), (1, ""), (1, ""),
         (12, "q r s t u v w")])


def test_release_drops_only_this_threads_tables(spark):
    from threading import Thread

    from vintagebook.llm.common import materialize, release
    mine = materialize(spark.range(3).toDF("id"), "scope")
    other = []

    def work():
        other.append(materialize(spark.range(4).toDF("id"), "scope").inputFiles())
        release(spark)

    t = Thread(target=work)
    t.start()
    t.join()
    assert mine.count() == 3 and other
    release(spark)
    with pytest.raises(Exception):
        mine.count()
