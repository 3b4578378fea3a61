"""Merkle manifest, exact top-k and lexical search against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from vintagebook.llm import lexical as L, merkle as M, topk as K
from vintagebook.llm.common import ascii_lower
from vintagebook.llm.queries import QUERIES

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


# ------------------------------------------------------------------ manifest
def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row):
    shown = (None if row[c] is None else str(row[c]) for c in FIELDS)
    return digest("".join("-" if x is None else f"{len(x.encode())}:{x}" for x in shown))


def plain_tree(leaves, fanout):
    """Root and, per leaf, its siblings level by level as (left, right)."""
    paths = [[] for _ in leaves]
    level, cover = list(leaves), [[i] for i in range(len(leaves))]
    while len(level) > 1:
        up, wide = [], []
        for a in range(0, len(level), fanout):
            run = level[a:a + fanout]
            for j in range(len(run)):
                for i in cover[a + j]:
                    paths[i].append(("".join(run[:j]), "".join(run[j + 1:])))
            up.append(digest("".join(run)))
            wide.append([i for c in cover[a:a + fanout] for i in c])
        level, cover = up, wide
    return level[0], paths


def plain_manifest(rows, fanout=16):
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t)
    groups = defaultdict(list)
    for r in rows:
        given = dict(r)
        hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
        if hit and r["text"] is not None:
            given["text"] = lower(r["text"])
        groups[r["source"]].append((r["doc_id"] is not None, r["doc_id"] or 0, plain_leaf(r), plain_leaf(given), r["doc_id"]))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = [plain_tree([x[2] for x in sorted(groups[s])], fanout) for s in names]
    root, above = plain_tree([t[0] for t in trees], fanout) if trees else (None, [])
    out = []
    for s, (sub, paths), top in zip(names, trees, above):
        for (_, _, leaf, given, i), path in zip(sorted(groups[s]), paths):
            folded = given
            for a, z in path + top:
                folded = digest(a + folded + z)
            proof = digest("".join(a + z for a, z in path + top))
            out.append((i, leaf, sub, root, proof, folded, folded == root))
    return Counter(out)


def found_manifest(docs, fanout=16):
    hit = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 5 == 0
    out = M.verified(M.manifest(docs, tampered=hit, altered={"text": ascii_lower(F.col("text"))}, fanout=fanout))
    return Counter(tuple(r) for r in out.select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect())


def test_manifest_of_messy_rows(messy, nothing):
    docs = messy.withColumn("path", F.lit(1)).withColumn("grp", F.lit("x")).withColumn("lo", F.lit(0))
    mixed = docs.withColumn("source", F.when(F.col("doc_id") == 2, None).when(F.col("doc_id") < 4, "")
                            .otherwise(F.col("source")))
    for d in (docs, mixed):
        want = plain_manifest([r.asDict() for r in d.collect()])
        assert found_manifest(d) == want
    assert M.manifest(nothing).count() == 0


@pytest.mark.parametrize("sizes", [(1,), (3,), (27, 9, 1), (28, 82, 3, 1, 1, 2, 1), (1,) * 11])
def test_manifest_of_any_shape(spark, sizes):
    rows = [(f * 1000 + i, f"g{f}" if f else None, "en", i, f"Text {i}") for f, n in enumerate(sizes) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    want = plain_manifest([r.asDict() for r in docs.collect()], 3)
    assert found_manifest(docs, 3) == want
    assert len(rows) < 20 or {x[-1] for x in want} == {True, False}


def test_intervals_cover_their_group(spark):
    docs = spark.range(700).selectExpr("id as doc_id", "if(id % 3 = 0, 'a', 'b') as grp", "id + 1 as digest")
    leaves = M.ranked(docs.select("grp", "doc_id", F.sha2(F.col("digest").cast("string"), 256).alias("digest")),
                      ["doc_id"], "test")
    for r in leaves.groupBy("grp").agg(F.min("lo"), F.max("hi"), F.countDistinct("lo"), F.max("n")).collect():
        assert r[1] == 0 and r[2] == r[3] == r[4]
    for k, t in enumerate(M.levels(leaves, 4), 1):
        for r in t.collect():
            assert r.lo % 4 ** k == 0 and r.hi == min(r.n, r.lo + 4 ** k)
            assert [x.lo for x in r.kids][1:] == [x.hi for x in r.kids][:-1] and len(r.kids) <= 4


# ------------------------------------------------------------------ top-k
def plain_top(rows, k, every):
    best = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole = [math.floor(64 * x) for x in v]
            best[i] = max(best.get(i, whole), whole)
    out = []
    for q, a in best.items():
        if q % every == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in best.items()
                            if i != q and len(b) == len(a))
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def found_top(spark, rows, k, every, **sizes):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, v int, len int, block string")
    vectors = df.select("*", F.col("vec_id").alias("id"), K.whole_numbers(F.col("embedding"), 64).alias("w")
                        ).select("id", F.col("w").alias("v"), "len", "block")
    return sorted(map(tuple, K.top_k(vectors, F.col("id") % every == 0, k, **sizes).collect()))


def test_top_k_equals_all_pairs(spark):
    rng = random.Random(5)
    hub = [rng.gauss(0, 1) for _ in range(40)]
    rows = [(i, [rng.gauss(0, 1) if i % 3 else h for h in hub], 0, 0, "x") for i in range(600)]
    rows += [(1000, None, 0, 0, None), (1001, [float("nan")] * 40, 0, 0, ""), (1002, [None] + hub[1:], 0, 0, ""),
             (1003, [float("inf")] + hub[1:], 0, 0, ""), (None, hub, 0, 0, ""), (5, hub, 0, 0, ""), rows[6],
             (1020, [2.0, 3.0], 0, 0, ""), (1021, [1.0, -7.5], 0, 0, ""), (1040, [], 0, 0, ""), (1041, [], 0, 0, ""),
             (-20, hub, 0, 0, ""), (1060, [1.0] * 7, 0, 0, "")]
    want = plain_top([(r[0], r[1]) for r in rows], 20, 20)
    assert found_top(spark, rows, 20, 20, block_rows=128, query_rows=16) == want
    assert found_top(spark, rows, 20, 20) == want
    assert found_top(spark, rows[:4], 20, 2) == plain_top([(r[0], r[1]) for r in rows[:4]], 20, 2)
    assert found_top(spark, [], 20, 20) == []


def test_top_k_of_large_numbers(spark):
    rng = random.Random(6)
    rows = [(i, [rng.uniform(-2.0 ** 21, 2.0 ** 21) for _ in range(20)], 0, 0, "x") for i in range(60)]
    want = plain_top([(r[0], r[1]) for r in rows], 5, 10)
    assert max(s for *_, s in want) > 1 << 53
    assert found_top(spark, rows, 5, 10) == want


def test_branch_and_bound_drops_candidates():
    import numpy as np
    rng = np.random.default_rng(1)
    v = (rng.normal(size=(500, 64)) * np.geomspace(64, 1, 64)).astype(np.int64)
    import pyarrow as pa
    block = K.lay_out(pa.table({"len": pa.array([64] * 500, pa.int32()), "block": pa.array([0] * 500, pa.int64()),
                                "id": pa.array(range(500), pa.int64()), "v": pa.array(v.tolist(), pa.list_(pa.int64()))}))
    ids, axes, groups, rest = K.laid_block(block.to_pylist()[0])
    assert (np.concatenate(groups) == v[:, axes].T).all() and (np.diff([r.sum() for r in rest]) < 0).all()
    got = K.search_block(block, block, 5).to_pylist()
    assert len(got) == 2500 and all(r["query_id"] != r["vec_id"] for r in got)


# ------------------------------------------------------------------ lexical search
def plain_search(docs, items, k=50):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+",
                               re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    bags = [(i, Counter(cut(t))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    nn, ll = len(bags), sum(n for *_, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    asked = defaultdict(set)
    for i, t in items:
        asked[i] |= set(cut(t))
    out = []
    for item, terms in asked.items():
        scored = []
        for i, b, n in bags:
            m = 50 + 50 * n * nn // ll
            s = sum(math.floor(1000 * math.log((2 * nn + 2) / (2 * df[t] + 1))) * (1000000000 * b[t] // (1000 * b[t] + 20 * m))
                    for t in terms if t in b)
            if s > 0 and i is not None:
                scored.append((-s, i))
        out += [(item, r, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


ITEMS = "item_id long, text string, term string, w int, block int"


def test_search_of_messy_rows(spark, messy, nothing, monkeypatch):
    items = [(1, "A one, no ID: b-c text"), (2, None), (3, ""), (4, "ok 龍 É w1 w30000"), (None, "words x"), (1, "other"),
             (5, "nowhere"), (6, "a a a b")]
    asked = spark.createDataFrame([(i, t, "t", 0, 0) for i, t in items], ITEMS)
    docs = messy.withColumn("term", F.lit(0)).withColumn("owner", F.lit(0)).withColumn("bucket", F.lit(0))
    want = plain_search([(r.doc_id, r.text) for r in messy.collect()], items)
    for docs_in_bucket, items_in_block in ((4096, 256), (3, 2)):
        monkeypatch.setattr(L, "BUCKET_DOCS", docs_in_bucket)
        monkeypatch.setattr(L, "ITEM_BLOCK", items_in_block)
        got = sorted(map(tuple, L.search(docs, asked).collect()), key=str)
        assert [x[:2] + x[3:] for x in got] == [x[:2] + x[3:] for x in want] and set(got) == set(want)
    assert L.search(nothing, asked).count() == 0
    assert L.search(docs, asked.limit(0)).count() == 0


def test_search_prunes_to_the_same_rows(spark, monkeypatch):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    draw = lambda n: " ".join(words[int(300 * rng.random() ** 3)] for _ in range(n))
    docs = [(i, draw(rng.randint(1, 60))) for i in range(1500)]
    items = [(i, draw(12)) for i in range(20)]
    monkeypatch.setattr(L, "BANDS", (64, 16, 4))
    monkeypatch.setattr(L, "BUCKET_DOCS", 400)
    got = L.search(spark.createDataFrame(docs, "doc_id long, text string"),
                   spark.createDataFrame(items, "item_id long, text string"), 10).collect()
    assert sorted(map(tuple, got), key=str) == plain_search(docs, items, 10)


def test_new_queries_keep_their_columns(spark, sf):
    assert QUERIES["op12_columnar_top_k"](spark, sf).columns == ["query_id", "rank", "vec_id", "score"]
    assert QUERIES["op13_pipelined_search"](spark, sf).columns == ["item_id", "rank", "doc_id", "score"]
