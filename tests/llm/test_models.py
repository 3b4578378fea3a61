import itertools
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vintagebook.llm import components, jaccard as J, lm_score as M
from vintagebook.llm.queries import QUERIES

PIECES = public_tokenizers.path("piece_bpe_32k.model")


# ---------------------------------------------------------------- language model
def small_pieces():
    texts = [b" ", b"a", b"b", b"ab", b" a", b" ab", b"ba", b"bab"]
    p = np.arange(1, len(texts) + 1, dtype=float)
    return M.Pieces(texts, np.log(p / p.sum()))


def segmentations(s, texts):
    if not s:
        yield ()
    for i, t in enumerate(texts):
        if t and s.startswith(t):
            for rest in segmentations(s[len(t):], texts):
                yield (i, *rest)


def test_forward_sums_all_segmentations():
    pieces = small_pieces()
    logp = np.append(pieces.first, -np.inf)
    words = [bytes(w) for n in range(1, 6) for w in itertools.product(b"ab", repeat=n)]
    times = np.arange(1.0, len(words) + 1)
    want = np.zeros(len(pieces.texts) + 1)
    for rows, found in M.lattices(words, pieces):
        got = M.forward(found, logp)[:, -1]
        for r, g in zip(rows, got):
            ways = [(x, np.exp(sum(logp[i] for i in x))) for x in segmentations(b" " + words[r], pieces.texts)]
            total = sum(p for _, p in ways)
            assert g == pytest.approx(np.log(total))
            for x, p in ways:
                for i in x:
                    want[i] += p / total * times[r]
    counts = sum(M.expected_counts(found, logp, times[rows]) for rows, found in M.lattices(words, pieces))
    assert counts[:-1] == pytest.approx(want[:-1])


def test_every_byte_string_has_a_probability():
    pieces = M.load_pieces(PIECES)
    logp = np.append(pieces.first, -np.inf)
    words = ["龍".encode(), b"\x00\xff", b"x" * 3000, "é́".encode()]
    for _, found in M.lattices(words, pieces):
        assert np.isfinite(M.forward(found, logp)[:, -1]).all()


def brute_base(rows):
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 if i is not None else False for i, _ in rows}
    split = lambda t: (t or "").encode().lower().split()
    c = Counter(w for i, t in rows if not held[i] for w in split(t))
    ends = sum(not held[i] for i, _ in rows)
    n, v = sum(c.values()) + ends, len(c) + (ends > 0)
    log = lambda k: np.log10((k + 0.5) / (n + 0.5 * (v + 1)))
    return sorted((i or -1, held[i], len(split(t)) + 1, sum(c[w] > 0 for w in split(t)) + (ends > 0), n,
                   round(sum(log(c[w]) for w in split(t)) + log(ends), 4)) for i, t in rows)


def test_scores_of_messy_rows(messy, nothing, monkeypatch):
    monkeypatch.setattr(M, "HOT", 50)  # most words take the joined way
    rows = [(r.doc_id, r.text) for r in messy.collect()]
    got = M.score_documents(messy, PIECES).collect()
    assert sorted((r.doc_id or -1, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4))
                  for r in got) == brute_base(rows)
    assert all(r.score < 0 and np.isfinite(r.score) for r in got)
    one = [r.score for r in got if r.doc_id == 4]
    assert one[0] == one[1] == pytest.approx(next(r.score for r in got if r.doc_id == 5))
    assert M.score_documents(nothing, PIECES).count() == 0


def test_score_query_learns(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = QUERIES["op3_lattice_lm_score"](spark, sf).collect()
    assert sorted((r.doc_id or -1, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4))
                  for r in got) == brute_base(rows)
    untrained = M.score_documents(docs, PIECES, rounds=0).collect()
    held = lambda x: sum(r.score for r in x if r.held_out)
    assert held(got) > 0.9 * held(untrained) * 1.0 or held(got) > held(untrained)
    assert held(got) > held(untrained)


# ---------------------------------------------------------------- near duplicates
def brute_components(rows):
    sets = []
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets.append(frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5
                    else frozenset([tuple(w)] if w else []))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            root[find(a)] = find(b)
    smallest = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            smallest[find(k)] = min(i, smallest.get(find(k), i))
    return Counter((i, len(s), smallest.get(find(k)) if s else i) for k, ((i, _), s) in enumerate(zip(rows, sets)))


def near_copies(seed, groups, copies, words, edits):
    r = random.Random(seed)
    rows, k = [], 0
    for _ in range(groups):
        base = [f"w{r.randrange(500)}" for _ in range(r.choice(words))]
        for _ in range(copies):
            w = list(base)
            for _ in range(r.randrange(edits + 1)):
                at = r.randrange(len(w))
                w[at:at + r.randrange(2)] = [f"e{r.randrange(10 ** 6)}"]
            rows.append((k, " ".join(w)))
            k += 1
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("group", [8192, 3])
def test_components_equal_brute_force(spark, monkeypatch, group):
    monkeypatch.setattr(J, "GROUP", group)
    rows = near_copies(1, 12, 14, [3, 5, 7, 12, 40, 63, 64, 120, 300], 6)
    shared = " ".join(f"p{i}" for i in range(60))
    rows += [(1000 + i, shared + " " + " ".join(f"q{i}x{j}" for j in range(12 + i % 4))) for i in range(20)]
    got = J.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(rows)


def test_components_of_messy_rows(messy, nothing):
    rows = [(r.doc_id, r.text) for r in messy.collect()]
    got = J.similar_documents(messy).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(rows)
    assert J.similar_documents(nothing).count() == 0


def test_component_query(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = QUERIES["op10_parity_sketch_join"](spark, sf).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(rows)


def test_connected_components(spark):
    r = random.Random(2)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1060)]
    root = {}
    find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = {r.node: r.root for r in components.connected_components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root if find(x) != x}


def _cells(rng, groups, two_parts):
    """Rows as `_compare` reads them: near copies in groups, two parts in every second one."""
    rows = []
    for key, size in enumerate(groups):
        base = np.unique(rng.integers(0, 1 << 62, 120, dtype=np.uint64))
        for m in range(size):
            cut = int(rng.integers(0, 70))
            s = np.sort(np.concatenate([base[cut:], rng.integers(0, 1 << 62, cut // 4 + 1, dtype=np.uint64)]))
            split = two_parts and key % 2
            rows.append((key, 0, int(split), key * 1000 + m, m % 2 if split else 0, int(rng.integers(0, 4)),
                         len(s), J.parity_sketch(s)))
    names = ["key", "one", "two", "cls", "part", "root", "n", "sketch"]
    return pa.table({x: [r[i] for r in rows] for i, x in enumerate(names)}), rows


@pytest.mark.parametrize("two_parts", [False, True])
def test_compare_against_all_pairs(two_parts):
    """Small groups (as pair lists), large ones (as blocks) and batch bounds give the
    pairs that the distance of the sketches allows; the nearest ones cover every member."""
    t, rows = _cells(np.random.default_rng(3), [1, 2, 5, 63, 64, 65, 130, 1, 3], two_parts)
    want, far_of = set(), {}
    for j, y in enumerate(rows):
        for x in rows[j + 1:]:
            if x[0] != y[0] or x[5] == y[5] or (x[1] != x[2] and x[4] == y[4]):
                continue
            w = min(len(x[7]), len(y[7])) // 8
            a, b = (J._folded(np.frombuffer(z[7], np.uint64)[None, :], w) for z in (x, y))
            far = int(np.bitwise_count(a ^ b).sum())
            if 100 * min(x[6], y[6]) >= 80 * max(x[6], y[6]) and far * 180 <= (x[6] + y[6]) * 20:
                want.add((y[3], x[3]))
                far_of[y[3], x[3]] = far
    assert len(want) > 500
    for size in (7, 64, 1000):
        def run(nearest):
            return [p for b in J._compare(iter(t.to_batches(size)), (80, 100), nearest)
                    for p in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
        found = run(False)
        assert len(found) == len(want) and set(found) == want
        near = set(run(True))
        assert near <= want
        for member in {m for p in want for m in p}:
            for side in (0, 1):
                mine = [far_of[p] for p in want if p[side] == member]
                if mine:
                    assert min(mine) in [far_of[p] for p in near if p[side] == member]


def test_large_groups_are_compared_in_small_pieces():
    """A cell of 2 x 1024 near copies: the pieces take a few MB, and no pair is lost."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from vintagebook.llm import jaccard
    rng, m = np.random.default_rng(0), 2048
    base, sets = rng.integers(0, 2**63, 400, dtype=np.uint64), []
    for _ in range(m):
        s = base.copy()
        s[rng.integers(0, 400, 8)] = rng.integers(0, 2**63, 8, dtype=np.uint64)
        sets.append(np.unique(s))
    side = np.arange(m) % 2
    rows = pa.table({"n": pa.array([len(s) for s in sets], pa.int32()), "part": side, "root": np.arange(m),
                     "one": np.zeros(m, np.int64), "two": np.ones(m, np.int64),
                     "sketch": pa.array([jaccard.parity_sketch(s) for s in sets], pa.binary())})
    tracemalloc.start()
    n = sum(len(i) for i, _, _ in jaccard.survivors(rows, np.array([0, m]), (80, 100)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == (m // 2) ** 2 and peak < 30e6


def traced(work):
    """The result of ``work`` and the bytes that the driver's Python held at most."""
    import tracemalloc
    tracemalloc.start()
    try:
        return work(), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_bitmap_has_every_cell_and_takes_the_driver_little(spark):
    from vintagebook.llm.common import bitmap
    most, at = 1 << 20, [0, 1, 7, 8, 32_767, 32_768, (1 << 20) - 1]
    some = spark.createDataFrame([(x,) for x in at * 2], "cell long")
    bits, _ = bitmap(some, most)
    assert np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little")).tolist() == at
    assert bitmap(some.limit(0), most) == (bytes(most // 8), [])
    (bits, _), peak = traced(lambda: bitmap(spark.range(most).select((F.col("id") * 3 % most).alias("cell")), most))
    assert bits == b"\xff" * (most // 8) and peak < 5e6


def test_frequent_shingles_take_the_driver_little(spark, tmp_path):
    """200 passages of 500 words in two documents each: 99,200 shingles that the driver gets."""
    rows = []
    for k in range(200):
        passage = " ".join(f"p{k}w{i}" for i in range(500))
        rows += [(2 * k, f"{passage} " + " ".join(f"x{k}y{i}" for i in range(600))), (2 * k + 1, passage)]
    rows.append((1000, rows[1][1]))
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    got, peak = traced(lambda: J.similar_documents(docs).filter("component_id != doc_id").collect())
    assert [(r.doc_id, r.component_id, r.n_shingles) for r in got] == [(1000, 1, 496)]
    assert peak < 12e6
