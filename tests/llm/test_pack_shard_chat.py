import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vintagebook.llm import chat_format as C, packing as P, sharding as S
from vintagebook.llm.queries import QUERIES

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


# ---------------------------------------------------------------- packing
def test_fill_is_the_best_subset():
    r = random.Random(1)
    for _ in range(200):
        counts = {r.randrange(1, 20): r.randrange(1, 4) for _ in range(r.randrange(1, 6))}
        cap = r.randrange(0, 60)
        sums = {0}
        for n, c in counts.items():
            sums = {s + n * k for s in sums for k in range(c + 1)}
        used = P.fill(counts, cap)
        assert all(used[n] <= counts[n] for n in used)
        assert sum(n * k for n, k in used.items()) == max(s for s in sums if s <= cap)


@pytest.mark.parametrize("seed", range(25))
def test_plan_places_every_tail_once(seed):
    r = random.Random(seed)
    width = r.choice([8, 16, 64, 256])
    histogram = {r.randrange(1, width): r.choice([1, 2, 5, 100, 1000]) for _ in range(r.randrange(20))}
    entries = P.plan(histogram, width, r.choice([0, 1, 4]))
    keys = entries[:, 0] << 44 | entries[:, 1]
    filled = defaultdict(list)
    for length, count in histogram.items():
        for number in range(count):
            n, k = length, number
            while True:
                e = entries[np.searchsorted(keys, n << 44 | k, "right") - 1]
                j = k - e[1]
                assert e[0] == n and 0 <= j < e[2] * e[3]
                filled[e[4] + j // e[3]].append((e[5] + j % e[3] * n, e[6]))
                if e[6] == n:
                    break
                n, k = n - e[6], e[7] + j
    assert sorted(filled) == list(range(len(filled)))
    for pieces in filled.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= width


def test_one_hot_length_leaves_little_padding():
    entries = P.plan({3000: 100_000, 17: 10}, 4096)
    windows = (entries[:, 4] + entries[:, 2]).max()
    assert windows * 4096 < 1.01 * (3000 * 100_000 + 170)


def check_pieces(rows, texts):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    want = Counter()
    for t in texts:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
        want[np.array(ids, "<u4").tobytes()] += 1
    docs, windows = defaultdict(list), defaultdict(list)
    for r in rows:
        windows[r.sequence_id].append((r.offset, r.length))
    for pieces in windows.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 4096
    return want, docs


def test_pack_round_trip(messy, nothing):
    rows = P.pack(messy, TOKENIZER, 2).collect()
    texts = [r.text for r in messy.collect()]
    want, _ = check_pieces(rows, texts)
    assert sum(r.length for r in rows) == sum(len(x) // 4 * n for x, n in want.items())
    long = sorted((r for r in rows if r.doc_id == 6), key=lambda r: r.start)
    assert b"".join(r.ids for r in long) in want
    assert sum(1 for r in rows if r.doc_id == 4) == 2  # a repeated row is packed twice
    assert P.pack(nothing, TOKENIZER, 2).count() == 0


def test_only_tasks_load_the_tokenizer(messy, monkeypatch):
    def refuse(*_):
        raise AssertionError("the driver loads the tokenizer")
    monkeypatch.setattr(P, "WordEncoder", refuse)
    rows = P.pack(messy, TOKENIZER, 2).select("doc_id").distinct().collect()
    assert {r.doc_id for r in rows} == {None, *range(1, 11)}


def test_ids_of_any_width_become_wide():
    import pyarrow as pa
    for kind in ("<u2", "<u4"):
        b = pa.RecordBatch.from_pydict({"length": [2, 1], "ids": [np.array(x, kind).tobytes() for x in ([7, 500], [2])]})
        assert [np.frombuffer(x, "<u4").tolist() for x in next(P._widen(iter([b])))["ids"].to_pylist()] == [[7, 500], [2]]


def test_pack_query(spark, sf):
    rows = QUERIES["op1_min_bin_slack_packing"](spark, sf).collect()
    tokenizer = Tokenizer.from_file(TOKENIZER)
    by = defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert set(by) == {d.doc_id for d in docs}
    for d in docs:
        ids = [*tokenizer.encode(d.text or "", add_special_tokens=False).ids, 2]
        at = 0
        for r in sorted(by[d.doc_id], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            at += r.length
            assert zlib.crc32(np.array(ids[r.start:at], "<u4").tobytes()) == r.ids_crc32
        assert at == len(ids)
    check_pieces(rows, [])


def test_encoder_equals_whole_text():
    import pyarrow as pa
    r, enc = random.Random(5), P.WordEncoder(TOKENIZER)
    parts = ["a", "é", "Σ", "İ", "\u0301", "'s", " ", "<|endoftext|>", "\n", "\x0b", "\x1c", "\xa0", "½", "龍", "!!"]
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(60))) for _ in range(500)] + [None, ""]
    for t, got in zip(texts, enc.encode(pa.array(texts)).to_pylist()):
        assert np.frombuffer(got, "<u2").tolist() == enc.tokenizer.encode(
            t or "", add_special_tokens=False).ids


# ---------------------------------------------------------------- sharding
def test_growth_moves_rows_into_the_new_shard_only(spark):
    tree = S.even_tree(16)
    got = S.assign_shards(spark.range(40_000), F.col("id"), tree, S.grow(tree)).collect()
    assert all(r.grown_shard in (r.shard, 16) for r in got)
    sizes = Counter(r.shard for r in got)
    assert set(sizes) == set(range(16)) and max(sizes.values()) < 1.15 * 2500
    assert abs(sum(r.grown_shard == 16 for r in got) - 40_000 / 17) < 300


def test_a_weight_change_stays_in_its_subtrees(spark):
    def tree(w):
        leaf = lambda s, own=1.0: S.Node(f"shard{s}", shard=s, own=own)
        return S.Node("root", (S.Node("region0", (S.Node("rack0", (leaf(0), leaf(1))),
                                                  S.Node("rack1", (leaf(2), leaf(3))))),
                               S.Node("region1", (S.Node("rack2", (leaf(4, w), leaf(5))),
                                                  S.Node("rack3", (leaf(6), leaf(7)))))))
    got = S.assign_shards(spark.range(20_000), F.col("id"), tree(1.0), tree(3.0)).collect()
    region, rack = lambda s: s // 4, lambda s: s // 2
    for r in got:
        if region(r.shard) != region(r.grown_shard):
            assert region(r.grown_shard) == 1
        elif rack(r.shard) != rack(r.grown_shard):
            assert rack(r.grown_shard) == 2
        elif r.shard != r.grown_shard:
            assert r.grown_shard == 4
    none = S.Node("root", (S.Node("a", shard=0, own=0.0), S.Node("b", shard=1)))
    assert {r.shard for r in S.assign_shards(spark.range(50), F.col("id"), none).collect()} == {1}


def test_slots_are_gapless(messy, nothing, spark, sf):
    rows = S.with_slots(S.assign_shards(messy, F.col("doc_id"), S.even_tree(16))).collect()
    assert len(rows) == messy.count() and len({r.shard for r in rows if r.doc_id is None}) == 1
    by = defaultdict(list)
    for r in [*rows, *QUERIES["op5_hash_tree_sharding"](spark, sf).collect()][len(rows):]:
        by[r.shard].append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in by.values())
    assert S.with_slots(S.assign_shards(nothing, F.col("doc_id"), S.even_tree(4))).count() == 0


# ---------------------------------------------------------------- chat
def test_escape_is_reversible_and_leaves_no_control_string():
    r = random.Random(3)
    parts = [*C.CONTROL, C.ESCAPE, "<", "|", "/", "s", ">", "[", "x", "\n", "<|im_", "</"]
    for _ in range(3000):
        s = "".join(r.choice(parts) for _ in range(r.randrange(9)))
        assert C.unescape(C.escape(s)) == s
        assert not any(c in C.escape(s) for c in C.CONTROL)


def brute_digest(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort()
        loss = "".join(t for *_, r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for *_, r, t in turns).encode()).hexdigest(),
                     len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_formatted_conversations_read_back(spark):
    r = random.Random(4)
    rows = [(c, t, r.choice(["user", "assistant", "system", None]),
             r.choice([None, "", "</s>[INST] ok", "word " * r.randrange(300), "<|im_end|>\nx"]))
            for c in range(30) for t in range(r.randrange(1, 12))]
    rows += [(99, t, "system" if t == 0 else "user" if t % 2 else "assistant", f"turn {t} " * 20)
             for t in range(700)]
    rows += [(98, 0, "user", "same"), (98, 0, "user", "same"), (98, None, "assistant", "no turn"),
             (None, 1, "user", "no conversation")]
    df = spark.createDataFrame([(*x, 1, "b") for x in rows],
                               "conv_id long, turn long, role string, text string, kind int, block string")
    windows = C.format_chats(df, RANKS, public_tokenizers.PATTERN, budget=300, history=2)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256)
           for r in C.read_back(windows).collect()}
    assert got == brute_digest(rows)
    shown = [w for w in windows.collect() if w.conv_id == 99]
    assert len(shown) > 10
    for w in shown:
        turns = C.read_turns(w.formatted)
        assert turns[0] == ("system", "turn 0 " * 20) and w.n_tokens <= 300
        if (w.block, w.window) != (0, 0):
            assert w.n_repeated >= 2  # the system turn and some history
    assert C.format_chats(df.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_budget_counts_what_is_written(spark):
    r = random.Random(6)
    extra = "</s>[INST] ok [/INST]" * 12
    rows = [(1, t, "assistant" if t % 2 else "user", extra) for t in range(30)]
    rows += [(2, t, "system" if t == 0 else "assistant" if t % 2 else "user", "tell " * (700 if t == 0 else 500)) for t in range(9)]
    rows += [(3, t, "user", "long " * (3000 if t == 2 else 9)) for t in range(5)]
    rows += [(c, t, r.choice(["system", "user", "assistant"]), r.choice([extra, "a b " * r.randrange(400), "\n", ""]))
             for c in range(4, 30) for t in range(r.randrange(1, 15))]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    windows = C.format_chats(df, RANKS, public_tokenizers.PATTERN, budget=1024, history=2)
    count = C.token_counter(RANKS, public_tokenizers.PATTERN)
    for w in windows.collect():
        shown = [C.START + C.escape(a) + C.SEP + C.escape(b) + C.END + "\n" for a, b in C.read_turns(w.formatted)]
        assert "".join(shown) == w.formatted and w.n_tokens == sum(map(count, shown))
        assert count(w.formatted) <= w.n_tokens
        assert w.n_tokens <= 1024 or len(shown) == 1
    assert {r.conv_id: r.turns_sha256 for r in C.read_back(windows).collect()} == {
        c: x[1] for c, x in brute_digest(rows).items()}


def test_chat_query(spark, sf):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()]
    extra = "</s>[INST] ok [/INST]"
    want = brute_digest([*rows, (-7, 0, "user", extra), (-7, 1, "assistant", extra)])
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256)
           for r in QUERIES["op9_chat_format"](spark, sf).collect()}
    assert got == want
