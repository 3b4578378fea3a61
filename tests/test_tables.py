"""Dedup, upsert and table-maintenance invariants (FIXTURES §C: keys, upsert)."""


from vintagebook.operators.dedup import dedup_latest
from vintagebook.sources.upsert import (ensure_table_like, merge_into_path, upsert_changes,
                                        upsert_hash_gated)


def test_dedup_latest_nulls_last_and_ties(spark):
    rows = [(1, None, "a"), (1, 5, "b"), (1, 3, "c"), (2, None, "x"), (3, 7, "p"), (3, 7, "q"),
            (None, 1, "n")]
    df = spark.createDataFrame(rows, "k int, ts int, v string")
    agg = {r.k: (r.ts, r.v) for r in dedup_latest(df, ["k"], ["ts", "v"]).collect()}
    win = {r.k: (r.ts, r.v) for r in dedup_latest(df, ["k"], ["ts", "v"], method="window").collect()}
    assert agg == win
    assert agg[1] == (5, "b")
    assert agg[2] == (None, "x")
    assert agg[3] == (7, "q")
    assert len(agg) == 4  # NULL key kept as its own group


def _tables(spark):
    schema = "id int, v string, row_hash string"
    target = spark.createDataFrame([(1, "old", "h1"), (2, "same", "h2"), (3, "keep", "h3"),
                                    (5, "nullhash", None)], schema)
    source = spark.createDataFrame([(1, "new", "h1b"), (2, "changed-but-same-hash", "h2"),
                                    (4, "insert", "h4"), (5, "fixed", "h5")], schema)
    return target, source


def test_upsert_semantics(spark):
    t, s = _tables(spark)
    out = {r.id: r.v for r in upsert_hash_gated(t, s, ["id"]).collect()}
    assert out == {1: "new", 2: "same", 3: "keep", 4: "insert", 5: "fixed"}
    ch = {r.id for r in upsert_changes(t, s, ["id"]).collect()}
    assert ch == {1, 4, 5}


def test_upsert_idempotent(spark):
    t, s = _tables(spark)
    once = upsert_hash_gated(t, s, ["id"])
    twice = upsert_hash_gated(once, s, ["id"])
    assert sorted(once.collect()) == sorted(twice.collect())


def test_merge_into_path_partitions(spark, tmp_path):
    path = str(tmp_path / "gold")
    schema = "id int, safra int, v string, row_hash string"
    first = spark.createDataFrame([(1, 201801, "a", "x"), (2, 201802, "b", "y")], schema)
    assert ensure_table_like(spark, first, path, ["safra"])
    assert not ensure_table_like(spark, first, path, ["safra"])
    merge_into_path(spark, path, first, ["id", "safra"], partition_by=["safra"])
    upd = spark.createDataFrame([(1, 201801, "a2", "x2"), (3, 201801, "c", "z")], schema)
    merge_into_path(spark, path, upd, ["id", "safra"], partition_by=["safra"])
    got = sorted((r.id, r.safra, r.v) for r in spark.read.parquet(path).collect())
    assert got == [(1, 201801, "a2"), (2, 201802, "b"), (3, 201801, "c")]


def test_csv_round_trip_quotes(spark, tmp_path):
    from vintagebook.sources.files import scan_csv_strings, write_csv
    rows = [("1", 'line one\nline two'), ("2", 'comma, inside'), ("3", 'doubled "quote"')]
    df = spark.createDataFrame(rows, "id string, txt string")
    p = str(tmp_path / "landing")
    write_csv(df, p)
    back = sorted(tuple(r) for r in scan_csv_strings(spark, p, ["id", "txt"]).collect())
    assert back == sorted(rows)
