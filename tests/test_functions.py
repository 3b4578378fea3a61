"""Hand-made edge fixtures for the scalar functions."""

import datetime as dt


from vintagebook.functions import dates as D
from vintagebook.functions.hashing import row_hash
from vintagebook.functions.text import normalize_text, safe_cast


def test_parse_all_patterns_and_junk(spark):
    rows = [("2018-03-04 05:06:07",), ("2018/03/04 05:06:07",), ("04/03/2018 05:06:07",),
            ("04-03-2018 05:06:07",), ("2018-03-04",), ("2018/03/04",), ("04/03/2018",),
            ("04-03-2018",), ("",), (None,), ("31/02/2018",), ("abc",)]
    df = spark.createDataFrame(rows, "s string")
    out = df.select(D.parse_timestamp_multi("s").alias("t"), D.safra_of(D.parse_timestamp_multi("s")).alias("safra")).collect()
    for r in out[:4]:
        assert r.t == dt.datetime(2018, 3, 4, 5, 6, 7)
        assert r.safra == 201803
    for r in out[4:8]:
        assert r.t == dt.datetime(2018, 3, 4)
    assert all(r.t is None and r.safra is None for r in out[8:])


def test_safe_cast(spark):
    df = spark.createDataFrame([("58.90",), (" 7 ",), ("7.9",), ("x",), ("",)], "s string")
    r = df.select(safe_cast("s", "int").alias("i"), safe_cast("s", "decimal(18,2)").alias("d")).collect()
    assert [x.i for x in r] == [None, 7, None, None, None]
    assert [str(x.d) if x.d is not None else None for x in r] == ["58.90", "7.00", "7.90", None, None]


def test_safra_arithmetic(spark):
    df = spark.createDataFrame([(201801,), (201812,), (201808,)], "s int")
    r = df.select(D.safra_shift("s", -1).alias("m1"), D.safra_shift("s", 2).alias("p2"),
                  D.safra_shift("s", -12).alias("m12"), D.month_index("s").alias("mi"),
                  D.safra_to_date("s").alias("d")).collect()
    assert [x.m1 for x in r] == [201712, 201811, 201807]
    assert [x.p2 for x in r] == [201803, 201902, 201810]
    assert [x.m12 for x in r] == [201701, 201712, 201708]
    assert r[0].mi == 2018 * 12 + 1
    assert r[0].d == dt.date(2018, 1, 1)
    assert D.shift_safra_value(201801, -1) == 201712


def test_row_hash_nulls_and_dates(spark):
    df = spark.createDataFrame([("a", None, dt.datetime(2018, 1, 2, 3, 4, 5))], "k string, v int, t timestamp")
    h = df.select(row_hash(["k", "v", "t"], df).alias("h")).first().h
    import hashlib
    assert h == hashlib.sha256("a||||2018-01-02".encode()).hexdigest()


def test_normalize_text(spark):
    df = spark.createDataFrame([("  delivered ",)], "s string")
    assert df.select(normalize_text("s").alias("x")).first().x == "DELIVERED"


def test_region_map(spark):
    from vintagebook.functions.mapping import state_to_region
    df = spark.createDataFrame([("SP",), ("RS",), ("XX",), (None,)], "s string")
    r = [x.r for x in df.select(state_to_region("s").alias("r")).collect()]
    assert r == ["SUDESTE", "SUL", None, None]
