"""Recoding through a mapping table."""

from vintagebook.operators.joins import apply_grouping


def test_numbers_meet_the_mapping_rounded(spark):
    df = spark.createDataFrame([(1, 0.12341), (2, 0.12344), (3, 2.0), (4, 7.55556), (5, None)], "k int, v double")
    m = spark.createDataFrame([("0.1234", "low"), ("2.0", "two"), ("x", "bad")], "v string, g string")
    got = {r.k: r.TFB_v for r in apply_grouping(df, m, "v").collect()}
    assert got == {1: "low", 2: "low", 3: "two", 4: "7.5556", 5: None}


def test_whole_numbers_and_texts(spark):
    ints = spark.createDataFrame([(1,), (12,), (None,)], "v int")
    m = spark.createDataFrame([(1, "one")], "v int, g string")
    assert sorted(str(r.TFB_v) for r in apply_grouping(ints, m, "v").collect()) == ["12", "None", "one"]
    texts = spark.createDataFrame([("a",), ("b",), (None,)], "v string")
    m = spark.createDataFrame([("a", "A"), ("a", "A")], "v string, g string")
    got = apply_grouping(texts, m, "v", keep_original=True)
    assert got.columns == ["v", "TFB_v"]
    assert sorted(map(str, (r.TFB_v for r in got.collect()))) == ["A", "None", "b"]
