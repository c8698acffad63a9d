"""Character statistics, code tables and parenthesis balance."""

from conftest import rows

from quarry.operators import char_stats as cs

BALANCED = ["f(x, g(y))", "(one) and (two\nlines (nested))", "", "none at all"]
UNBALANCED = [")(", "a) b (c", "((x)"]


def test_freq_and_order(spark):
    df = spark.createDataFrame([("aba",), ("",)], "text string")
    assert dict(rows(cs.char_freq(df))) == {"a": 2, "b": 1}
    f = spark.createDataFrame([("t", 2), ("e", 1), ("x", 3)], "ch string, n long")
    assert rows(cs.ordered_leaves(f).orderBy("pos"), "ch") == [("e",), ("t",), ("x",)]


def test_encode(spark):
    table = spark.createDataFrame([("a", "0"), ("b", "10"), ("é", "110"), ("漢", "111")], "ch string, bits string")
    df = spark.createDataFrame([(1, "ab"), (2, ""), (3, None), (1, "ba"), (4, "é漢a")], "id long, text string")
    got = sorted(rows(cs.encode(df, "text", table, "id")), key=str)
    assert got == sorted([(1, "010"), (1, "100"), (2, ""), (3, None), (4, "1101110")], key=str)


def test_encode_large_alphabet_and_double_codes(spark):
    table = spark.createDataFrame([(chr(0x4E00 + i), str(i)) for i in range(12_000)], "ch string, bits string")
    df = spark.createDataFrame([(1, chr(0x4E00) + chr(0x4E00 + 11_999))], "id long, text string")
    assert rows(cs.encode(df, "text", table, "id")) == [(1, "011999")]
    empty = spark.createDataFrame([(1, ""), (2, None)], "id long, text string")
    assert sorted(rows(cs.encode(empty, "text", table.limit(0), "id"))) == [(1, ""), (2, None)]
    twice = spark.createDataFrame([("a", "0"), ("a", "1")], "ch string, bits string")
    try:
        cs.encode(spark.createDataFrame([(1, "a")], "id long, text string"), "text", twice, "id").collect()
        raise AssertionError("two codes must raise")
    except Exception as e:  # noqa: BLE001
        assert "two codes" in str(e)


def test_encode_unknown_char_raises(spark):
    table = spark.createDataFrame([("a", "0")], "ch string, bits string")
    df = spark.createDataFrame([(1, "ab")], "id long, text string")
    try:
        cs.encode(df, "text", table, "id").collect()
        raise AssertionError("unknown character must raise")
    except Exception as e:  # noqa: BLE001
        assert "no code" in str(e)


def test_code_table_and_merge(spark):
    f = spark.createDataFrame([("a", 5), ("b", 3), ("c", 1)], "ch string, n long")
    assert dict(rows(cs.code_table(f))) == {"a": "00", "b": "01", "c": "10"}
    t1 = spark.createDataFrame([("a", "0")], "ch string, bits string")
    t2 = spark.createDataFrame([("a", "1"), ("b", "11")], "ch string, bits string")
    assert dict(rows(cs.merge_code_tables(t1, t2))) == {"a": "0", "b": "11"}


def test_balance(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(BALANCED + UNBALANCED)], "id long, text string")
    got = dict(rows(cs.balanced_texts(df, "id")))
    assert [got[i] for i in range(len(BALANCED))] == [True] * len(BALANCED)
    assert [got[len(BALANCED) + i] for i in range(len(UNBALANCED))] == [False] * len(UNBALANCED)
