"""Anagram cases on a dictionary of its own, and a brute-force model."""

import itertools

import pytest
from conftest import rows
from pyspark.sql import functions as F

from quarry.functions.text import occurrences, signature, subtract_signature
from quarry.operators import signatures as sg
from quarry.session import plan_text

DICT = "stone notes onset tones ten net one eon so to On sent Nest café face".split()


@pytest.fixture(scope="module")
def words(spark):
    return spark.createDataFrame([(w,) for w in DICT], "word string")


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first()["v"]


def test_occurrences(spark):
    assert one(spark, occurrences(F.lit("dabc"))) == "a1b1c1d1"
    assert one(spark, occurrences(signature(F.lit("Letter")))) == "e2l1r1t2"
    assert one(spark, signature(F.lit("Letter"))) == "eelrtt"


def test_dictionary_and_word_anagrams(spark, words):
    d = sg.dictionary(words)
    assert sorted(rows(d.filter("sig = 'ent'"), "word")) == [("net",), ("ten",)]
    q = spark.createDataFrame([("onset",), ("ÉFAC",), ("zzz",), ("onset",)], "word string")
    got = sorted(rows(sg.word_anagrams(q, d), "word", "anagram"))
    assert got == [("onset", w) for w in ("notes", "onset", "stone", "tones")] + [("zzz", ""), ("ÉFAC", "café")]


def test_subtract(spark):
    assert one(spark, subtract_signature(signature(F.lit("stone")), F.lit("t"))) == "enos"
    assert one(spark, subtract_signature(F.lit("aab"), F.lit("aaa"))) == "aab"   # y holds more: x kept


def test_combinations(spark):
    df = spark.createDataFrame([("", ""), ("aabb", "aabb")], "sentence string, sig string")
    subs = sorted(rows(sg.combinations(df), "sentence", "sub"))
    assert [s for n, s in subs if n == ""] == [""]
    assert sorted(s for n, s in subs if n == "aabb") == sorted(
        ["", "a", "aa", "b", "ab", "aab", "bb", "abb", "aabb"])


def test_sentence_anagrams(spark, words):
    sents = spark.createDataFrame([("Ten so",), ("",), ("xyz",), ("one one",)], "sentence string")
    out = rows(sg.sentence_anagrams(sents, words))
    for s in ("Ten so", "", "xyz", "one one"):
        assert sorted(a for x, a in out if x == s) == _brute_anagrams(s, DICT)
    assert ("Ten so", "notes") in out and ("", "") in out


def test_a_long_sentence_finishes(spark, words):
    sents = spark.createDataFrame([("stonestonestonesentqwvxj",), ("tonestonenotesonsetstones",)], "sentence string")
    assert len("tonestonenotesonsetstones") == 25
    d = words.where("length(word) = 5")
    out = rows(sg.sentence_anagrams(sents, d))
    assert not [a for s, a in out if s.startswith("stonestone")]
    five = spark.createDataFrame([("stone",), ("s",)], "word string")
    got = rows(sg.sentence_anagrams(sents.where("sentence like 'tones%'"), five))
    assert got == [] or all(sorted(a.replace(" ", "")) == sorted("tonestonenotesonsetstones") for _, a in got)


def _brute_anagrams(sentence, dictionary):
    """Plain-Python model: every word sequence using exactly the sentence's letters."""
    def sig(w):
        return "".join(sorted(w.lower()))

    def remove(rest, w):
        rest = list(rest)
        for c in sig(w):
            if c not in rest:
                return None
            rest.remove(c)
        return "".join(rest)

    out = []

    def go(rest, path):
        if not rest:
            out.append(" ".join(path))
            return
        for w in dictionary:
            r = remove(rest, w)
            if r is not None:
                go(r, path + [w])

    go(sig("".join(sentence.split(" "))) if sentence else "", [])
    return sorted(out)


def test_sentence_anagrams_match_brute_force(spark):
    import random
    rnd = random.Random(3)
    letters = "aeinrst"
    dictionary = sorted({"".join(rnd.choice(letters) for _ in range(rnd.randint(1, 3))) for _ in range(14)})
    sentences = ["".join(rnd.choice(letters) for _ in range(rnd.randint(1, 4))) + " " +
                 "".join(rnd.choice(letters) for _ in range(rnd.randint(1, 3))) for _ in range(4)]
    words = spark.createDataFrame([(w,) for w in dictionary], "word string")
    sents = spark.createDataFrame([(s,) for s in sentences], "sentence string")
    got = rows(sg.sentence_anagrams(sents, words))
    for s in sentences:
        assert sorted(a for x, a in got if x == s) == _brute_anagrams(s, dictionary)


def test_a_large_class_is_one_row_per_word(spark):
    perms = sorted({"".join(p) for p in itertools.permutations("abcdef")})       # 720 words, one class
    words = spark.createDataFrame([(w,) for w in perms], "word string")
    assert sorted(rows(sg.dictionary(words))) == [("abcdef", w) for w in perms]


def test_states_are_unique_and_held_frames_are_released(spark, words):
    sents = sg.sentence_signature(spark.createDataFrame([("one one",), ("eon one",), ("so to",)], "sentence string"))
    levels = sg.anagram_graph(sents, sg.word_signatures(words))
    for level in levels:
        assert level.count() == level.select("rem", "sig").distinct().count()
    for level in levels:
        level.unpersist()


def test_sub_multisets_of_a_long_signature(spark):
    df = spark.createDataFrame([("aabbbcdddd",)], "sig string")
    subs = [r[0] for r in rows(sg.combinations(df), "sub")]
    assert len(subs) == len(set(subs)) == 3 * 4 * 2 * 5
    assert spark.range(1).select(F.lit("abcdefghijklmnopqrst").alias("sig")).transform(sg.combinations).count() == 2 ** 20


def test_subtract_against_counts(spark):
    """Random multisets with letters of one to four bytes; x need not be sorted, a null y takes nothing."""
    import random
    from collections import Counter
    rng = random.Random(2)
    pairs = [("".join(rng.choices("aab'éß😀中", k=rng.randint(0, 12))), "".join(rng.choices("ab'é😀中z", k=rng.randint(0, 5)))) for _ in range(300)]
    pairs += [("ba", None), (None, "a"), ("", "a"), ("aaaa", "aa")]

    def model(x, y):
        if x is None:
            return None
        nx, ny = Counter(x), Counter(y or "")
        return "".join(c * (nx[c] - ny[c] if ny[c] <= nx[c] else nx[c]) for c in sorted(nx))

    df = spark.createDataFrame(pairs, "x string, y string")
    for in_order in (False, True):
        given = df.withColumn("x", F.array_join(F.array_sort(F.split("x", "")), "")) if in_order else df
        got = sg.subtract(given, "x", "y", in_order=in_order).collect()
        assert len(got) == len(pairs) and all(r["rest"] == model(r["x"], r["y"]) for r in got)
        assert [r["rest"] for r in sg.subtract(given, "x", "y", in_order=in_order).where("y is null").collect()] == ["ab"]


def test_no_interpreted_sort_and_no_walk_over_all_letters(spark):
    """Signatures are sorted natively; subtraction walks the letters of y, not those of x."""
    df = spark.createDataFrame([("stone", "to")], "s string, t string").select(signature("s").alias("x"), signature("t").alias("y"))
    assert "array_sort" not in plan_text(df, "simple")
    given = spark.createDataFrame([("enost", "ot")], "x string, y string")
    p = plan_text(sg.subtract(given, "x", "y"), "simple")
    assert "array_sort" not in p and "array_distinct" in p and "array_distinct(sort" not in p
