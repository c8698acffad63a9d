"""Letter signatures, anagram dictionary and sentence anagrams.

A word's letter multiset is carried as its *signature*: lower-cased letters
in sorted order (``married`` → ``adeimrr``).  Dictionary lookups become
equi-joins on the signature.  Sentence anagrams run on a graph whose nodes are
remaining signatures: the dictionary signatures inside a remainder are found by
growing prefixes a few letters at a time (each step an equi-join with the
dictionary's prefixes, so only prefixes that some word has stay alive), every
remainder is expanded once whatever the sentences it stands in, dead ends are
dropped, and word orders are written out only at the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import letter_count, letter_counts, signature, sub_multiset, sub_multiset_count, subtract_signature
from quarry.session import cut_lineage, release

#: Letters by which prefixes of signatures grow.
GROW = 4


def word_signatures(words: DataFrame, word: str = "word") -> DataFrame:
    """Distinct words with their signature."""
    return words.select(F.col(word).alias("word")).distinct().select("word", signature("word").alias("sig"))


def sentence_signature(sentences: DataFrame, col: str = "sentence") -> DataFrame:
    """Signature of the words of a sentence taken together (empty sentence → '')."""
    joined = F.array_join(F.split(F.col(col), " "), "")
    return sentences.select(col, signature(joined).alias("sig"))


def dictionary(words: DataFrame, word: str = "word") -> DataFrame:
    """Words by signature in long form, ``(sig, word)``: a class of any size is as many rows."""
    return word_signatures(words, word).select("sig", "word")


def word_anagrams(query_words: DataFrame, dict_df: DataFrame, word: str = "word") -> DataFrame:
    """For each distinct query word a row per dictionary word with the same letters ('' if there is none)."""
    q = word_signatures(query_words, word)
    return q.join(dict_df.select("sig", F.col("word").alias("anagram")), "sig", "left").select("word", "sig", F.coalesce("anagram", F.lit("")).alias("anagram"))


def subtract(df: DataFrame, x: str, y: str, out: str = "rest", in_order: bool = False) -> DataFrame:
    """H12 as a column on a frame of signatures (``in_order``: x is known to be sorted)."""
    return df.withColumn(out, subtract_signature(x, y, in_order))


def combinations(df: DataFrame, sig: str = "sig", out: str = "sub") -> DataFrame:
    """One row per distinct sub-multiset of each signature, the empty one included.

    Sub-multisets are numbered; the number is dealt out in two steps, high and low part, so no array is longer
    than about the square root of their count, and each is decoded from its number."""
    side = F.ceil(F.sqrt(F.col("_t").cast("double"))).cast("long")
    high = (df.withColumn("_l", letter_counts(sig)).withColumn("_t", sub_multiset_count("_l")).withColumn("_s", side)
            .withColumn("_h", F.explode(F.sequence(F.lit(0).cast("long"), F.call_function("div", F.col("_t") - 1, F.col("_s"))))))
    low = high.withColumn("_n", F.explode(F.sequence(F.col("_h") * F.col("_s"), F.least((F.col("_h") + 1) * F.col("_s"), F.col("_t")) - 1)))
    return low.withColumn(out, sub_multiset("_l", "_n")).drop("_l", "_t", "_s", "_h", "_n")


def _inside(inner: str, outer: str):
    """Whether the signature ``inner`` is a sub-multiset of ``outer``."""
    return F.forall(F.array_distinct(F.split(F.col(inner), "")), lambda c: (c == "") | (letter_count(F.col(inner), c) <= letter_count(F.col(outer), c)))


def _steps(rems: DataFrame, prefixes: list[DataFrame]) -> DataFrame:
    """``(rem, sig, next)``: every dictionary signature inside each remainder, and what is left."""
    live = rems.select("rem", F.explode(F.array_distinct(F.split("rem", ""))).alias("p")).where("p != ''")
    found = []
    for grown in prefixes:                                     # prefixes of 1, 1 + GROW, 1 + 2 GROW, ... letters
        live = live.join(grown, "p").where(_inside("q", "rem")).select("rem", F.col("q").alias("p"), "whole")
        found.append(live.where("whole").select("rem", F.col("p").alias("sig")))
        live = live.select("rem", "p")
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out.select("rem", "sig", subtract_signature("rem", "sig", in_order=True).alias("next"))


def prefix_tables(sigs: DataFrame, longest: int, grow: int = GROW) -> list[DataFrame]:
    """For prefixes of 1, 1 + ``grow``, ... letters up to the longest signature: ``(p, q, whole)``, the prefixes q of
    that many letters (or a whole shorter signature), the prefix p one step before (for the first, the letter
    itself), and whether q is a signature."""
    out, before = [], 0
    for n in range(1, longest + grow, grow):
        own = sigs.where(F.length("sig") > before)
        out.append(own.groupBy(F.expr(f"substring(sig, 1, {max(before, 1)})").alias("p"), F.expr(f"substring(sig, 1, {n})").alias("q"))
                   .agg(F.max(F.length("sig") <= n).alias("whole")))
        before = n
    return out


def anagram_graph(sentences: DataFrame, words: DataFrame) -> list[DataFrame]:
    """Transitions ``(rem, sig, next)`` by number of words used before, each level's remainders once; frames are held."""
    sigs = words.select("sig").distinct()
    longest = sigs.agg(F.max(F.length("sig"))).first()[0] or 0
    if not longest:
        return []
    prefixes = [cut_lineage(p) for p in prefix_tables(sigs, longest)]
    levels: list[DataFrame] = []
    rems = sentences.select(F.col("sig").alias("rem")).where("rem != ''").distinct()
    while True:
        level = cut_lineage(_steps(rems, prefixes))
        if level.isEmpty():
            release(level)
            break
        levels.append(level)
        rems = level.select(F.col("next").alias("rem")).where("rem != ''").distinct()
    release(*prefixes)
    return levels


def sentence_anagrams(sentences: DataFrame, dict_words: DataFrame, col: str = "sentence",
                      word: str = "word") -> DataFrame:
    """Every word sequence from the dictionary using exactly the sentence's letters.

    Order matters; the empty sentence has one answer, the empty sequence.
    Returns ``(sentence, anagram)`` with the words joined by a space.
    """
    d = cut_lineage(word_signatures(dict_words, word).filter(F.col("sig") != ""))
    given = cut_lineage(sentence_signature(sentences.select(F.col(col).alias("sentence")).distinct(), "sentence"))
    levels = anagram_graph(given, d)
    # Backwards: a transition stays if what it leaves is empty or can be used up by the levels after it.
    useful: list[DataFrame] = []
    for level in reversed(levels):
        done = level.where("next = ''")
        if useful:
            done = done.unionByName(level.join(useful[-1].select(F.col("rem").alias("next")).distinct(), "next", "left_semi").select("rem", "sig", "next"))
        useful.append(cut_lineage(done))
    out = given.where("sig = ''").select("sentence", F.lit("").alias("anagram"))
    paths = given.where("sig != ''").select("sentence", F.col("sig").alias("rem"), F.array().cast("array<string>").alias("path"))
    for level in reversed(useful):
        step = paths.join(level.join(d, "sig"), "rem").select("sentence", F.col("next").alias("rem"), F.concat("path", F.array("word")).alias("path"))
        out = out.unionByName(step.where("rem = ''").select("sentence", F.array_join("path", " ").alias("anagram")))
        paths = step.where("rem != ''")
    result = cut_lineage(out)                                  # the caller's to release
    release(d, given, *levels, *useful)
    return result
