"""Text expressions: tokens, keyword tests, letter signatures, multisets, balance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def space_tokens(text: Column | str) -> Column:
    """H1: split on a single space; trailing empty tokens dropped (JVM split rule).

    ``rtrim`` strips trailing ' ' only — the same effect as dropping trailing
    empty tokens, without a regex pass over the whole text.
    """
    return F.split(F.rtrim(_c(text)), " ")


def mentions(text: Column | str, keyword: str) -> Column:
    """B1: whole-token, case-sensitive keyword test (``Java,`` is not ``Java``)."""
    return F.array_contains(space_tokens(text), F.lit(keyword))


def characters(text: Column | str) -> Column:
    """H7: the characters of a text; the empty text has none."""
    t = _c(text)
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, ""))


def sorted_characters(text: Column | str) -> Column:
    """The characters of a text in order.  (``sort_array`` compares natively, ``array_sort`` by an interpreted function.)"""
    return F.sort_array(characters(text))


def signature(word: Column | str) -> Column:
    """Lower-cased letters in sorted order — the canonical letter multiset."""
    return F.array_join(sorted_characters(F.lower(_c(word))), "")


def letter_count(s: Column, ch: Column) -> Column:
    """Occurrences of one character in a string."""
    return F.length(s) - F.length(F.replace(s, ch, F.lit("")))


def occurrences(sig: Column | str) -> Column:
    """D20 as (letter, count) pairs rendered ``a1b2`` in letter order."""
    s = _c(sig)
    distinct = F.array_distinct(sorted_characters(s))
    return F.array_join(F.transform(distinct, lambda c: F.concat(c, letter_count(s, c).cast("string"))), "")


def subtract_signature(x: Column | str, y: Column | str, in_order: bool = False) -> Column:
    """Multiset x − y on signatures.

    Per letter of x: keep ``nx − ny`` when ``ny ≤ nx``; when y holds more of a
    letter than x, x's entry stays as it is (reference rule).  Letters of y
    absent from x are ignored.  The result is sorted; x need not be, unless the
    caller says it is ``in_order``.  A null y takes nothing.

    Equal letters of the sorted x stand together, so each distinct letter of y
    takes one stretch out of it, if x has one that long.
    """
    ys = F.coalesce(_c(y), F.lit(""))
    runs = F.transform(F.array_distinct(characters(ys)), lambda c: F.repeat(c, letter_count(ys, c)))

    def take(rest: Column, run: Column) -> Column:
        at = F.instr(rest, run)
        return F.when(at > 0, F.overlay(rest, F.lit(""), at, F.length(run))).otherwise(rest)

    return F.aggregate(runs, _c(x) if in_order else F.array_join(sorted_characters(x), ""), take)


def letter_counts(sig: Column | str) -> Column:
    """The distinct letters of a signature with their counts, as an array of (c, n)."""
    s = _c(sig)
    return F.transform(F.array_distinct(sorted_characters(s)), lambda c: F.struct(c.alias("c"), letter_count(s, c).cast("long").alias("n")))


def sub_multiset_count(counts: Column | str) -> Column:
    """How many sub-multisets an array of (c, n) has: the product of n + 1 (beyond 64 bits it is an error)."""
    return F.aggregate(_c(counts), F.lit(1).cast("long"), lambda acc, x: acc * (x["n"] + 1))


def sub_multiset(counts: Column | str, number: Column | str) -> Column:
    """The sub-multiset of that number (from 0): its digits, in base n + 1 letter by letter, are the counts."""
    start = F.struct(_c(number).cast("long").alias("rest"), F.lit("").alias("out"))

    def digit(acc: Column, x: Column) -> Column:
        base = x["n"] + 1
        d = acc["rest"] % base
        return F.struct(F.call_function("div", acc["rest"], base).alias("rest"), F.concat(acc["out"], F.repeat(x["c"], d.cast("int"))).alias("out"))

    return F.aggregate(_c(counts), start, digit, lambda acc: acc["out"])


def balanced(text: Column | str) -> Column:
    """Parentheses never close below depth 0 and end at depth 0.

    Non-parenthesis characters are stripped first (a cheap regex on the JVM),
    so the fold only walks the parentheses.
    """
    parens = F.regexp_replace(_c(text), r"[^()]", "")
    start = F.struct(F.lit(0).alias("d"), F.lit(True).alias("ok"))

    def step(acc: Column, c: Column) -> Column:
        d = acc["d"] + F.when(c == "(", 1).otherwise(-1)
        return F.struct(d.alias("d"), (acc["ok"] & (d >= 0)).alias("ok"))

    res = F.aggregate(characters(parens), start, step)
    return res["ok"] & (res["d"] == 0)


def contains_any(text: Column | str, keywords: list[str]) -> Column:
    """Substring match on any keyword, case-sensitive."""
    t = _c(text)
    out = F.lit(False)
    for kw in keywords:
        out = out | t.contains(kw)
    return out


def hash_order(seed: int | str, key: Column | str) -> Column:
    """Deterministic pseudo-random order key: md5 of ``seed:key`` (same value in DuckDB)."""
    return F.md5(F.concat(F.lit(f"{seed}:"), _c(key).cast("string")))
