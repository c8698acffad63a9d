"""Character statistics and dictionary encoding of text columns.

Character counts are an explode + partial hash aggregate: each map task
collapses its rows to one counter per distinct character before the
shuffle.  A code table is bounded by the alphabet; it becomes one array by
code point, and encoding is a projection that reads it (no join, no shuffle).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.text import balanced, characters


def char_freq(texts: DataFrame, text: str = "text") -> DataFrame:
    """(ch, n) over all characters, case-sensitive."""
    return texts.select(F.explode(characters(text)).alias("ch")).groupBy("ch").agg(F.count("*").alias("n"))


def ordered_leaves(freqs: DataFrame) -> DataFrame:
    """characters by ascending weight (character breaks ties), with their position.

    The numbering window runs over one row per distinct character.
    """
    return freqs.select("ch", "n", (F.row_number().over(Window.orderBy("n", "ch")) - 1).cast("long").alias("pos"))


def code_table(freqs: DataFrame) -> DataFrame:
    """A fixed-width code per character: binary rank by descending frequency."""
    w = Window.orderBy(F.desc("n"), "ch")
    ranked = freqs.select("ch", (F.row_number().over(w) - 1).alias("rank"),
                          F.count("*").over(Window.partitionBy()).alias("size"))
    width = F.greatest(F.lit(1), F.length(F.bin(F.col("size") - 1)))
    return ranked.select("ch", F.lpad(F.bin("rank"), width, "0").alias("bits"))


def merge_code_tables(first: DataFrame, second: DataFrame) -> DataFrame:
    """Append two tables; lookups see the first entry per character.

    Code tables hold one entry per character, so the merged lookup is the
    first table plus the second's characters the first lacks (an anti-join).
    """
    extra = second.select("ch", "bits").join(first.select("ch"), "ch", "left_anti")
    return first.select("ch", "bits").unionByName(extra)


def code_array(table: DataFrame) -> DataFrame:
    """The code table as one row: an array of codes by code point (at most Unicode's size), null where the
    alphabet has none.  A character with two codes raises."""
    codes = table.groupBy(F.ascii("ch").alias("cp")).agg(
        F.when(F.count("*") > 1, F.raise_error(F.concat(F.lit("two codes for "), F.min("ch")))).otherwise(F.min("bits")).alias("bits"))
    points = codes.agg(F.max("cp").alias("m")).select(F.explode(F.sequence(F.lit(0), F.coalesce("m", F.lit(0)))).alias("cp"))
    rows = points.join(codes, "cp", "left").agg(F.array_sort(F.collect_list(F.struct("cp", "bits"))).alias("a"))
    return rows.select(F.transform("a", lambda s: s["bits"]).alias("codes"))


def encode(df: DataFrame, text: str, table: DataFrame, key: str, out: str = "bits") -> DataFrame:
    """Each row's text as the concatenated codes of its characters, by one lookup per character.

    A null text stays null, the empty text is empty, rows that share a key stay rows of their own, an unknown
    character raises.  The same plan for a table of any size: the code array is a scalar subquery.
    """
    held = df.select(key, F.col(text).alias("_text"), code_array(table).scalar().alias("_codes"))

    def look(c):
        return F.coalesce(F.get("_codes", F.ascii(c)), F.raise_error(F.concat(F.lit("no code for "), c)))

    return held.select(key, F.array_join(F.transform(characters("_text"), look), "").alias(out))


def balanced_texts(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """B23 per row."""
    return df.select(key, balanced(text).alias("balanced"))
