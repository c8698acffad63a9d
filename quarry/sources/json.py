"""JSON text columns in and out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


_STRICT = {"mode": "FAILFAST"}


def json_map(col: Column | str) -> Column:
    """A7 ``getMap``: a JSON object as map<string,string>; broken JSON raises, null stays null."""
    return F.from_json(col, "map<string,string>", _STRICT)


def json_records(df: DataFrame, json_col: str, user_col: str, count_field: str = "retweets") -> DataFrame:
    """A JSON array of {text, <count_field>} objects → one row per record, its user from ``user_col``.

    The count is read as double and truncated to int, as the reference
    reads ``retweets`` / ``retweet_count`` numbers.  Broken JSON, a record without text or count and a null
    array raise.
    """
    c = F.col(json_col)
    items = F.from_json(c, f"array<struct<text:string,{count_field}:double>>", _STRICT)
    checked = F.when(items.isNull(), F.raise_error(F.concat(F.lit("no JSON array: "), F.coalesce(F.substring(c, 1, 80), F.lit("null"))))).otherwise(items)
    out = df.select(F.col(user_col).alias("user"), F.inline(checked))

    def need(name: str) -> Column:
        return F.when(F.col(name).isNull(), F.raise_error(F.lit(f"record without {name}"))).otherwise(F.col(name))

    return out.select("user", need("text").alias("text"), need(count_field).cast("int").alias("retweets"))


def records_to_json(df: DataFrame, cols: list[str], alias: str = "json") -> DataFrame:
    """One JSON object text per record (proper escaping, unlike the reference's printer)."""
    return df.select(F.to_json(F.struct(*cols)).alias(alias))


def write_json(df: DataFrame, path: str, mode: str = "error") -> None:
    """A11 sink: JSON lines, one object per record, written by the executors."""
    df.write.mode(mode).json(path)


def records_to_lines(df: DataFrame, alias: str = "line") -> DataFrame:
    """A11 in the reference's own text form, one record per line.

    ``{ "user": "u", "text": "t", "retweets": N.0 },`` — only ``"`` in the
    text is escaped and the count is printed with ``.0``.  Written with
    ``write.text`` every line ends in a newline, which gives the reference's
    ``,\\n`` separation without concatenating records on the driver.
    """
    return df.select(F.concat(
        F.lit('{ "user": "'), F.col("user"), F.lit('", "text": "'),
        F.replace(F.col("text"), F.lit('"'), F.lit('\\"')),
        F.lit('", "retweets": '), F.col("retweets").cast("long").cast("string"), F.lit(".0 },")).alias(alias))


def write_lines(df: DataFrame, path: str, mode: str = "error") -> None:
    """Sink for ``records_to_lines``: plain text, one record per line."""
    records_to_lines(df).write.mode(mode).text(path)


def write_store(df: DataFrame, path: str, site: str = "source", replace_sites: bool = False) -> None:
    """Records as JSON lines in a folder for each site, ``path/<site>=<name>``, written by the tasks that hold
    them (no shuffle, so a site with most of the records is many files).

    ``replace_sites`` puts the given sites' records in place of what the store holds of these sites and leaves the
    others' folders alone.  Null sites have a folder of their own; an empty name, which a folder cannot carry, raises.
    """
    c = F.col(site)
    named = df.withColumn(site, F.when(c == "", F.raise_error(F.lit("a site without a name"))).otherwise(c))
    out = named.write.partitionBy(site)
    if replace_sites:
        out = out.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    out.json(path)


def read_store(spark: SparkSession, path: str, schema: StructType, site: str = "source") -> DataFrame:
    """The whole store, its site from the folder names (as text, whatever they look like); broken JSON raises.

    A filter on the site reads only those folders."""
    fields = [f for f in schema.fields if f.name != site] + [StructField(site, StringType())]
    return spark.read.schema(StructType(fields)).options(**_STRICT).json(path)


def stored_site(spark: SparkSession, path: str, schema: StructType, name: str, sites: list[str], site: str = "source") -> DataFrame:
    """A10: the records of one listed site, read from its folder alone; a site that is not listed raises, one without
    records has none."""
    if name not in sites:
        raise KeyError(name)
    return read_store(spark, path, schema, site).filter(F.col(site) == name)
