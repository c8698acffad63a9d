"""Line-oriented text sources: articles, postings, wide CSV, word lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.constants import ARTICLE_SEPARATOR, ARTICLE_TAIL, ARTICLE_TITLE_START

POSTING_SCHEMA = T.StructType([
    T.StructField("type", T.IntegerType(), False),
    T.StructField("id", T.LongType(), False),
    T.StructField("accepted", T.LongType(), True),
    T.StructField("parent_id", T.LongType(), True),
    T.StructField("score", T.IntegerType(), False),
    T.StructField("tags", T.StringType(), True),
])


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One string per line, column ``value``."""
    return spark.read.text(path)


def write_lines(lines: DataFrame, path: str, line: str = "value") -> None:
    """Sink for A1/A12: a file a partition, a line a row.  A null line or one with a line break raises, as it would not
    come back as it is."""
    c = F.col(line)
    whole = F.when(c.isNull() | c.rlike("[\\r\\n]"), F.raise_error(F.lit("a line is null or holds a line break"))).otherwise(c)
    lines.select(whole.alias("value")).write.text(path)


def parse_articles(lines: DataFrame, line: str = "value",
                   title_start: int = ARTICLE_TITLE_START,
                   tail: int = ARTICLE_TAIL) -> DataFrame:
    """A2: split an article line into (title, text); a line without the separator raises."""
    sep = F.lit(ARTICLE_SEPARATOR)
    pos = F.locate(ARTICLE_SEPARATOR, F.col(line))            # 1-based, 0 = absent
    checked = F.when(pos > 0, pos).otherwise(
        F.raise_error(F.concat(F.lit("article line without separator: "),
                               F.substring(F.col(line), 1, 80))))
    text_start = checked + F.length(sep)
    return lines.select(
        F.col(line).alias("_line"), checked.alias("_pos"), text_start.alias("_ts"),
    ).select(
        F.expr(f"substring(_line, {title_start + 1}, _pos - {title_start + 1})").alias("title"),
        F.expr(f"substring(_line, _ts, length(_line) - {tail} - _ts + 1)").alias("text"),
    )


def _whole(c: Column, kind: str) -> Column:
    """The number, or null where the text is no plain integer of that size (blanks and overflow are not)."""
    return F.when(c.rlike("^[+-]?[0-9]+$"), c.try_cast(kind))


def _strict_int(c: Column, what: str, kind: str = "long") -> Column:
    """Integer field that raises on empty, malformed, padded or oversized text, whatever the session's ANSI setting."""
    v = _whole(c, kind)
    return F.when(v.isNull(), F.raise_error(F.concat(F.lit(f"bad {what}: "), F.coalesce(c, F.lit("null"))))
                  ).otherwise(v)


def parse_postings(lines: DataFrame, line: str = "value") -> DataFrame:
    """A3: headerless CSV posting lines → POSTING_SCHEMA.

    Plain split on ',' (no quoting); trailing empty fields are dropped as the
    JVM's String.split does, so ``tags`` exists only with six non-trailing
    fields; empty accepted/parent fields become null; bad integers raise.

    Each line is split exactly once: the typed fields are produced by a
    generator (``inline``), which later filters (``type = 1``) cannot be
    pushed through — otherwise Catalyst would inline the split into every
    predicate that mentions a field.
    """
    arr = F.split(F.expr(f"trim(TRAILING ',' FROM `{line}`)"), ",")

    def opt(c: Column) -> Column:
        v = _whole(c, "long")
        bad = F.raise_error(F.concat(F.lit("bad integer field: "), c))
        return F.when(c.isNull() | (c == ""), F.lit(None).cast("long")).when(v.isNull(), bad).otherwise(v)

    a = F.col("_a")
    fields = F.struct(
        _strict_int(F.get(a, 0), "type", "int").alias("type"),
        _strict_int(F.get(a, 1), "id").alias("id"),
        opt(F.get(a, 2)).alias("accepted"),
        opt(F.get(a, 3)).alias("parent_id"),
        _strict_int(F.get(a, 4), "score", "int").alias("score"),
        F.get(a, 5).alias("tags"),
    )
    return lines.select(arr.alias("_a")).select(F.inline(F.array(fields)))


def wide_schema(columns: list[str]) -> T.StructType:
    """A5: first column text, the rest double, none nullable."""
    if not columns:
        raise ValueError("empty header")
    return T.StructType([T.StructField(columns[0], T.StringType(), False)] +
                        [T.StructField(c, T.DoubleType(), False) for c in columns[1:]])


def write_wide_csv(df: DataFrame, path: str) -> None:
    """Sink for A4: CSV files, a partition each and each with the header, no quoting.  The first column is text, the others
    are numbers; a null, and a text with a comma or a line break, raises, as it could not be read back."""
    first, *numbers = df.columns
    if any("," in c or "\n" in c for c in df.columns):
        raise ValueError("a column name holds a comma or a line break")

    def checked(name: str, bad: Column) -> Column:
        c = F.col(f"`{name}`")
        return F.when(bad, F.raise_error(F.lit(f"column {name} cannot be written"))).otherwise(c).alias(name)

    text = F.col(f"`{first}`")
    out = df.select(checked(first, text.isNull() | text.rlike("[,\\r\\n]")), *[checked(c, F.col(f"`{c}`").isNull()) for c in numbers])
    (out.write.option("header", True).option("quote", "\u0000").option("emptyValue", "").option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))


def read_wide_csv(spark: SparkSession, path: str) -> tuple[list[str], DataFrame]:
    """CSV files whose first line is the header; no quoting.

    The header is read with a one-line job; the body is parsed by the CSV
    source with an explicit schema (no inference pass over the data).  A file whose header differs from the
    first one's, a bad number and an empty number raise; an empty text is the empty string.
    """
    header = spark.read.text(path).first()
    if header is None:
        raise ValueError(f"{path}: empty file")
    columns = header[0].split(",")
    df = (spark.read.option("header", True).option("quote", "\u0000").option("enforceSchema", False)
          .option("mode", "FAILFAST").schema(wide_schema(columns)).csv(path))

    def need(name: str) -> Column:
        c = F.col(f"`{name}`")
        return F.when(c.isNull(), F.raise_error(F.lit(f"empty number in column {name}"))).otherwise(c).alias(name)

    first = F.coalesce(F.col(f"`{columns[0]}`"), F.lit("")).alias(columns[0])
    return columns, df.select(first, *[need(c) for c in columns[1:]])
