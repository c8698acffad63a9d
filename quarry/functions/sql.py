"""The row rules of ``functions.text`` as SQL functions, for queries given as SQL text.

Each is one ``CREATE TEMPORARY FUNCTION ... RETURN`` of built-in functions, so Catalyst inlines its body in the plan
of the query that calls it: no Python, and filters on it are planned like any other expression.  Nulls give null.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Name, parameters, result type and body; a body may call the functions before it.
FUNCTIONS = [
    ("space_tokens", "t STRING", "ARRAY<STRING>", "split(rtrim(t), ' ')"),
    ("mentions", "t STRING, keyword STRING", "BOOLEAN", "array_contains(space_tokens(t), keyword)"),
    ("contains_any", "t STRING, keywords ARRAY<STRING>", "BOOLEAN", "exists(keywords, k -> contains(t, k))"),
    ("characters", "t STRING", "ARRAY<STRING>", "if(t = '', CAST(array() AS ARRAY<STRING>), split(t, ''))"),
    ("signature", "t STRING", "STRING", "array_join(array_sort(characters(lower(t))), '')"),
    ("letter_count", "t STRING, letter STRING", "INT", "length(t) - length(replace(t, letter, ''))"),
    ("occurrences", "sig STRING", "STRING",
     "array_join(transform(array_distinct(array_sort(characters(sig))), c -> concat(c, CAST(length(sig) - length(replace(sig, c, '')) AS STRING))), '')"),
    ("subtract_signature", "x STRING, y STRING", "STRING",
     "array_join(transform(array_distinct(array_sort(characters(x))), c -> repeat(c, length(x) - length(replace(x, c, '')) - "
     "if(length(y) - length(replace(y, c, '')) <= length(x) - length(replace(x, c, '')), length(y) - length(replace(y, c, '')), 0))), '')"),
    ("balanced", "t STRING", "BOOLEAN",
     "aggregate(characters(regexp_replace(t, '[^()]', '')), named_struct('d', 0, 'ok', true), "
     "(a, c) -> named_struct('d', a.d + if(c = '(', 1, -1), 'ok', a.ok AND a.d + if(c = '(', 1, -1) >= 0), a -> a.ok AND a.d = 0)"),
    ("squared_distance", "x1 INT, y1 INT, x2 INT, y2 INT", "DOUBLE",
     "(CAST(x1 AS DOUBLE) - x2) * (CAST(x1 AS DOUBLE) - x2) + (CAST(y1 AS DOUBLE) - y2) * (CAST(y1 AS DOUBLE) - y2)"),
]


def register(spark: SparkSession) -> list[str]:
    """Makes the functions known to the session (again, if they are); their names."""
    for name, args, result, body in FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {result} RETURN {body}")
    return [f[0] for f in FUNCTIONS]


def query(spark: SparkSession, text: str, **frames: DataFrame) -> DataFrame:
    """A query as SQL text with the functions; ``{name}`` in it stands for the frame of that name."""
    register(spark)
    return spark.sql(text, **frames)
