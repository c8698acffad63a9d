"""Deterministic sampling.

Order within a group is an md5 of ``seed:id`` — reproducible, engine
independent and unbiased.  The top n of a group are found in two stages, per
(group, salt) and then per group, so for every n a group that holds a third
of the table is dealt over many tasks and sends n rows per salt to the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.constants import KERNELS, LANGUAGES
from quarry.functions.text import hash_order

#: Parts a group is dealt over in the first stage.
SALTS = 64


def _first_n(df: DataFrame, by: list[str], n: int, seed: int, id_col: str) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(hash_order(seed, F.col(id_col)), F.col(id_col))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def sample_per_group(df: DataFrame, group: str, n: int, seed: int, id_col: str,
                     strict: bool = True) -> DataFrame:
    """n rows per group; a group with fewer rows raises when strict."""
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(id_col), F.lit(SALTS)))
    picked = _first_n(_first_n(salted, [group, "_salt"], n, seed, id_col).drop("_salt"), [group], n, seed, id_col)
    if not strict:
        return picked
    gn = F.count("*").over(Window.partitionBy(group))
    cols = [F.when(gn < n, F.raise_error(F.lit(f"group has fewer than {n} rows"))).otherwise(F.col(c)).alias(c)
            if c == group else F.col(c) for c in picked.columns]
    return picked.select(*cols)


def sample_global(df: DataFrame, n: int, seed: int, id_col: str) -> DataFrame:
    """n rows of the whole table without replacement (top-k plan, no full sort)."""
    return df.orderBy(hash_order(seed, F.col(id_col)), F.col(id_col)).limit(n)


def initial_means(vectors: DataFrame, kernels: int = KERNELS, n_langs: int = len(LANGUAGES),
                  method: str = "per_group", seed: int = 42, id_col: str = "qid") -> DataFrame:
    """F8: the k starting centres as ``(i, x, y)``; fewer than k raise.

    ``per_group`` samples kernels / n_langs vectors per language (the reference's rule for a language spread of
    500 or more), ``global`` samples the whole table (its rule below).  Kernels must be a multiple of the
    number of languages.  Numbering and the size check run over at most k rows.
    """
    if kernels % n_langs != 0:
        raise ValueError("kernels must be a multiple of the number of languages")
    if method == "global":
        s = sample_global(vectors, kernels, seed, id_col)
    elif method == "per_group":
        s = sample_per_group(vectors, "x", kernels // n_langs, seed, id_col)
    else:
        raise ValueError(f"unknown sampling method {method!r}")
    order = Window.orderBy("x", hash_order(seed, F.col(id_col)), id_col)
    n = F.count("*").over(Window.partitionBy())
    number = F.row_number().over(order) - 1
    return s.select(F.when(n < kernels, F.raise_error(F.lit(f"fewer than {kernels} initial means"))).otherwise(number).cast("int").alias("i"), "x", "y")
