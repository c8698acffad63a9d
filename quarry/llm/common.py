"""Shared helpers: row keys, written intermediate tables, and letting finished shuffles go."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session, or the context's
    checkpoint folder.  Only a local session that names none gets a fresh folder of its own."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; written tables need a shared folder")
    own = tempfile.mkdtemp(prefix="quarry-shared-")
    spark.sparkContext.setCheckpointDir(own)
    return own


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame, written once as Parquet into the shared folder and read back: a cut in the lineage
    that survives a lost executor and is scanned, not recomputed, by each later use."""
    path = f"{shared_dir(df.sparkSession)}/quarry-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of at most so many rows for what the session runs from here on: a text table's default batch
    of 10,000 rows stands several times over in an executor's JVM and Python memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def forget(*tables: DataFrame) -> None:
    """Deletes written tables that nothing will read again, and lets finished shuffles go."""
    spark = tables[0].sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for t in tables:
        path = jvm.org.apache.hadoop.fs.Path(t.written_to)
        path.getFileSystem(conf).delete(path, True)
    let_go(spark)


def let_go(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of frames that are no longer referenced (it learns of
    them from the driver's garbage collection), so that a many-step job holds one step's files at a time."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(key, id, text)``: key is a 64-bit hash of id and text, so it needs no unique ids and is the same
    however often the input is computed; only rows that repeat both share it."""
    return docs.select(texts_key(id_col, text_col).alias("key"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))


def texts_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    return F.xxhash64(F.col(id_col).cast("string"), F.lit("|"), F.col(text_col))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fresh(name: str, columns: list[str]) -> str:
    """The name, with underscores before it until no column has it (names are compared without case, as Spark does)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


#: Characters of a text that decide, with the id, to which range a row goes.
_LEAD = 32


def in_order(rows: DataFrame) -> DataFrame:
    """``(id, text)`` dealt out by ranges in ascending order, null ids first, equal ids by their texts.  The ranges look at
    the texts' beginnings as well, so an id with many rows spans tasks (rows that begin alike stand together)."""
    lead = F.substring("text", 1, _LEAD)
    return rows.repartitionByRange(F.col("id"), lead).sortWithinPartitions("id", "text")
