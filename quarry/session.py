"""Session helpers: a sane local session for tests/bench and checkpoint-dir handling."""

from __future__ import annotations

import contextlib
import io
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app_name: str = "quarry") -> SparkSession:
    """A local session tuned like a small cluster: AQE on, UI off, UTC."""
    parts = shuffle_partitions or (8 if cores == "*" else max(2, int(cores) * 2))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The checkpoint folder the session names (``spark.checkpoint.dir`` or the context's own), if any.

    The library never makes one: on a cluster a machine-local folder would not survive a lost executor.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named:
            sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A path of its own, not made yet, in the folder the session names for checkpoints, which all executors see.  Only a
    local session that names none gets one in the temporary folder."""
    base = checkpoint_dir(spark)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; files need a shared folder")
        base = tempfile.gettempdir()
    return f"{base.rstrip('/')}/quarry-{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """The frame, computed once: a reliable checkpoint where the session names a folder, else persisted
    (recomputable from its lineage).  Release it with ``release`` when nothing reads it any more."""
    held = df.persist()
    if checkpoint_dir(df.sparkSession) is None:
        held.count()
        return held
    out = held.checkpoint(eager=True)
    held.unpersist()
    return out


def release(*frames: DataFrame) -> None:
    for f in frames:
        f.unpersist()


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """A round-robin repartition to the count the caller names; none (the default) leaves the frame as it is.

    For a file whose one large row group scans as one task before CPU-heavy row work.
    """
    return df if partitions is None else df.repartition(partitions)


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The text ``df.explain(mode)`` prints, for plan checks in tests and audits."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()
