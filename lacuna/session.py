"""Spark session and lineage helpers.

The library never creates a session behind the caller's back; ``get_spark`` is a
convenience for tests, benchmarks and scripts.  Lineage is cut with reliable
``checkpoint()`` into the directory the cluster names in ``spark.checkpoint.dir``.
Only a local session with no such setting gets a scratch directory of its own.
"""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


#: Frames with files of their own that were made in the innermost ``scratch``, by this thread.
_MADE: ContextVar[list | None] = ContextVar("made", default=None)


def get_spark(app: str = "lacuna", master: str | None = None,
              shuffle_partitions: int | None = None) -> SparkSession:
    master = master or os.environ.get("LACUNA_MASTER", "local[*]")
    parts = shuffle_partitions or int(os.environ.get("LACUNA_SHUFFLE_PARTITIONS", "8"))
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("LACUNA_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Point the context at ``spark.checkpoint.dir``; invent one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; a cluster run needs a shared checkpoint folder")
    scratch = tempfile.mkdtemp(prefix="lacuna-ckpt-")
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss), never ``localCheckpoint``.

    The frame is cached first so that writing the checkpoint files reads the
    cache instead of recomputing the plan a second time.
    """
    from pyspark import StorageLevel
    ensure_checkpoint_dir(df.sparkSession)
    was_cached = df.storageLevel.useMemory or df.storageLevel.useDisk
    cached = df if was_cached else df.persist(StorageLevel.MEMORY_AND_DISK)
    out = cached.checkpoint(eager=True)
    if not was_cached:
        cached.unpersist(blocking=False)
    _noted(out)
    return out


def stored(df: DataFrame) -> DataFrame:
    """The frame as a Parquet table in the checkpoint folder: less disk than a checkpoint, other partitions."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_path = path
    _noted(out)
    return out


def _noted(df: DataFrame) -> None:
    made = _MADE.get()
    if made is not None:
        made.append(df)


def _drop(df: DataFrame) -> None:
    """Removes the files of a frame that ``cut_lineage`` or ``stored`` made."""
    spark = df.sparkSession
    path = getattr(df, "stored_path", None)
    if path is None:
        file = df._jdf.queryExecution().logical().rdd().getCheckpointFile()
        if file.isEmpty():
            return
        path = file.get()
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[DataFrame]]:
    """At the end the files of the frames that ``cut_lineage`` and ``stored`` made inside go, and shuffle files
    that nothing refers to.

    Nothing that reads them may leave the block; a frame taken out of the list stays.
    """
    made: list[DataFrame] = []
    token = _MADE.set(made)
    try:
        yield made
    finally:
        _MADE.reset(token)
        for df in made:
            _drop(df)
        made.clear()
        gc.collect()  # else shuffle files stay until the driver happens to collect its garbage
        spark.sparkContext._jvm.System.gc()


SPREAD_ROWS = 1_000


def spread(df: DataFrame, rows: int, keys, per_core: int = 4,
           part_rows: int = SPREAD_ROWS) -> DataFrame:
    """``df`` dealt by hash of ``keys``, for work that costs far more than its rows weigh.

    Shuffle partitions are merged by their bytes, which leaves a narrow table to one core.
    Here a part has ``part_rows`` rows, up to ``per_core`` parts a core or one a million rows.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = min(-(-rows // part_rows), max(per_core * cores, rows // 1_000_000))
    return df.repartition(parts, *keys) if parts > 1 else df
