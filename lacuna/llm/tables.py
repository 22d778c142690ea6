"""Tables between steps: written ones, and small ones of a fixed size."""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .text import give_back

BITMAP_BITS = 25
_CHUNK = 1 << 13  # numbers in a row of a table that is summed
_FANIN = 64       # tables that one task adds up at the first step


def written(df: DataFrame) -> DataFrame:
    """The frame as a Parquet table in the checkpoint folder, computed once."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_path = path
    return out


def remove(table: DataFrame) -> None:
    """Removes the files of a ``written`` table that nothing reads any more."""
    spark = table.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(table.written_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of steps whose results are written.

    Its cleaner acts on what the driver's collectors find unreachable; without a call
    they may not run before a long query ends.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def small(df: DataFrame, rows: int) -> DataFrame:
    """Marks a materialised frame for broadcast if it has at most ``rows`` rows."""
    return F.broadcast(df) if df.count() <= rows else df


def summed(df: DataFrame, count: Callable[[Iterator[pa.RecordBatch]], np.ndarray],
           size: int) -> np.ndarray:
    """Sum over all tasks of the integer tables (``size`` numbers) that ``count`` returns.

    Tables are added as they stream past, in two steps, by as many tasks as they
    have chunks; the driver gets one table.  A chunk travels in the smallest width that
    holds its numbers, and not at all if they are 0.
    """
    schema = "part int, chunk int, sums binary"

    def wide(data: bytes, chunk: int) -> np.ndarray:
        n = min(_CHUNK, size - chunk * _CHUNK)
        return np.frombuffer(data, f"<i{len(data) // n}").astype(np.int64)

    def narrow(v: np.ndarray) -> bytes:
        most = int(np.abs(v).max())
        return v.astype(next(f"<i{b}" for b in (1, 2, 4, 8) if most < 1 << (8 * b - 1))).tobytes()

    def rows(part: int, chunks) -> pa.RecordBatch:
        chunks = [(k, v) for k, v in chunks if v.any()]
        return pa.RecordBatch.from_arrays(
            [pa.array([part] * len(chunks), pa.int32()), pa.array([k for k, _ in chunks], pa.int32()),
             pa.array([narrow(v) for _, v in chunks], pa.binary())],
            names=["part", "chunk", "sums"])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = count(batches)
        yield rows(TaskContext.get().partitionId() % _FANIN,
                   [(k, table[lo:lo + _CHUNK]) for k, lo in enumerate(range(0, size, _CHUNK))])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for p, k, data in zip(*(batch.column(i).to_pylist() for i in range(3))):
                sums = wide(data, k)
                total[p, k] = total[p, k] + sums if (p, k) in total else sums
        for p in sorted({p for p, _ in total}):
            yield rows(p, [(k, v) for (q, k), v in sorted(total.items()) if q == p])

    some = df.mapInArrow(first, schema).repartition("part", "chunk").mapInArrow(add, schema)
    whole = some.withColumn("part", F.lit(0)).repartition("chunk").mapInArrow(add, schema)
    out = np.zeros(size, np.int64)
    for r in whole.collect():
        out[r["chunk"] * _CHUNK:][:_CHUNK] = wide(r["sums"], r["chunk"])
    return out


def bitmap(hashes: DataFrame, bits: int = BITMAP_BITS) -> np.ndarray:
    """One bit for each value of the low ``bits`` bits of column ``g``."""
    at = F.col("g").bitwiseAND(F.lit((1 << bits) - 1))
    words = (hashes.select(F.shiftright(at, 6).alias("w"),
                           at.bitwiseAND(F.lit(63)).cast("int").alias("b"))
             .groupBy("w").agg(F.expr("bit_or(shiftleft(1L, b))").alias("m")).toArrow())
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[words.column("w").to_numpy()] = words.column("m").to_numpy().view(np.uint64)
    return out


def in_bitmap(bits: np.ndarray, g: np.ndarray) -> np.ndarray:
    """Whether the bits of unsigned hashes are set."""
    at = g & np.uint64(len(bits) * 64 - 1)
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)) > 0


def list_slices(batches: Iterator[pa.RecordBatch], column: str,
                most: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about ``most`` entries of a list column."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.asarray(batch.column(column).value_lengths().fill_null(0), np.int64)
        piece = np.cumsum(size) // most
        cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)
    give_back()


def listed(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column of longs, unsigned, and where each list begins."""
    size = np.asarray(col.value_lengths().fill_null(0), np.int64)
    values = col.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    return values.view(np.uint64), np.concatenate([[0], np.cumsum(size)])


def lists(values: np.ndarray, first: np.ndarray) -> pa.Array:
    """A list column of longs from flat unsigned or signed values."""
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)),
                                    pa.array(values.view(np.int64)))
