"""Rows of several fits as packed blocks, and passes that sum arrays over them.

Model selection fits many models on overlapping rows: folds, parameter settings,
repaired tables.  Here each *data set* (the rows of one fit, with its own
preprocessing) is packed into blocks: a row of the frame is (data set, matrix of
features, label indexes, training marks, row hashes) of up to ``BLOCK_ROWS`` rows.  One
pass over the blocks serves all fits at once, so an iteration of every fit is one job.

``Blocks.sums`` adds up arrays by key.  Tasks add up their own blocks; the sums of
many tasks are added by key in a second step, so the driver gets one array per key.
Their sizes follow from features, classes, bins and open nodes, not from rows.

Blocks are checkpointed (``spark.checkpoint.dir``): a lost executor's tasks run again
from files.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

BLOCK_ROWS = 8192
FAN_IN = 32  # tasks whose sums the driver adds itself
SCHEMA = "d int, n int, x binary, y binary, used binary, rid binary, state binary"


@dataclass
class Block:
    """One row of the frame, as arrays (``state``: whatever a fit keeps per row)."""

    d: int
    x: np.ndarray
    y: np.ndarray
    used: np.ndarray
    rid: np.ndarray
    state: np.ndarray

    def __len__(self) -> int:
        return len(self.y)


@dataclass
class DataSet:
    """What the driver knows of one data set."""

    labels: list
    width: int
    rows: int = 0          # that train
    info: dict = field(default_factory=dict)


def _blocks(batches: Iterator[pa.RecordBatch], dtype) -> Iterator[Block]:
    for b in batches:
        for d, n, *parts in zip(*(c.to_pylist() for c in b.columns)):
            x, y, used, rid, state = parts
            yield Block(d, np.frombuffer(x, dtype).reshape(n, -1) if n else np.zeros((0, 1), dtype),
                        np.frombuffer(y, np.int32), np.frombuffer(used, np.uint8).astype(bool),
                        np.frombuffer(rid, np.uint64), np.frombuffer(state, np.float64).reshape(n, -1)
                        if len(state) else np.zeros((n, 0)))


def _row(b: Block) -> dict:
    return {"d": b.d, "n": len(b), "x": np.ascontiguousarray(b.x).tobytes(), "y": b.y.tobytes(),
            "used": b.used.astype(np.uint8).tobytes(), "rid": b.rid.tobytes(),
            "state": np.ascontiguousarray(b.state, np.float64).tobytes()}


_ARROW = pa.schema([("d", pa.int32()), ("n", pa.int32())] + [
    (c, pa.binary()) for c in ("x", "y", "used", "rid", "state")])


class Blocks:
    """A frame of blocks and its data sets; ``dtype`` is that of the matrices."""

    def __init__(self, frame: DataFrame, sets: list[DataSet], dtype=np.float64):
        self.frame, self.sets, self.dtype = frame, sets, dtype
        self.tasks = frame.rdd.getNumPartitions()

    def map(self, change: Callable[[Block], Block], dtype=None) -> Blocks:
        """Blocks changed one by one, checkpointed."""
        was = self.dtype

        def run(batches):
            for b in _blocks(batches, was):
                yield pa.RecordBatch.from_pylist([_row(change(b))], schema=_ARROW)

        return Blocks(cut_lineage(self.frame.mapInArrow(run, SCHEMA)), self.sets, dtype or was)

    def dealt(self) -> Blocks:
        """The same blocks over all cores: shuffles merged by bytes leave narrow rows to a few tasks."""
        cores = self.frame.sparkSession.sparkContext.defaultParallelism
        some, rows = self.frame.agg(F.count(F.lit(1)), F.sum("n")).first()
        if self.tasks >= min(cores, some) or rows <= BLOCK_ROWS * len(self.sets):
            return self
        return Blocks(cut_lineage(self.frame.repartition(min(some, 4 * cores))), self.sets, self.dtype)

    def rows(self, emit: Callable[[Block], Iterator[tuple]], schema: str) -> DataFrame:
        """A frame of the rows that ``emit`` makes of each block."""
        dtype = self.dtype
        from pyspark.sql.pandas.types import to_arrow_schema
        from pyspark.sql.types import _parse_datatype_string
        wanted = to_arrow_schema(_parse_datatype_string(schema))

        def run(batches):
            for b in _blocks(batches, dtype):
                found = list(emit(b))
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*found), wanted)], schema=wanted)

        return self.frame.mapInArrow(run, schema)

    def sums(self, measure: Callable[[Block], Iterator[tuple[int, np.ndarray]]]) -> dict[int, np.ndarray]:
        """Sum per key of the float arrays that ``measure`` yields for each block."""
        dtype = self.dtype

        def each(batches):
            for b in _blocks(batches, dtype):
                yield from measure(b)

        return sum_arrays(self.frame, each, self.tasks)


def sum_arrays(frame: DataFrame, measure: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[int, np.ndarray]]],
               tasks: int | None = None) -> dict[int, np.ndarray]:
    """Sum per key of the float arrays that ``measure`` yields for the batches of all tasks."""
    schema = "k long, v binary"
    arrow = pa.schema([("k", pa.int64()), ("v", pa.binary())])

    def put(total, k, v):
        if k in total:
            total[k] += v
        else:
            total[k] = np.array(v, np.float64)

    def out(total):
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(
            [v.tobytes() for v in total.values()], pa.binary())], schema=arrow)

    def first(batches):
        total: dict[int, np.ndarray] = {}
        for k, v in measure(batches):
            put(total, k, v)
        yield from out(total)

    def again(batches):
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for k, v in zip(b.column(0).to_pylist(), b.column(1)):
                put(total, k, np.frombuffer(v.as_buffer(), np.float64))
        yield from out(total)

    found = frame.mapInArrow(first, schema)
    if (frame.rdd.getNumPartitions() if tasks is None else tasks) > FAN_IN:
        found = found.repartition("k").mapInArrow(again, schema)
    got = found.toArrow()
    total: dict[int, np.ndarray] = {}
    for k, v in zip(got.column(0).to_pylist(), got.column(1)):
        put(total, k, np.frombuffer(v.as_buffer(), np.float64))
    return total


def pack(frames: list[tuple[DataFrame, DataSet]], label: str, key_cols, used: str | None = None,
         features: str = "features") -> Blocks:
    """Blocks of preprocessed frames (a vector, a label index), one data set each.

    ``used`` names a boolean column of the rows that train; the others are kept for
    scoring.  Rows hash by their key, so that a row draws the same lots wherever it lies.
    """
    parts = []
    for d, (df, _) in enumerate(frames):
        parts.append(df.select(
            F.lit(d).alias("d"), vector_to_array(features).alias("x"), F.col(label).cast("int").alias("y"),
            (F.col(used) if used else F.lit(True)).alias("u"), F.xxhash64(*key_cols).alias("r")))

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK_ROWS):
                b = batch.slice(lo, BLOCK_ROWS)
                ids = b.column(0).to_numpy()
                x = b.column(1).flatten().to_numpy().reshape(len(ids), -1)
                yield pa.RecordBatch.from_pylist([_row(Block(
                    int(ids[0]), x, b.column(2).to_numpy().astype(np.int32),
                    b.column(3).to_numpy(zero_copy_only=False), b.column(4).to_numpy().view(np.uint64),
                    np.zeros((len(ids), 0))))], schema=_ARROW)

    frame = None
    for p in parts:
        packed = p.mapInArrow(run, SCHEMA)
        frame = packed if frame is None else frame.unionByName(packed)
    cores = frame.sparkSession.sparkContext.defaultParallelism
    frame = cut_lineage(frame)
    some = frame.agg(F.count(F.lit(1)).alias("b")).first()["b"]
    few = max(cores, -(-some // 64))
    if frame.rdd.getNumPartitions() > few:  # many small blocks: fewer tasks a pass
        frame = cut_lineage(frame.coalesce(few))
    out = Blocks(frame, [s for _, s in frames])
    counts = out.sums(lambda b: [(b.d, np.bincount(b.y[b.used], minlength=1).sum(keepdims=True).astype(float))])
    for d, s in enumerate(out.sets):
        s.rows = int(counts.get(d, np.zeros(1))[0])
    return out
