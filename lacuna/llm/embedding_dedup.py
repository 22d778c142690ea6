"""Near duplicates among embeddings: hyperplane signs, exact cosines, components.

Equal vectors of a label are one representative with a multiplicity.  Each
representative has ``TABLES`` signatures of ``BITS`` hyperplane signs; those that
agree in one are compared by their cosine in double precision.  At a cosine of
0.98 a sign agrees with probability 0.936, a signature with 0.35, so that a pair is
missed with probability 0.65^32 = 1e-6 at the threshold and less above it.

A bucket of many vectors is dealt into blocks, and every two blocks meet in a task
of their own: all pairs are compared, none is emitted.  A pair counts in the
first table in which it agrees.  Tasks return, per vector, its links found and
one edge to the smallest vector it is connected with there.

Vectors that are null, empty or zero, or hold a null, NaN or infinite component,
and those without a label, link with nothing.  Vectors of different length do not
link.  Repeated rows are vectors of their own (ids are keys: rows of one id are one
node).  An empty table gives no rows.  Other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from .components import components, ids_of_several

THRESHOLD = 0.98
TABLES = 32
BITS = 16
SEED = 5
#: Vectors of a bucket in a block.
BLOCK = 1024
#: Buckets up to this size are compared many at a time.
FEW = 32
_PAIRS = 1 << 16

_cache: dict[int, np.ndarray] = {}


def planes(dims: int) -> np.ndarray:
    if dims not in _cache:
        _cache.clear()
        _cache[dims] = np.random.default_rng(SEED).standard_normal((dims, TABLES * BITS))
    return _cache[dims]


def usable(column: str):
    """Whether a vector can link at all."""
    finite = F.forall(column, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(column, lambda x: x != 0), F.lit(False))


def _matrix(col: pa.Array) -> np.ndarray:
    """Rows of a list column of one length, as unit vectors in double precision."""
    x = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(col), -1)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        dims = batch.column("dims").to_numpy()
        for d in np.unique(dims):
            b = batch.filter(pa.array(dims == d))
            for lo in range(0, b.num_rows, 2048):
                part = b.slice(lo, 2048)
                signs = (_matrix(part.column("vector")) @ planes(int(d)) > 0)
                sig = signs.reshape(-1, TABLES, BITS) @ (1 << np.arange(BITS))
                at = np.arange(0, sig.size + 1, TABLES, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.ListArray.from_arrays(pa.array(at),
                                                             pa.array(sig.astype(np.int32).ravel()))],
                    names=[*part.schema.names, "sig"])


def _verified(x, sig, i, j, table, threshold):
    """The pairs (rows i, j) that link and agree in no earlier table."""
    keep = []
    for lo in range(0, len(i), _PAIRS):
        a, b = i[lo:lo + _PAIRS], j[lo:lo + _PAIRS]
        hit = np.einsum("ij,ij->i", x[a], x[b]) >= threshold
        a, b = a[hit], b[hit]
        first = (sig[a] == sig[b]).argmax(1) == table[a]
        keep.append((a[first], b[first]))
    if not keep:
        return i[:0], j[:0]
    return np.concatenate([k[0] for k in keep]), np.concatenate([k[1] for k in keep])


def _compare(rows: pa.Table, threshold: float) -> pa.RecordBatch | None:
    """Links inside the buckets of ``rows``; whole buckets, sorted by bucket."""
    group = rows.column("g").to_numpy()
    node, many = rows.column("node").to_numpy(), rows.column("n").to_numpy()
    own, lo, hi = (rows.column(c).to_numpy() for c in ("own", "lo", "hi"))
    table = rows.column("t").to_numpy()
    sig = rows.column("sig").combine_chunks().flatten().to_numpy().reshape(-1, TABLES)
    x = _matrix(rows.column("vector").combine_chunks())
    cut = np.flatnonzero(np.diff(group)) + 1
    bounds = np.concatenate([[0], cut, [len(group)]])
    size = np.diff(bounds)
    links, label = np.zeros(len(node), np.int64), node.copy()
    found = []
    small = np.repeat(size <= FEW, size)
    for d in range(1, min(FEW, int(size.max(initial=0)))):
        i = np.flatnonzero((group[:-d] == group[d:]) & small[:-d])
        if not len(i):
            break
        i = i[(lo[i] == hi[i]) | (own[i] != own[i + d])]
        found.append(_verified(x, sig, i, i + d, table, threshold))
    for k in np.flatnonzero(size > FEW):
        a, b = bounds[k], bounds[k + 1]
        left = a + np.flatnonzero(own[a:b] == lo[a])
        right = left if lo[a] == hi[a] else a + np.flatnonzero(own[a:b] == hi[a])
        for s in range(0, len(left), 256):
            part = left[s:s + 256]
            i, j = np.nonzero(x[part] @ x[right].T >= threshold - 1e-9)
            i, j = part[i], right[j]
            if lo[a] == hi[a]:
                i, j = i[i < j], j[i < j]
            found.append(_verified(x, sig, i, j, table, threshold))
    i = np.concatenate([f[0] for f in found]) if found else np.zeros(0, np.int64)
    j = np.concatenate([f[1] for f in found]) if found else i
    if not len(i):
        return None
    np.add.at(links, i, many[j])
    np.add.at(links, j, many[i])
    while True:
        before = label.copy()
        np.minimum.at(label, i, label[j])
        np.minimum.at(label, j, label[i])
        if (before == label).all():
            break
    hit = np.flatnonzero(links)
    return pa.RecordBatch.from_arrays(
        [pa.array(node[hit]), pa.array(links[hit]), pa.array(label[hit])],
        names=["node", "links", "root"])


def _compared(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # the last bucket may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            g = batch.column("g").to_numpy()
            last = int(np.searchsorted(g, g[-1]))
            if last == 0 and (len(held) == 1 or held[0].column("g")[0].as_py() == g[-1]):
                continue
            whole = [*held[:-1], batch.slice(0, last)]
            out = by_dims(pa.Table.from_batches(whole), threshold)
            yield from out
            held = [batch.slice(last)]
        if held:
            yield from by_dims(pa.Table.from_batches(held), threshold)

    def by_dims(rows: pa.Table, threshold: float):
        dims = rows.column("dims").to_numpy()
        for d in np.unique(dims):
            got = _compare(rows.filter(pa.array(dims == d)), threshold)
            if got is not None:
                yield got

    return run


def dedup(vectors: DataFrame, key: str = "vec_id", column: str = "embedding",
          label: str = "label", threshold: float = THRESHOLD) -> DataFrame:
    """``key, n_links, component_id, kept`` of every vector."""
    every = vectors.select(F.col(key).alias("id"), F.col(label).alias("label"),
                           F.col(column).alias("vector"))
    usable_ = F.col("label").isNotNull() & usable("vector")
    reps = (every.where(usable_).groupBy("label", "vector")
            .agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("n"))
            .withColumn("dims", F.size("vector")))
    schema = T.StructType([*reps.schema.fields, T.StructField("sig", T.ArrayType(T.IntegerType()))])
    reps = cut_lineage(reps.mapInArrow(_signed, schema))

    bucket = ["label", "dims", "t", "s"]
    narrow = reps.select("node", "label", "dims", F.posexplode("sig").alias("t", "s"))
    shared = (narrow.groupBy(*bucket).agg(F.count(F.lit(1)).alias("size")).where("size > 1"))
    # only buckets with company get the vectors
    tables = (narrow.join(shared, bucket).groupBy("node")
              .agg(F.collect_list(F.struct("t", "s", "size")).alias("in")))
    blocks = F.ceil(F.col("x.size") / F.lit(BLOCK)).cast("int")
    rows = (reps.join(tables, "node").select("*", F.explode("in").alias("x"))
            .withColumn("own", F.pmod(F.xxhash64("node"), blocks).cast("int"))
            .select("*", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
            .select("node", "n", "dims", "vector", "sig", "own", F.col("x.t").alias("t"),
                    F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"),
                    F.xxhash64("label", "dims", "x.t", "x.s", F.least("own", "other"),
                               F.greatest("own", "other")).alias("g"),
                    "label", F.col("x.s").alias("s")))
    # g stands for its bucket and blocks; two that agree by chance would only be compared too
    rows = rows.repartition("g").sortWithinPartitions("g", "label", "s", "node")
    found = cut_lineage(
        rows.select("g", "node", "n", "dims", "vector", "sig", "own", "lo", "hi", "t")
        .mapInArrow(_compared(threshold), "node long, links long, root long"))

    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    edges = found.select(F.col("node").alias("a"), F.col("root").alias("b"))
    several = ids_of_several(every, "id", "label", "vector")
    repeats = not several.isEmpty()
    if repeats:
        edges = edges.union(every.where(usable_).join(several, "id")
                            .join(reps.select("label", "vector", "node"), ["label", "vector"])
                            .select("id", "node"))
    roots = components(edges)
    done = (reps.select("label", "vector", "node", "n")
            .join(links, "node", "left").join(roots, "node", "left")
            .select(F.col("label").alias("l"), F.col("vector").alias("v"),
                    (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                    F.coalesce("component", "node").alias("component_id")))
    linked = every.where(usable_).join(done, (F.col("label") == F.col("l"))
                                       & (F.col("vector") == F.col("v")))
    alone = every.where(~usable_)
    alone = alone.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    if repeats:  # an id without a usable vector here may have one in another row
        alone = alone.join(roots, F.col("id") == F.col("node"), "left").select(
            "id", "n_links", F.coalesce("component", "component_id").alias("component_id"))
    return (linked.select("id", "n_links", "component_id").union(alone)
            .select(F.col("id").alias(key), "n_links", "component_id",
                    (F.col("id") == F.col("component_id")).alias("kept")))


def op1_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    """Links and components of all vectors."""
    return dedup(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP1_SQL = """
WITH RECURSIVE e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
u AS (SELECT * FROM e WHERE label IS NOT NULL AND v IS NOT NULL
        AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(v, lambda x: x <> 0)) > 0),
l AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b
        ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
        AND list_cosine_similarity(a.v, b.v) >= 0.98),
r(a, b) AS (SELECT vec_id, vec_id FROM e UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, c.component_id,
       e.vec_id = c.component_id AS kept
FROM e JOIN c USING (vec_id) LEFT JOIN n USING (vec_id)
"""
