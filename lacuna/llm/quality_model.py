"""A quality classifier on random-indexing word vectors.

1. Words (runs of letters and digits, runs of signs) fall into ``BUCKETS`` hash
   buckets; the words of a bucket share their vectors (README: what that costs).
   Each bucket has a fixed sparse index vector of -1, 0 and 1; its vector is the sum of the index vectors of all words near its words' occurrences in the
   whole corpus.  Every task sums its own table, and the tables are added up
   in streams: a fixed size, whatever the corpus.
2. A document's features pool its words' vectors: mean and spread by dimension,
   the norm of the mean, the likeness of neighbours, the share of equal
   neighbours, the logarithm of the word count.
3. A two-layer network in NumPy learns from labelled documents, at most
   ``MAX_LABELLED`` chosen by hash; a part of them that it does not see sets the
   temperature by which its logits are divided.
4. Every whole text is scored.

Sums are of integers, so reruns agree.  Null and empty texts have features of 0 and
are scored like any other.  Labels that are null do not count; of several labels of
one id the larger share decides (a tie is good).  With labels of one class only, or
none, every score is the smoothed share of good labels.  A null id is not held out.  Repeated
rows are scored alike.  Other columns of the input do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import tables as tb
from . import text as tx

BUCKETS = 1 << 14
DIMS = 32
NONZERO = 4       # of an index vector
REACH = 2         # words on each side
MAX_LABELLED = 20_000
HIDDEN = 32
EPOCHS = 60
CALIBRATION_SHARE = 5  # one labelled document in so many sets the temperature
SEED = 11
FEATURES = 2 * DIMS + 4

_CLASSES = tx.INK.copy()
_CLASSES[[b for b in range(33, 127) if not chr(b).isalnum()]] = 2


def index_vectors() -> np.ndarray:
    rng = np.random.default_rng(SEED)
    at = rng.random((BUCKETS, DIMS)).argsort(1)[:, :NONZERO]
    out = np.zeros((BUCKETS, DIMS), np.int8)
    np.put_along_axis(out, at, rng.choice(np.array([-1, 1], np.int8), (BUCKETS, NONZERO)), 1)
    return out


def buckets_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash bucket of every word, and the first word of each text."""
    w = tx.words(texts, _CLASSES)
    return (w.hashes() >> np.uint64(64 - 14)).astype(np.int64), w.first


def add_contexts(table: np.ndarray, index: np.ndarray, b: np.ndarray, first: np.ndarray) -> None:
    """Add to each word's row the index vectors of the words near it in its text."""
    if not len(b):
        return
    own = index[b]
    near = np.zeros((len(b), DIMS), np.int16)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    for k in range(1, REACH + 1):
        same = (text[k:] == text[:-k])[:, None]
        near[k:] += own[:-k] * same
        near[:-k] += own[k:] * same
    order = np.argsort(b, kind="stable")
    rows, at = np.unique(b[order], return_index=True)
    table[rows] += np.add.reduceat(near[order], at, axis=0, dtype=np.int64)


def word_vectors(docs: DataFrame, column: str = "text") -> np.ndarray:
    """Unit vectors of all buckets, from every text of the corpus."""

    def count(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        index, table = index_vectors(), np.zeros((BUCKETS, DIMS), np.int64)
        for s in tx.slices(batches, "__text", 1 << 20):
            add_contexts(table, index, *buckets_of(s.column("__text")))
        return table.ravel()

    texts = docs.select(F.col(column).cast("string").alias("__text"))
    table = tb.summed(texts, count, BUCKETS * DIMS).reshape(BUCKETS, DIMS).astype(np.float64)
    norm = np.sqrt((table ** 2).sum(1, keepdims=True))
    return (table / np.where(norm > 0, norm, 1)).astype(np.float32)


def pool(vectors: np.ndarray, b: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Features of each text."""
    n = np.diff(first)
    out = np.zeros((len(n), FEATURES), np.float64)
    full = np.flatnonzero(n)
    if not len(full):
        return out
    at, size = first[:-1][full], n[full].astype(np.float64)
    v = vectors[b]
    mean = np.add.reduceat(v, at, axis=0, dtype=np.float64) / size[:, None]
    square = np.add.reduceat(v * v, at, axis=0, dtype=np.float64) / size[:, None]
    out[full, :DIMS] = mean
    out[full, DIMS:2 * DIMS] = np.sqrt(np.maximum(square - mean ** 2, 0))
    text = np.repeat(np.arange(len(n)), n)
    inner = text[1:] == text[:-1]
    alike = np.concatenate([np.einsum("ij,ij->i", v[1:], v[:-1]) * inner, [0]])
    same = np.concatenate([(b[1:] == b[:-1]) & inner, [False]])
    out[full, -4] = np.sqrt((mean ** 2).sum(1))
    out[full, -3] = np.add.reduceat(alike, at) / size
    out[full, -2] = np.add.reduceat(same, at, dtype=np.float64) / size
    out[full, -1] = np.log1p(size) / 10
    return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


class Network:
    """Two layers, trained with Adam on cross-entropy; calibrated by a temperature."""

    def __init__(self):
        self.constant: float | None = 0.5
        self.temperature = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean) / self.scale
        return np.tanh(z @ self.w1 + self.b1) @ self.w2 + self.b2

    def predict(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return _sigmoid(self.logits(x) / self.temperature)

    def fit(self, x: np.ndarray, y: np.ndarray, calibrate: np.ndarray) -> Network:
        self.constant = (y.sum() + 1) / (len(y) + 2)
        learn = ~calibrate
        if len(np.unique(y[learn])) < 2:
            return self
        self.constant = None
        rng = np.random.default_rng(SEED)
        self.mean, self.scale = x[learn].mean(0), x[learn].std(0) + 1e-6
        self.w1 = rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN))
        self.b1, self.w2 = np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN)
        self.b2 = np.zeros(1)
        z, t = (x[learn] - self.mean) / self.scale, y[learn].astype(np.float64)
        params = [self.w1, self.b1, self.w2, self.b2]
        m, v, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
        for _ in range(EPOCHS):
            for rows in np.array_split(rng.permutation(len(z)), max(1, len(z) // 128)):
                step += 1
                hidden = np.tanh(z[rows] @ self.w1 + self.b1)
                err = (_sigmoid(hidden @ self.w2 + self.b2) - t[rows]) / len(rows)
                back = np.outer(err, self.w2) * (1 - hidden ** 2)
                grads = [z[rows].T @ back + 1e-4 * self.w1, back.sum(0),
                         hidden.T @ err + 1e-4 * self.w2, err.sum(keepdims=True)]
                for p, g, a, c in zip(params, grads, m, v):
                    a += 0.1 * (g - a)
                    c += 0.001 * (g * g - c)
                    p -= 0.005 * (a / (1 - 0.9 ** step)) / (np.sqrt(c / (1 - 0.999 ** step)) + 1e-8)
        if calibrate.any():
            raw, t = self.logits(x[calibrate]), y[calibrate]
            grid = np.exp(np.linspace(np.log(0.2), np.log(10), 120))
            loss = [-np.mean(np.log(np.clip(np.where(t == 1, _sigmoid(raw / g), 1 - _sigmoid(raw / g)),
                                            1e-12, 1))) for g in grid]
            self.temperature = float(grid[int(np.argmin(loss))])
        return self


def _mapped(docs: DataFrame, column: str, carried: list[str], schema: T.StructType, values):
    """The columns to read, and a function that adds ``values(features)`` to the carried ones."""
    # a text that is carried goes to the tasks once
    named = column if column in carried and dict(docs.dtypes)[column] == "string" else f"__{column}_"

    def run(batches: Iterator[pa.RecordBatch], vectors) -> Iterator[pa.RecordBatch]:
        for s in tx.slices(batches, named, 1 << 20):
            made = values(pool(vectors, *buckets_of(s.column(named))))
            yield pa.RecordBatch.from_arrays([s.column(c) for c in carried] + made,
                                             names=schema.names)

    text = [] if named in carried else [F.col(column).cast("string").alias(named)]
    return docs.select(*carried, *text), run


def features(docs: DataFrame, vectors: np.ndarray, carried: list[str],
             column: str = "text") -> DataFrame:
    """``carried`` and the features (float64 bytes) of every document."""
    schema = T.StructType([docs.schema[c] for c in carried]
                          + [T.StructField("features", T.BinaryType())])
    src, run = _mapped(docs, column, carried, schema,
                       lambda f: [pa.array([r.tobytes() for r in f], pa.binary())])
    sent = docs.sparkSession.sparkContext.broadcast(vectors)
    return src.mapInArrow(lambda batches: run(batches, sent.value), schema)


def held_out(key: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, vectors: np.ndarray, key: str = "doc_id",
          column: str = "text", label: str = "quality",
          max_labelled: int = MAX_LABELLED) -> Network:
    """Fit the network on at most ``max_labelled`` labelled documents not held out."""
    known = (labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(key))
             .groupBy(F.col(key).alias("__k"))
             .agg((F.avg(F.col(label).cast("double")) >= 0.5).cast("int").alias("__y"))
             .withColumn("__h", F.abs(F.xxhash64("__k") % 1_000_000)))
    n = known.count()
    share = min(1.0, 0.97 * max_labelled / max(1, n))
    chosen = F.broadcast(known.where(F.col("__h") < share * 1_000_000).limit(max_labelled))
    # of rows that share an id the smallest text is learned from, so that reruns agree
    sample = (docs.select(F.col(key).alias("__i"), F.col(column).alias("__t"))
              .join(chosen, F.col("__i") == F.col("__k"))
              .groupBy("__k", "__y", "__h").agg(F.min("__t").alias("__t")))
    rows = features(sample, vectors, ["__k", "__y", "__h"], "__t").collect()
    rows.sort(key=lambda r: r["__k"])
    x = np.array([np.frombuffer(r["features"]) for r in rows]).reshape(-1, FEATURES)
    y = np.array([r["__y"] for r in rows], np.int64)
    return Network().fit(x, y, np.array([r["__h"] % CALIBRATION_SHARE == 0 for r in rows], bool))


def scored(docs: DataFrame, vectors: np.ndarray, net: Network, carried: list[str],
           column: str = "text", names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """``carried``, score and prediction of every document."""
    schema = T.StructType([docs.schema[c] for c in carried]
                          + [T.StructField(names[0], T.DoubleType()),
                             T.StructField(names[1], T.IntegerType())])
    sent = docs.sparkSession.sparkContext.broadcast((vectors, net))

    def values(f: np.ndarray):
        s = sent.value[1].predict(f)
        return [pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32))]

    src, run = _mapped(docs, column, carried, schema, values)
    return src.mapInArrow(lambda batches: run(batches, sent.value[0]), schema)


def classify(docs: DataFrame, labels: DataFrame, carried: list[str], key: str = "doc_id",
             column: str = "text", names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """Learn from ``docs`` and ``labels``, then score all of ``docs``."""
    vectors = word_vectors(docs, column)
    net = learn(docs, labels, vectors, key, column)
    return scored(docs, vectors, net, carried, column, names)


def op2_quality_classifier(spark, sf_dir: str) -> DataFrame:
    """Quality scores of all documents, learned from the labels not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return classify(docs, labels, ["doc_id"]).select(
        "doc_id", held_out().alias("held_out"), "score", "predicted")
