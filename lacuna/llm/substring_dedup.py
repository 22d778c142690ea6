r"""Removal of passages of 35 words that occur twice, by level-wise doubling.

A window of 35 words can only be repeated if the shorter windows inside it are.
So the windows of 8 words are counted first, those repeated are extended to 16,
to 32 and at last to 35 words, and what is not repeated at one length is gone from
the next.  To count little, a level counts of each candidate only its anchor: the
inner window with the smallest hash.  Equal candidates have equal anchors, so a
candidate whose anchor occurs once is not repeated; at the last length every
candidate is counted itself, and exactly those that occur once are taken out.

What a level leaves is sent to the tasks as a bitmap of hashes of a fixed size
(``tables.BITMAP_BITS``); hashes that share a bit only leave candidates for the next level.
Regions of candidates (word hashes, not texts) are written to the checkpoint
folder between levels; texts are read three times and joined once, with the spans
found.  Counts are partial sums per task, so a passage in a third of all documents
is a row per task.

Words are ``[^\x20\x09-\x0D]+``, unchanged; a null or empty text has none.
Documents of fewer than 35 words lose nothing.  Repeated rows are documents of
their own and repeat each other.  Hashes of a window have 64 bits.  An empty table
gives no rows; other columns than the id and the text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage
from . import tables as tb
from . import text as tx

WIDTH = 35
BASE = 8
#: Words in a region; a longer one goes on in another that overlaps it.
REGION_WORDS = 1 << 18
#: Spans are broadcast up to this many documents, and joined beyond.
BROADCAST_DOCS = 200_000
_MOST = np.uint64(2 ** 64 - 1)
_POS_BITS, _INDEX_BITS = 19, 24  # of a window's number, below its partition


def levels(width: int = WIDTH, base: int = BASE) -> list[int]:
    """Lengths counted: doubled from ``base`` up to ``width``."""
    out, w = [], min(base, width)
    while w < width:
        out.append(w)
        w *= 2
    return [*out, width]


def _slide(a: np.ndarray, k: int, op, fill, back: bool = False) -> np.ndarray:
    """``op`` over each k entries from (or, with ``back``, up to) every place."""
    out, size = a, 1
    while size < k:
        step = min(size, k - size)
        pad = np.full(step, fill, a.dtype)
        moved = np.concatenate([pad, out[:-step]] if back else [out[step:], pad])[:len(a)]
        out, size = op(out, moved), size + step
    return out


class _Level:
    """Windows of ``width`` inside candidates of ``whole`` words over flat texts."""

    def __init__(self, h: np.ndarray, first: np.ndarray, width: int, whole: int):
        n, k = len(h), whole - width + 1
        g, at = tx.windows(h, first, width)
        self.hashes = np.full(n, _MOST)
        self.hashes[at] = g
        end = np.repeat(first[1:], np.diff(first))
        self.fits = np.arange(n) + whole <= end
        #: the anchor of the candidate that starts at each word
        self.least = _slide(self.hashes, k, np.minimum, _MOST)
        self.k = k

    def anchors(self) -> np.ndarray:
        """Hashes at the places that are the anchor of some candidate."""
        top = _slide(np.where(self.fits, self.least, np.uint64(0)), self.k, np.maximum,
                     np.uint64(0), back=True)
        return self.hashes[(self.hashes == top) & (top > 0)]


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    if "words" in batch.schema.names:
        return tb.listed(batch.column("words"))
    w = tx.words(batch.column("text"))
    return w.hashes(), w.first


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if "text" in batch.schema.names:
            yield from tx.slices([batch], "text")
        else:
            yield from tb.list_slices([batch], "words")


def _count(rows: DataFrame, width: int, whole: int) -> DataFrame:
    """``g`` of the anchors that occur more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _parts(batches):
            a = _Level(*_flat(b), width, whole).anchors()
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64))], names=["g"])

    return rows.mapInArrow(run, "g long").groupBy("g").count().where("count > 1").select("g")


def _runs(alive: np.ndarray, text: np.ndarray, whole: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of words covered by the windows that start where ``alive`` is set."""
    n = len(alive)
    step = np.zeros(n + 1, np.int32)
    at = np.flatnonzero(alive)
    step[at] += 1
    np.subtract.at(step, at + whole, 1)
    cover = np.cumsum(step[:-1]) > 0
    turn = np.ones(n + 1, bool)
    turn[1:-1] = (cover[1:] != cover[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(turn)
    begin, end = at[:-1], at[1:]
    keep = cover[begin] if n else begin.astype(bool)
    return begin[keep], end[keep]


def _regions(rows: DataFrame, bitmap: np.ndarray, width: int, whole: int) -> DataFrame:
    """Regions of the candidates that ``bitmap`` leaves, as word hashes.

    ``region`` numbers them (partition, index); ``start`` is the first word in the text.
    """
    fields = [rows.schema["id"], rows.schema["th"]]
    schema = T.StructType(fields + [T.StructField("start", T.LongType()),
                                    T.StructField("region", T.LongType()),
                                    T.StructField("words", T.ArrayType(T.LongType(), False))])
    sent = rows.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << _INDEX_BITS
        for b in _parts(batches):
            h, first = _flat(b)
            level = _Level(h, first, width, whole)
            text = np.repeat(np.arange(len(first) - 1), np.diff(first))
            begin, end = _runs(level.fits & tb.in_bitmap(sent.value, level.least), text, whole)
            cuts = [(s, min(s + REGION_WORDS, e)) for b0, e in zip(begin.tolist(), end.tolist())
                    for s in range(b0, max(b0 + 1, e - whole + 1), REGION_WORDS - whole + 1)]
            if not cuts:
                continue
            s, e = np.array(cuts, np.int64).T
            of = text[s]
            base = b.column("start").to_numpy()[of] if "start" in b.schema.names else 0
            at = np.concatenate([[0], np.cumsum(e - s)])
            values = np.concatenate([h[i:j] for i, j in cuts])
            take = pa.array(of)
            yield pa.RecordBatch.from_arrays(
                [b.column("id").take(take), b.column("th").take(take),
                 pa.array(s - first[of] + base), pa.array(number + np.arange(len(s))),
                 tb.lists(values, at)], names=schema.names)
            number += len(s)

    return tb.written(rows.mapInArrow(run, schema))


def _numbered(regions: DataFrame, whole: int) -> DataFrame:
    """``g`` and number (region, place) of every candidate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _parts(batches):
            h, first = tb.listed(b.column("words"))
            g, at = tx.windows(h, first, whole)
            of = np.searchsorted(first, at, side="right") - 1
            number = (b.column("region").to_numpy()[of] << _POS_BITS) + at - first[of]
            yield pa.RecordBatch.from_arrays([pa.array(g.view(np.int64)), pa.array(number)],
                                             names=["g", "number"])

    return regions.select("region", "words").mapInArrow(run, "g long, number long")


def spans(docs: DataFrame, key: str = "doc_id", column: str = "text",
          width: int = WIDTH) -> DataFrame:
    """``id, th, spans``: word spans of repeated passages, for documents that have any.

    ``th`` is the text's hash: rows of one id with different texts stay apart.
    """
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    rows = docs.select(F.col(key).alias("id"), F.xxhash64(text).alias("th"), text.alias("text"))
    for w in levels(width)[:-1]:
        found = tb.bitmap(_count(rows.select("words" if "words" in rows.columns else "text"), w, width))
        rows = _regions(rows, found, w, width)
    if "text" in rows.columns:  # too short to be doubled: every window is a candidate
        rows = _regions(rows, np.full(1, _MOST), width, width)
    once = (_numbered(rows, width).groupBy("g")
            .agg(F.count(F.lit(1)).alias("n"), F.min("number").alias("number")).where("n = 1")
            .groupBy(F.shiftright("number", _POS_BITS).alias("r"))
            .agg(F.collect_list(F.col("number").bitwiseAND(F.lit((1 << _POS_BITS) - 1))).alias("once")))
    schema = T.StructType([rows.schema["id"], rows.schema["th"], T.StructField(
        "spans", T.ArrayType(T.LongType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size, start = b.column("size").to_numpy(), b.column("start").to_numpy()
            out, at = [], [0]
            for k, gone in enumerate(b.column("once").to_pylist()):
                alive = np.zeros(size[k], bool)
                alive[:size[k] - width + 1] = True
                alive[gone or []] = False
                pair = np.stack(_runs(alive, np.zeros(size[k], np.int8), width), 1) + start[k]
                out.append(pair.ravel())
                at.append(at[-1] + pair.size)
            values = np.concatenate(out) if out else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("th"),
                 tb.lists(values, np.array(at))], names=schema.names)

    per_region = (rows.select("id", "th", "start", "region", F.size("words").alias("size"))
                  .join(once, F.col("region") == F.col("r"), "left")
                  .select("id", "th", "start", "size", "once").mapInArrow(run, schema)
                  .where(F.size("spans") > 0))
    # rows that are alike have the same spans, so a document keeps one copy of each
    return (per_region.distinct().groupBy("id", "th")
            .agg(F.flatten(F.collect_list("spans")).alias("spans")))


def remove_repeats(docs: DataFrame, key: str = "doc_id", column: str = "text",
                   width: int = WIDTH, with_text: bool = True) -> DataFrame:
    """``key, n_words, n_removed, kept_sha256`` (and the ``kept`` text) of every document."""
    found = cut_lineage(spans(docs, key, column, width).select(
        F.col("id").alias("__i"), F.col("th").alias("__h"), "spans"))
    found = tb.small(found, BROADCAST_DOCS)
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    rows = docs.select(F.col(key).alias("id"), text.alias("text"), F.xxhash64(text).alias("th")).join(
        found, F.col("id").eqNullSafe(F.col("__i")) & (F.col("th") == F.col("__h")), "left")
    schema = T.StructType([docs.schema[key], T.StructField("n_words", T.LongType()),
                           T.StructField("n_removed", T.LongType()),
                           T.StructField("kept_sha256", T.StringType())]
                          + [T.StructField("kept", T.StringType())] * with_text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in tx.slices(batches, "text"):
            n, gone, sha, kept = [], [], [], []
            for t, s in zip(b.column("text").to_pylist(), b.column("spans").to_pylist()):
                words = t.encode().split()
                n.append(len(words))
                if s:
                    keep = np.ones(len(words), bool)
                    for i, j in zip(s[::2], s[1::2]):
                        keep[i:j] = False
                    words = [w for w, k in zip(words, keep.tolist()) if k]
                gone.append(n[-1] - len(words))
                line = b" ".join(words)
                sha.append(hashlib.sha256(line).hexdigest())
                if with_text:
                    kept.append(line.decode())
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()),
                 pa.array(sha, pa.string())] + [pa.array(kept, pa.string())] * with_text,
                names=schema.names)

    return rows.select("id", "text", "spans").mapInArrow(run, schema)


def op5_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Remove the repeated passages of 35 words from every document."""
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), with_text=False)


OP5_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id,
        list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'),
                    lambda x: x <> '') AS w FROM documents),
p AS (SELECT rid, w, unnest(range(1, len(w) - 33)) AS p FROM d WHERE len(w) >= 35),
g AS (SELECT rid, p, md5(array_to_string(w[p : p + 34], ' ')) AS g FROM p),
c AS (SELECT rid, p FROM (SELECT rid, p, count(*) OVER (PARTITION BY g) AS n FROM g) WHERE n > 1),
x AS (SELECT rid, list(DISTINCT p + k) AS gone FROM c, (SELECT unnest(range(0, 35)) AS k)
      GROUP BY rid),
k AS (SELECT doc_id, len(w) AS n, CASE WHEN gone IS NULL THEN w ELSE
        list_filter(w, lambda v, i: NOT list_contains(gone, i)) END AS kept
      FROM d LEFT JOIN x USING (rid))
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(n - len(kept) AS BIGINT) AS n_removed,
       sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM k
"""
