r"""Periodic runs of words, by recursive frequency splitting and a lag scan.

Words are ``[^\x20\x09-\x0D]+`` of whole texts.  A run is a stretch with smallest period
q and at least ``max(LEAST, TIMES * q)`` words that no neighbouring word extends with
that period.

Splitting: each word of a run occurs in it at least ``TIMES`` times.  A word that occurs
less often within its segment lies in no run there, so it splits the segment; the parts
are split again by their own counts until nothing changes.  Segments of fewer than
``LEAST`` words go.

Lag scan: a run of period q has at least ``(TIMES - 1) * q`` consecutive words equal to the
word q later, so among the multiples of q in its segment ``TIMES - 1`` neighbours at least
match.  Only those places are compared for each lag, n / q of them, and a match is then
extended to both sides.  Places and stretches inside a run whose period divides q are
passed over: there q is not the smallest period.

Texts are worked on in slices, one after the other, as arrays; words are compared by
exact ids.  A null text has no words, no runs and collapses to an empty text; so does
an empty one.  Repeated rows are rows of their own; an empty table gives no rows.
Columns that are not named are carried along unread, so clashing names do not matter
except for the columns this adds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import INK, Words, slices, words

LEAST, TIMES = 6, 4
RUNS = T.ArrayType(T.StructType([T.StructField(n, T.LongType(), False)
                                 for n in ("start", "length", "period")]), False)


def word_ids(w: Words) -> np.ndarray:
    """Ids of the words of a slice; equal ids are equal words."""
    ink = np.zeros(len(w.raw) + 1, np.int8)
    ink[w.starts] += 1
    ink[w.ends] -= 1
    data = w.raw[np.cumsum(ink[:-1]) > 0]
    offsets = np.concatenate([[0], np.cumsum(w.ends - w.starts)])
    found = pa.Array.from_buffers(pa.large_binary(), len(w.starts),
                                  [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return found.dictionary_encode().indices.to_numpy().astype(np.int64)


def segments(ids: np.ndarray, segment: np.ndarray, least: int = LEAST,
             times: int = TIMES) -> np.ndarray:
    """Places of the words that survive the splitting; ``segment`` numbers each word's segment.

    Consecutive survivors without a gap, of one text, form a segment.
    """
    at = np.arange(len(ids))
    width = int(ids.max()) + 1 if len(ids) else 1
    while len(at):
        _, inverse, count = np.unique(segment * width + ids[at], return_inverse=True, return_counts=True)
        keep = count[inverse] >= times
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1] + 1) | (segment[1:] != segment[:-1]) | ~keep[:-1]
        part = np.cumsum(new) - 1
        size = np.bincount(part[keep], minlength=int(part[-1]) + 1)
        keep &= size[part] >= least
        if keep.all() and part[-1] == segment[-1]:
            break
        at, segment = at[keep], np.unique(part[keep], return_inverse=True)[1]
    return at


def scan(x: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of one segment."""
    runs: list[tuple[int, int, int]] = []
    n = len(x)
    for q in range(1, n // times + 1):
        marks = x[::q]
        same = np.flatnonzero(marks[1:] == marks[:-1])
        want = times - 1
        if len(same) < want:
            continue
        starts = same[:len(same) - want + 1]
        starts = starts[same[want - 1:] - starts == want - 1]
        done = -1
        known = [(s, s + size) for s, size, p in runs if q % p == 0] if len(starts) else []
        for k in starts.tolist():
            j = k * q
            if j <= done or any(s <= j and j + want * q < e for s, e in known):
                continue
            lo, hi = _extent(x, j, q)
            done = hi
            if hi + q - lo >= max(least, times * q) and not any(
                    s <= lo and hi + q <= e for s, e in known):
                runs.append((lo, hi + q - lo, q))
    return runs


def _extent(x: np.ndarray, j: int, q: int) -> tuple[int, int]:
    """The widest [lo, hi) around ``j`` in which each word equals the word ``q`` later."""
    hi, step, n = j, 64, len(x) - q
    while hi < n:
        end = min(n, hi + step)
        differ = np.flatnonzero(x[hi:end] != x[hi + q:end + q])
        if len(differ):
            hi += int(differ[0])
            break
        hi, step = end, step * 2
    lo, step = j, 64
    while lo > 0:
        begin = max(0, lo - step)
        differ = np.flatnonzero(x[begin:lo] != x[begin + q:lo + q])
        if len(differ):
            lo = begin + int(differ[-1]) + 1
            break
        lo, step = begin, step * 2
    return lo, hi


def find_runs(ids: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(text, start, length, period) of all runs, by text, start and period.

    ``first`` has the first word of each text and the end; starts count within a text.
    """
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = segments(ids, text)
    if not len(at):
        return []
    cut = np.flatnonzero((at[1:] != at[:-1] + 1) | (text[at[1:]] != text[at[:-1]])) + 1
    out = []
    for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(at)]):
        t = int(text[at[a]])
        lead = int(at[a] - first[t])
        out += [(t, lead + s, size, q) for s, size, q in scan(ids[at[a]:at[b - 1] + 1])]
    return sorted(out, key=lambda r: (r[0], r[1], r[3]))


def collapsed(w: Words, kept: np.ndarray) -> pa.Array:
    """Each text's kept words, joined by one space."""
    count = np.concatenate([[0], np.cumsum(kept)])[w.first]
    begin, end = w.starts[kept], w.ends[kept] + 1  # the blank behind a word goes along
    end[count[1:][np.diff(count) > 0] - 1] -= 1    # but for a text's last
    mark = np.zeros(len(w.raw) + 2, np.int8)
    mark[begin] += 1
    np.add.at(mark, end, -1)
    chosen = np.cumsum(mark[:len(w.raw)], dtype=np.int8) > 0
    data = w.raw[chosen]
    data[INK[data] == 0] = 0x20
    offsets = np.concatenate([[0], np.cumsum(end - begin)])[count]
    return pa.Array.from_buffers(pa.large_string(), len(w.first) - 1, [
        None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)]).cast(pa.string())


def kept_words(w: Words, runs: list[tuple[int, int, int, int]]) -> np.ndarray:
    """Words outside all runs or in the first period of those that hold them."""
    drop = np.zeros(len(w.starts) + 1, np.int64)
    for t, start, length, period in runs:
        drop[w.first[t] + start + period] += 1
        drop[w.first[t] + start + length] -= 1
    return np.cumsum(drop[:-1]) == 0


def collapse_runs(df: DataFrame, text: str = "text", runs: str = "runs",
                  out: str = "collapsed") -> DataFrame:
    """``df`` with the runs of each text (start, length, period) and the text without repeats."""
    schema = T.StructType([f for f in df.schema.fields if f.name not in (runs, out)]
                          + [T.StructField(runs, RUNS, False), T.StructField(out, T.StringType(), False)])
    keep = [f.name for f in schema.fields[:-2]]
    fields = [pa.field(n, pa.int64(), False) for n in ("start", "length", "period")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text):
            w = words(b.column(text))
            found = find_runs(word_ids(w), w.first)
            of = np.bincount([r[0] for r in found], minlength=b.num_rows) if found \
                else np.zeros(b.num_rows, np.int64)
            flat = np.array(found, np.int64).reshape(-1, 4)
            rows = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in (1, 2, 3)], fields=fields)
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(of)]).astype(np.int32)), rows)
            yield pa.RecordBatch.from_arrays(
                [b.column(k) for k in keep] + [lists, collapsed(w, kept_words(w, found))],
                names=schema.names)

    return df.select(*keep).mapInArrow(run, schema)


def plant(docs: DataFrame) -> DataFrame:
    """``doc_id`` and text, with a periodic tail in those whose id's CRC ends in 0.

    A null id has no CRC and is left alone.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    found = docs.select("doc_id", "text", h.alias("h")).withColumn("w", F.expr(
        r"CASE WHEN h % 10 = 0 THEN filter(split(text, '[\\x20\\x09-\\x0D]+'), x -> x != '') END"))
    n, g = F.size("w").cast("long"), F.col("h").cast("long")
    found = found.withColumn("n", n).withColumn("g", F.floor(g / 10)).withColumn(
        "a", F.expr("CASE WHEN n > 0 THEN g % n END")).withColumn(
        "p", F.expr("1 + (n - a) div (3 + g % 8)"))
    tail = F.expr("array_join(transform(sequence(0L, n - 1), "
                  "i -> element_at(w, CAST(1 + IF(i < a, i, a + (i - a) % p) AS INT))), ' ')")
    return found.select("doc_id", F.when(F.expr("a IS NOT NULL"), tail).otherwise(
        F.col("text")).alias("text"))


def op13_periodic_runs(spark, sf_dir: str) -> DataFrame:
    """Runs of all documents, with planted ones; digests of the runs and collapsed texts."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = collapse_runs(plant(docs)).drop("text")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    best = F.expr("array_max(transform(runs, r -> struct(r.length AS l, -r.start AS s, -r.period AS p)))")
    found = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("b"),
                         F.sha2(lines, 256).alias("runs_sha256"),
                         F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return found.select(
        "doc_id", "n_runs", (-F.col("b.s")).alias("start"), F.col("b.l").alias("length"),
        (-F.col("b.p")).alias("period"),
        F.expr("1000 * b.l div -b.p").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
