"""Quality rules as a ledger of failure bits.

``measure`` reads every text once and stores its measurements; ``ledger`` adds
``fail_bits``: bit k is set where rule k fails.  A policy is a versioned set of
rules, so applying one (``apply_policy``) or asking what each rule costs
(``ablations``) are bit operations on the ledger and never read a text again.

Null and empty texts have zero words and measurements of 0.  Repeated rows are
judged one by one and alike.  A clashing input column (a name this module
writes) is replaced; other columns are kept only by ``measure(keep=...)``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import text as tx

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
            "n_repeat_words", "n_adjacent")
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
WINDOW = 5

#: (name, condition under which the rule fails); a rule's place is its bit.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 10"),
    ("repeated_windows", "100 * n_repeat_words > 20 * n_words"),
    ("symbols", "100 * n_symbols > 10 * n_words"),
    ("duplicate_lines", "100 * n_dup_lines > 50 * n_lines"),
    ("word_length", "n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 12 * n_words)"),
    ("adjacent_words", "100 * n_adjacent > 20 * n_words"),
)


@dataclass(frozen=True)
class Policy:
    """A version of the filter: a document is kept if none of ``rules`` fails."""

    version: str
    rules: tuple[str, ...]

    def mask(self, rules=RULES) -> int:
        names = [n for n, _ in rules]
        return sum(1 << names.index(r) for r in self.rules)


BASE = Policy("base-1", ("few_words", "repeated_windows"))
FULL = Policy("full-1", tuple(n for n, _ in RULES))


def _lines(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word, and how many of them equal an earlier one."""
    n = np.zeros(len(texts), np.int64)
    dup = np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts.to_pylist()):
        full = [x for x in (t or "").encode().split(b"\n") if x.strip()]
        n[i], dup[i] = len(full), len(full) - len(set(full))
    return n, dup


def measurements(texts: pa.Array) -> dict[str, np.ndarray]:
    """All measurements of a batch of texts."""
    w = tx.words(texts)
    h, of = w.hashes(), w.text_of()
    grams, at = w.windows(h, WINDOW)
    twice = at[tx.repeated(tx.mix(grams ^ tx.mix(of[at].astype(np.uint64))))]
    edge = np.zeros(len(h) + 1, np.int32)
    edge[twice] += 1
    np.subtract.at(edge, twice + WINDOW, 1)
    same = np.zeros(len(h), bool)
    if len(h):
        same[1:] = (h[1:] == h[:-1]) & (of[1:] == of[:-1])
    ink = np.zeros(len(w.raw) + 1, np.int8)
    ink[w.starts] += 1
    np.subtract.at(ink, w.ends, 1)
    inside = np.cumsum(ink[:-1], dtype=np.int8) > 0
    n_lines, n_dup = _lines(texts)
    return {
        "n_words": w.counts.astype(np.int64),
        "word_chars": tx.per_text(inside & ((w.raw & 0xC0) != 0x80), w.bytes_at),
        "n_symbols": tx.per_text(_SYMBOL[w.raw], w.bytes_at),
        "n_lines": n_lines,
        "n_dup_lines": n_dup,
        "n_repeat_words": tx.per_text(np.cumsum(edge)[:-1] > 0, w.first),
        "n_adjacent": tx.per_text(same, w.first),
    }


def measure(docs: DataFrame, key: str = "doc_id", column: str = "text",
            keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: ``key``, ``keep`` and the measurements."""
    carried = [c for c in dict.fromkeys((key, *keep)) if c not in MEASURES]
    fields = [docs.schema[c] for c in carried]
    schema = T.StructType(fields + [T.StructField(m, T.LongType()) for m in MEASURES])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in tx.slices(batches, "__text"):
            got = measurements(b.column("__text"))
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in carried] + [pa.array(got[m], pa.int64()) for m in MEASURES],
                names=carried + list(MEASURES))

    return docs.select(*carried, F.col(column).cast("string").alias("__text")).mapInArrow(run, schema)


def ledger(measured: DataFrame, rules=RULES) -> DataFrame:
    """Adds ``fail_bits``; every rule is evaluated once."""
    bits = F.lit(0).cast("long")
    for k, (_, fails) in enumerate(rules):
        bits = bits.bitwiseOR(F.when(F.expr(fails), F.lit(1 << k)).otherwise(F.lit(0)).cast("long"))
    return measured.withColumn("fail_bits", bits)


def passes(policy: Policy, rules=RULES) -> Column:
    return F.col("fail_bits").bitwiseAND(F.lit(policy.mask(rules)).cast("long")) == 0


def apply_policy(led: DataFrame, policy: Policy, out: str = "kept", rules=RULES) -> DataFrame:
    return led.withColumn(out, passes(policy, rules))


def ablations(led: DataFrame, policy: Policy, rules=RULES) -> DataFrame:
    """Per rule of the policy: documents it fails, and those that it alone removes.

    The ledger is first summed by failure pattern (at most 2^rules groups, with
    partial sums per task), so its size does not matter afterwards.
    """
    mask = policy.mask(rules)
    patterns = (led.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask).cast("long")).alias("bits"))
                .agg(F.count(F.lit(1)).alias("n")))
    named = F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(1 << k).cast("long").alias("bit"))
                      for k, (n, _) in enumerate(rules) if n in policy.rules])
    each = patterns.select("bits", "n", F.explode(named).alias("r"))
    hit = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    return (each.groupBy(F.col("r.rule").alias("rule"))
            .agg(F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).alias("n_failed"),
                 F.coalesce(F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n"))), F.lit(0))
                 .alias("n_only_this"))
            .withColumn("policy", F.lit(policy.version)))


def op8_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Measurements, base verdict and full verdict of every document."""
    led = ledger(measure(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    judged = apply_policy(apply_policy(led, BASE, "__base"), FULL, "kept")
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", (~F.col("__base")).alias("base_failed"), "kept",
                         "n_lines", "n_adjacent", "fail_bits")


OP8_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
t AS (SELECT rid, doc_id, text,
        list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
        list_filter(string_split(text, chr(10)),
                    lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ln FROM d),
pos AS (SELECT rid, w, unnest(range(1, len(w) - 3)) AS p FROM t WHERE len(w) >= 5),
g AS (SELECT rid, p, count(*) OVER (PARTITION BY rid, w[p : p + 4]) AS c FROM pos),
cov AS (SELECT rid, count(DISTINCT p + k) AS n FROM g, (SELECT unnest(range(0, 5)) AS k)
        WHERE c >= 2 GROUP BY rid),
m AS (SELECT t.rid, doc_id, CAST(len(w) AS BIGINT) AS n_words,
        CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(ln) AS BIGINT) AS n_lines,
        CAST(len(ln) - len(list_distinct(ln)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words,
        CAST(coalesce(list_sum(list_transform(range(2, len(w) + 1),
             lambda i: CASE WHEN w[i] = w[i - 1] THEN 1 ELSE 0 END)), 0) AS BIGINT) AS n_adjacent
      FROM t LEFT JOIN cov USING (rid)),
f AS (SELECT *,
        CASE WHEN n_words < 10 THEN 1 ELSE 0 END
      + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
      + CASE WHEN 100 * n_symbols > 10 * n_words THEN 4 ELSE 0 END
      + CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 8 ELSE 0 END
      + CASE WHEN n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 12 * n_words)
             THEN 16 ELSE 0 END
      + CASE WHEN 100 * n_adjacent > 20 * n_words THEN 32 ELSE 0 END AS b FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (b & 3) <> 0 AS base_failed, b = 0 AS kept, n_lines, n_adjacent,
       CAST(b AS BIGINT) AS fail_bits FROM f
"""
