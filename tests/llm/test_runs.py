"""Periodic runs against a comparison of every place with every lag."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from lacuna.llm import periodic_runs as P


def brute(x):
    """Runs (start, length, period) by smallest period of every maximal stretch at every lag."""
    found, n = {}, len(x)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if x[i] != x[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and x[j] == x[j + q]:
                j += 1
            size = j + q - i
            if size >= max(6, 4 * q):
                found.setdefault((i, size), q)  # a smaller period came before
            i = j + 1
    return sorted((s, size, q) for (s, size), q in found.items())


def sample(rng, n):
    """Words with runs in runs, neighbours that nearly extend them, and noise."""
    out = []
    while len(out) < n:
        block = [rng.randrange(rng.choice([1, 2, 3, 40])) for _ in range(rng.randint(1, 7))]
        if rng.random() < 0.4:
            block = block * rng.randint(3, 6) + block[:rng.randrange(len(block))]
        if rng.random() < 0.3:
            block = block * rng.randint(1, 5)
        out += block
    return out[:n]


@pytest.mark.parametrize("seed", range(6))
def test_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    texts = [sample(rng, rng.choice([0, 1, 5, 6, 7, 20, 90, 400])) for _ in range(60)]
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    got = P.find_runs(np.array([w for t in texts for w in t], np.int64), first)
    assert got == [(k, *r) for k, t in enumerate(texts) for r in sorted(brute(t), key=lambda r: (r[0], r[2]))]


def expected(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = sorted(brute(w), key=lambda r: (r[0], r[2]))
    gone = {k for s, size, q in runs for k in range(s + q, s + size)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{s},{size},{q}\n" for s, size, q in runs)),
            sha(" ".join(x for k, x in enumerate(w) if k not in gone)))


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
           "collapsed_sha256"]


def of(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def test_query_equals_brute_force(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").where(
        "coalesce(length(text), 0) < 20000")
    P_rows = [tuple(r) for r in docs.collect()]
    got = [r for r in of(P.op13_periodic_runs(spark, sf_small)) if r[0] in {d for d, _ in P_rows}]
    assert got == sorted((expected(*r) for r in P_rows), key=str)
    assert P.op13_periodic_runs(spark, sf_small).count() == spark.read.parquet(
        f"{sf_small}/documents.parquet").count()


def test_odd_rows(spark, odd_docs, odd_rows, as_table):
    folder = as_table(documents=odd_docs)
    rows = [(d, t) for d, t, _ in odd_rows]
    got = of(P.op13_periodic_runs(spark, folder))
    short = {r[0] for r in rows if len(r[1] or "") < 100_000}
    assert [r for r in got if r[0] in short] == sorted(
        (expected(*r) for r in rows if r[0] in short), key=str)
    assert len(got) == len(rows)


def test_long_runs_and_clashing_columns(spark):
    texts = ["a " * 50_000, ("a b c d e " * 9000) + "x", " ".join(str(k % 9000) for k in range(40_000)),
             "    " * 3, "\x0b".join(["q"] * 7)]
    df = spark.createDataFrame([(k, t, "clash", "clash") for k, t in enumerate(texts)],
                               "doc_id long, text string, runs string, kept string")
    got = {r["doc_id"]: r for r in P.collapse_runs(df).collect()}
    runs = {k: [tuple(x) for x in r["runs"]] for k, r in got.items()}
    assert runs[0] == [(0, 50_000, 1)] and got[0]["collapsed"] == "a"
    assert runs[1] == [(0, 45_000, 5)] and got[1]["collapsed"] == "a b c d e x"
    assert runs[2] == [(0, 40_000, 9000)]
    assert runs[3] == [(0, 6, 1)] and got[3]["collapsed"] == " "
    assert runs[4] == [(0, 7, 1)] and got[4]["kept"] == "clash"


def test_empty_table(spark, no_docs, as_table):
    assert P.op13_periodic_runs(spark, as_table(documents=no_docs)).count() == 0
