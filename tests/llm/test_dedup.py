"""Deduplication operators against brute force on small inputs."""

import hashlib
import re

import numpy as np
import pytest

from lacuna.llm import embedding_dedup, line_dedup, ngram_join, substring_dedup

BLANK = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in BLANK.split(text or "") if w]


def roots(nodes, links):
    """Smallest reachable node of each node."""
    low = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(low[a], low[b])
            if low[a] != m or low[b] != m:
                low[a] = low[b] = m
                changed = True
    return low


# ------------------------------------------------------------------ lines
def brute_lines(rows):
    docs = sorted({(i, t) for i, t in rows if t is not None}, key=lambda r: r[0])
    seen, out = [], {}
    for i, t in docs:
        lines, keep = t.split("\n"), []
        for x in lines:
            s = set(words(x))
            hit = s and any(5 * len(s & o) >= 4 * len(s | o) for o in seen)
            if not hit:
                keep.append(x)
            if s:
                seen.append(s)
        out[i] = "\n".join(keep)
    return out


def test_line_dedup_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    pool = [[f"v{x}" for x in rng.integers(0, 60, rng.integers(1, 14))] for _ in range(60)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rng.integers(1, 6)):
            w = list(pool[rng.integers(0, 60)])
            if rng.random() < 0.5:
                w[rng.integers(0, len(w))] = f"v{rng.integers(0, 60)}"
            lines.append("  ".join(w))
        rows.append((i, "\n".join(lines)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["text"] for r in line_dedup.remove_matches(df).collect()}
    assert got == brute_lines(rows)


def test_line_dedup_odd_rows(spark, odd_docs, odd_rows):
    out = line_dedup.remove_matches(odd_docs)
    assert out.columns == odd_docs.columns
    want = brute_lines([(i, t) for i, t, _ in odd_rows if i is not None])
    rows = out.collect()
    assert len(rows) == len(odd_rows)
    for r in rows:
        if r["doc_id"] is not None:
            assert r["text"] == want.get(r["doc_id"])


# ------------------------------------------------------------------ n-grams
def shingle_set(text):
    w = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)}


def brute_components(rows):
    sets = {}
    for i, t in rows:
        sets.setdefault(i, []).append(shingle_set(t))
    ids = sorted(sets)
    links = [(a, b) for a in ids for b in ids if a < b
             for x in sets[a] for y in sets[b]
             if x and y and 100 * len(x & y) >= 80 * len(x | y)]
    return roots(ids, links)


def test_ngram_join_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = []
    for g in range(12):
        base = [f"g{g}w{x}" for x in rng.integers(0, 400, rng.integers(3, 150))]
        for _ in range(rng.integers(1, 12)):
            w = list(base)
            for _ in range(rng.integers(0, 5)):
                w[rng.integers(0, len(w))] = f"e{rng.integers(0, 10 ** 6)}"
            rows.append((len(rows), " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.join(df).collect()}
    assert got == brute_components(rows)


def test_ngram_join_large_near_group(spark):
    """Hundreds of near copies at the edge of the threshold, not all linked with the first."""
    rng = np.random.default_rng(3)
    base = [f"w{x}" for x in range(100)]
    rows = []
    for i in range(250):
        w = list(base)
        for k in rng.choice(100, rng.integers(0, 4), replace=False):
            w[k] = f"e{rng.integers(0, 10 ** 6)}"
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.join(df).collect()}
    assert got == brute_components(rows)


def test_ngram_join_odd_rows(spark, odd_docs, odd_rows):
    rows = [(i, t) for i, t, _ in odd_rows if i is not None]
    want = brute_components(rows)
    got = ngram_join.join(odd_docs).collect()
    assert len(got) == len(odd_rows)
    assert all(r["component_id"] == want[r["doc_id"]] for r in got if r["doc_id"] is not None)
    kept = ngram_join.representatives(odd_docs)
    assert kept.columns == odd_docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert {i for i in ids if i is not None} == set(want.values())


def test_ngram_join_one_id_on_several_texts(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(3, a), (5, a), (5, b), (7, b + " end"), (9, ""), (9, c), (8, c), (10, None), (10, "z"),
            (11, "y"), (12, "x"), (12, "w"), (13, "w")]
    df = spark.createDataFrame(rows + [(None, a), (None, "v")], "doc_id long, text string").repartition(3)
    want = brute_components(rows)
    got = ngram_join.join(df).collect()
    assert len(got) == len(rows) + 2
    assert {(r["doc_id"], r["component_id"]) for r in got if r["doc_id"] is not None} == set(want.items())
    assert want[7] == 3 and want[9] == 8
    ids = [r["doc_id"] for r in ngram_join.representatives(df).collect() if r["doc_id"] is not None]
    assert set(ids) == set(want.values())


# ------------------------------------------------------------------ passages
def test_substring_dedup_odd_rows(spark, odd_docs, odd_rows):
    text = [words(t) for _, t, _ in odd_rows]
    seen = {}
    for d, w in enumerate(text):
        for p in range(len(w) - 34):
            seen.setdefault(tuple(w[p:p + 35]), []).append((d, p))
    gone = [set() for _ in text]
    for places in seen.values():
        if len(places) > 1:
            for d, p in places:
                gone[d] |= set(range(p, p + 35))
    want = sorted((str(i), len(w), len(g), hashlib.sha256(" ".join(
        x for k, x in enumerate(w) if k not in g).encode()).hexdigest())
        for (i, _, _), w, g in zip(odd_rows, text, gone))
    got = sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_sha256"])
                 for r in substring_dedup.remove_repeats(odd_docs).collect())
    assert got == want


@pytest.mark.parametrize("width", [3, 8, 20])
def test_substring_dedup_other_widths(spark, width):
    rng = np.random.default_rng(width)
    rows = [(i, " ".join(f"a{x}" for x in rng.integers(0, 3, 60))) for i in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["n_removed"] for r in
           substring_dedup.remove_repeats(df, width=width).collect()}
    seen = {}
    for i, t in rows:
        w = t.split()
        for p in range(len(w) - width + 1):
            seen.setdefault(tuple(w[p:p + width]), []).append((i, p))
    gone = {i: set() for i, _ in rows}
    for places in seen.values():
        if len(places) > 1:
            for i, p in places:
                gone[i] |= set(range(p, p + width))
    assert got == {i: len(g) for i, g in gone.items()}


# ------------------------------------------------------------------ embeddings
def test_embeddings_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 64)  # several blocks to a bucket
    rng = np.random.default_rng(4)
    rows = []
    for g in range(6):
        base = rng.normal(size=16)
        for _ in range(int(rng.integers(1, 90))):
            v = base + rng.normal(size=16) * 0.12
            rows.append((len(rows), v.tolist(), int(rng.integers(0, 2))))
    rows += [(len(rows) + k, rows[0][1], rows[0][2]) for k in range(40)]  # equal vectors
    odd = [None, [], [0.0] * 16, [1.0, None] * 8, [float("nan")] * 16, [float("inf")] * 16,
           rows[0][1][:8]]
    rows += [(len(rows) + k, v, 0) for k, v in enumerate(odd)]
    rows.append((len(rows), rows[0][1], None))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(4)
    got = {r["vec_id"]: r for r in embedding_dedup.dedup(df).collect()}
    assert len(got) == len(rows)

    def unit(v):
        if not v or any(x is None or not np.isfinite(x) for x in v) or not np.any(v):
            return None
        return np.array(v) / np.linalg.norm(v)

    u = [unit(v) for _, v, _ in rows]
    links = [(a, b) for a in range(len(rows)) for b in range(a)
             if u[a] is not None and u[b] is not None and rows[a][2] is not None
             and rows[a][2] == rows[b][2] and len(u[a]) == len(u[b]) and u[a] @ u[b] >= 0.98]
    n = np.zeros(len(rows), int)
    for a, b in links:
        n[a] += 1
        n[b] += 1
    low = roots(range(len(rows)), links)
    assert n.max() > 40
    for i in range(len(rows)):
        assert (got[i]["n_links"], got[i]["component_id"]) == (n[i], low[i]), i
        assert got[i]["kept"] == (low[i] == i)


def test_embeddings_one_id_on_several_vectors(spark):
    a, b, c = np.eye(16).tolist()[:3]
    near = (np.array(b) + 0.01).tolist()
    rows = [(3, a, 0), (5, a, 0), (5, b, 0), (7, near, 0), (8, c, 1), (9, c, 1), (9, None, 1),
            (10, c, 0), (12, b, 1), (12, [], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    got = embedding_dedup.dedup(df).collect()
    assert len(got) == len(rows)
    want = {3: 3, 5: 3, 7: 3, 8: 8, 9: 8, 10: 10, 12: 12}
    assert {(r["vec_id"], r["component_id"]) for r in got} == set(want.items())
    assert all(r["kept"] == (r["vec_id"] == want[r["vec_id"]]) for r in got)


def test_embeddings_empty(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_dedup.dedup(df).count() == 0


def test_line_dedup_hot_words(spark, monkeypatch):
    """Words that many classes have in their prefix take the pivot and the rest."""
    monkeypatch.setattr(line_dedup, "HOT", 3)
    rng = np.random.default_rng(9)
    base = [f"b{x}" for x in range(20)]
    rows = []
    for i in range(80):
        w = list(base)
        for k in rng.choice(20, rng.integers(0, 5), replace=False):
            w[k] = f"e{rng.integers(0, 40)}"
        rows.append((i, " ".join(w) + "\n" + " ".join(rng.permutation(w)[:int(rng.integers(1, 9))])))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["text"] for r in line_dedup.remove_matches(df).collect()}
    assert got == brute_lines(rows)


def test_line_dedup_runs_no_python(spark, monkeypatch):
    """DataFrame operations only, and the rows of steps are dealt once for both their uses."""
    plans = []
    written = line_dedup.tb.written

    def seen(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return written(df)

    monkeypatch.setattr(line_dedup.tb, "written", seen)
    monkeypatch.setattr(line_dedup, "BROADCAST_ROWS", 2)
    rng = np.random.default_rng(4)
    rows = []
    for i in range(40):
        w = [f"w{'x' * int(k % 6)}{k}" for k in rng.choice(40, rng.integers(4, 30), replace=False)]
        near = list(w)
        near[0] = f"e{i}"
        rows.append((i, "\t ".join(w) + "\r\n\n" + "\x0b".join(rng.permutation(near)) + "\n" + "e f"))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = line_dedup.remove_matches(df)
    assert {r["doc_id"]: r["text"] for r in out.collect()} == brute_lines(rows)
    assert plans and not any("InArrow" in p or "Python" in p for p in plans)


@pytest.mark.parametrize("seed", [1, 2])
def test_line_dedup_shares_a_step(spark, seed):
    """Sets that match at the very bound, words left out, added and changed; ids are texts."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(30):
        n = int(rng.integers(4, 70))
        w = [f"{'y' * int(rng.integers(0, 8))}{i}z{k}" for k in range(n)]
        change = int(rng.integers(0, n // 9 + 2))
        less = int(rng.integers(0, n // 5 + 1))
        more = int(rng.integers(0, n // 4 + 1))
        for k, other in enumerate((w[change:] + [f"c{i}q{x}" * int(rng.integers(1, 4)) for x in range(change)],
                                   w[less:], w + [f"m{i}q{x}" for x in range(more)])):
            rows.append((f"{i:03d}-{k}", " ".join(rng.permutation(other))))
        rows.append((f"{i:03d}-9", " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id string, text string").repartition(3)
    got = {r["doc_id"]: r["text"] for r in line_dedup.remove_matches(df).collect()}
    assert got == brute_lines(rows)
