"""Exact "k smallest hashes" selection without a global sort.

Masks and samples must pick *exactly* ``k`` rows (``max(1, int(n * rate))``) in a
way that DuckDB can reproduce: the rows with the ``k`` smallest
``md5(key | seed)`` values.  ``ORDER BY ... LIMIT k`` or ``row_number()`` over the
whole table would funnel every row through one task, so instead we find the k-th
smallest hash by radix refinement on hex prefixes:

1. count rows per (group, first 4 hex digits)            -> <= 65,536 rows per group
2. walk the cumulative counts on the driver, keep the bucket holding rank k
3. repeat inside that bucket with 4 more digits until it holds <= ``leaf_rows``
4. collect that last bucket's hashes (bounded) and read off the threshold.

Each pass is one partially aggregated scan of a single narrow column, so skew in
any other column is irrelevant and md5 spreads rows evenly over prefixes.  The
result is a per-group threshold; ``hash <= threshold`` is a plain column
predicate that stays in whole-stage codegen.  The hashed key must be unique where
it matters: equal hashes below the threshold are simply all selected, but if the
k-th and the next hash agree no threshold gives k rows, and a ``ValueError`` says
so (refinement ends with the hash's 32 digits).  Groups are few (features, not users).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_ALL = "__all__"
_DIGITS = 32  # of an md5 in hex


def _not_unique(group: str) -> ValueError:
    return ValueError(f"rows of group {group!r} share a hash at the threshold: the key is not unique")


def _group_expr(group_col: str | None) -> Column:
    return F.col(group_col).cast("string") if group_col else F.lit(_ALL)


def hash_thresholds(df: DataFrame, hash_col: str, k_by_group: dict, n_by_group: dict,
                    group_col: str | None = None, step: int = 4,
                    leaf_rows: int = 50_000) -> dict:
    """Return {group: hash} so that exactly k rows of each group have hash <= it."""
    from pyspark import StorageLevel
    g = _group_expr(group_col)
    base = df.select(g.alias("_g"), F.col(hash_col).alias("_h")).persist(
        StorageLevel.MEMORY_AND_DISK)   # narrow (group, hash) pairs, read by every pass
    try:
        return _thresholds(base, k_by_group, n_by_group, step, leaf_rows)
    finally:
        base.unpersist(blocking=False)


def _thresholds(base: DataFrame, k_by_group: dict, n_by_group: dict, step: int,
                leaf_rows: int) -> dict:
    state = {}
    out = {}
    for grp, k in k_by_group.items():
        n = n_by_group.get(grp, 0)
        if k <= 0 or n <= 0:
            out[grp] = None
            continue
        state[grp] = {"prefix": "", "need": min(k, n), "size": n}
    depth = 0
    while state:
        for x, s in list(state.items()):
            if len(s["prefix"]) >= _DIGITS:  # one hash, shared by all the rows left
                if s["need"] < s["size"]:
                    raise _not_unique(x)
                out[x] = s["prefix"]
                del state[x]
        leaves = {x: s for x, s in state.items() if s["size"] <= leaf_rows}
        if leaves:
            cond = None
            for x, s in leaves.items():
                c = (F.col("_g") == F.lit(x)) & F.col("_h").startswith(s["prefix"])
                cond = c if cond is None else (cond | c)
            got: dict[str, list[str]] = {x: [] for x in leaves}
            for r in base.filter(cond).collect():
                got[r["_g"]].append(r["_h"])
            for x, s in leaves.items():
                hs = sorted(got[x])
                if s["need"] < len(hs) and hs[s["need"]] == hs[s["need"] - 1]:
                    raise _not_unique(x)
                out[x] = hs[s["need"] - 1]
                del state[x]
        if not state:
            break
        depth = min(depth + step, _DIGITS)
        cond = None
        for x, s in state.items():
            c = (F.col("_g") == F.lit(x)) & F.col("_h").startswith(s["prefix"])
            cond = c if cond is None else (cond | c)
        counts = (base.filter(cond)
                  .groupBy("_g", F.substring("_h", 1, depth).alias("_p"))
                  .count().collect())
        per: dict[str, list] = {}
        for r in counts:
            per.setdefault(r["_g"], []).append((r["_p"], r["count"]))
        for x, s in list(state.items()):
            cum = 0
            for p, c in sorted(per.get(x, [])):
                if cum + c >= s["need"]:
                    s["prefix"], s["need"], s["size"] = p, s["need"] - cum, c
                    break
                cum += c
    return out


def smallest_flag(hash_col: str, thresholds: dict, group_col: str | None = None) -> Column:
    """Boolean column: the row is among the k smallest hashes of its group."""
    h = F.col(hash_col)
    expr = None
    for grp, t in thresholds.items():
        hit = F.lit(False) if t is None else (h <= F.lit(t))
        cond = F.lit(True) if group_col is None else (F.col(group_col).cast("string") == F.lit(grp))
        expr = F.when(cond, hit) if expr is None else expr.when(cond, hit)
    return F.lit(False) if expr is None else expr.otherwise(F.lit(False))


def mask_count(n: int, rate: float) -> int:
    """max(1, int(n * rate)) capped at n: the reference's masked-cell count."""
    if n <= 0:
        return 0
    return min(n, max(1, int(n * rate)))


def k_smallest(df: DataFrame, hash_col: str, k_of_n, group_col: str | None = None,
               counts: dict | None = None) -> Column:
    """Convenience: count per group, derive k with ``k_of_n(n)``, return the flag column."""
    if counts is None:
        g = _group_expr(group_col)
        counts = {r["_g"]: r["n"] for r in
                  df.groupBy(g.alias("_g")).agg(F.count(F.lit(1)).alias("n")).collect()}
    ks = {grp: k_of_n(n) for grp, n in counts.items()}
    th = hash_thresholds(df, hash_col, ks, counts, group_col)
    return smallest_flag(hash_col, th, group_col)
