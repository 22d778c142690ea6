"""Exact interpolated quantiles (DuckDB ``quantile_cont`` / pandas ``quantile``).

Spark's exact ``percentile`` aggregate keeps a value -> count map per group; on a
continuous column of a 100 TB table that map is the whole column in one task.
``exact_quantiles`` instead brackets each needed order statistic by a sample of
about ``SAMPLE`` values of its interval (a ``percentile_approx`` sketch costs far more
a row, and its merging grows with the tasks), counts exactly how many values lie below
and on its bounds, and goes on strictly between (or outside) them until at most ``leaf_rows`` values are left, which are
collected and read off.  A bound that holds the rank is the answer, however
often it occurs, so ties end a search and are never collected.  Every step is
verified by exact counts and leaves fewer values, whatever the sample.
One ``agg`` pass handles every column at once.

Grouped quantiles over low-cardinality keys use ``percentile`` in ``groupBy``
(``grouped_percentile``); inside bounded window frames the frame is small.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import or_

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE = 4_000  # values that bracket an order statistic


def _ranks(n: int, p: float) -> tuple[int, int, float]:
    h = (n - 1) * p
    lo = math.floor(h)
    return lo, min(lo + 1, n - 1), h - lo


def exact_quantiles(df: DataFrame, cols, probs, leaf_rows: int = 50_000) -> dict:
    """{(col, p): value} for non-NULL values; NULL (None) for an all-NULL column."""
    cols = list(cols)
    probs = list(probs)
    if not cols:
        return {}
    from pyspark import StorageLevel
    # several passes follow: keep just these columns, computed once
    df = df.select(*[F.col(c).cast("double").alias(c) for c in cols]).persist(
        StorageLevel.MEMORY_AND_DISK)
    try:
        return _exact_quantiles(df, cols, probs, leaf_rows)
    finally:
        df.unpersist(blocking=False)


class _Target:
    """One order statistic that is looked for, and the open interval it is known to lie in."""

    def __init__(self, col: str, rank: int, size: int):
        self.col, self.rank, self.size = col, rank, size  # rank within the interval
        self.above: float | None = None
        self.below: float | None = None

    @property
    def interval(self) -> tuple:
        return self.col, self.above, self.below


def _inside(interval: tuple) -> Column:
    col, above, below = interval
    cond = F.col(col).isNotNull()
    if above is not None:
        cond = cond & (F.col(col) > F.lit(above))
    if below is not None:
        cond = cond & (F.col(col) < F.lit(below))
    return cond


def _values(df: DataFrame, wanted: dict) -> dict:
    """Sorted values that meet each condition, ``wanted[name] = (column, condition)``, in one pass."""
    some = reduce(or_, [cond for _, cond in wanted.values()])
    hits = F.filter(F.array(*[F.struct(F.lit(j).alias("j"), F.col(c).alias("x"), cond.alias("in"))
                              for j, (c, cond) in enumerate(wanted.values())]), lambda s: s["in"])
    got = df.where(some).select(F.explode(hits).alias("h")).select("h.j", "h.x").toArrow()
    j, x = (got.column(c).to_numpy() for c in ("j", "x"))
    return {name: np.sort(x[j == i]) for i, name in enumerate(wanted)}


def _exact_quantiles(df: DataFrame, cols, probs, leaf_rows: int) -> dict:
    counts = df.agg(*[F.count(F.col(c)).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    value: dict[tuple[str, int], float] = {}
    pending: dict[tuple[str, int], _Target] = {}
    for i, c in enumerate(cols):
        n = counts[f"n{i}"]
        for p in probs if n else ():
            for r in _ranks(n, p)[:2]:
                pending[(c, r)] = _Target(c, r, n)
    turn = 0
    while pending:
        leaves = {k: t for k, t in pending.items() if t.size <= leaf_rows}
        if leaves:
            # at most leaf_rows values for each interval, one pass for all
            found = _values(df, {t.interval: (t.col, _inside(t.interval)) for t in leaves.values()})
            for k, t in leaves.items():
                value[k] = float(found[t.interval][t.rank])
                del pending[k]
        if not pending:
            break
        # bracket each by a sample of its interval, then count what lies below and on the bounds
        turn += 1
        share = {t.interval: SAMPLE / t.size for t in pending.values()}
        found = _values(df.withColumn("__lot", F.rand(turn)), {
            i: (i[0], _inside(i) & (F.col("__lot") < F.lit(s))) for i, s in share.items()})
        bounds = {}
        for k, t in pending.items():
            v = found[t.interval]
            if len(v):  # else another sample
                p = (t.rank + 0.5) / t.size
                slack = 4 * math.sqrt(p * (1 - p) / len(v)) + 1 / len(v)
                bounds[k] = tuple(float(v[min(len(v) - 1, max(0, math.floor(q * len(v))))])
                                  for q in (p - slack, p + slack))
        asked = list(dict.fromkeys((pending[k].interval, repr(x), x) for k, pair in bounds.items() for x in pair))
        at = {(i, r): j for j, (i, r, _) in enumerate(asked)}
        aggs = []
        for j, (i, _, x) in enumerate(asked):
            aggs += [F.count_if(_inside(i) & (F.col(i[0]) < F.lit(x))).alias(f"lt{j}"),
                     F.count_if(_inside(i) & (F.col(i[0]) <= F.lit(x))).alias(f"le{j}")]
        cnt = df.agg(*aggs).first() if aggs else {}
        for key, (lo, hi) in bounds.items():
            t = pending[key]
            a, b = (at[t.interval, repr(x)] for x in (lo, hi))
            lt_lo, le_lo, lt_hi, le_hi = cnt[f"lt{a}"], cnt[f"le{a}"], cnt[f"lt{b}"], cnt[f"le{b}"]
            # a bound itself (however often it occurs), or an interval without both bounds
            if lt_lo <= t.rank < le_lo:
                value[key] = lo
            elif lt_hi <= t.rank < le_hi:
                value[key] = hi
            elif t.rank < lt_lo:
                t.below, t.size = lo, lt_lo
            elif t.rank < lt_hi:
                t.above, t.below, t.size, t.rank = lo, hi, lt_hi - le_lo, t.rank - le_lo
            else:
                t.above, t.size, t.rank = hi, t.size - le_hi, t.rank - le_hi
            if key in value:
                del pending[key]
    out = {}
    for i, c in enumerate(cols):
        n = counts[f"n{i}"]
        for p in probs:
            if not n:
                out[(c, p)] = None
                continue
            a, b, f = _ranks(n, p)
            va, vb = value[(c, a)], value[(c, b)]
            out[(c, p)] = va + f * (vb - va) if f else va
    return out


def medians(df: DataFrame, cols) -> dict:
    q = exact_quantiles(df, cols, [0.5])
    return {c: q[(c, 0.5)] for c in cols}


def grouped_percentile(col: str, p) -> Column:
    """Exact interpolated percentile inside ``groupBy``/window frames."""
    return F.percentile(F.col(col), p)


def grouped_quantiles(df: DataFrame, group_cols, values, probs, names=None) -> DataFrame:
    """Exact interpolated quantiles of one or more columns per group, by rank selection.

    The columns are stacked long (group, column, value) and counted by value, so
    one distributed running count serves them all and a value that repeats is one
    row: for each probability the order statistics floor/ceil((n-1)p) are the values
    whose running counts reach them, interpolated.  No per-group value map, no
    single-task window.  One row per group, a NULL group included; the column for
    (value column v, i-th probability) is ``names[i]`` for a single column, else
    ``names(v, i)`` or ``f"{v}_q{i}"``.
    """
    from .rank import null_safe, running_counts
    group_cols = list(group_cols)
    single = isinstance(values, str)
    values = [values] if single else list(values)
    if names is None:
        name_of = lambda v, i: f"{v}_q{i}"
    elif callable(names):
        name_of = names
    else:
        name_of = lambda v, i: list(names)[i]
    long = None
    for v in values:
        part = df.select(*group_cols, F.lit(v).alias("_feat"), F.col(v).cast("double").alias("_x"))
        long = part if long is None else long.unionByName(part)
    long = long.filter(F.col("_x").isNotNull())
    g2 = group_cols + ["_feat"]
    cnt = long.groupBy(*g2).agg(F.count(F.lit(1)).alias("_n"))
    j = null_safe(running_counts(long, g2, "_x"), cnt, g2)
    aggs = []
    for i, p in enumerate(probs):
        h = (F.col("_n") - 1) * F.lit(float(p))
        for name, k in (("_lo", F.floor(h)), ("_hi", F.least(F.floor(h) + 1, F.col("_n") - 1))):
            here = (F.col("_before") <= k) & (k < F.col("_before") + F.col("_count"))
            aggs.append(F.max(F.when(here, F.col("_x"))).alias(f"{name}{i}"))
        aggs.append(F.max(h - F.floor(h)).alias(f"_f{i}"))
    sel = j.groupBy(*g2).agg(*aggs)
    vals = sel.select(*g2, *[(F.col(f"_lo{i}") + F.col(f"_f{i}") * (F.col(f"_hi{i}") - F.col(f"_lo{i}")))
                             .alias(f"_q{i}") for i in range(len(probs))])
    # every (group, column) row of ``vals`` is one group's result: fold columns back
    keys = df.select(*group_cols).distinct()
    wide = vals.groupBy(*group_cols).agg(*[
        F.max(F.when(F.col("_feat") == F.lit(v), F.col(f"_q{i}"))).alias(name_of(v, i))
        for v in values for i in range(len(probs))])
    return null_safe(keys, wide, group_cols, "left")
