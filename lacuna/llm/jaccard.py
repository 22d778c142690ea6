"""Prefix arithmetic for sets whose Jaccard similarity is to be 0.8 or more.

With the words of all sets in one order, two such sets of n and m words have at least
4(n + m)/9 in common, and share one of the first ``n - ceil(0.8n) + 1`` words of each.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def prefix_size(n: Column) -> Column:
    return (n - F.ceil(4 * n / F.lit(5.0)) + 1).cast("int")


def rest(n: Column) -> Column:
    """Words of a set of n outside its prefix."""
    return F.ceil(4 * n / F.lit(5.0)) - 1


def plausible(common: Column, n: Column, m: Column) -> Column:
    """Whether sets with ``common`` shared prefix words can be similar enough.

    Of the two prefixes one ends first; what it shares is among the common ones, and
    behind it there is at most the rest of its set.
    """
    return ((5 * F.least(n, m) >= 4 * F.greatest(n, m))
            & (9 * (common + F.greatest(rest(n), rest(m))) >= 4 * (n + m)))


def similar(s: str, t: str) -> Column:
    """Whether two arrays of distinct words are similar enough."""
    both = F.size(F.array_intersect(s, t))
    return 9 * both >= 4 * (F.size(s) + F.size(t))


def size_class(n: Column, shift: float) -> Column:
    """Classes within which sizes differ by less than a quarter."""
    return F.floor(F.log(n) / F.log(F.lit(1.25)) + F.lit(shift))
