"""The complementary error function of whole arrays (NumPy has none)."""

from __future__ import annotations

import math

import numpy as np

_SERIES_TERMS = 70    # enough below 3
_FRACTION_LEVELS = 60  # enough from 3 on


def erfc(x: np.ndarray) -> np.ndarray:
    """Complementary error function of a whole array, to double precision.

    Below 3 the series erf(x) = 2/sqrt(pi) exp(-x^2) sum 2^k x^(2k+1) / (2k+1)!!, from 3
    on the continued fraction, evaluated from its end; negative arguments by symmetry.
    """
    a = np.abs(np.asarray(x, float))
    small = np.minimum(a, 3.0)
    term = small.copy()
    total = term.copy()
    for k in range(1, _SERIES_TERMS):
        term = term * (2 * small * small / (2 * k + 1))
        total += term
    near = 1 - 2 / math.sqrt(math.pi) * np.exp(-small * small) * total
    big = np.maximum(a, 3.0)
    tail = big.copy()
    for k in range(_FRACTION_LEVELS, 0, -1):
        tail = big + k / 2 / tail
    far = np.exp(-big * big) / math.sqrt(math.pi) / tail
    out = np.where(a < 3, near, far)
    return np.where(np.asarray(x, float) < 0, 2 - out, out)
