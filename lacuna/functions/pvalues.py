"""Tail probabilities for test statistics (driver-side scalars only).

Statistics are Spark aggregates; turning one scalar into a p-value is pure
math and runs on the driver.  Standard textbook algorithms: the regularised
incomplete beta (continued fraction) for t and F, the regularised incomplete
gamma for chi-square, ``math.erfc`` for the normal, the Kolmogorov series for KS.
"""

from __future__ import annotations

import math


def norm_cdf(x: float) -> float:
    return 0.5 * math.erfc(-x / math.sqrt(2.0))


def norm_sf(x: float) -> float:
    return 0.5 * math.erfc(x / math.sqrt(2.0))


def norm_ppf(p: float) -> float:
    """Inverse normal CDF (rational start, two Newton steps on erfc)."""
    if p <= 0.0:
        return -math.inf
    if p >= 1.0:
        return math.inf
    # initial guess (logistic-like approximation), then Newton refinement
    q = p - 0.5
    if abs(q) <= 0.425:
        r = 0.180625 - q * q
        x = q * (((((((2509.0809287301226727 * r + 33430.575583588128105) * r
                      + 67265.770927008700853) * r + 45921.953931549871457) * r
                    + 13731.693765509461125) * r + 1971.5909503065514427) * r
                  + 133.14166789178437745) * r + 3.387132872796366608) / \
            (((((((5226.495278852545925 * r + 28729.085735721942674) * r
                  + 39307.89580009271061) * r + 21213.794301586595867) * r
                + 5394.1960214247511077) * r + 687.1870074920579083) * r
              + 42.313330701600911252) * r + 1.0)
    else:
        r = p if q < 0 else 1.0 - p
        r = math.sqrt(-math.log(r))
        if r <= 5.0:
            r -= 1.6
            x = (((((((7.7454501427834140764e-4 * r + 0.0227238449892691845833) * r
                      + 0.24178072517745061177) * r + 1.27045825245236838258) * r
                    + 3.64784832476320460504) * r + 5.7694972214606914055) * r
                  + 4.6303378461565452959) * r + 1.42343711074968357734) / \
                (((((((1.05075007164441684324e-9 * r + 5.475938084995344946e-4) * r
                      + 0.0151986665636164571966) * r + 0.14810397642748007459) * r
                    + 0.68976733498510000455) * r + 1.6763848301838038494) * r
                  + 2.05319162663775882187) * r + 1.0)
        else:
            r -= 5.0
            x = (((((((2.01033439929228813265e-7 * r + 2.71155556874348757815e-5) * r
                      + 0.0012426609473880784386) * r + 0.026532189526576123093) * r
                    + 0.29656057182850489123) * r + 1.7848265399172913358) * r
                  + 5.4637849111641143699) * r + 6.6579046435011037772) / \
                (((((((2.04426310338993978564e-15 * r + 1.4215117583164458887e-7) * r
                      + 1.8463183175100546818e-5) * r + 7.868691311456132591e-4) * r
                    + 0.0148753612908506148525) * r + 0.13692988092273580531) * r
                  + 0.59983220655588793769) * r + 1.0)
        if q < 0:
            x = -x
    return x


def _betacf(a: float, b: float, x: float) -> float:
    tiny = 1e-300
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 400):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        de = d * c
        h *= de
        if abs(de - 1.0) < 1e-15:
            break
    return h


def betainc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    lbt = (math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
           + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1.0) / (a + b + 2.0):
        return math.exp(lbt) * _betacf(a, b, x) / a
    return 1.0 - math.exp(lbt) * _betacf(b, a, 1.0 - x) / b


def t_sf2(t: float, df: float) -> float:
    """Two-sided p-value of Student's t."""
    if math.isnan(t) or df <= 0:
        return float("nan")
    if math.isinf(t):
        return 0.0
    return betainc(df / 2.0, 0.5, df / (df + t * t))


def f_sf(f: float, d1: float, d2: float) -> float:
    if math.isnan(f) or d1 <= 0 or d2 <= 0:
        return float("nan")
    if f <= 0:
        return 1.0
    return betainc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))


def gammaincc(a: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(a, x)."""
    if x <= 0:
        return 1.0
    gln = math.lgamma(a)
    if x < a + 1.0:
        ap, s, d = a, 1.0 / a, 1.0 / a
        for _ in range(1000):
            ap += 1.0
            d *= x / ap
            s += d
            if abs(d) < abs(s) * 1e-16:
                break
        return 1.0 - s * math.exp(-x + a * math.log(x) - gln)
    tiny = 1e-300
    b = x + 1.0 - a
    c = 1.0 / tiny
    d = 1.0 / b
    h = d
    for i in range(1, 1000):
        an = -i * (i - a)
        b += 2.0
        d = an * d + b
        d = d if abs(d) > tiny else tiny
        c = b + an / c
        c = c if abs(c) > tiny else tiny
        d = 1.0 / d
        de = d * c
        h *= de
        if abs(de - 1.0) < 1e-16:
            break
    return math.exp(-x + a * math.log(x) - gln) * h


def chi2_sf(x: float, dof: float) -> float:
    if math.isnan(x) or dof <= 0:
        return float("nan")
    return gammaincc(dof / 2.0, x / 2.0)


def kolmogorov_sf(d: float, n: int) -> float:
    """Asymptotic two-sided KS p-value with the small-sample correction of Stephens."""
    if n <= 0 or math.isnan(d):
        return float("nan")
    en = math.sqrt(n)
    lam = (en + 0.12 + 0.11 / en) * d
    if lam < 1e-3:
        return 1.0
    s = 0.0
    for k in range(1, 200):
        term = 2.0 * (-1) ** (k - 1) * math.exp(-2.0 * k * k * lam * lam)
        s += term
        if abs(term) < 1e-16:
            break
    return max(0.0, min(1.0, s))


def shapiro_p(w: float, n: int) -> float:
    """Royston (1995) normalising transformation of W to a p-value (3 <= n <= 5000)."""
    if n < 3 or math.isnan(w):
        return float("nan")
    if n == 3:
        return max(0.0, min(1.0, 6.0 / math.pi * (math.asin(math.sqrt(w)) - math.asin(math.sqrt(0.75)))))
    ln = math.log(n)
    if n <= 11:
        gamma = 0.459 * n - 2.273
        m = -0.0006714 * n ** 3 + 0.025054 * n ** 2 - 0.39978 * n + 0.5440
        s = math.exp(-0.0020322 * n ** 3 + 0.062767 * n ** 2 - 0.77857 * n + 1.3822)
        y = -math.log(gamma - math.log1p(-w))
    else:
        m = 0.0038915 * ln ** 3 - 0.083751 * ln ** 2 - 0.31082 * ln - 1.5861
        s = math.exp(0.0030302 * ln ** 2 - 0.082676 * ln - 0.4803)
        y = math.log1p(-w)
    return norm_sf((y - m) / s)


def shapiro_coefficients(n: int):
    """Royston's approximation of the Shapiro-Wilk weights a_1..a_n (antisymmetric)."""
    m = [norm_ppf((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)]
    ss = sum(v * v for v in m)
    u = 1.0 / math.sqrt(n)
    rs = math.sqrt(ss)
    a = [v / rs for v in m]
    an = (-2.706056 * u ** 5 + 4.434685 * u ** 4 - 2.071190 * u ** 3 - 0.147981 * u ** 2
          + 0.221157 * u + m[-1] / rs)
    if n > 5:
        an1 = (-3.582633 * u ** 5 + 5.682633 * u ** 4 - 1.752461 * u ** 3 - 0.293762 * u ** 2
               + 0.042981 * u + m[-2] / rs)
        phi = (ss - 2 * m[-1] ** 2 - 2 * m[-2] ** 2) / (1 - 2 * an ** 2 - 2 * an1 ** 2)
        r = math.sqrt(phi)
        a = [v / r for v in m]
        a[-1], a[0], a[-2], a[1] = an, -an, an1, -an1
    elif n > 3:
        phi = (ss - 2 * m[-1] ** 2) / (1 - 2 * an ** 2)
        r = math.sqrt(phi)
        a = [v / r for v in m]
        a[-1], a[0] = an, -an
    else:
        a = [-math.sqrt(0.5), 0.0, math.sqrt(0.5)]
    return a
