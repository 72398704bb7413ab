"""Tail probabilities of Student's t, a batch of rows at a time, and of the hypergeometric distribution as column expressions."""

from __future__ import annotations

from collections.abc import Callable
from math import log, pi

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

#: Steps of the continued fraction; Student's t needs up to 50 at any degrees of freedom.
STEPS = 100
_TINY = 1e-300
#: Stirling's series of the log-gamma function, and that of log(gamma(y + 1/2) / gamma(y)); both are used from y = 8 on.
_STIRLING = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188, -691 / 360360)
_HALF_STEP = (-1 / 8, 1 / 192, -1 / 640, 17 / 14336, -31 / 18432, 691 / 180224)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _odd_series(y, terms: tuple[float, ...]):
    """The sum of terms[k] / y**(2 k + 1), of columns or arrays."""
    out = 0.0
    for t in reversed(terms):
        out = t + out / (y * y)
    return out / y


def log_gamma(x: Column) -> Column:
    """ln gamma(x) of positive x."""
    below = lambda a: F.ln(a * (a + 1) * (a + 2) * (a + 3)) + F.ln((a + 4) * (a + 5) * (a + 6) * (a + 7))
    at = lambda y: (y - 0.5) * F.ln(y) - y + F.lit(0.5 * log(2 * pi)) + _odd_series(y, _STIRLING)
    return let(x.cast("double"), lambda a: at(a + 8) - below(a))


def log_gamma_half_step(a, ln: Callable = F.ln):
    """ln(gamma(a + 1/2) / gamma(a)) of a column, or of an array with its logarithm, without the cancellation of two large numbers."""
    product = 1.0
    for k in range(8):
        product = product * (a + k) / (a + (k + 0.5))
    return 0.5 * ln(a + 8) + _odd_series(a + 8, _HALF_STEP) + ln(product)


def beta_fraction(a: np.ndarray, b: np.ndarray, x: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """The continued fraction of the incomplete beta function, by Lentz's method; a row that has settled takes no further step."""
    safe = lambda v: np.where(np.abs(v) < _TINY, _TINY, v)
    out = np.empty(len(x))
    left = np.arange(len(x))
    d = 1 / safe(1 - (a + b) * x / (a + 1))
    c, h = np.ones(len(x)), d.copy()
    for m in range(1, steps + 1):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for number in (even, odd):
            d, c = 1 / safe(1 + number * d), safe(1 + number / c)
            h = h * c * d
        going = np.abs(c * d - 1) >= 1e-15
        if not going.all():
            out[left[~going]] = h[~going]
            a, b, x, c, d, h, left = (v[going] for v in (a, b, x, c, d, h, left))
        if not len(left):
            break
    out[left] = h
    return out


def _t_tails(t: np.ndarray, nu: np.ndarray) -> np.ndarray:
    """p is the incomplete beta function at nu / (nu + t^2) with nu / 2 and 1 / 2; t is finite and not 0."""
    q = t * t
    total = nu + q
    front = np.exp(log_gamma_half_step(nu / 2, np.log) - 0.5 * log(pi) - nu / 2 * np.log1p(q / nu) + 0.5 * np.log(q / total))
    direct = nu / total < (nu / 2 + 1) / (nu / 2 + 2.5)
    a = np.where(direct, nu / 2, 0.5)
    part = front * beta_fraction(a, np.where(direct, 0.5, nu / 2), np.where(direct, nu, q) / total) / a
    return np.clip(np.where(direct, part, 1 - part), 0.0, 1.0)


def _two_sided(t: pd.Series, df: pd.Series) -> pd.Series:
    t, df = t.to_numpy(float), df.to_numpy(float)
    out = np.full(len(t), np.nan)
    usable = ~np.isnan(t) & (df > 0) & (df < np.inf)
    with np.errstate(all="ignore"):  # squares of the largest and smallest t
        out[usable & (t * t == 0)], out[usable & np.isinf(t * t)] = 1.0, 0.0
        rest = usable & (t * t > 0) & np.isfinite(t * t)
        out[rest] = _t_tails(t[rest], df[rest])
    return pd.Series(out)


_two_sided_of = F.pandas_udf(_two_sided, DoubleType())


def t_two_sided(t: Column, df: Column) -> Column:
    """Two-sided p value of Student's t; NULL without a t or positive degrees of freedom."""
    return _two_sided_of(t.cast("double"), df.cast("double"))


def hypergeometric_tail(k: Column, drawn: Column, marked: Column, total: Column) -> Column:
    """P(X >= k) when `drawn` of `total` are drawn and `marked` of these are marked.

    The first probability comes from log-gamma functions and each further one from its ratio
    to the one before.
    """
    def tail(v: Column) -> Column:
        choose = lambda n, r: log_gamma(n + 1.0) - log_gamma(r + 1.0) - log_gamma(n - r + 1.0)
        n, m, big, low = v["n"], v["m"], v["big"], v["low"]
        first = F.exp(choose(m, low) + choose(big - m, n - low) - choose(big, n))

        def add(s: Column, x: Column) -> Column:
            ratio = (m - x + 1) * (n - x + 1) / (x * (big - m - n + x))
            return let(s["p"] * ratio, lambda p: F.struct(p.alias("p"), (s["sum"] + p).alias("sum")))

        rest = F.when(v["high"] > low, F.sequence(low + 1, v["high"])).otherwise(F.array().cast("array<bigint>"))
        start = let(first, lambda p: F.struct(p.alias("p"), p.alias("sum")))
        summed = F.aggregate(rest, start, lambda s, x: add(s, x.cast("double")), lambda s: s["sum"])
        return F.when(v["k"] <= v["least"], 1.0).when(low > v["high"], 0.0).otherwise(F.least(F.lit(1.0), summed))

    k, n, m, big = (c.cast("bigint") for c in (k, drawn, marked, total))
    least = F.greatest(F.lit(0).cast("bigint"), n + m - big)
    of = F.struct(k.alias("k"), n.alias("n"), m.alias("m"), big.alias("big"), least.alias("least"), F.greatest(k, least).alias("low"), F.least(n, m).alias("high"))
    return let(of, tail)
