"""Confidence limits as column expressions."""

from __future__ import annotations

import math
from functools import lru_cache
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F

# Counts below this get exact Poisson limits, the others Byar's approximation.
EXACT_BELOW = 10


def confidence_level(confidence: float) -> float:
    """Accept 0.95 or 95."""
    level = confidence / 100 if confidence >= 90 else confidence
    if not 0.9 <= level <= 1:
        raise ValueError("confidence must lie between 0.9 and 1, or between 90 and 100")
    return level


def z_value(confidence: float) -> float:
    return NormalDist().inv_cdf(0.5 + confidence_level(confidence) / 2)


def wilson(x: Column, n: Column, confidence: float = 0.95) -> tuple[Column, Column]:
    """Wilson score limits of the proportion ``x / n``."""
    z = z_value(confidence)
    share = F.try_divide(x, n)
    spread = z * F.sqrt(z * z + 4 * x * (1 - share))
    base = 2 * (n + z * z)
    lower = F.try_divide(2 * x + z * z - spread, base)
    upper = F.try_divide(2 * x + z * z + spread, base)
    return lower, upper


def byars_lower(x: Column, confidence: float = 0.95) -> Column:
    """Byar's lower limit of a count; NULL at 0."""
    z = z_value(confidence)
    return x * F.pow(1 - F.try_divide(F.lit(1.0), 9 * x) - F.try_divide(F.lit(z), 3 * F.sqrt(x)), 3.0)


def byars_upper(x: Column, confidence: float = 0.95) -> Column:
    """Byar's upper limit of a count."""
    z = z_value(confidence)
    above = x + 1
    return above * F.pow(1 - 1 / (9 * above) + z / (3 * F.sqrt(above)), 3.0)


def _poisson_cdf(k: int, mean: float) -> float:
    term = total = math.exp(-mean)
    for i in range(1, k + 1):
        term *= mean / i
        total += term
    return total


@lru_cache
def exact_poisson_table(confidence: float = 0.95) -> tuple[tuple[float, ...], tuple[float, ...]]:
    """Exact lower and upper limits of the whole counts 0..9."""
    tail = (1 - confidence_level(confidence)) / 2

    def mean_where(k: int, probability: float) -> float:
        low, high = 0.0, 60.0
        for _ in range(200):
            middle = (low + high) / 2
            if _poisson_cdf(k, middle) > probability:
                low = middle
            else:
                high = middle
        return (low + high) / 2

    lower = [0.0] + [mean_where(k - 1, 1 - tail) for k in range(1, EXACT_BELOW)]
    upper = [mean_where(k, tail) for k in range(EXACT_BELOW)]
    return tuple(lower), tuple(upper)


# Lanczos approximation of the gamma function, g = 7 (fixed values).
_LANCZOS = [
    0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313,
    -176.61502916214059, 12.507343278686905, -0.13857109526572012,
    9.9843695780195716e-6, 1.5056327351493116e-7,
]


def _log_gamma_1p(a: Column) -> Column:
    """log(Gamma(a + 1)) for a >= 0."""
    series = F.lit(_LANCZOS[0])
    for i, weight in enumerate(_LANCZOS[1:], start=1):
        series = series + F.lit(weight) / (a + i)
    t = a + 7.5
    return 0.5 * math.log(2 * math.pi) + (a + 0.5) * F.log(t) - t + F.log(series)


def _gamma_quantile(a: Column, probability: float) -> Column:
    """Mean at which the regularised lower gamma function of shape ``a`` (< 12) is ``probability``.

    Bisection inside one expression: the fold runs only on the rows that reach it.
    """
    steps = F.sequence(F.lit(1), F.lit(60))
    terms = F.sequence(F.lit(1), F.lit(120))
    log_norm = _log_gamma_1p(a)

    def cdf(y: Column) -> Column:
        series = F.aggregate(
            terms,
            F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total")),
            lambda s, k: F.struct(
                (s["term"] * y / (a + k)).alias("term"),
                (s["total"] + s["term"] * y / (a + k)).alias("total"),
            ),
            lambda s: s["total"],
        )
        return F.exp(a * F.log(y) - y - log_norm) * series

    def halve(s: Column, _: Column) -> Column:
        middle = (s["low"] + s["high"]) / 2
        below = cdf(middle) < probability
        return F.struct(
            F.when(below, middle).otherwise(s["low"]).alias("low"),
            F.when(below, s["high"]).otherwise(middle).alias("high"),
        )

    return F.aggregate(
        steps,
        F.struct(F.lit(0.0).alias("low"), F.lit(40.0).alias("high")),
        halve,
        lambda s: (s["low"] + s["high"]) / 2,
    )


def poisson_limits(
    x: Column, confidence: float = 0.95, fractional: bool = True
) -> tuple[Column, Column]:
    """Limits of a count: exact below 10, Byar's from 10 on.

    Whole counts read a ten-entry constant table.  ``fractional=False`` leaves fractional counts
    below 10 NULL, for inputs known to hold whole counts only.
    """
    tail = (1 - confidence_level(confidence)) / 2
    lows, highs = exact_poisson_table(confidence)
    whole = x == F.floor(x)
    position = F.when((x >= 0) & (x < EXACT_BELOW), x).cast("int")

    def limit(table: tuple[float, ...], large: Column, solve) -> Column:
        small = F.get(F.array(*[F.lit(v) for v in table]), position)
        choice = F.when(x >= EXACT_BELOW, large).when(whole, small)
        return choice.when(x > 0, solve()) if fractional else choice

    return (
        limit(lows, byars_lower(x, confidence), lambda: _gamma_quantile(x, tail)),
        limit(highs, byars_upper(x, confidence), lambda: _gamma_quantile(x + 1, 1 - tail)),
    )
