"""Distances between two discrete distributions, as aggregates over their values.

The inputs are per-value columns: ``p`` and ``q`` are shares that each sum to 1,
``a`` and ``b`` the counts behind them; a value absent on one side counts 0 there.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def total_variation() -> Column:
    return F.lit(0.5) * F.sum(F.abs(F.col("p") - F.col("q")))


def l_infinity() -> Column:
    return F.max(F.abs(F.col("p") - F.col("q")))


def divergence_half(name: str) -> Column:
    """Half the term of one value in the divergence of ``p`` or ``q`` from their middle."""
    share, middle = F.col(name), (F.col("p") + F.col("q")) / 2
    return F.when(share > 0, share * F.log2(share / middle)).otherwise(F.lit(0.0)) / 2


def jensen_shannon() -> Column:
    """Distance with base-2 logarithms: 0 for equal, 1 for disjoint distributions."""
    return F.sqrt(F.greatest(F.sum(divergence_half("p") + divergence_half("q")), F.lit(0.0)))


def chi_squared() -> Column:
    """Two-sample statistic with expected counts from the pooled sample."""
    spread = F.sum(F.pow(F.col("p") - F.col("q"), 2) / (F.col("a") + F.col("b")))
    return spread * F.sum("a") * F.sum("b")


#: Rounds of the continued fraction of the error function, which is used from one and a half on only.
_ROUNDS = 160


def _log_gamma(z: Column) -> Column:
    """Logarithm of the gamma function of z > 0: Stirling's series, eight steps up where it is exact enough."""
    up = z + 8
    steps = F.log(z)
    for k in range(1, 8):
        steps = steps + F.log(z + k)
    series = 1 / (12 * up) - 1 / (360 * F.pow(up, 3)) + 1 / (1260 * F.pow(up, 5)) - 1 / (1680 * F.pow(up, 7))
    return (up - 0.5) * F.log(up) - up + math.log(2 * math.pi) / 2 + series - steps


def _sum_of_products(count: Column, ratio) -> Column:
    """1 + r(1) + r(1) r(2) + ... with this many ratios; all terms of one sign, so no digits are lost."""
    start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))

    def step(held: Column, m: Column) -> Column:
        term = F.when(m > 0, held["term"] * ratio(m)).otherwise(held["term"])
        return F.struct(term.alias("term"), (held["total"] + F.when(m > 0, term).otherwise(F.lit(0.0))).alias("total"))

    places = F.sequence(F.lit(0).cast("long"), F.greatest(count, F.lit(0)).cast("long"))
    return F.aggregate(places, start, step, lambda held: held["total"])


def chi_squared_p_value(statistic: Column, degrees: Column) -> Column:
    """Tail probability of the chi-squared distribution with a whole number of degrees.

    With s half the degrees and x half the statistic: below s + 1 the convergent series of the
    lower part; above, the recurrence over s of the upper part, which ends at exp(-x) or at the
    complementary error function. Terms fall like exp(-n^2 / 2s), so some nine times the root
    of s are enough, however many degrees there are.
    """
    s, x = degrees / 2, statistic / 2
    enough = F.ceil(9 * F.sqrt(s) + 60)
    whole = F.pmod(degrees, F.lit(2)) == 0
    shared = F.exp(s * F.log(x) - x - _log_gamma(s + 1))  # x^s exp(-x) / gamma(s + 1)
    lower = shared * _sum_of_products(enough, lambda m: x / (s + m))
    steps = F.floor(s)
    upper = F.when(steps > 0, shared * s / x * _sum_of_products(F.least(steps - 1, enough), lambda m: (s - m) / x)).otherwise(0.0)
    root = F.sqrt(x)
    nested = F.aggregate(F.sequence(F.lit(_ROUNDS), F.lit(1)), root, lambda held, n: root + n / 2 / held)
    error = F.exp(-x) / (math.sqrt(math.pi) * nested)
    tail = F.when(x < s + 1, 1 - lower).otherwise(upper + F.when(whole, F.lit(0.0)).otherwise(error))
    sound = statistic.isNotNull() & ~F.isnan(statistic) & (degrees >= 1)
    return F.when(sound, F.when(x <= 0, 1.0).otherwise(F.greatest(F.least(tail, F.lit(1.0)), F.lit(0.0))))
