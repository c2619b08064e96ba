"""Special functions as Column expressions (the tail of the F distribution, E-13)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: coefficients of Stirling's series of ln(gamma), B(2k) / (2k (2k - 1))
STIRLING = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188, -691 / 360360)
#: the argument is moved up by so much before the series is used
MOVE = 10
#: terms of the continued fraction
TERMS = 400


def ln_gamma(x: Column) -> Column:
    """ln(gamma(x)) for x > 0."""
    y = x + F.lit(float(MOVE))
    series = (y - 0.5) * F.ln(y) - y + F.lit(0.5 * math.log(2 * math.pi))
    for k, c in enumerate(STIRLING):
        series = series + F.lit(c) / F.pow(y, F.lit(float(2 * k + 1)))
    steps = x
    for i in range(1, MOVE):
        steps = steps * (x + F.lit(float(i)))
    return series - F.ln(steps)


def beta_share(a: Column, b: Column, x: Column) -> Column:
    """The regularised incomplete beta function of 0 <= x <= 1.

    Its continued fraction converges fast below the mean of the distribution; above it,
    the complement is taken with a and b exchanged."""
    below = x < (a + 1) / (a + b + 2)
    turned = F.struct(F.when(below, a).otherwise(b).alias("a"), F.when(below, b).otherwise(a).alias("b"),
                      F.when(below, x).otherwise(1 - x).alias("x"), below.alias("below"))

    def share(v: Column) -> Column:
        found = _beta_below(v["a"], v["b"], v["x"])
        return F.when(v["below"], found).otherwise(1 - found)

    # a one-element array binds the values once; plain expressions would be copied into every use
    return F.element_at(F.transform(F.array(turned), share), 1)


def _beta_below(a: Column, b: Column, x: Column) -> Column:
    def safe(v: Column) -> Column:
        return F.when(F.abs(v) < 1e-300, F.lit(1e-300)).otherwise(v)

    def step(state: Column, term: Column) -> Column:
        """One coefficient of the fraction (even and odd ones by turns), as ratios of successive numerators and denominators."""
        half = F.floor(term / 2).cast("double")
        even = half * (b - half) * x / ((a + 2 * half - 1) * (a + 2 * half))
        odd = -(a + half) * (a + b + half) * x / ((a + 2 * half) * (a + 2 * half + 1))
        up = F.when(term % 2 == 0, even).otherwise(odd)
        over, under = safe(1 + up / state["over"]), 1 / safe(1 + up * state["under"])
        return F.struct(over.alias("over"), under.alias("under"), (state["value"] * over * under).alias("value"))

    start = F.struct(F.lit(1.0).alias("over"), F.lit(0.0).alias("under"), F.lit(1.0).alias("value"))
    value = F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, step)["value"]
    front = F.exp(a * F.ln(x) + b * F.ln(1 - x) + ln_gamma(a + b) - ln_gamma(a) - ln_gamma(b)) / a
    return F.when(x <= 0, 0.0).when(x >= 1, 1.0).otherwise(front / value)


def f_tail(f: Column, between: Column, within: Column) -> Column:
    """Probability that an F value with these degrees of freedom is ``f`` or more; NULL for NULL, 1 for 0 and less."""
    d1, d2 = between.cast("double"), within.cast("double")
    return F.when(f <= 0, F.lit(1.0)).when(f.isNotNull(), beta_share(d2 / 2, d1 / 2, d2 / (d2 + d1 * f)))
