"""Tail probabilities of Student's t and chi-square as column expressions.

Spark SQL has neither distribution. The tail is the integral of the density
from the statistic to infinity; with ``u = statistic + exp(pi/2 sinh s)`` the
integrand falls off double-exponentially in s at both ends, so the plain sum
over fixed, evenly spaced s reaches full double accuracy. The densities'
constants use gamma functions at an argument shifted up by a fixed number of
factors, where a short asymptotic series is exact. One formula serves all
degrees of freedom, and no Python runs.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

NODES, STEP = 80, 1 / 16  # s runs over -5 .. 5
SHIFT = 24                # factors between an argument and the series' argument
# --- fixed values: gamma(z + 1/2) / (gamma(z) sqrt(z)) in powers of 1 / z ------
HALF_STEP_SERIES = (1.0, -1 / 8, 1 / 128, 5 / 1024, -21 / 32768, -399 / 262144, 869 / 4194304)
# --- fixed values: Stirling's series for ln gamma(z), odd powers of 1 / z ------
STIRLING_SERIES = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188)


def _horner(coefficients, x: Column) -> Column:
    out = F.lit(coefficients[-1])
    for c in coefficients[-2::-1]:
        out = F.lit(c) + out * x
    return out


def gamma_half_step(z: Column) -> Column:
    """gamma(z + 1/2) / gamma(z) for z > 0."""
    far = z + SHIFT
    start = F.sqrt(far) * _horner(HALF_STEP_SERIES, 1 / far)
    return F.aggregate(F.sequence(F.lit(0), F.lit(SHIFT - 1)), start, lambda out, k: out * ((z + k) / (z + k + 0.5)))


def ln_gamma(z: Column) -> Column:
    """ln gamma(z) for z > 0."""
    far = z + SHIFT
    inverse = 1 / far
    start = (far - 0.5) * F.log(far) - far + F.lit(0.5 * math.log(2 * math.pi)) + inverse * _horner(STIRLING_SERIES, inverse * inverse)
    return F.aggregate(F.sequence(F.lit(0), F.lit(SHIFT - 1)), start, lambda out, k: out - F.log(z + k))


def _integral_from(start: Column, log_density) -> Column:
    """Integral of exp(log_density(u)) for u from ``start`` to infinity."""
    def add(total: Column, i: Column) -> Column:
        s = i * STEP
        x = F.exp(F.sinh(s) * (math.pi / 2))
        return total + F.exp(log_density(start + x)) * x * F.cosh(s) * (STEP * math.pi / 2)
    return F.aggregate(F.sequence(F.lit(-NODES), F.lit(NODES)), F.lit(0.0), add)


def t_two_sided(t: Column, dof: Column) -> Column:
    """P(|T| >= |t|); null when either is null or dof <= 0."""
    const = 2.0 * gamma_half_step(dof / 2) / F.sqrt(dof * math.pi)
    area = _integral_from(F.abs(t), lambda u: -(dof + 1) / 2 * F.log1p(u / dof * u))
    return F.when(t.isNotNull() & (dof > 0), F.least(F.lit(1.0), const * area))


def chi2_tail(x: Column, dof: Column) -> Column:
    """P(X >= x) for x >= 0; null when either is null or dof <= 0."""
    half = dof / 2
    const = half * math.log(2) + ln_gamma(half)
    area = _integral_from(F.greatest(x, F.lit(0.0)), lambda u: (half - 1) * F.log(u) - u / 2 - const)
    return F.when(x.isNotNull() & (dof > 0), F.least(F.lit(1.0), area))
