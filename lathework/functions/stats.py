"""Small-sample statistics. Closed forms are Columns; exact binomial results are integers over tiny inputs."""

from __future__ import annotations

from fractions import Fraction
from math import asin, comb, pi, sin, sqrt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values that results depend on.
Z95 = 1.959963984540054
Z_ALPHA_2, Z_POWER = 1.959963984540054, 0.8416212335729143
ALPHA = Fraction(1, 20)
EPSILON_FLOOR = Fraction(1, 10)
MIN_STABLE = 6


def wilson(passed: Column, n: Column, z: float = Z95) -> Column:
    """struct p, lo, hi of the Wilson score interval; zeros for n = 0."""
    p = F.try_divide(passed.cast("double"), n.cast("double"))
    d = 1 + z * z / n
    centre = (p + z * z / (2 * n)) / d
    half = z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / d
    zero = n == 0
    return F.struct(
        F.when(zero, 0.0).otherwise(p).alias("p"),
        F.when(zero, 0.0).otherwise(F.greatest(F.lit(0.0), centre - half)).alias("lo"),
        F.when(zero, 0.0).otherwise(F.least(F.lit(1.0), centre + half)).alias("hi"),
    )


def min_detectable_delta(n: Column, p: float) -> Column:
    """The smallest difference in percentage points that two runs of n tasks show; null where the form saturates."""
    h = F.sqrt(F.lit(2 * (Z_ALPHA_2 + Z_POWER) ** 2) / n)
    phi = 2 * asin(sqrt(p)) + h
    return F.when(phi < pi, 100 * (F.pow(F.sin(phi / 2), 2) - p))


def discordant_count(n: Column, rate: Column) -> Column:
    """Rounded half to even."""
    return F.bround(n * rate).cast("long")


def binomial_tail(n: int, p: Fraction, m: int) -> Fraction:
    """P(X >= m), exactly."""
    a, b = Fraction(p).numerator, Fraction(p).denominator
    return Fraction(sum(comb(n, k) * a**k * (b - a) ** (n - k) for k in range(max(m, 0), n + 1)), b**n)


def mcnemar_min_split(k: int, alpha: Fraction = ALPHA) -> int | None:
    """Of k discordant tasks, how many must point one way to be significant; None if even all do not."""
    return next((b for b in range(k // 2 + 1, k + 1) if 2 * binomial_tail(k, Fraction(1, 2), b) <= alpha), None)


def block_threshold(n: int, eps: Fraction, alpha: Fraction = ALPHA) -> int | None:
    return next((m for m in range(n + 1) if binomial_tail(n, eps, m) <= alpha), None)


def detection_probability(n: int, m: int, p_after: Fraction = Fraction(1, 2)) -> Fraction:
    return binomial_tail(n, p_after, m)


def delta_at(n: int, p: float) -> float | None:
    phi = 2 * asin(sqrt(p)) + sqrt(2 * (Z_ALPHA_2 + Z_POWER) ** 2 / n)
    return None if phi >= pi else 100 * (sin(phi / 2) ** 2 - p)


def threshold_table(spark: SparkSession, sizes: list[int], epsilons: list[Fraction]) -> DataFrame:
    """(n, eps, m, detect): thresholds for each size and error rate, with the chance to detect a drop to one half."""
    rows = []
    for n in sizes:
        for e in epsilons:
            m = block_threshold(n, e)
            rows.append((n, float(e), m, None if m is None else float(detection_probability(n, m))))
    return spark.createDataFrame(rows, "n long, eps double, m long, detect double")


def mcnemar_table(spark: SparkSession, ks: list[int]) -> DataFrame:
    return spark.createDataFrame([(k, mcnemar_min_split(k)) for k in ks], "k long, b long")
