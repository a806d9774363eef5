"""Sample statistics that Spark has in the population form only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sample_skewness(c: str) -> Column:
    """Bias-corrected skewness; null below three values."""
    n = F.count(c).cast("double")
    return F.when((n > 2) & (F.stddev_pop(c) > 0), F.skewness(c) * F.sqrt(n * (n - 1)) / (n - 2))


def sample_kurtosis(c: str) -> Column:
    """Bias-corrected excess kurtosis; null below four values."""
    n = F.count(c).cast("double")
    return F.when((n > 3) & (F.stddev_pop(c) > 0), ((n + 1) * F.kurtosis(c) + 6) * (n - 1) / ((n - 2) * (n - 3)))


def safe_corr(x: str, y: str) -> Column:
    """Pearson correlation over the rows that have both; null, not an error, where a side does not vary.

    ``corr`` itself divides before any condition around it is looked at, so it is composed here.
    """
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    spread = F.stddev_pop(F.when(both, F.col(x))) * F.stddev_pop(F.when(both, F.col(y)))
    return F.try_divide(F.covar_pop(x, y), spread)


def two_sided_p(t: Column, freedom: Column, steps: int = 2000) -> Column:
    """Two-sided p-value of a Student t statistic, by Simpson's rule on the density; null without a degree of freedom.

    The ratio of gamma functions in the density comes from its asymptotic series ten steps up.
    """
    v = F.when(freedom > 0, freedom.cast("double"))
    x = v / 2
    up = x + 10
    ratio = F.sqrt(up) * (1 - 1 / (8 * up) + 1 / (128 * up * up) + 5 / (1024 * up * up * up) - 21 / (32768 * up * up * up * up))
    for k in range(10):
        ratio = ratio * (x + k) / (x + k + 0.5)
    scale, h = ratio / F.sqrt(v * F.pi()), F.abs(t) / steps
    weight = lambda i: F.when((i == 0) | (i == steps), 1).when(i % 2 == 1, 4).otherwise(2)
    density = lambda u: F.pow(1 + u * u / v, -(v + 1) / 2)
    area = F.aggregate(F.sequence(F.lit(0), F.lit(steps)), F.lit(0.0), lambda acc, i: acc + weight(i) * density(i * h))
    return F.greatest(F.lit(0.0), 1 - 2 * scale * h / 3 * area)
