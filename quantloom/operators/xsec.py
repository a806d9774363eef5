"""Cross-sectional operators: statistics among the rows of a day."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantloom.operators.quantiles import exact_quantiles


def clip(c: Column, lo: float | Column | None, hi: float | Column | None) -> Column:
    """Within [lo, hi]; null stays null."""
    out = c
    if lo is not None:
        out = F.greatest(out, F.lit(lo) if not isinstance(lo, Column) else lo)
    if hi is not None:
        out = F.least(out, F.lit(hi) if not isinstance(hi, Column) else hi)
    return F.when(c.isNotNull(), out)


def zscore(c: Column, by: str, bound: float | None = None, floor: float = 1e-10) -> Column:
    """Standard score within ``by``; a deviation of zero or null counts as ``floor``."""
    w = Window.partitionBy(by)
    std = F.stddev_samp(c).over(w)
    z = (c - F.avg(c).over(w)) / F.when(std > 0, std).otherwise(F.lit(floor))
    return z if bound is None else clip(z, -bound, bound)


def pct_rank(c: Column, by: str) -> Column:
    """Percentile rank with average ties among the values that are not null; null stays null."""
    order = Window.partitionBy(by).orderBy(c.asc_nulls_last())
    same = Window.partitionBy(by, c)
    return F.when(c.isNotNull(), (F.rank().over(order) + (F.count(F.lit(1)).over(same) - 1) / 2) / F.count(c).over(Window.partitionBy(by)))


def average_rank(c: Column, by: str) -> Column:
    order = Window.partitionBy(by).orderBy(c.asc_nulls_last())
    return F.when(c.isNotNull(), F.rank().over(order) + (F.count(F.lit(1)).over(Window.partitionBy(by, c)) - 1) / 2)


def quantile_bucket(c: Column, by: str, q: int, tie: Column) -> Column:
    """Bucket 1 to ``q`` of the rank in order of arrival ``tie``, with edges of a linear quantile."""
    rn = F.row_number().over(Window.partitionBy(by).orderBy(c.asc_nulls_last(), tie))
    n = F.count(c).over(Window.partitionBy(by))
    return F.when(c.isNotNull() & (n > 1), F.greatest(F.lit(1), F.ceil((rn - 1) * F.lit(q) / (n - 1)))).cast("long")


def winsorize(df: DataFrame, columns: Iterable[str], lo: float = 0.01, hi: float = 0.99, train: Column | None = None) -> DataFrame:
    """Clip to exact linear quantiles; from the rows of ``train`` only, if given.

    The bounds are found by distributed selection, all columns at once; a column whose bounds
    are missing or equal stays as it is.
    """
    columns = list(columns)
    bounds = exact_quantiles(df if train is None else df.where(train), columns, (lo, hi))
    usable = {c: b for c, b in bounds.items() if b[0] is not None and b[0] < b[1]}
    return df.withColumns({c: clip(F.col(c), a, b) for c, (a, b) in usable.items()}) if usable else df


def tercile_label(c: Column, by: str, lo: float = 0.3, hi: float = 0.7) -> Column:
    """0, 1 or 2 by the quantiles within ``by``; at ties the top one counts."""
    w = Window.partitionBy(by)
    a, b = F.percentile(c, lo).over(w), F.percentile(c, hi).over(w)
    return F.when(c.isNull(), None).when(c >= b, 2).when(c <= a, 0).otherwise(1)
