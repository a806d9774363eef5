"""Time-series operators over ``Window.partitionBy(code).orderBy(day)``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from quantloom.operators.scan import exponential_means


def per_code(code: str = "code", day: str = "d") -> WindowSpec:
    return Window.partitionBy(code).orderBy(day)


def ffill(c: str | Column, w: WindowSpec) -> Column:
    """Last value that is not null, this row's included."""
    return F.last(c, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))


def rolling(fn: Callable[[Column], Column], c: Column, w: WindowSpec, n: int, least: int | None = None) -> Column:
    """Aggregate over the last ``n`` rows; null below ``least`` (default ``n``) values."""
    frame = w.rowsBetween(-(n - 1), 0)
    return F.when(F.count(c).over(frame) >= (n if least is None else least), fn(c).over(frame))


def rolling_mean(c: Column, w: WindowSpec, n: int, least: int | None = None) -> Column:
    return rolling(F.avg, c, w, n, least)


def rolling_std(c: Column, w: WindowSpec, n: int, least: int | None = None) -> Column:
    return rolling(F.stddev_samp, c, w, n, least)


def difference(c: Column, w: WindowSpec, k: int = 1) -> Column:
    return c - F.lag(c, k).over(w)


def pct_change(c: Column, w: WindowSpec, k: int = 1) -> Column:
    before = F.lag(c, k).over(w)
    return F.try_divide(c - before, before)


def forward_return(c: Column, w: WindowSpec, k: int) -> Column:
    return F.try_divide(F.lead(c, k).over(w), c) - 1


def future_std(c: Column, w: WindowSpec, n: int) -> Column:
    """Standard deviation of rows t to t+n-1; null below max(2, n // 2) values."""
    frame = w.rowsBetween(0, n - 1)
    return F.when(F.count(c).over(frame) >= max(2, n // 2), F.stddev_samp(c).over(frame))


def future_sum(c: Column, w: WindowSpec, n: int) -> Column:
    return F.coalesce(F.sum(c).over(w.rowsBetween(1, n)), F.lit(0))


def trailing_any(flag: Column, w: WindowSpec, k: int) -> Column:
    """1 if any of the last ``k`` rows has the flag."""
    return (F.coalesce(F.sum(flag).over(w.rowsBetween(-(k - 1), 0)), F.lit(0)) > 0).cast("int")


def ewm(df: DataFrame, code: str, day: str, value: str, alpha: float, out: str) -> DataFrame:
    """Recursive exponential mean (no bias adjustment) of the values that are there: code, day, value, ``out``."""
    return ewm_grouped(df, code, day, value, {out: alpha})


def ewm_grouped(df: DataFrame, code: str, day: str, value: str, alphas: dict[str, float]) -> DataFrame:
    """Several means of one column in one pass (see ``scan.exponential_means``)."""
    rows = df.where(F.col(value).isNotNull()).select(code, day, value)
    return exponential_means(rows, code, day, [(out, value, a) for out, a in alphas.items()])


def macd(df: DataFrame, code: str, day: str, value: str, fast: int = 12, slow: int = 26, signal: int = 9) -> DataFrame:
    """Adds ``fast``, ``slow``, ``dif`` and ``signal``: means of spans, their difference and its mean, in one pass."""
    span = lambda n: 2 / (n + 1)
    steps = [("fast", value, span(fast)), ("slow", value, span(slow)), ("signal", ("fast", "slow"), span(signal))]
    return exponential_means(df, code, day, steps).withColumn("dif", F.col("fast") - F.col("slow"))


def rsi(c: Column, w: WindowSpec, n: int) -> Callable[[DataFrame], DataFrame]:
    """Relative strength with simple means: 100 - 100 / (1 + gain / (loss + 1e-10))."""

    def apply(df: DataFrame) -> DataFrame:
        df = df.withColumn("_move", difference(c, w))
        gain = F.when(F.col("_move").isNotNull(), F.greatest("_move", F.lit(0.0)))
        loss = F.when(F.col("_move").isNotNull(), F.greatest(-F.col("_move"), F.lit(0.0)))
        g, l = rolling_mean(gain, w, n), rolling_mean(loss, w, n)  # noqa: E741
        return df.withColumn(f"rsi_{n}", 100 - 100 / (1 + g / (l + 1e-10))).drop("_move")

    return apply


def day_chunks(days: DataFrame, day: str, size: int) -> DataFrame:
    """First and last day of each run of ``size`` days between the least and the greatest: chunk, start, end."""
    ends = days.agg(F.min(day).alias("a"), F.max(day).alias("b")).where("a is not null")
    starts = ends.select("b", F.posexplode(F.sequence("a", "b", F.make_interval(days=F.lit(size)))).alias("chunk", "start"))
    return starts.select("chunk", F.col("start").cast("date").alias("start"), F.least(F.date_add(F.col("start").cast("date"), size - 1), F.col("b")).alias("end"))
