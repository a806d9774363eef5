"""The trading calendar as a small table, and the two ways to map days onto it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def calendar_dim(open_days: DataFrame, day: str = "d") -> DataFrame:
    """One row per calendar day: cal_date, is_open, pos, next_on_or_after, next_strict.

    ``pos`` counts the open days up to and including the day.  Its size is the
    number of days of the span, which is why it is broadcast.
    """
    days = open_days.select(F.col(day).cast("date").alias("cal_date")).distinct()
    span = days.agg(F.min("cal_date").alias("a"), F.max("cal_date").alias("b")).where("a is not null")
    every = span.select(F.explode(F.sequence("a", "b")).alias("cal_date"))
    dim = every.join(days.withColumn("is_open", F.lit(1)), "cal_date", "left").na.fill(0, ["is_open"])
    w = Window.orderBy("cal_date")
    day_if_open = F.when(F.col("is_open") == 1, F.col("cal_date"))
    return dim.select(
        "cal_date",
        "is_open",
        F.sum("is_open").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("int").alias("pos"),
        F.min(day_if_open).over(w.rowsBetween(0, Window.unboundedFollowing)).alias("next_on_or_after"),
        F.min(day_if_open).over(w.rowsBetween(1, Window.unboundedFollowing)).alias("next_strict"),
    )


def map_strictly_after(df: DataFrame, calendar: DataFrame, day: str, out: str) -> DataFrame:
    """The first open day after ``day``: what is published on a day is known the next one.  Rows without one go.

    Days before the calendar map to its first open day.
    """
    first = F.broadcast(calendar.agg(F.min("next_on_or_after").alias("_first"), F.min("cal_date").alias("_from")))
    near = F.broadcast(calendar.select(F.col("cal_date").alias("_day"), F.col("next_strict").alias("_next")))
    both = df.join(near, F.col(day) == F.col("_day"), "left").join(first, how="cross")
    got = F.when(F.col(day) < F.col("_from"), F.col("_first")).otherwise(F.col("_next"))
    return both.withColumn(out, got).where(F.col(out).isNotNull()).drop("_day", "_next", "_first", "_from")


def map_on_or_after(df: DataFrame, calendar: DataFrame, day: str, out: str) -> DataFrame:
    """The day itself if open, else the next open one; days outside the calendar stay as they are."""
    near = F.broadcast(calendar.select(F.col("cal_date").alias("_day"), F.col("next_on_or_after").alias("_next")))
    return df.join(near, F.col(day) == F.col("_day"), "left").withColumn(out, F.coalesce("_next", F.col(day))).drop("_day", "_next")


def previous_open_day(calendar: DataFrame) -> DataFrame:
    """Open days with the open day before each."""
    return calendar.where("is_open = 1").select("cal_date", F.lag("cal_date").over(Window.orderBy("cal_date")).alias("prev_open"))
