"""Sparse records as dense daily rows, by stretching each over the days it holds for."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quantloom.operators.calendar import calendar_dim


def stretch(records: DataFrame, days: DataFrame, key: str, day: str, state: Sequence[str], once: Sequence[str] = (), pos: str | None = None, parts: int | None = None) -> DataFrame:
    """Every key on every day of ``days``: the last known ``state`` values, and ``once`` values on their own day only.

    ``records`` lie on days of ``days``; of the records of a key and day at most one has a
    value in each column.  Values are carried forward among the records; a record then holds
    up to the next one and is repeated for the days between, taken from the one-row list of
    all days (a calendar, broadcast).  No dense row is joined, sorted or shuffled.  ``pos``
    names a column for the place of the day among ``days``, from 1 on; records are dealt
    by key to ``parts`` partitions.
    """
    line = days.select(F.col(day).alias("_d")).where(F.col(day).isNotNull()).distinct()
    numbered = line.withColumn("_pos", F.row_number().over(Window.orderBy("_d")))  # one row a day: a calendar fits a task
    every = F.broadcast(line.agg(F.sort_array(F.collect_list("_d")).alias("_days")))
    r = records.join(F.broadcast(numbered), F.col(day) == F.col("_d")).select(F.col(key).alias("_key"), "_pos", *state, *once)
    none = [F.lit(None).cast(r.schema[c].dataType).alias(c) for c in (*state, *once)]
    marks = r.unionByName(r.select("_key").distinct().select("_key", F.lit(1).alias("_pos"), *none))
    if parts is not None:
        marks = marks.repartition(parts, "_key")
    points = marks.groupBy("_key", "_pos").agg(*[F.first(c, ignorenulls=True).alias(c) for c in (*state, *once)])
    w = Window.partitionBy("_key").orderBy("_pos")
    last = w.rowsBetween(Window.unboundedPreceding, 0)
    spans = points.select("_key", "_pos", F.lead("_pos").over(w).alias("_next"), *[F.last(c, ignorenulls=True).over(last).alias(c) for c in state], *once)
    spans = spans.join(every, how="cross")
    upto = F.coalesce("_next", F.size("_days") + 1) - F.col("_pos")
    rows = spans.where(F.col("_pos") <= F.size("_days")).select(F.col("_key").alias(key), F.posexplode(F.slice("_days", F.col("_pos"), upto)).alias("_i", day), "_pos", *state, *once)
    place = [] if pos is None else [(F.col("_pos") + F.col("_i")).alias(pos)]
    return rows.select(key, day, *place, *state, *[F.when(F.col("_i") == 0, F.col(c)).alias(c) for c in once])


def on_listed_days(changes: DataFrame, days: DataFrame, key: str, day: str, values: Sequence[str], parts: int) -> DataFrame:
    """Changes at any days as records of ``stretch``: each on the first of ``days`` at or after its own, the last of several there; what begins after the last of ``days`` goes.

    ``changes`` has at most one row a key and day.
    """
    dim = calendar_dim(days, day)
    first = F.broadcast(dim.agg(F.min("cal_date").alias("_from")))
    near = F.broadcast(dim.select(F.col("cal_date").alias("_at"), F.col("next_on_or_after").alias("_next")))
    c = changes.join(first, how="cross").withColumn("_at", F.greatest(day, "_from")).join(near, "_at")
    held = F.max_by(F.struct(*values), F.col(day)).alias("_v")
    return c.repartition(parts, key).groupBy(key, F.col("_next").alias("_on")).agg(held).select(key, F.col("_on").alias(day), "_v.*")
