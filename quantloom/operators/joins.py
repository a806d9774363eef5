"""Joins of panels, intervals and events, as equi-joins with residual predicates or one-shuffle windows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantloom.operators.timeline import coverage, timeline


def skeleton(days: DataFrame, codes: DataFrame) -> DataFrame:
    """Dense table of days and codes.  The calendar side, of bounded length, is broadcast."""
    return codes.distinct().join(F.broadcast(days.distinct()), how="cross")


def covered_by_interval(rows: DataFrame, intervals: DataFrame, key: str, day: str, start: str, end: str, flag: str) -> DataFrame:
    """1 where a closed interval [start, end] of the key covers the day, else 0; a null end is open.

    The number of open intervals is a running sum over their ends, met by an as-of join.
    """
    found = asof_backward(rows, coverage(intervals, key, start, end, day, "_open"), key, day, ["_open"])
    return found.withColumn(flag, (F.coalesce("_open", F.lit(0)) > 0).cast("int")).drop("_open")


def latest_interval(rows: DataFrame, intervals: DataFrame, key: str, day: str, start: str, end: str, values: Sequence[str], tie: Sequence[str] = ()) -> DataFrame:
    """Values of the latest half-open interval [start, end) of the key that covers the day (of equal starts, the greatest ``tie``); null if none does."""
    order = [F.col(start).desc(), *[F.col(t).desc_nulls_last() for t in tie]]
    return asof_backward(rows, timeline(intervals, key, start, end, order, values, day), key, day, values)


def asof_backward(left: DataFrame, right: DataFrame, key: str, ts: str, values: Sequence[str]) -> DataFrame:
    """For each left row the latest right row of its key at or before its time.

    Both sides are tagged, united and swept by one window: one shuffle, no range join.
    """
    held = F.struct(*[F.col(v) for v in values])
    kind = right.select(held.alias("h")).schema["h"].dataType
    a = left.select(key, ts, F.lit(1).alias("_side"), F.lit(None).cast(kind).alias("_held"), F.struct(*left.columns).alias("_row"))
    b = right.select(key, ts, F.lit(0).alias("_side"), held.alias("_held"), F.lit(None).cast(a.schema["_row"].dataType).alias("_row"))
    w = Window.partitionBy(key).orderBy(ts, "_side").rowsBetween(Window.unboundedPreceding, 0)
    swept = a.unionByName(b).withColumn("_held", F.last("_held", ignorenulls=True).over(w)).where("_side = 1")
    return swept.select("_row.*", *[F.col(f"_held.{v}").alias(v) for v in values])


def nearest_visible_event(rows: DataFrame, events: DataFrame, key: str, pos: str, seen: str, at: str, out: str) -> DataFrame:
    """Positions to the nearest event at or after the row's that is announced by then; -1 if there is none.

    An event is visible from ``seen`` to ``at``; of the visible ones the next counts.
    """
    spans = events.select(F.col(key).alias(key), F.col(seen).alias("_seen"), F.col(at).alias("_at"), (F.col(at) + 1).alias("_past")).distinct()
    found = asof_backward(rows, timeline(spans, key, "_seen", "_past", [F.col("_at").asc()], ["_at"], pos), key, pos, ["_at"])
    return found.withColumn(out, F.coalesce(F.col("_at") - F.col(pos), F.lit(-1))).drop("_at")


def least_containing(words: DataFrame, texts: DataFrame, key: str, word: str, text: str, value: str) -> DataFrame:
    """For each different (``key``, ``word``) the least ``value`` of the texts of the key that contain the word: key, word, value.

    Words hold no blank, so a word lies within one blank-separated piece of a text.  The
    different pieces give their substrings of the lengths that words have, which meet the words
    in an equi-join: no text is compared with another.
    """
    wanted = words.select(key, word).where(F.col(key).isNotNull() & F.col(word).isNotNull()).distinct()
    sizes = wanted.agg(F.collect_set(F.length(word)).alias("_sizes"))  # one row: the lengths
    pieces = texts.where(F.col(value).isNotNull()).select(key, value, F.explode(F.split(text, " ")).alias("_piece")).groupBy(key, "_piece").agg(F.min(value).alias(value))
    some = pieces.join(F.broadcast(sizes), how="cross").select(key, value, "_piece", F.explode("_sizes").alias("_n")).where(F.col("_n") <= F.length("_piece"))
    parts = some.select(key, value, F.explode(F.transform(F.sequence(F.lit(1), F.length("_piece") - F.col("_n") + 1), lambda i: F.substring("_piece", i, F.col("_n")))).alias(word))
    return wanted.join(parts.groupBy(key, word).agg(F.min(value).alias(value)), [key, word])


def left_keep(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join where columns on both sides are the left table's."""
    return left.join(right.drop(*[c for c in right.columns if c in left.columns and c not in on]), list(on), how)


def fill_from(left: DataFrame, right: DataFrame, on: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Left join that takes a value from the right where the left one is null."""
    r = right.select(*on, *[F.col(c).alias(f"_new_{c}") for c in columns])
    return left.join(r, list(on), "left").withColumns({c: F.coalesce(c, f"_new_{c}") for c in columns}).drop(*[f"_new_{c}" for c in columns])


def outer_fold(series: Sequence[DataFrame], on: str) -> DataFrame:
    """Full outer join of calendar series."""
    return reduce(lambda a, b: a.join(b, on, "full_outer"), series)


def keep_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the first in ``order`` (which must be total)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def not_in(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Rows whose id is not in the other table; rows without an id stay."""
    return left.join(right.select(on).where(F.col(on).isNotNull()).distinct(), on, "left_anti")
