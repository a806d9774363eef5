"""Intervals as timelines: which interval counts from when on, swept once, for as-of joins in place of range joins.

Of the intervals of a key that are open at a time, the best in a given order counts.  That
changes only where an interval starts or ends, so a sweep over the intervals of a key, with
the open ones in a heap, gives at most two changes for each; rows then meet the changes in
one window (``asof_backward``).  Work is n log n for each key, whatever the rows are.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantloom.operators.scan import series_starts

FOREVER = 1 << 62


class Sweep:
    """The best open interval of one key over time; intervals come in order of their starts."""

    def __init__(self) -> None:
        self.open: list[tuple[int, int, tuple | None]] = []
        self.most = 64  # open and ended ones together; ended ones below the best go when there are more
        self.pending: tuple[int, tuple | None] | None = None

    def _change(self, at: int, best: tuple | None) -> Iterator[tuple[int, tuple | None]]:
        if self.pending is not None and self.pending[0] != at:
            yield self.pending
        self.pending = (at, best)

    def upto(self, time: int) -> Iterator[tuple[int, tuple | None]]:
        """Changes by intervals that end at or before ``time``."""
        while self.open and self.open[0][1] <= min(time, FOREVER - 1):
            at = self.open[0][1]
            while self.open and self.open[0][1] <= at:
                heapq.heappop(self.open)
            yield from self._change(at, self.open[0][2] if self.open else None)

    def add(self, start: int, end: int, rank: int, values: tuple) -> Iterator[tuple[int, tuple | None]]:
        yield from self.upto(start)
        if end > start:
            heapq.heappush(self.open, (rank, end, values))
            if len(self.open) > self.most:
                self.open = [x for x in self.open if x[1] > start]
                heapq.heapify(self.open)
                self.most = max(64, 2 * len(self.open))
            if self.open[0][0] == rank:
                yield from self._change(start, values)

    def finish(self) -> Iterator[tuple[int, tuple | None]]:
        yield from self.upto(FOREVER)
        if self.pending is not None:
            yield self.pending
        self.open, self.pending = [], None


def _number(df: DataFrame, c: str) -> Column:
    return F.unix_date(c).cast("long") if isinstance(df.schema[c].dataType, T.DateType) else F.col(c).cast("long")


def timeline(intervals: DataFrame, key: str, start: str, end: str, order: Sequence[Column], values: Sequence[str], at: str, parts: int | None = None) -> DataFrame:
    """Changes (key, ``at``, values): from ``at`` on the first of the open half-open intervals [start, end) in ``order`` counts, or none (null values).

    A null end is open for ever; intervals without key or start, or that end before they
    start, count nowhere.  Starts and ends are days or whole numbers.  One shuffle by key (to
    ``parts`` partitions); a task holds the open intervals of one key.
    """
    kind = intervals.schema[start].dataType
    fields = [T.StructField(f"v{i}", intervals.schema[v].dataType) for i, v in enumerate(values)]
    ranked = intervals.where(F.col(key).isNotNull() & F.col(start).isNotNull())
    ranked = ranked.select("*", F.col(key).alias("_key"), _number(intervals, start).alias("_start"), F.coalesce(_number(intervals, end), F.lit(FOREVER)).alias("_end"))
    if parts is not None:
        ranked = ranked.repartition(parts, "_key")
    w = Window.partitionBy("_key").orderBy(*order, "_start", "_end", *values)
    ranked = ranked.withColumn("_rank", F.row_number().over(w)).select(F.col("_key").alias("key"), F.col("_start").alias("start"), F.col("_end").alias("end"), F.col("_rank").alias("rank"), *[F.col(v).alias(f"v{i}") for i, v in enumerate(values)])
    schema = T.StructType([T.StructField("key", intervals.schema[key].dataType), T.StructField("at", T.LongType()), *fields])
    names, n = [f.name for f in schema], len(values)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sweep, last, of = Sweep(), [], None
        types: list[pa.DataType] = []

        def packed(keys: list, changes: list) -> pa.RecordBatch:
            columns = [[None if c[1] is None else c[1][i] for c in changes] for i in range(n)]
            return pa.RecordBatch.from_arrays([pa.array(keys, types[0]), pa.array([c[0] for c in changes], pa.int64()), *[pa.array(c, t) for c, t in zip(columns, types[1:], strict=True)]], names=names)

        for batch in batches:
            if not batch.num_rows:
                continue
            types = [batch.schema.field(c).type for c in ("key", *names[2:])]
            firsts = series_starts(batch.column("key"), last)
            keys, changes = [], []
            for first, k, a, b, r, *v in zip(firsts, *[batch.column(c).to_pylist() for c in ("key", "start", "end", "rank", *names[2:])], strict=True):
                if first:
                    found = list(sweep.finish())
                    keys += [of] * len(found)
                    changes += found
                    of = k
                found = list(sweep.add(a, b, r, tuple(v)))
                keys += [k] * len(found)
                changes += found
            yield packed(keys, changes)
        found = list(sweep.finish())
        if found:
            yield packed([of] * len(found), found)

    swept = ranked.sortWithinPartitions("key", "start").mapInArrow(work, schema)
    day = F.date_from_unix_date(F.col("at").cast("int")) if isinstance(kind, T.DateType) else F.col("at").cast(kind)
    return swept.select(F.col("key").alias(key), day.alias(at), *[F.col(f"v{i}").alias(v) for i, v in enumerate(values)])


def coverage(intervals: DataFrame, key: str, start: str, end: str, at: str, out: str) -> DataFrame:
    """Changes (key, ``at``, ``out``) of the number of closed intervals [start, end] that cover a day: sums of what starts and ends there, by functions alone."""
    spans = intervals.where(F.col(key).isNotNull() & F.col(start).isNotNull() & (F.col(end).isNull() | (F.col(start) <= F.col(end))))
    after = F.date_add(F.col(end), 1) if isinstance(intervals.schema[end].dataType, T.DateType) else (F.col(end) + 1).cast(intervals.schema[start].dataType)
    marks = spans.select(F.col(key).alias(key), F.explode(F.array(F.struct(F.col(start).alias("t"), F.lit(1).alias("n")), F.struct(after.alias("t"), F.lit(-1).alias("n")))).alias("m"))
    marks = marks.where("m.t is not null").groupBy(key, F.col("m.t").alias(at)).agg(F.sum("m.n").alias("_n"))
    w = Window.partitionBy(key).orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    return marks.select(key, at, F.sum("_n").over(w).alias(out))
