"""Recursive means as scans of affine maps: linear in the length of a series, many means in one pass.

A step of an exponential mean is y -> a*y + b.  Such maps compose, so a batch of rows is cut
into blocks whose prefixes are composed by doubling, all blocks at once; the blocks' own maps
are scanned the same way, and the value that the batch before ended with is put in last.
A new series starts with a map of a = 0, so one scan runs over all codes of a batch.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: A mean of a column, or of the difference of two; both may be earlier outputs.
Source = str | tuple[str, str]


def affine_prefixes(a: np.ndarray, b: np.ndarray, width: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Prefix compositions of the maps y -> a[i]*y + b[i], in order."""
    n = len(a)
    if n <= 1:
        return a, b
    rows = -(-n // width)
    a, b = np.concatenate([a, np.ones(rows * width - n)]).reshape(rows, width), np.concatenate([b, np.zeros(rows * width - n)]).reshape(rows, width)
    step = 1
    while step < width:
        b[:, step:] += a[:, step:] * b[:, :-step]
        a[:, step:] = a[:, step:] * a[:, :-step]
        step *= 2
    if rows > 1:
        up, add = affine_prefixes(a[:, -1].copy(), b[:, -1].copy(), width)
        b[1:] += a[1:] * add[:-1, None]
        a[1:] *= up[:-1, None]
    return a.ravel()[:n], b.ravel()[:n]


class Mean:
    """One exponential mean over the batches of a sorted partition; it remembers where the last batch ended."""

    def __init__(self, alpha: float) -> None:
        self.alpha, self.value, self.gap = alpha, np.nan, 0

    def step(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Means at the rows of ``x`` (NaN: missing); ``first`` marks the rows at which a series starts."""
        n, at, alpha = len(x), np.arange(len(x)), self.alpha
        have = ~np.isnan(x)
        start = np.maximum.accumulate(np.where(first, at, -1))  # -1: the series goes on from the last batch
        seen = np.maximum.accumulate(np.where(have, at, -1))
        before = np.concatenate([[-1], seen[:-1]])
        inside = before >= np.maximum(start, 0)
        held = (start < 0) & ~inside & ~np.isnan(self.value)
        gap = np.where(inside, at - before, np.where(held, at + 1 + self.gap, 0))
        decay = np.where(inside | held, (1 - alpha) ** gap.astype(float), 0.0)
        total = decay + np.where(inside | held, alpha, 1.0)
        a = np.where(have, decay / total, np.where(first, 0.0, 1.0))
        b = np.where(have, np.where(inside | held, alpha, 1.0) * np.nan_to_num(x) / total, 0.0)
        a, b = affine_prefixes(a, b)
        known = (seen >= np.maximum(start, 0)) | ((start < 0) & ~np.isnan(self.value))
        y = np.where(known, a * np.nan_to_num(self.value) + b, np.nan)
        if n:
            self.value = y[-1]
            self.gap = n - 1 - seen[-1] if seen[-1] >= max(start[-1], 0) else (self.gap + n if start[-1] < 0 else 0)
        return y


def series_starts(codes: pa.Array, last: list) -> np.ndarray:
    """Rows whose code is not the one before; ``last`` holds the code that the batch before ended with."""
    keys = codes.dictionary_encode()
    index = keys.indices.fill_null(-1).to_numpy(zero_copy_only=False)
    first = np.concatenate([[True], index[1:] != index[:-1]])
    now = codes[0].as_py()
    first[0] = not last or last[0] != now
    last[:] = [codes[-1].as_py()]
    return first


def exponential_means(df: DataFrame, code: str, day: str, steps: Sequence[tuple[str, Source, float]], parts: int | None = None) -> DataFrame:
    """Adds exponential means (not bias-adjusted) by ``code`` in the order of ``day``: (name, source, alpha) each.

    A missing value keeps the mean of the row before and weakens it: after a gap of g rows the
    old mean weighs (1 - alpha)^g against alpha.  Rows before the first value have none.
    One shuffle by code and one pass of sorted Arrow batches for all steps; a batch at a time
    is held.  All rows of a code go through one task, as in any window over the code.  Rows that are
    dealt by ``code`` in ``parts`` partitions already stay where they are.
    """
    fields = [*df.schema.fields, *[T.StructField(name, T.DoubleType()) for name, _, _ in steps]]
    names = [f.name for f in fields]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        means, last = [Mean(alpha) for _, _, alpha in steps], []
        for batch in batches:
            if not batch.num_rows:
                continue
            first, found = series_starts(batch.column(code), last), {}

            def values(c: str, found: dict = found, batch: pa.RecordBatch = batch) -> np.ndarray:
                return found[c] if c in found else batch.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False)

            for (name, source, _), mean in zip(steps, means, strict=True):
                x = values(source) if isinstance(source, str) else values(source[0]) - values(source[1])
                found[name] = mean.step(x, first)
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(found[name], from_pandas=True) for name, _, _ in steps]], names=names)

    return (df.repartition(code) if parts is None else df.repartition(parts, code)).sortWithinPartitions(code, day).mapInArrow(work, T.StructType(fields))
