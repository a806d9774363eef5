"""Correlations of all pairs of columns at once, each over the rows that have both values.

Every task adds up small matrices of products (values, squares, presence), so p columns
cost one read of the table and p*p numbers a task; the sums of tasks are merged by an
ordinary aggregate.  Values are taken from the column's mean, found first, so that large
offsets do not cancel.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SCHEMA = "i int, j int, n double, xi double, xj double, xii double, xjj double, xij double"


def co_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """For each pair a < b of ``columns`` in their order: n, mean_a, mean_b, var_a, var_b, cov (of samples) and corr over the rows with both.

    Null and NaN are missing, infinite values too.  ``corr`` is null where a side does not
    vary or fewer than two rows have both.
    """
    columns = list(columns)
    p = len(columns)
    clean = df.select(*[F.when(F.abs(F.col(c).cast("double")) < float("inf"), F.col(c).cast("double")).alias(f"c{k}") for k, c in enumerate(columns)])
    shift = [float(x or 0.0) for x in clean.agg(*[F.avg(f"c{k}").alias(f"c{k}") for k in range(p)]).first()]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, q, g = (np.zeros((p, p)) for _ in range(4))
        for batch in batches:
            x = np.column_stack([batch.column(k).to_numpy(zero_copy_only=False).astype(float) for k in range(p)]) - shift
            has = (~np.isnan(x)).astype(float)
            x = np.nan_to_num(x)
            n += has.T @ has
            s += x.T @ has
            q += (x * x).T @ has
            g += x.T @ x
        i, j = np.triu_indices(p, 1)
        out = [i.astype(np.int32), j.astype(np.int32), n[i, j], s[i, j], s[j, i], q[i, j], q[j, i], g[i, j]]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in out], names=["i", "j", "n", "xi", "xj", "xii", "xjj", "xij"])

    names, means = F.array(*[F.lit(c) for c in columns]), F.array(*[F.lit(m) for m in shift])
    sums = clean.mapInArrow(work, _SCHEMA).groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "xi", "xj", "xii", "xjj", "xij")])
    centred = lambda xy, x, y: F.col(xy) - F.try_divide(F.col(x) * F.col(y), F.col("n"))
    free = F.col("n") - 1
    m = sums.select(
        F.get(names, "i").alias("a"),
        F.get(names, "j").alias("b"),
        F.col("n").cast("long").alias("n"),
        (F.get(means, "i") + F.try_divide("xi", "n")).alias("mean_a"),
        (F.get(means, "j") + F.try_divide("xj", "n")).alias("mean_b"),
        F.try_divide(centred("xii", "xi", "xi"), free).alias("var_a"),
        F.try_divide(centred("xjj", "xj", "xj"), free).alias("var_b"),
        F.try_divide(centred("xij", "xi", "xj"), free).alias("cov"),
    )
    spread = F.sqrt(F.greatest("var_a", F.lit(0.0))) * F.sqrt(F.greatest("var_b", F.lit(0.0)))
    return m.withColumn("corr", F.when(F.col("n") > 1, F.try_divide("cov", spread)))
