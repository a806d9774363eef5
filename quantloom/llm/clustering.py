"""Exact k-means of integer vectors with Hamerly's bounds.

Each vector keeps one upper bound of the distance to its centroid and one lower bound of
that to the second nearest.  After the centroids moved, the bounds are loosened by their
drift; only vectors whose bounds overlap are measured again, first against their own
centroid, then, if still ambiguous, against all in exact integers.  Bounds are doubles
rounded away from each other, so they decide nothing that integers would not.

A round reads and writes the vectors with their bounds once, where they lie: nothing but a
line of sums for each centroid and task is shuffled.  Rounds are Parquet files in the shared
folder; the one before is deleted when the next is written.

Defined cases: vectors that are null, of another length or with a null or non-finite
component are left out; repeated rows are rows like others; a null id sorts behind the
others when centroids are chosen; with fewer vectors than clusters there are as many
clusters as vectors; an empty table gives an empty result; ties go to the smaller number;
components beyond +-2^27 after scaling are an error.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantloom.llm._spark import discard, materialise
from quantloom.llm._vectors import decimals, first_vectors, integers, lists, matrix, usable

#: Relative slack of the bounds, far over the rounding of a square root or a sum.
SLACK = 1e-12


def squares(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``x`` to one centre (or one centre a row)."""
    diff = x - centre
    return np.einsum("ij,ij->i", diff, diff)


def nearest_two(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Full scan: number of the nearest centre (ties: the smaller), its squared distance and the second smallest one (2^62 for one centre)."""
    every = np.stack([squares(x, c) for c in centres], 1)
    near = every.argmin(1)
    at = np.arange(len(x))
    best = every[at, near]
    every[at, near] = 1 << 62
    return near, best, every.min(1)


def half_gaps(centres: np.ndarray) -> np.ndarray:
    """Half the distance from each centre to the next one, rounded down."""
    out = np.full(len(centres), np.inf)
    for i, c in enumerate(centres):
        others = np.delete(centres, i, 0)
        if len(others):
            out[i] = np.sqrt(squares(others, c).min().astype(float)) / 2 * (1 - SLACK)
    return out


def reassign(x: np.ndarray, near: np.ndarray, upper: np.ndarray, lower: np.ndarray, centres: np.ndarray, drift: np.ndarray) -> int:
    """One step of the bounds, in place; returns how many vectors were scanned in full."""
    top = np.argsort(drift)[::-1]
    other = np.where(near == top[0], drift[top[1]] if len(top) > 1 else 0.0, drift[top[0]])
    upper[:] = (upper + drift[near]) * (1 + SLACK)
    lower[:] = lower - other - np.abs(lower + other) * SLACK
    safe = np.maximum(half_gaps(centres)[near], lower)
    open_ = np.flatnonzero(~(upper < safe))
    if len(open_):
        upper[open_] = np.sqrt(squares(x[open_], centres[near[open_]]).astype(float)) * (1 + SLACK)
        open_ = open_[~(upper[open_] < safe[open_])]
    if len(open_):
        found, best, second = nearest_two(x[open_], centres)
        near[open_] = found
        upper[open_] = np.sqrt(best.astype(float)) * (1 + SLACK)
        lower[open_] = np.sqrt(second.astype(float)) * (1 - SLACK)
    return len(open_)


def _round(dims: int, centres: np.ndarray, drift: np.ndarray | None):
    """Worker: vectors with their cluster, bounds and exact distance under ``centres``; without ``drift`` all are scanned."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("v"), dims)
            if drift is None:
                near, best, second = nearest_two(x, centres)
                upper, lower = np.sqrt(best.astype(float)) * (1 + SLACK), np.sqrt(second.astype(float)) * (1 - SLACK)
            else:
                near, upper, lower = (batch.column(c).to_numpy(zero_copy_only=False).copy() for c in ("cluster", "upper", "lower"))
                near = near.astype(np.int64)
                reassign(x, near, upper, lower, centres, drift)
            yield pa.RecordBatch.from_arrays([batch.column("id"), lists(x), pa.array(near.astype(np.int32)), pa.array(upper), pa.array(lower)], names=["id", "v", "cluster", "upper", "lower"])

    return work


def _distances(dims: int, centres: np.ndarray):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = batch.column("cluster").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("cluster"), pa.array(squares(matrix(batch.column("v"), dims), centres[near]))], names=["id", "cluster", "distance"])

    return work


def moved(state: DataFrame, centres: np.ndarray) -> np.ndarray:
    """Centroids as exact floors of their vectors' means; an empty one stays.  One line a centroid comes to the driver."""
    dims = centres.shape[1]
    sums = state.groupBy("cluster").agg(F.count("*").alias("n"), *[F.sum(F.col("v")[i]).alias(f"s{i}") for i in range(dims)])
    out = centres.copy()
    for r in sums.collect():
        out[r.cluster] = [r[f"s{i}"] // r.n for i in range(dims)]
    return out


def cluster_vectors(vectors: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: int = 3, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The cluster of every usable vector after ``rounds`` rounds of exact k-means: ``vec_id``, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Components count as ``floor(scale * x)``; the first centroids are the vectors of smallest
    SHA-256 of ``seed:id``.
    """
    kind = vectors.schema[vec_id].dataType
    kept = vectors.where(usable(vector, dims)).select(F.col(vec_id).alias("id"), integers(vector, scale).alias("v"))
    state = materialise(kept, "vectors")
    drawn = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    centres = first_vectors(state, [drawn.asc_nulls_last(), F.col("v")], k, dims)
    if not len(centres):
        return state.select(F.col("id").alias(vec_id), F.lit(0).alias("cluster"), *[F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")], F.lit("").alias("centroid_sha256"))

    drift, schema = None, state.select("id", "v", F.lit(0).alias("cluster"), F.lit(0.0).alias("upper"), F.lit(0.0).alias("lower")).schema
    for r in range(rounds + 1):
        last, state = state, materialise(state.mapInArrow(_round(dims, centres, drift), schema), "bounds")
        discard(last)
        if r < rounds:
            before, centres = centres, moved(state, centres)
            drift = np.sqrt(squares(centres, before).astype(float)) * (1 + SLACK)

    from pyspark.sql import types as T

    found = T.StructType([T.StructField("id", kind), T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    measured = materialise(state.mapInArrow(_distances(dims, centres), found), "distances")
    discard(state)
    inertia = {r.cluster: int(r.s) for r in measured.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    of = lambda values, t: F.element_at(F.array(*[F.lit(x).cast(t) for x in values]), F.col("cluster") + 1)
    return measured.select(
        F.col("id").alias(vec_id),
        "cluster",
        "distance",
        of([inertia.get(i, 0) for i in range(len(centres))], "long").alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("inertia"),
        of([hashlib.sha256(decimals(c).encode()).hexdigest() for c in centres], "string").alias("centroid_sha256"),
    )
