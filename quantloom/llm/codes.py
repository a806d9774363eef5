"""Product codes of integer vectors, entries found by partial-distance search.

A vector is cut into parts; each part gets the number of the nearest entry of its codebook.
The search takes the dimensions in descending variance of the codebook and drops an entry
for all vectors at once (by a mask) where the sum so far strictly exceeds the best complete
distance, so only entries that can still win are summed to the end.

Vectors are read in place in each round; a task sends one line of sums for each part and
entry.  Defined cases: a vector that is null, of another length than ``dims`` or with a null
or non-finite component is left out; repeated rows are rows like others; a null id sorts
behind the others when codebooks start; fewer vectors than entries give as many entries as
vectors; ties go to the lower index; an unused entry stays; null labels are one label; an
empty table gives an empty result; components beyond +-2^27 after scaling are an error.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantloom.llm._spark import discard, join_counted, materialise
from quantloom.llm._vectors import decimals, first_vectors, integers, matrix, usable


def nearest_entry(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of ``x`` the nearest entry of ``book`` (ties: the lower index) and its exact squared distance."""
    order = np.argsort(-book.var(0), kind="stable")
    index = np.abs(x[:, order[0], None] - book[None, :, order[0]]).argmin(1)  # a first complete distance
    diff = x - book[index]
    best = np.einsum("ij,ij->i", diff, diff)
    for e, entry in enumerate(book):
        rows = np.arange(len(x))
        sums = np.zeros(len(x), np.int64)
        for d in order:
            step = x[rows, d] - entry[d]
            sums += step * step
            live = sums <= best[rows]
            if not live.all():
                rows, sums = rows[live], sums[live]
        closer = (sums < best[rows]) | (e < index[rows])  # the rest are equally near
        best[rows[closer]], index[rows[closer]] = sums[closer], e
    return index, best


def encode(x: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance of each part of each row; ``books`` is (parts, entries, width)."""
    found = [nearest_entry(p, b) for p, b in zip(np.split(x, len(books), 1), books, strict=True)]
    return np.stack([f[0] for f in found], 1), np.stack([f[1] for f in found], 1)


def _sums(dims: int, books: np.ndarray):
    """Worker: for each part and used entry the number and the sums of its vectors' parts, one line a task."""
    parts, entries, width = books.shape

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for batch in batches:
            x = matrix(batch.column("v"), dims)
            index, _ = encode(x, books)
            for p, part in enumerate(np.split(x, parts, 1)):
                np.add.at(count[p], index[:, p], 1)
                np.add.at(total[p], index[:, p], part)
        p, e = np.nonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(p.astype(np.int32)), pa.array(e.astype(np.int32)), pa.array(count[p, e]), *[pa.array(total[p, e, i]) for i in range(width)]], names=["part", "entry", "n", *[f"s{i}" for i in range(width)]])

    return work


def _codes(dims: int, books: np.ndarray):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            index, error = encode(matrix(batch.column("v"), dims), books)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), pa.array([r.tobytes().hex() for r in index.astype(np.uint8)], pa.string()), pa.array(error.sum(1))], names=["id", "label", "code", "error"])

    return work


def fit_codebooks(ints: DataFrame, books: np.ndarray, rounds: int) -> np.ndarray:
    """``rounds`` rounds of assignment and exact floor means over all rows of ``ints(v)``."""
    parts, _, width = books.shape
    schema = "part int, entry int, n long, " + ", ".join(f"s{i} long" for i in range(width))
    for _ in range(rounds):
        lines = ints.mapInArrow(_sums(parts * width, books), schema)
        lines = lines.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.col(f"s{i}").cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)])
        books = books.copy()
        for r in lines.collect():  # parts x entries lines
            books[r.part, r.entry] = [int(r[f"s{i}"]) // r.n for i in range(width)]
    return books


def compress_vectors(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, dims: int = 64, scale: int = 4096, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """The code of every usable vector: ``vec_id``, code, error, label_error, codebooks_sha256 (and the label, as ``label``)."""
    if dims % parts or not 0 < entries <= 256:
        raise ValueError("parts must divide dims, and an entry's number must fit two hex digits")
    kinds = {c: vectors.schema[c].dataType for c in (vec_id, label)}
    kept = vectors.where(usable(vector, dims)).select(F.col(vec_id).alias("id"), F.col(label).alias("label"), integers(vector, scale).alias("v"))
    ints = materialise(kept, "integers")
    first = first_vectors(ints, [F.col("id").asc_nulls_last(), F.col("v")], entries, dims)
    digest = ""
    if len(first):
        books = fit_codebooks(ints, first.reshape(len(first), parts, dims // parts).transpose(1, 0, 2), rounds)
        digest = hashlib.sha256(decimals(books).encode()).hexdigest()
        schema = T.StructType([T.StructField("id", kinds[vec_id]), T.StructField("label", kinds[label]), T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
        coded = materialise(ints.mapInArrow(_codes(dims, books), schema), "codes")
    else:
        coded = materialise(ints.select("id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), "codes")
    discard(ints)
    key = F.coalesce(F.concat(F.lit("0"), F.col("label").cast("string")), F.lit("1"))  # null labels are one
    keyed = coded.withColumn("key", key)
    sums = materialise(keyed.groupBy("key").agg(F.sum("error").alias("label_error"), F.count("*").alias("n")), "labels")
    out = join_counted(keyed, sums, ["key"], "n", coded.count())
    return out.select(F.col("id").alias(vec_id), F.col("label").alias(label), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
