"""Exact dedup by content-defined chunk recipes.

Each text is cut where a rolling hash of its last bytes says so; a chunk is named
by a 64-bit hash and *verified* by SHA-256: chunks that share the hash but not the
digest get different identifiers.  A document becomes the ordered list of its
chunks' identifiers (its recipe).  Only chunk names and recipes are shuffled, a
long document never moves.  Equal recipes are equal texts.

Defined cases: a null text counts as empty; an empty text has the empty recipe
and equals other empty texts; a null ``doc_id`` never wins over a real one; rows
that repeat the winning ``doc_id`` with the same text are one row written twice
and all carry ``kept``; a very long text is one recipe of many chunks; an empty table
gives no rows; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantloom.llm import _kernels as K
from quantloom.llm._spark import join_counted, materialise

#: Bytes that the rolling hash sees, bits that a cut has at zero (chunks of about 2 KB beyond the least), least and largest chunk.
WINDOW, CUT_BITS, LEAST, LARGEST = 48, 11, 512, 16384


def cut_points(data: np.ndarray) -> list[int]:
    """Ends of the chunks of one text; they depend on nearby content alone, but for the largest size."""
    n = len(data)
    if n <= LEAST:
        return [n] if n else []
    ends, last = [], 0
    sums, down = K.prefix(K._CODES[data], K._BYTES)
    lo = np.arange(n - WINDOW + 1)
    h = K.spans_hash(sums, down, lo, lo + WINDOW)
    for c in (np.flatnonzero(h >> np.uint64(64 - CUT_BITS) == 0) + WINDOW).tolist():
        while c - last > LARGEST:
            last += LARGEST
            ends.append(last)
        if c - last >= LEAST:
            ends.append(c)
            last = c
    while n - last > LARGEST:
        last += LARGEST
        ends.append(last)
    if last < n:
        ends.append(n)
    return ends


def recipes(lower: bool = True):
    """Worker: doc_id, digest of the normalised text, chunk hashes and chunk digests in order."""

    schema = pa.schema([("doc_id", pa.int64()), ("text_sha256", pa.string()), ("hashes", pa.list_(pa.int64())), ("digests", pa.list_(pa.binary()))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = K.texts(batch.column("text"))
            sha, hashes, digests = [], [], []
            for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                part = K.UPPER[data[lo:hi]] if lower else data[lo:hi]
                raw, last, hs, ds = part.tobytes(), 0, [], []
                for end in cut_points(part):
                    piece = raw[last:end]
                    hs.append(xxhash.xxh3_64_intdigest(piece) - (1 << 63))
                    ds.append(hashlib.sha256(piece).digest())
                    last = end
                sha.append(hashlib.sha256(raw).hexdigest())
                hashes.append(hs)
                digests.append(ds)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(sha, pa.string()), pa.array(hashes, schema.field("hashes").type), pa.array(digests, schema.field("digests").type)], schema=schema)

    return work


def exact_dedup(docs: DataFrame, lower: bool = True) -> DataFrame:
    """Group the rows of ``docs(doc_id, text)`` by equal text; the largest ``doc_id`` of a group stays.

    Returns doc_id, keep_id, group_size, kept, text_sha256, n_chunks for every row.
    """
    found = materialise(
        docs.select("doc_id", "text").mapInArrow(recipes(lower), "doc_id long, text_sha256 string, hashes array<long>, digests array<binary>"),
        "recipes",
    )
    # A hash with more than one digest is a collision: its chunks are told apart by the digest.
    chunks = found.select(F.explode(F.arrays_zip("hashes", "digests")).alias("c")).select("c.hashes", "c.digests")
    clash = chunks.groupBy("hashes").agg(F.min("digests").alias("a"), F.max("digests").alias("b")).where("a <> b").select("hashes")
    if clash.isEmpty():
        named = found.withColumn("recipe", F.col("hashes"))
    else:
        named = _with_clashes(found, clash)
    named = named.select("doc_id", "text_sha256", F.size("hashes").cast("long").alias("n_chunks"), F.xxhash64("recipe").alias("bucket"), "recipe")
    groups = named.groupBy("bucket", "recipe").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"), F.first("text_sha256").alias("text_sha256"))
    # Equal recipes are one text, so its digest names the group: what goes back to the rows is short however long the recipe.
    groups = groups.select("text_sha256", "keep_id", "group_size", F.col("group_size").alias("rows"))
    both = join_counted(named.drop("bucket", "recipe"), groups, ["text_sha256"], "rows", found.count())
    return both.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256", "n_chunks")


def _with_clashes(found: DataFrame, clash: DataFrame) -> DataFrame:
    """Recipes where the chunks of clashing hashes are named by hash and digest."""
    rows = found.withColumn("rid", F.struct("doc_id", "text_sha256"))
    parts = rows.select("rid", F.posexplode(F.arrays_zip("hashes", "digests")).alias("at", "c")).distinct()
    parts = parts.select("rid", "at", F.col("c.hashes").alias("h"), F.col("c.digests").alias("d"))
    parts = parts.join(clash.select(F.col("hashes").alias("h"), F.lit(True).alias("bad")), "h", "left")
    parts = parts.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("at", "h", F.when(F.col("bad"), F.col("d")).alias("d")))).alias("l"))
    parts = parts.select("rid", F.transform("l", lambda x: F.struct(x["h"].alias("h"), x["d"].alias("d"))).alias("recipe"))
    out = rows.join(parts, rows["rid"].eqNullSafe(parts["rid"]), "left").drop(parts["rid"])
    return out.withColumn("recipe", F.coalesce("recipe", F.array().cast("array<struct<h:bigint,d:binary>>")))
