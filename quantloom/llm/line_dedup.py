"""Line dedup by distinct-site spread.

For every line a HyperLogLog sketch of the sites that carry it is kept by hash and
merged by aggregation.  Lines whose estimate is clearly above the threshold are
boilerplate, those clearly below are not; those near it get an exact distinct count.
Boilerplate goes everywhere but from its keeper, the smallest ``doc_id`` that has it,
so that no text is lost altogether.

A line is what stands between line feeds, trimmed of white space; blank lines stay.

Defined cases: a null text has no lines and stays null; a null site is no site; a
null ``doc_id`` is no keeper unless no other has the line; rows repeated are judged
alike; a very long text is split where it lies, only hashes of its lines move; an empty
table gives no rows; other columns are kept as they are, but for ``n_lines`` and
``n_removed``, whose old values are replaced.  Lines on more than their share of the rows
are joined by broadcast (``join_counted``), so no line is one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantloom.llm._spark import fresh, join_counted, materialise, row_hash

MIN_SITES, LOG_K = 8, 10


def _key(line: Column) -> Column:
    """128 bits that name a line."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.reverse(line), F.length(line)).alias("b"))


def line_spread(docs: DataFrame, min_sites: int = MIN_SITES, log_k: int = LOG_K) -> tuple[DataFrame, DataFrame]:
    """The lines of all rows (doc_id, row_hash, at, a, b, site), and the boilerplate lines (a, b, keeper, n: rows that have it)."""
    lines = F.transform(F.split("text", "\n", -1), lambda x, i: F.struct(i.alias("at"), _key(F.trim(F.regexp_replace(x, r"^\s+|\s+$", ""))).alias("k"), F.length(F.regexp_replace(x, r"\s+", "")).alias("n")))
    rows = docs.select("doc_id", row_hash("text").alias("row_hash"), F.col("source").alias("site"), F.explode(lines).alias("l")).where("l.n > 0")
    rows = materialise(rows.select("doc_id", "row_hash", "site", "l.at", "l.k.a", "l.k.b"), "lines")
    sketched = rows.groupBy("a", "b").agg(F.hll_sketch_agg(F.coalesce("site", F.lit("")), log_k).alias("sketch"), F.count("*").alias("n"), F.min("doc_id").alias("keeper"))
    # A line on fewer rows than the threshold cannot reach it; a null site counts as one here and not below.
    band = max(1.0, 4 * 1.04 / 2 ** (log_k / 2) * min_sites)
    sized = sketched.where(F.col("n") >= min_sites).select("a", "b", "keeper", "n", F.hll_sketch_estimate("sketch").alias("spread")).where(F.col("spread") >= min_sites - band)
    sized = materialise(sized, "spread")
    sure = sized.where(F.col("spread") > min_sites + 1 + band).select("a", "b", "keeper", "n")
    near = sized.where(F.col("spread") <= min_sites + 1 + band)
    exact = join_counted(rows, near.select("a", "b", "n"), ["a", "b"], "n", rows.count()).groupBy("a", "b").agg(F.count_distinct("site").alias("sites")).where(F.col("sites") >= min_sites)
    return rows, sure.unionByName(near.join(exact.select("a", "b"), ["a", "b"]).select("a", "b", "keeper", "n"))


def remove_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, log_k: int = LOG_K) -> DataFrame:
    """``docs`` (doc_id, text, source, ...) with boilerplate lines cut out of ``text``.

    ``n_chars``, if there, follows the new text.  Adds ``n_lines`` (not blank) and ``n_removed``.
    """
    rows, bad = line_spread(docs, min_sites, log_k)
    docs = docs.drop("n_lines", "n_removed")
    doc, own, cut = (fresh(docs, x) for x in ("gone_doc", "gone_hash", "gone"))
    gone = join_counted(rows, bad, ["a", "b"], "n", rows.count()).where("keeper is not null and (doc_id is null or doc_id <> keeper)")
    gone = gone.groupBy(F.col("doc_id").alias(doc), F.col("row_hash").alias(own)).agg(F.collect_set("at").alias(cut))
    both = docs.join(gone, F.col("doc_id").eqNullSafe(F.col(doc)) & (row_hash("text") == F.col(own)), "left")
    parts = F.split("text", "\n", -1)
    dead = F.coalesce(cut, F.array().cast("array<int>"))
    both = both.withColumn("n_lines", F.coalesce(F.size(F.filter(parts, lambda x: x.rlike(r"\S"))), F.lit(0)).cast("long")).withColumn("n_removed", F.size(dead).cast("long"))
    alive = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), dead)  # hashed: linear in the lines
    kept = F.array_join(F.transform(alive, lambda i: F.get(parts, i)), "\n")
    both = both.withColumn("text", F.when(F.col("n_removed") > 0, kept).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        both = both.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return both.select(*docs.columns, "n_lines", "n_removed")
