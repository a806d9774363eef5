"""Mixing of sources to target weights by capped water-filling, with seeded whole and fractional repetitions.

All of it is DataFrame functions.  Sources are numbered by sorted ranges, their targets come
from rounds of one-row aggregates, and what a source repeats in part is found by a
selection over hash buckets: no task ever holds a source.

Defined cases: a null or empty text has size 0 and gives nothing; null sources are one
source, numbered last; rows equal in ``doc_id`` and text are dealt alike (rows of equal
hash share what is left of a target in proportion to their sizes, rounded down); a null
``doc_id`` is an id like others; an empty table stays empty; a source of size 0 has target
0; extra columns stay (those called like a result give way to it), helper columns have
names that no column has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantloom.llm._spark import discard, fresh, join_counted, materialise, partitions_of

#: A word, and the characters between words.
WORD, BETWEEN = r"[^\x20\x09-\x0D]+", " \t\n\x0b\f\r"
#: Hex digits of a hash that name its bucket: 4096 buckets a source.
DIGITS = 3
#: Lines of the plan (some 100 bytes each) that are broadcast at most; sources of fewer than 1/100,000 of all rows are shuffled.
BROADCAST_SOURCES = 100_000
ADDED = ("size", "source_size", "target", "taken")


def n_words(text: Column | str) -> Column:
    """Words of a text, without making an array of them; null has none."""
    marks = F.translate(F.regexp_replace(text, WORD, "x"), BETWEEN, "")
    return F.coalesce(F.length(marks).cast("long"), F.lit(0).cast("long"))


def source_key(source: Column | str) -> Column:
    """Sorts as the source does by code point, null last, and is never null."""
    return F.coalesce(F.concat(F.lit("0"), F.col(source) if isinstance(source, str) else source), F.lit("1"))


def numbered(keys: DataFrame, key: str, out: str) -> DataFrame:
    """Rows of distinct ``key`` with their places 0, 1, ... in its order: ranges are numbered apart and shifted by the sizes of those before."""
    n = partitions_of(keys)
    ranged = materialise(keys.repartitionByRange(n, key).withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = ranged.groupBy("_range").count()  # one row a partition
    before = F.sum("count").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_range", F.coalesce(before, F.lit(0)).alias("_start"))
    at = F.row_number().over(Window.partitionBy("_range").orderBy(key)) - 1 + F.col("_start")
    return ranged.join(F.broadcast(starts), "_range").withColumn(out, at.cast("long")).drop("_range", "_start")


def water_fill(sources: DataFrame, share_pct: int, max_epochs: int) -> DataFrame:
    """Adds ``target`` to rows of (``_size``, ``_weight``): ``share_pct`` percent of all sizes dealt by weight, none above ``max_epochs`` times its size.

    Each round deals what the clamped sources leave to the others by weight and clamps those
    that would exceed their cap; it ends when none does.  A round is one aggregate of exact
    integers; the level rises, so a clamped source stays clamped, and the rounds are at most
    as many as sources, in practice a few.
    """
    big = lambda c: F.col(c).cast("decimal(38,0)")
    total = sources.agg(F.sum(big("_size"))).first()[0] or 0
    pool, clamped, weight = share_pct * int(total), 0, None
    cap = F.col("_size") * max_epochs
    while weight != 0:
        left = pool - 100 * clamped  # hundredths of words
        if weight is None:
            full = F.lit(False)
        else:
            full = cap.cast("decimal(38,0)") * F.lit(100 * weight).cast("decimal(38,0)") <= F.lit(left).cast("decimal(38,0)") * F.col("_weight")
        row = sources.agg(F.sum(F.when(full, cap.cast("decimal(38,0)"))).alias("c"), F.sum(F.when(~full, big("_weight"))).alias("w")).first()
        now = (int(row.c or 0), int(row.w or 0))
        if weight is not None and now == (clamped, weight):
            break
        clamped, weight = now
    left = pool - 100 * clamped
    if not weight:
        return sources.withColumn("target", cap.cast("double"))
    level = (F.lit(left).cast("decimal(38,0)") * F.col("_weight")).cast("double") / F.lit(float(100 * weight))
    full = cap.cast("decimal(38,0)") * F.lit(100 * weight).cast("decimal(38,0)") <= F.lit(left).cast("decimal(38,0)") * F.col("_weight")
    return sources.withColumn("target", F.when(full, cap.cast("double")).otherwise(level))


def mix_sources(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), share_pct: int = 150, max_epochs: int = 2, seed: int = 11, text: str = "text", source: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """The columns of ``docs`` with ``size``, ``source_size``, ``target`` and ``taken``.

    ``weights`` go to the sources in order, repeating.  A source takes its target rounded to
    a word: every document ``target // size of the source`` times whole, and once more the
    documents of smallest seeded hash, up to the one in which the rest ends and which gives
    its first words only.  So a source misses its target by less than a word (more only where
    rows of equal hash share that place), no document is taken over ``max_epochs`` times, and
    a rerun takes the same.

    The place where a rest ends is found by sums of hash buckets, then within the one
    bucket: the largest window has 1/4096 of a source.  Rows meet their source's line by
    ``join_counted``, so a source of a third of all rows stays where it is.
    """
    size, key, h, held = (fresh(docs, x) for x in ("size_", "key_", "hash_", "plan_"))
    ident = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.coalesce(F.col(text), F.lit("")))
    slim = docs.select(n_words(text).alias("_size"), source_key(source).alias("_key"), F.md5(ident).alias("_hash"))
    slim = materialise(slim.withColumn("_bucket", F.substring("_hash", 1, DIGITS)), "sizes")

    buckets = materialise(slim.groupBy("_key", "_bucket").agg(F.sum("_size").alias("_words"), F.count("*").alias("_rows")), "buckets")
    sources = numbered(buckets.groupBy("_key").agg(F.sum("_words").alias("_size"), F.sum("_rows").alias("_rows")), "_key", "_no")
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("_no") % len(weights)).cast("int") + 1)
    sources = materialise(sources.withColumn("_weight", weight.cast("long")), "sources")
    plan = water_fill(sources, share_pct, max_epochs).withColumn("_take", F.round("target").cast("long"))
    plan = plan.withColumn("_whole", F.coalesce(F.expr("_take div nullif(_size, 0)"), F.lit(0)))
    targets = materialise(plan.withColumn("_rest", F.col("_take") - F.col("_whole") * F.col("_size")), "targets")

    def crossing(groups: DataFrame, unit: str) -> DataFrame:
        """Of each source the ``unit`` in which the rest ends, with what is left of it there."""
        upto = F.sum("_words").over(Window.partitionBy("_key").orderBy(unit).rowsBetween(Window.unboundedPreceding, 0))
        marked = groups.withColumn("_upto", upto).where("_upto >= _rest and _upto - _words < _rest")
        return marked.select("_key", unit, (F.col("_rest") - F.col("_upto") + F.col("_words")).alias("_rest"), "_words")

    total = targets.agg(F.sum("_rows")).first()[0] or 0
    ends = crossing(buckets.drop("_rows").join(targets.select("_key", "_rest"), "_key"), "_bucket").drop("_words").join(targets.select("_key", "_rows"), "_key")
    inside = join_counted(slim.where("_size > 0"), materialise(ends, "ends"), ["_key", "_bucket"], "_rows", total, BROADCAST_SOURCES)
    last = crossing(inside.groupBy("_key", "_hash", "_rest").agg(F.sum("_size").alias("_words")), "_hash")
    plan = targets.join(last.select("_key", F.col("_hash").alias("_last"), F.col("_rest").alias("_part"), F.col("_words").alias("_shared")), "_key", "left")
    planned = F.struct("_size", "target", "_whole", "_last", "_part", "_shared")
    mixed = materialise(plan.select(F.col("_key").alias(key), planned.alias(held), "_rows"), "mix")
    discard(slim, buckets, sources, targets)

    # Sizes and hashes are made again behind the join: what is broadcast is at most BROADCAST_SOURCES lines.
    rows = join_counted(docs.withColumn(key, source_key(source)), mixed.withColumnRenamed("_rows", h), [key], h, total, BROADCAST_SOURCES)
    rows = rows.withColumns({size: n_words(text), h: F.md5(ident)})
    p = lambda c: F.col(held)[c]
    part = F.expr(f"(cast(`{size}` as decimal(19,0)) * cast(`{held}`._part as decimal(19,0))) div cast(`{held}`._shared as decimal(19,0))")
    more = F.when(F.col(h) < p("_last"), F.col(size)).when(F.col(h) == p("_last"), part).otherwise(0)
    return rows.select(
        *[F.col(c) for c in docs.columns if c not in ADDED],
        F.col(size).alias("size"),
        p("_size").alias("source_size"),
        p("target").alias("target"),
        (p("_whole") * F.col(size) + more).cast("long").alias("taken"),
    )


def repeat_documents(mixed: DataFrame, text: str = "text") -> DataFrame:
    """The mix itself: each row of ``mix_sources`` once for each time it is taken (``copy`` 0, 1, ...), its text cut to its first words where it is taken in part.

    The words of a cut text are joined by single spaces; a document of which nothing is taken goes.
    """
    copies = mixed.where("taken > 0").withColumn("copy", F.explode(F.sequence(F.lit(0), (F.ceil(F.col("taken") / F.col("size")) - 1).cast("int"))))
    left = F.col("taken") - F.col("copy") * F.col("size")
    cut = F.concat_ws(" ", F.slice(F.regexp_extract_all(F.col(text), F.lit(WORD), 0), F.lit(1), left.cast("int")))
    return copies.withColumn(text, F.when(left >= F.col("size"), F.col(text)).otherwise(cut))
