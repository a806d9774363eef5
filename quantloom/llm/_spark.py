"""Spark helpers shared by the corpus operators: tables in the shared folder and graph components."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quantloom.sources import bound_batches  # noqa: F401  (the operators take it from here)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only where the setting is absent and all runs in one machine (``local``
    masters, as in tests) a temporary folder is made and becomes the session's
    checkpoint folder; on a cluster its absence is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        found = spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="quantloom-"))
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back.

    The copy cuts the lineage: a lost executor costs the re-reading of files,
    never a second run of what made them.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    collect_driver(df.sparkSession)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written = path
    return out


def discard(*written: DataFrame) -> None:
    """Delete the files of tables that ``materialise`` wrote and that no later result reads."""
    for df in written:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._written)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or with signs added what no column of ``df`` is called."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def return_memory() -> None:
    """Gives freed memory of this process back to the system, where the C library can."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def collect_driver(spark: SparkSession, share: float = 0.6) -> None:
    """Collects the driver's heap where it has grown beyond ``share`` of its limit, so that the JVM gives it back.

    Every scan, stage and broadcast join of a plan takes a few MB of the driver for a moment.  Many at a time make
    the heap grow up to its limit though little of it lives, and what Spark holds for past shuffles and
    broadcasts it cleans only when their handles are collected.
    """
    heap = spark.sparkContext._jvm.java.lang.Runtime.getRuntime()
    if heap.totalMemory() > share * heap.maxMemory():
        gc.collect()  # frames that Python no longer names are held for it in the driver
        spark.sparkContext._jvm.java.lang.System.gc()


def partitions_of(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def row_hash(text: Column | str) -> Column:
    """64-bit hash of a text; with ``doc_id`` it names a row, repeated rows alike."""
    return F.xxhash64(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[k])
    return cond


def join_counted(rows: DataFrame, keyed: DataFrame, keys: list[str], weight: str, total: int, share: int | None = None) -> DataFrame:
    """Inner join of ``rows`` with ``keyed`` (one row a key, no null keys), even where one key holds most rows.

    ``weight`` is how many of ``total`` rows hold the key.  Fewer than ``share`` keys can
    hold more than 1/``share`` of them: that many at most are broadcast, so that their
    rows stay where they are; the rows of the other keys are shuffled.  By default
    ``share`` is four times the shuffle partitions, 1000 at least: no key left to the
    shuffle fills over a quarter of a mean task, and what is broadcast is bounded by the
    number of tasks, not by the data.
    """
    heavy = F.col(weight) * (share or max(1000, 4 * partitions_of(rows))) > total
    hot, rest = keyed.where(heavy).drop(weight), keyed.where(~heavy).drop(weight)
    others = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(rest, keys)
    return rows.join(F.broadcast(hot), keys).unionByName(others)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Label every node of ``edges(u, v)`` with the smallest node it reaches.

    Alternates large-star and small-star steps (Kiveris et al., 2014) until the
    edge set is stable.  All steps are joins and aggregations; each step and its
    minima are written to the shared folder, for ``join_counted`` reads both of its
    sides several times: in one plan a round would read the edges fifty times over,
    and the driver holds and logs whole plans.  The files of a round are deleted
    after it.  A hub of many edges is joined by broadcast (``join_counted``).  Rows
    with a null end are ignored, an empty input gives an empty result; edges that
    still change after ``max_rounds`` rounds (far more than any number of nodes
    needs) are an error.  Returns ``(node, root)``.
    """
    e = edges.select(F.col("u").alias("u"), F.col("v").alias("v")).where("u <> v")
    e = materialise(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc")
    before, n = None, e.count()
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = materialise(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count("*").alias("n")), "cc-low")
        large = materialise(join_counted(both, low, ["u"], "n", 2 * n).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct(), "cc-large")
        least = materialise(large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")), "cc-low")
        small = (
            join_counted(large, least, ["u"], "n", n)
            .select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("x"))
            .select(F.col("x.v").alias("u"), F.col("x.m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        last, e = e, materialise(small, "cc")
        discard(last, low, large, least)
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before, n = now, now[0]
    else:
        raise RuntimeError(f"components still change after {max_rounds} rounds")
    roots = e.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct()).distinct()
