"""Table sources and sinks."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantloom.schema import existing


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``, which driver and executors share; a temporary folder only where it is unset and all runs in one machine."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="quantloom-"))
        root = spark.sparkContext.getCheckpointDir()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written_once(df: DataFrame, name: str) -> DataFrame:
    """``df`` as Parquet below the shared folder, read back: what several results read is made once."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None, schema: str | None = None) -> DataFrame:
    """Parquet with the declared columns that exist; a missing path gives an empty frame of ``schema``."""
    try:
        df = spark.read.parquet(path)
    except AnalysisException as e:
        if schema is None or "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)
    return df if columns is None else df.select(*existing(df, columns))


def read_directory(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Union by name of files whose columns or types disagree: to double among numbers, else to string."""
    parts = [spark.read.parquet(p) for p in paths]
    kinds: dict[str, set[str]] = {}
    for p in parts:
        for c, t in p.dtypes:
            kinds.setdefault(c, set()).add(t)
    numbers = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    target = {c: next(iter(t)) if len(t) == 1 else ("double" if t <= numbers else "string") for c, t in kinds.items()}
    parts = [p.select(*[F.col(c).cast(target[c]).alias(c) for c in p.columns]) for p in parts]
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


#: Rows of a task in which a few windows sort and hold what they need.
ROWS_A_TASK = 50_000


def parts_of(rows: DataFrame) -> int:
    """Partitions of about ``ROWS_A_TASK`` rows, one a core at least, so that a task does not grow with the table; ``rows`` is a plain scan, counted by the footers of its files."""
    return max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // ROWS_A_TASK))


def bound_batches(spark: SparkSession, rows: int = 1000, size: int = 8 << 20) -> None:
    """Arrow batches of at most ``rows`` rows and about ``size`` bytes, for tables of whole texts: what a worker and the JVM hold at a time is bounded by them."""
    for name, most in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", size)):
        name = f"spark.sql.execution.arrow.{name}"
        now = int(str(spark.conf.get(name)).rstrip("b") or 0)
        if now <= 0 or now > most:
            spark.conf.set(name, str(most))


def spread(df: DataFrame) -> DataFrame:
    """At least as many partitions as cores, for work that costs more than the rows' way: a file of one row group is one task otherwise.

    Such work is done on whole texts in Python workers: Arrow batches are bounded.
    """
    bound_batches(df.sparkSession)
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def write_table(df: DataFrame, path: str, by: Sequence[str] = (), mode: str = "overwrite") -> None:
    writer = df.write.mode(mode).option("compression", "snappy")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def split_table(df: DataFrame, path: str, by: str) -> None:
    """One folder per value of ``by``; rows of a value are spread over as many files as it has tasks, so no value is one task."""
    write_table(df, path, [by])


def by_month(df: DataFrame, day: str) -> DataFrame:
    """Adds year and month, for a sink partitioned by them and scans pruned by them."""
    return df.withColumns({"year": F.year(day), "month": F.month(day)})


def pending(df: DataFrame, processed: DataFrame, on: str) -> DataFrame:
    """Rows whose id is not in the table of processed ids: a batch that can be resumed."""
    return df.join(processed.select(on).distinct(), on, "left_anti")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def save_model(model, path: str) -> None:
    """A fitted ``pyspark.ml`` model as its own files; its class reads them with ``load``."""
    model.write().overwrite().save(path)


def score_with(df: DataFrame, text: str, scorer: Callable | None = None, name: str = "score") -> DataFrame:
    """Adds what ``scorer`` (a function from a series of texts to a series of numbers) says of each text.

    The place of a language model: it is called once per Arrow batch on the workers.
    Without one, the score is the number of characters, by column functions.
    """
    if scorer is None:
        return df.withColumn(name, F.coalesce(F.length(text), F.lit(0)).cast("double"))

    bound_batches(df.sparkSession)

    def work(batches):
        for batch in batches:
            yield batch.assign(**{name: scorer(batch[text])})

    schema = ", ".join(f"`{c}` {t}" for c, t in [*df.dtypes, (name, "double")])
    return df.mapInPandas(work, schema)
