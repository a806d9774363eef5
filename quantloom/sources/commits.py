"""Tables that are written in units: each unit as one partition, its completion in a manifest.

Data of a unit is written first, by dynamic partition overwrite, and then listed in the
manifest.  A run that ends in between leaves a unit that is not listed; the next run writes
it again, over what is there.  So a run can be repeated at any point and ends with the same
table, and units that are listed are not worked on again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quantloom.sources import read_directory, read_table

_MANIFEST = "unit string, rows bigint, run string"


def finished(spark: SparkSession, manifest: str) -> DataFrame:
    """Units listed so far: unit, rows, run."""
    return read_table(spark, manifest, schema=_MANIFEST)


def overwrite_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Writes the partitions that ``df`` has rows of; the others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "snappy").partitionBy(*by).parquet(path)


def process_units(df: DataFrame, unit: str, work: Callable[[DataFrame], DataFrame], out: str, manifest: str, run: str, only: Sequence[str] | None = None) -> DataFrame:
    """``work`` on the units of ``df`` that no earlier run has finished (of ``only``, if given), written to ``out``; returns the units of this run.

    ``work`` must keep the column ``unit``.  Null units are one unit, called ``__null__``.
    The manifest has a row for each unit with rows that was given, also where ``work`` left none.
    """
    spark = df.sparkSession
    named = df.withColumn(unit, F.coalesce(F.col(unit).cast("string"), F.lit("__null__")))
    if only is not None:
        named = named.where(F.col(unit).isin(list(only)))
    done = finished(spark, manifest).select(F.col("unit").alias(unit)).distinct()
    given = named.select(unit).distinct().join(done, unit, "left_anti")
    todo = [r[0] for r in given.collect()]  # names of units, not rows
    if not todo:
        return spark.createDataFrame([], _MANIFEST)
    pending = named.where(F.col(unit).isin(todo))
    overwrite_partitions(work(pending), out, [unit])
    written = spark.read.option("basePath", out).parquet(out).withColumn(unit, F.col(unit).cast("string")).where(F.col(unit).isin(todo))
    counts = given.join(written.groupBy(unit).agg(F.count("*").alias("rows")), unit, "left")
    listed = counts.select(F.col(unit).alias("unit"), F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"), F.lit(run).alias("run"))
    listed.coalesce(1).write.mode("append").parquet(manifest)  # a row a unit
    return finished(spark, manifest).where(F.col("run") == run)


def append_distinct(spark: SparkSession, path: str, new: DataFrame, by: Sequence[str]) -> DataFrame:
    """Adds the rows of ``new`` that the table does not have in full, and returns the table.

    Only the partitions that ``new`` touches are read and written again; a full duplicate is
    in the same partition as its original.  Running it again changes nothing.
    """
    by = list(by)
    touched = new.select(*by).distinct()
    try:
        old = spark.read.option("basePath", path).parquet(path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        old = new.limit(0)
    types = dict(new.dtypes)
    old = old.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in old.columns])
    same = [F.col(f"o.{c}").eqNullSafe(F.col(f"t.{c}")) for c in by]
    near = old.alias("o").join(touched.alias("t"), reduce(and_, same), "left_semi").select(*[F.col(f"o.{c}") for c in old.columns])
    overwrite_partitions(near.unionByName(new, allowMissingColumns=True).dropDuplicates(), path, by)
    return spark.read.option("basePath", path).parquet(path)


def compact(spark: SparkSession, folders: dict[str, Sequence[str]], out: str, manifest: str, run: str, rows_per_file: int = 5_000_000, dry_run: bool = False) -> DataFrame:
    """The files of each named folder as few large ones below ``out``, types made equal; the sources stay.

    A folder that the manifest lists is left alone; one whose count differs from its sources
    is an error and is not listed.  With ``dry_run`` nothing is written.  Returns (unit, rows, run) of
    this run.
    """
    done = {r.unit for r in finished(spark, manifest).select("unit").distinct().collect()}  # names of folders
    for name, files in folders.items():
        if name in done:
            continue
        table = read_directory(spark, files)
        if dry_run:
            continue
        target = f"{out}/{name}"
        table.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(target)
        n, want = spark.read.parquet(target).count(), table.count()
        if n != want:
            raise ValueError(f"{name}: {n} rows written of {want}")
        spark.createDataFrame([(name, n, run)], _MANIFEST).coalesce(1).write.mode("append").parquet(manifest)
    return finished(spark, manifest).where(F.col("run") == run)


def file_statistics(spark: SparkSession, path: str) -> DataFrame:
    """Rows, bytes and last change of each file of a table, a row a file; rows come from the footers, as no column is read."""
    files = spark.read.parquet(path).select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time")
    return files.groupBy("file_path", "file_size", "file_modification_time").agg(F.count("*").alias("rows"))


def columns_of(df: DataFrame) -> DataFrame:
    """Name, type and place of each column, from the schema alone."""
    items = [F.struct(F.lit(n).alias("column"), F.lit(t).alias("type"), F.lit(i).alias("place")) for i, (n, t) in enumerate(df.dtypes)]
    return df.sparkSession.range(1).select(F.explode(F.array(*items)).alias("c")).select("c.*")


def markdown(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """A table as lines of Markdown (line, content), in ``order``: built where the rows are, written by any sink."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("None"))
    head = df.sparkSession.range(2).select(F.col("id").cast("int").alias("line"), F.when(F.col("id") == 0, "| " + " | ".join(df.columns) + " |").otherwise("|" + " - |" * len(df.columns)).alias("content"))
    body = df.select((F.row_number().over(Window.orderBy(*order)) + 1).alias("line"), F.concat(F.lit("| "), F.concat_ws(" | ", *[text(c) for c in df.columns]), F.lit(" |")).alias("content"))
    return head.unionByName(body)
