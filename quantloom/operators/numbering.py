"""Codes 0, 1, ... of sorted values without one task that sorts them all."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quantloom.sources import scratch_path


def sorted_codes(values: DataFrame, c: str, out: str) -> DataFrame:
    """Distinct values of ``c`` that are not null with their place in the sorted list, as ``out``.

    Values are dealt by ranges and written once, so that ranges are the same for all later
    reads; each is numbered for itself and shifted by the sizes of the ranges before it
    (one row a range, broadcast).
    """
    spark = values.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "codes")
    ranged = values.select(c).where(F.col(c).isNotNull()).distinct().repartitionByRange(n, c)
    ranged.withColumn("_range", F.spark_partition_id()).write.parquet(path)
    ranged = spark.read.parquet(path)
    before = F.coalesce(F.sum("count").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = ranged.groupBy("_range").count().select("_range", before.alias("_start"))
    at = F.row_number().over(Window.partitionBy("_range").orderBy(c)) - 1 + F.col("_start")
    return ranged.join(F.broadcast(starts), "_range").select(c, at.cast("long").alias(out))


def ordinal_codes(df: DataFrame, c: str, out: str, missing: int = -1) -> DataFrame:
    """Adds the code of each value; ``missing`` for null."""
    return df.join(sorted_codes(df, c, out), c, "left").na.fill(missing, [out])
