"""Data-quality checks: each is one aggregate over the table, many share a scan."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quantloom.operators.quantiles import exact_quantiles
from quantloom.operators.stats import sample_kurtosis, sample_skewness


@dataclass(frozen=True)
class Check:
    """Share of rows that break a rule, and the share up to which it passes."""

    name: str
    broken: Column
    limit: float = 0.0
    severity: str = "ERROR"
    among: Column | None = None


def run_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One pass for all: rows (name, severity, passed, n, value)."""
    exprs = []
    for i, c in enumerate(checks):
        broken = F.coalesce(c.broken, F.lit(False))
        among = F.lit(True) if c.among is None else F.coalesce(c.among, F.lit(False))
        exprs += [F.count_if(broken & among).alias(f"b{i}"), F.count_if(among).alias(f"n{i}")]
    row = df.agg(*exprs)
    items = [F.struct(F.lit(c.name).alias("name"), F.lit(c.severity).alias("severity"), F.col(f"b{i}").alias("broken"), F.col(f"n{i}").alias("n"), F.lit(float(c.limit)).alias("limit")) for i, c in enumerate(checks)]
    out = row.select(F.explode(F.array(*items)).alias("c")).select("c.*")
    value = F.coalesce(F.try_divide(F.col("broken").cast("double"), F.col("n")), F.lit(0.0))
    return out.select("name", F.when(value <= F.col("limit"), "PASS").otherwise(F.col("severity")).alias("severity"), (value <= F.col("limit")).cast("long").alias("passed"), F.col("broken").alias("n"), F.round(value, 8).alias("value"))


@dataclass(frozen=True)
class Measure:
    """A number of a table, the range in which it passes (None: open), and what it is if it does not."""

    name: str
    value: Column
    least: float | None = None
    most: float | None = None
    severity: str = "ERROR"


def measure(df: DataFrame, measures: Sequence[Measure]) -> DataFrame:
    """One aggregate for all: rows (name, severity, passed, value); a missing value passes."""
    row = df.agg(*[m.value.cast("double").alias(f"v{i}") for i, m in enumerate(measures)])
    none = F.lit(None).cast("double")
    items = [F.struct(F.lit(m.name).alias("name"), F.lit(m.severity).alias("severity"), F.col(f"v{i}").alias("value"), (none if m.least is None else F.lit(float(m.least))).alias("least"), (none if m.most is None else F.lit(float(m.most))).alias("most")) for i, m in enumerate(measures)]
    out = row.select(F.explode(F.array(*items)).alias("m")).select("m.*")
    fits = F.coalesce(F.col("value") >= F.col("least"), F.lit(True)) & F.coalesce(F.col("value") <= F.col("most"), F.lit(True))
    return out.select("name", F.when(fits, "PASS").otherwise(F.col("severity")).alias("severity"), fits.cast("long").alias("passed"), F.round("value", 6).alias("value"))


def profile(df: DataFrame, columns: Sequence[str], extended: bool = False) -> DataFrame:
    """Count, nulls, extremes, mean, deviation and median of numeric columns, a row each; medians by distributed selection, the rest from one aggregate."""
    medians = exact_quantiles(df, columns, (0.5,))
    parts = []
    for c in columns:
        x = F.col(c).cast("double")
        e = [F.lit(c).alias("column"), F.count(c).alias("n"), F.count_if(F.col(c).isNull()).alias("nulls"), F.count_distinct(c).alias("kinds"), F.min(x).alias("lo"), F.max(x).alias("hi"), F.round(F.avg(x), 4).alias("mean"), F.round(F.stddev_samp(x), 4).alias("std"), F.round(F.lit(medians[c][0]).cast("double"), 4).alias("median")]
        if extended:
            e += [F.count_if(x == 0).alias("zeros"), F.round(sample_skewness(c), 4).alias("skew"), F.round(sample_kurtosis(c), 4).alias("kurt")]
        parts.append(F.struct(*e))
    return df.agg(F.array(*parts).alias("p")).select(F.explode("p").alias("p")).select("p.*")


def same_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of each side that the other lacks, duplicates counted."""
    return a.exceptAll(b).agg(F.count("*").alias("n")).select(F.lit("left").alias("side"), "n").union(b.exceptAll(a).agg(F.count("*").alias("n")).select(F.lit("right"), "n"))
