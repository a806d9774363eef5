"""Walk-forward folds and factor evaluation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quantloom.operators import xsec
from quantloom.operators.stats import safe_corr, two_sided_p


def fold_table(days: DataFrame, day: str, train_months: int, valid_months: int, gap: int, kind: str = "rolling", warm_up: int = 0) -> DataFrame:
    """Fold ranges over a calendar: fold, train_start, train_end, valid_start, valid_end, train_warm, valid_warm.

    ``gap`` open days lie between training and validation; ``warm_up`` days before each range feed
    sequences.  Folds end before the first whose validation has under half of its span.
    Training starts at the first day (``expanding``) or moves along (``rolling``).  The
    calendar is one sorted list in one row; folds are numbers exploded beside it.
    """
    line = days.agg(F.sort_array(F.collect_set(day)).alias("days")).where(F.size("days") > 0)
    first, last = F.get("days", F.lit(0)), F.element_at("days", -1)
    k = line.select("days", F.explode(F.sequence(F.lit(0), F.floor(F.months_between(last, first) / valid_months).cast("int") + 1)).alias("fold"))
    moved = F.col("fold") * valid_months
    k = k.withColumn("train_start", first if kind == "expanding" else F.add_months(first, moved)).withColumn("train_end", F.date_sub(F.add_months(first, moved + train_months), 1))
    before = lambda c, strict: F.size(F.filter("days", lambda d: (d < F.col(c)) if strict else (d <= F.col(c))))
    k = k.withColumn("_at", before("train_end", False) + gap)
    k = k.withColumn("valid_start", F.get("days", F.col("_at"))).withColumn("valid_end", F.least(F.add_months("train_end", valid_months), last))
    whole = F.coalesce(F.datediff("valid_end", "valid_start") >= 15 * valid_months, F.lit(False)).cast("int")
    k = k.withColumn("_whole", F.min(whole).over(Window.orderBy("fold").rowsBetween(Window.unboundedPreceding, 0))).where("_whole = 1")  # a row a fold
    warm = lambda at: F.get("days", F.greatest(F.lit(0), at - warm_up))
    return k.select(F.col("fold").cast("long").alias("fold"), "train_start", "train_end", "valid_start", "valid_end", warm(before("train_start", True)).alias("train_warm"), warm(F.col("_at")).alias("valid_warm"))


def daily_ic(pairs: DataFrame, by: str, y: str, p: str) -> DataFrame:
    """Pearson correlation per day of at least three pairs; days without one are left out."""
    g = pairs.groupBy(by).agg(safe_corr(y, p).alias("ic"), F.count("*").alias("_n")).where("_n >= 3").drop("_n")
    return g.where(F.col("ic").isNotNull() & ~F.isnan("ic"))


def daily_rank_ic(pairs: DataFrame, by: str, y: str, p: str) -> DataFrame:
    ranked = pairs.select(by, xsec.average_rank(F.col(y), by).alias("_a"), xsec.average_rank(F.col(p), by).alias("_b"))
    return daily_ic(ranked, by, "_a", "_b").withColumnRenamed("ic", "rank_ic")


def ic_summary(ic: DataFrame, c: str) -> DataFrame:
    """Number, mean, deviation, ratio, share above zero, t statistic and its two-sided p-value: one row."""
    n, mean, std = F.count(c), F.avg(c), F.stddev_samp(c)
    row = ic.agg(n.alias("n"), mean.alias("mean"), std.alias("std"), F.try_divide(mean, std).alias("icir"), F.avg((F.col(c) > 0).cast("int")).alias("positive"), F.try_divide(mean, std / F.sqrt(n)).alias("t"))
    return row.withColumn("p", two_sided_p(F.col("t"), F.col("n") - 1)).select("n", *[F.round(x, 5 if x == "t" else 6).alias(x) for x in ("mean", "std", "icir", "positive", "t", "p")])


def group_returns(pairs: DataFrame, by: str, y: str, p: str, q: int, tie: Column) -> DataFrame:
    """Mean return of each quantile bucket of the prediction per day; days of fewer rows than buckets are skipped."""
    g = pairs.withColumn("grp", xsec.quantile_bucket(F.col(p), by, q, tie))
    g = g.withColumn("_n", F.count("*").over(Window.partitionBy(by))).where(F.col("_n") >= q)
    return g.groupBy(by, "grp").agg(F.avg(y).alias("r"))


def long_short(groups: DataFrame, by: str, q: int) -> DataFrame:
    pick = lambda k: F.max(F.when(F.col("grp") == k, F.col("r")))
    return groups.groupBy(by).agg((pick(q) - pick(1)).alias("ls"))


def ensemble(rolling: Sequence[Column], full: Column, w_rolling: float = 0.4, w_full: float = 0.6) -> Column:
    """Weighted mean of the rolling models' mean and the full model, weights made to sum to one."""
    mean = sum(rolling[1:], rolling[0]) / len(rolling)
    return (w_rolling * mean + w_full * full) / (w_rolling + w_full)
