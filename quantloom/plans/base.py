"""Registry and the proxy tables that the plans share.

The driver's tables stand in for market data: suppliers are codes, shipping days are
trading days, prices are unit prices of lines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quantloom.operators.calendar import calendar_dim
from quantloom.sources import parts_of

Plan = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Plan] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Plan], Plan]:
    """Register a plan and, where SQL can express it, its twin."""

    def keep(fn: Plan) -> Plan:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def panel_parts(spark: SparkSession, sf: str) -> int:
    """Partitions of tables with about a row a line."""
    return parts_of(table(spark, sf, "lineitem"))


def price_panel(spark: SparkSession, sf: str) -> DataFrame:
    """Sparse panel (code, d): high, low, open, close, vol, amount; dealt by code, in partitions that do not grow with the table.

    Hardly two lines share a code and day, so nothing is lost by dealing the lines: days and
    windows of a code need no shuffle after this one.
    """
    line = table(spark, sf, "lineitem", "l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")
    line = line.select(
        F.col("l_suppkey").alias("code"),
        F.col("l_shipdate").cast("date").alias("d"),
        "l_orderkey",
        "l_linenumber",
        F.try_divide("l_extendedprice", "l_quantity").alias("px"),
        F.col("l_quantity").alias("q"),
        F.col("l_extendedprice").alias("a"),
    )
    line = line.repartition(panel_parts(spark, sf), "code")
    order = F.struct("l_orderkey", "l_linenumber", "px")
    out = line.groupBy("code", "d").agg(F.max("px").alias("high"), F.min("px").alias("low"), F.min(order).alias("o"), F.max(order).alias("c"), F.sum("q").alias("vol"), F.round(F.sum("a"), 2).alias("amount"))
    return out.select("code", "d", "high", "low", F.col("o.px").alias("open"), F.col("c.px").alias("close"), "vol", "amount")


def with_day_volume(rows: DataFrame, spark: SparkSession, sf: str, out: str) -> DataFrame:
    """Adds the volume of all codes on the row's day: a sum a day, broadcast, so no panel is sorted by day."""
    line = table(spark, sf, "lineitem", "l_shipdate", "l_quantity")
    sums = line.groupBy(F.col("l_shipdate").cast("date").alias("_day")).agg(F.sum("l_quantity").alias(out))
    return rows.join(F.broadcast(sums), F.col("d").eqNullSafe(F.col("_day")), "left").drop("_day")


PANEL = """line AS (
  SELECT l_suppkey AS code, CAST(l_shipdate AS DATE) AS d, l_orderkey, l_linenumber, l_extendedprice / nullif(l_quantity, 0) AS px, l_quantity AS q, l_extendedprice AS a FROM lineitem
), panel AS (
  SELECT code, d, max(px) AS high, min(px) AS low, min({'o': l_orderkey, 'n': l_linenumber, 'p': px}).p AS open,
    max({'o': l_orderkey, 'n': l_linenumber, 'p': px}).p AS close, sum(q) AS vol, round(sum(a), 2) AS amount FROM line GROUP BY 1, 2
)"""


def open_days(spark: SparkSession, sf: str) -> DataFrame:
    """Shipping days from Monday to Friday."""
    days = table(spark, sf, "lineitem", "l_shipdate").select(F.col("l_shipdate").cast("date").alias("d")).distinct()
    return days.where(~F.dayofweek("d").isin(1, 7))


def calendar(spark: SparkSession, sf: str) -> DataFrame:
    return calendar_dim(open_days(spark, sf))


OPEN_DAYS = "open_days AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem WHERE dayofweek(l_shipdate) BETWEEN 1 AND 5)"
CALENDAR = (
    OPEN_DAYS
    + """, span AS (SELECT unnest(generate_series(min(d), max(d), INTERVAL 1 DAY))::DATE AS cal_date FROM open_days),
calendar AS (
  SELECT cal_date, (o.d IS NOT NULL)::INTEGER AS is_open,
    CAST(sum((o.d IS NOT NULL)::INTEGER) OVER (ORDER BY cal_date) AS INTEGER) AS pos,
    min(o.d) OVER (ORDER BY cal_date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS next_on_or_after,
    min(o.d) OVER (ORDER BY cal_date ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_strict
  FROM span LEFT JOIN open_days o ON o.d = cal_date
)"""
)


def reports(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as announcements: code, ann (day), period_end (last quarter end before it), value."""
    o = table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "o_orderpriority")
    ann = F.col("o_orderdate").cast("date")
    return o.select(F.col("o_custkey").alias("code"), ann.alias("ann"), F.date_sub(F.trunc(ann, "quarter"), 1).alias("period_end"), F.col("o_totalprice").alias("value"), "o_orderkey", F.col("o_orderpriority").alias("kind"))


REPORTS = "reports AS (SELECT o_custkey AS code, CAST(o_orderdate AS DATE) AS ann, CAST(date_trunc('quarter', o_orderdate) AS DATE) - 1 AS period_end, o_totalprice AS value, o_orderkey, o_orderpriority AS kind FROM orders)"


def intervals(spark: SparkSession, sf: str) -> DataFrame:
    """Per customer, from each order day to the next one: code, start, end (null at the last), kind."""
    from pyspark.sql import Window

    r = reports(spark, sf)
    w = Window.partitionBy("code").orderBy("ann", "o_orderkey")
    return r.select("code", F.col("ann").alias("start"), F.lead("ann").over(w).alias("end"), "kind", "o_orderkey")


INTERVALS = REPORTS + ", intervals AS (SELECT code, ann AS start, lead(ann) OVER (PARTITION BY code ORDER BY ann, o_orderkey) AS \"end\", kind, o_orderkey FROM reports)"


def daily(spark: SparkSession, sf: str) -> DataFrame:
    """Calendar series: total and mean order value and number of orders by day."""
    o = table(spark, sf, "orders", "o_orderdate", "o_totalprice")
    return o.groupBy(F.col("o_orderdate").cast("date").alias("d")).agg(F.round(F.sum("o_totalprice"), 2).alias("total"), F.round(F.avg("o_totalprice"), 6).alias("mean"), F.count("*").alias("n"))


DAILY = "daily AS (SELECT CAST(o_orderdate AS DATE) AS d, round(sum(o_totalprice), 2) AS total, round(avg(o_totalprice), 6) AS mean, count(*) AS n FROM orders GROUP BY 1)"


def flows(spark: SparkSession, sf: str) -> DataFrame:
    """Events as flows: per user and day the summed value of each event type."""
    e = table(spark, sf, "events", "user_id", "ts", "event_type", "value")
    kinds = ("view", "click", "purchase", "signup", "error")
    return e.groupBy(F.col("user_id").alias("code"), F.col("ts").cast("date").alias("d")).agg(*[F.round(F.coalesce(F.sum(F.when(F.col("event_type") == k, F.col("value"))), F.lit(0.0)), 4).alias(k) for k in kinds], F.count("*").alias("n"))
