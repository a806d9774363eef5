"""Batch forms of the streaming operators, with the same code."""

from __future__ import annotations

from pyspark.sql import functions as F

from quantloom import streaming as T
from quantloom.plans.base import query, table


def _events(spark, sf):
    return table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))


@query("st1_tumbling", "SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS n, round(sum(value), 4) AS v FROM events GROUP BY 1, 2")
def st1(spark, sf):
    return T.tumbling(_events(spark, sf)).withColumn("start", F.date_format("start", "yyyy-MM-dd HH:mm:ss"))


@query("st2_sessions", "WITH s AS (SELECT user_id, ts, coalesce(ts >= lag(ts) OVER w + INTERVAL 30 MINUTE, true)::INTEGER AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), g AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM s) SELECT user_id, count(*) AS n, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start FROM g GROUP BY user_id, k")
def st2(spark, sf):
    return T.sessions(_events(spark, sf)).select("user_id", "n", F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"))
