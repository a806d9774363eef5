"""Window operators W01-W27 over the price panel."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quantloom.operators import ts, xsec
from quantloom.operators.joins import keep_latest
from quantloom.operators.sliding import sliding
from quantloom.plans.base import CALENDAR, DAILY, OPEN_DAYS, PANEL, REPORTS, calendar, daily, open_days, price_panel, query, reports, table

W = ts.per_code
OVER = "OVER (PARTITION BY code ORDER BY d)"


def _frame(n: int) -> str:
    return f"OVER (PARTITION BY code ORDER BY d ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def _dense(spark, sf):
    """All codes on every open day, prices where there are any."""
    from quantloom.operators.joins import skeleton

    p = price_panel(spark, sf)
    return skeleton(open_days(spark, sf), p.select("code")).join(p, ["code", "d"], "left")


DENSE = f"""{PANEL}, {OPEN_DAYS}, dense AS (
  SELECT k.code, o.d, close, vol, amount FROM (SELECT DISTINCT code FROM panel) k CROSS JOIN open_days o LEFT JOIN panel p ON p.code = k.code AND p.d = o.d
)"""


@query("w01_forward_fill", f"WITH {DENSE} SELECT code, d, last_value(close IGNORE NULLS) OVER (PARTITION BY code ORDER BY d ROWS UNBOUNDED PRECEDING) AS close_ff FROM dense")
def w01(spark, sf):
    return _dense(spark, sf).select("code", "d", ts.ffill("close", W()).alias("close_ff"))


@query("w02_calendar_fill", f"WITH {CALENDAR}, {DAILY} SELECT cal_date, last_value(total IGNORE NULLS) OVER (ORDER BY cal_date ROWS UNBOUNDED PRECEDING) AS total_ff FROM calendar LEFT JOIN daily ON daily.d = cal_date")
def w02(spark, sf):
    w = Window.orderBy("cal_date")  # one row a day: a calendar fits a task
    return calendar(spark, sf).join(daily(spark, sf), F.col("cal_date") == F.col("d"), "left").select("cal_date", ts.ffill("total", w).alias("total_ff"))


@query("w03_lag", f"WITH {PANEL} SELECT code, d, lag(close, 2) {OVER} AS lag2, lag(close) OVER (PARTITION BY code, year(d) ORDER BY d) AS lag_in_year FROM panel")
def w03(spark, sf):
    y = Window.partitionBy("code", F.year("d")).orderBy("d")
    return price_panel(spark, sf).select("code", "d", F.lag("close", 2).over(W()).alias("lag2"), F.lag("close").over(y).alias("lag_in_year"))


@query("w04_lead", f"WITH {PANEL} SELECT code, d, round(lead(close, 5) {OVER} / nullif(close, 0) - 1, 8) AS ret_5 FROM panel")
def w04(spark, sf):
    return price_panel(spark, sf).select("code", "d", F.round(ts.forward_return(F.col("close"), W(), 5), 8).alias("ret_5"))


@query("w05_calendar_shift", f"WITH {DAILY} SELECT d, lag(total) OVER (ORDER BY d) AS total, lag(mean) OVER (ORDER BY d) AS mean, lag(n) OVER (ORDER BY d) AS n FROM daily")
def w05(spark, sf):
    s, w = daily(spark, sf), Window.orderBy("d")
    return s.select("d", *[F.lag(c).over(w).alias(c) for c in s.columns if c != "d"])


@query("w06_difference", f"WITH {PANEL} SELECT code, d, round(close - lag(close) {OVER}, 7) AS chg FROM panel")
def w06(spark, sf):
    return price_panel(spark, sf).select("code", "d", F.round(ts.difference(F.col("close"), W()), 7).alias("chg"))


@query("w07_pct_change", f"WITH {PANEL} SELECT code, d, round((close - lag(close, 5) {OVER}) / nullif(lag(close, 5) {OVER}, 0), 8) AS roc_5 FROM panel")
def w07(spark, sf):
    return price_panel(spark, sf).select("code", "d", F.round(ts.pct_change(F.col("close"), W(), 5), 8).alias("roc_5"))


@query("w08_rolling_mean", f"WITH {PANEL} SELECT code, d, CASE WHEN count(close) {_frame(20)} = 20 THEN round(avg(close) {_frame(20)}, 6) END AS ma_20 FROM panel")
def w08(spark, sf):
    return price_panel(spark, sf).select("code", "d", F.round(ts.rolling_mean(F.col("close"), W(), 20), 6).alias("ma_20"))


@query("w09_rolling_std", f"WITH {PANEL} SELECT code, d, CASE WHEN count(close) {_frame(20)} = 20 THEN round(stddev_samp(close) {_frame(20)}, 6) END AS std_20 FROM panel")
def w09(spark, sf):
    return price_panel(spark, sf).select("code", "d", F.round(ts.rolling_std(F.col("close"), W(), 20), 6).alias("std_20"))


@query("w10_rolling_min_periods", f"WITH {PANEL} SELECT code, d, round(avg(close) {_frame(60)}, 6) AS ma60, CASE WHEN count(close) {_frame(250)} >= 30 THEN round(stddev_samp(close) {_frame(250)}, 6) END AS std250 FROM panel")
def w10(spark, sf):
    out = sliding(price_panel(spark, sf), "code", "d", [("ma60", "close", "mean", 60, 1), ("std250", "close", "std", 250, 30)])
    return out.select("code", "d", F.round("ma60", 6).alias("ma60"), F.round("std250", 6).alias("std250"))


@query("w11_future_std", f"WITH {PANEL} SELECT code, d, CASE WHEN count(close) OVER f >= 5 THEN round(stddev_samp(close) OVER f, 6) END AS fstd FROM panel WINDOW f AS (PARTITION BY code ORDER BY d ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING)")
def w11(spark, sf):
    return price_panel(spark, sf).select("code", "d", F.round(ts.future_std(F.col("close"), W(), 10), 6).alias("fstd"))


@query("w12_future_sum", f"WITH {PANEL} SELECT code, d, coalesce(sum((vol < 10)::INTEGER) OVER (PARTITION BY code ORDER BY d ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING), 0)::BIGINT AS thin_days FROM panel")
def w12(spark, sf):
    thin = (F.col("vol") < 10).cast("int")
    return price_panel(spark, sf).select("code", "d", ts.future_sum(thin, W(), 5).cast("long").alias("thin_days"))


@query("w13_trailing_any", f"WITH {PANEL} SELECT code, d, (sum((vol > 90)::INTEGER) {_frame(30)} > 0)::BIGINT AS in_window FROM panel")
def w13(spark, sf):
    return price_panel(spark, sf).select("code", "d", ts.trailing_any((F.col("vol") > 90).cast("int"), W(), 30).cast("long").alias("in_window"))


@query("w14_sum_over_k", f"WITH {DAILY} SELECT d, round(sum(total) OVER (ORDER BY d ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) / 20, 4) AS ma20 FROM daily")
def w14(spark, sf):
    return daily(spark, sf).select("d", F.round(F.sum("total").over(Window.orderBy("d").rowsBetween(-19, 0)) / 20, 4).alias("ma20"))


@query("w15_row_number", f"WITH {REPORTS} SELECT code, o_orderkey, row_number() OVER (PARTITION BY code ORDER BY value DESC, o_orderkey)::BIGINT AS rn FROM reports QUALIFY rn <= 10")
def w15(spark, sf):
    w = Window.partitionBy("code").orderBy(F.desc("value"), "o_orderkey")
    return reports(spark, sf).withColumn("rn", F.row_number().over(w)).where("rn <= 10").select("code", "o_orderkey", F.col("rn").cast("long").alias("rn"))


@query("w16_keep_last", f"WITH {REPORTS} SELECT code, period_end, ann, o_orderkey FROM reports QUALIFY row_number() OVER (PARTITION BY code, period_end ORDER BY ann DESC, o_orderkey DESC) = 1")
def w16(spark, sf):
    return keep_latest(reports(spark, sf), ["code", "period_end"], [F.desc("ann"), F.desc("o_orderkey")]).select("code", "period_end", "ann", "o_orderkey")


@query("w17_percentile_rank", f"WITH {PANEL} SELECT code, d, round((rank() OVER (PARTITION BY d ORDER BY vol) + (count(*) OVER (PARTITION BY d, vol) - 1) / 2.0) / count(vol) OVER (PARTITION BY d), 8) AS rank_vol FROM panel")
def w17(spark, sf):
    return price_panel(spark, sf).select("code", "d", F.round(xsec.pct_rank(F.col("vol"), "d"), 8).alias("rank_vol"))


@query("w18_quantile_bucket", f"""WITH {PANEL}, r AS (SELECT code, d, row_number() OVER (PARTITION BY d ORDER BY close, code) AS rn, count(close) OVER (PARTITION BY d) AS n FROM panel)
SELECT code, d, CASE WHEN n > 1 THEN greatest(1, ceil((rn - 1) * 5.0 / (n - 1)))::BIGINT END AS bucket FROM r""")
def w18(spark, sf):
    return price_panel(spark, sf).select("code", "d", xsec.quantile_bucket(F.col("close"), "d", 5, F.col("code")).alias("bucket"))


EWM = f"""WITH RECURSIVE {PANEL}, s AS (
  SELECT code, d, close, row_number() OVER (PARTITION BY code ORDER BY d) AS i FROM panel
), r AS (
  SELECT code, d, i, close AS e FROM s WHERE i = 1 UNION ALL
  SELECT s.code, s.d, s.i, r.e + 2.0 / 13 * (s.close - r.e) FROM r JOIN s ON s.code = r.code AND s.i = r.i + 1
) SELECT code, d, round(e, 6) AS ema12 FROM r"""


@query("w19_exponential_mean", EWM)
def w19(spark, sf):
    p = price_panel(spark, sf)
    return ts.ewm(p, "code", "d", "close", 2 / 13, "e").select("code", "d", F.round("e", 6).alias("ema12"))


@query("w19_exponential_mean_grouped", EWM)
def w19b(spark, sf):
    p = price_panel(spark, sf)
    return ts.ewm_grouped(p, "code", "d", "close", {"e": 2 / 13}).select("code", "d", F.round("e", 6).alias("ema12"))


@query("w20_rolling_extremes", f"WITH {PANEL} SELECT code, d, min(low) {_frame(9)} AS low_9, max(high) {_frame(9)} AS high_9 FROM panel")
def w20(spark, sf):
    return price_panel(spark, sf).select("code", "d", ts.rolling(F.min, F.col("low"), W(), 9, 1).alias("low_9"), ts.rolling(F.max, F.col("high"), W(), 9, 1).alias("high_9"))


@query("w21_date_series_zscore", f"""WITH {PANEL}, s AS (SELECT d, round(avg(close), 6) AS m FROM panel GROUP BY 1),
z AS (SELECT d, CASE WHEN count(m) OVER f >= 30 AND stddev_samp(m) OVER f > 0 THEN round((m - avg(m) OVER f) / stddev_samp(m) OVER f, 6) END AS z FROM s WINDOW f AS (ORDER BY d ROWS BETWEEN 249 PRECEDING AND CURRENT ROW))
SELECT code, d, z FROM panel JOIN z USING (d)""")
def w21(spark, sf):
    p = price_panel(spark, sf)
    s = p.groupBy("d").agg(F.round(F.avg("close"), 6).alias("m"))
    w = Window.orderBy("d")
    m = F.col("m")
    std = ts.rolling_std(m, w, 250, 30)
    s = s.select("d", F.round(F.when(std > 0, (m - ts.rolling_mean(m, w, 250, 30)) / std), 6).alias("z"))
    return p.select("code", "d").join(F.broadcast(s), "d").select("code", "d", "z")


@query("w22_change_flag", f"WITH {REPORTS} SELECT code, o_orderkey, (lag(kind) OVER w IS NOT NULL AND kind <> lag(kind) OVER w AND kind <> '5-LOW')::BIGINT AS changed FROM reports WINDOW w AS (PARTITION BY code ORDER BY ann, o_orderkey)")
def w22(spark, sf):
    before = F.lag("kind").over(Window.partitionBy("code").orderBy("ann", "o_orderkey"))
    return reports(spark, sf).select("code", "o_orderkey", F.coalesce((F.col("kind") != before) & (F.col("kind") != "5-LOW"), F.lit(False)).cast("long").alias("changed"))


@query("w23_largest_gap", f"WITH {PANEL} SELECT code, max(gap)::BIGINT AS gap FROM (SELECT code, date_diff('day', lag(d) {OVER}, d) AS gap FROM panel) GROUP BY 1")
def w23(spark, sf):
    return price_panel(spark, sf).withColumn("gap", F.datediff("d", F.lag("d").over(W()))).groupBy("code").agg(F.max("gap").cast("long").alias("gap"))


@query("w24_cumulative_return", f"WITH {DAILY}, r AS (SELECT d, (mean - lag(mean) OVER (ORDER BY d)) / nullif(lag(mean) OVER (ORDER BY d), 0) / 100 AS r FROM daily) SELECT year(d)::BIGINT AS y, round(product(1 + r) - 1, 6) AS cum FROM r GROUP BY 1")
def w24(spark, sf):
    r = daily(spark, sf).select("d", (ts.pct_change(F.col("mean"), Window.orderBy("d")) / 100).alias("r"))
    return r.groupBy(F.year("d").cast("long").alias("y")).agg(F.round(F.product(1 + F.col("r")) - 1, 6).alias("cum"))


@query("w25_tail_per_group", f"WITH {PANEL} SELECT code, d, close FROM panel QUALIFY row_number() OVER (PARTITION BY code ORDER BY d DESC) <= 5")
def w25(spark, sf):
    return keep_n(price_panel(spark, sf), F.desc("d"), 5)


@query("w26_head_per_group", f"WITH {PANEL} SELECT code, d, close FROM panel QUALIFY row_number() OVER (PARTITION BY code ORDER BY d) <= 5")
def w26(spark, sf):
    return keep_n(price_panel(spark, sf), F.asc("d"), 5)


def keep_n(df, order, n):
    w = Window.partitionBy("code").orderBy(order)
    return df.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n).select("code", "d", "close")


@query("w27_order_check", "SELECT l_suppkey AS code, count(*) FILTER (WHERE l_orderkey < p)::BIGINT AS breaks FROM (SELECT l_suppkey, l_orderkey, lag(l_orderkey) OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_extendedprice) AS p FROM lineitem) GROUP BY 1")
def w27(spark, sf):
    w = Window.partitionBy("l_suppkey").orderBy("l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice")
    line = table(spark, sf, "lineitem", "l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice")
    return line.withColumn("p", F.lag("l_orderkey").over(w)).groupBy(F.col("l_suppkey").alias("code")).agg(F.count_if(F.col("l_orderkey") < F.col("p")).alias("breaks"))
