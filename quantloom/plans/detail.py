"""Detail builders D01-D17, features E01-E15, preprocessors Q01-Q08 and collector computations K01-K07, on the proxies."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quantloom.operators import calendar as cal
from quantloom.operators import joins as J
from quantloom.operators import ts, xsec
from quantloom.operators.numbering import ordinal_codes, sorted_codes
from quantloom.operators.pointintime import on_listed_days, stretch
from quantloom.operators.scan import exponential_means
from quantloom.operators.sliding import sliding
from quantloom.operators.timeline import coverage, timeline
from quantloom.plans.base import CALENDAR, DAILY, INTERVALS, OPEN_DAYS, PANEL, REPORTS, calendar, daily, flows, intervals, open_days, panel_parts, price_panel, query, reports, table
from quantloom.sources import written_once

W = ts.per_code
P = "PARTITION BY code ORDER BY d"


def _frame(n: int) -> str:
    return f"OVER ({P} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def _r(c, k=6):
    return F.round(c, k)


FROM = "1996-01-01"


@query("d01_price_table", f"""WITH {PANEL}, {OPEN_DAYS}, f AS (SELECT p_partkey AS code, p_size / 10.0 AS adj FROM part), hal AS (SELECT DISTINCT l_suppkey AS code, CAST(l_shipdate AS DATE) AS d FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 49), sp AS (SELECT s_suppkey AS code, s_acctbal FROM supplier),
j AS (SELECT k.code, o.d, last_value(open IGNORE NULLS) OVER w AS open, last_value(high IGNORE NULLS) OVER w AS high, last_value(low IGNORE NULLS) OVER w AS low, last_value(close IGNORE NULLS) OVER w AS close, coalesce(vol, 0) AS vol, coalesce(amount, 0) * 1000 AS amount, adj, hal.d IS NOT NULL AS halted, s_acctbal
  FROM (SELECT DISTINCT code FROM panel) k CROSS JOIN open_days o LEFT JOIN panel p ON p.code = k.code AND p.d = o.d LEFT JOIN f ON f.code = k.code LEFT JOIN hal ON hal.code = k.code AND hal.d = o.d LEFT JOIN sp ON sp.code = k.code WINDOW w AS (PARTITION BY k.code ORDER BY o.d ROWS UNBOUNDED PRECEDING)),
g AS (SELECT *, lag(close) OVER ({P}) AS pre_close FROM j)
SELECT code, d, round(open * adj, 8) AS open_hfq, round(high * adj, 8) AS high_hfq, round(low * adj, 8) AS low_hfq, round(close * adj, 8) AS close_hfq, vol, round(amount, 2) AS amount, round(CASE WHEN vol > 0 THEN amount / (vol * 100) END, 8) AS vwap, round(CASE WHEN vol > 0 THEN amount / (vol * 100) * adj END, 7) AS vwap_hfq,
  round(CASE WHEN vol <= 0 THEN 0 WHEN pre_close * adj > 0 THEN close * adj / (pre_close * adj) - 1 END, 8) AS return_1d, round(vol / nullif(abs(s_acctbal), 0), 8) AS turnover, (vol > 0)::BIGINT AS is_trading, halted::BIGINT AS is_suspended FROM g WHERE close IS NOT NULL AND adj IS NOT NULL AND d >= DATE '{FROM}'""")
def d01(spark, sf):
    adj = table(spark, sf, "part", "p_partkey", "p_size").select(F.col("p_partkey").alias("code"), (F.col("p_size") / 10.0).alias("adj"))
    line = table(spark, sf, "lineitem", "l_suppkey", "l_shipdate", "l_returnflag", "l_quantity").where("l_returnflag = 'R' and l_quantity >= 49")
    halted = line.select(F.col("l_suppkey").alias("code"), F.col("l_shipdate").cast("date").alias("d")).distinct().withColumn("is_suspended", F.lit(1).cast("long"))
    float_ = table(spark, sf, "supplier", "s_suppkey", "s_acctbal").select(F.col("s_suppkey").alias("code"), F.abs("s_acctbal").alias("float_share"))
    return price_table(price_panel(spark, sf), open_days(spark, sf), adj, halted, float_, FROM)


def price_table(prices, days, adj, halted, shares, since: str):
    """Prices of every code on every open day from its first one on, carried over days without trade, raw and adjusted.

    The whole history is read, so that what is carried into the first day of the slice is known.
    """
    s = J.skeleton(days, prices.select("code")).join(prices, ["code", "d"], "left").join(halted, ["code", "d"], "left").join(adj, "code", "left").join(shares, "code", "left")
    s = s.withColumns({c: ts.ffill(c, W()) for c in ("open", "high", "low", "close")}).na.fill(0, ["vol", "amount", "is_suspended"]).na.fill(0.0, ["vol", "amount"])
    s = s.withColumns({"pre": F.lag("close").over(W()), "amount": F.col("amount") * 1000}).where(F.col("close").isNotNull() & F.col("adj").isNotNull() & (F.col("d") >= F.lit(since).cast("date")))
    pre, hfq = F.col("pre") * F.col("adj"), F.col("close") * F.col("adj")
    vwap = F.when(F.col("vol") > 0, F.try_divide(F.col("amount"), F.col("vol") * 100))
    ret = F.when(F.col("vol") <= 0, 0.0).when(pre > 0, F.try_divide(hfq, pre) - 1)
    return s.select(
        "code", "d", *[_r(F.col(c) * F.col("adj"), 8).alias(f"{c}_hfq") for c in ("open", "high", "low", "close")], "vol", F.round("amount", 2).alias("amount"), _r(vwap, 8).alias("vwap"), _r(vwap * F.col("adj"), 7).alias("vwap_hfq"),
        _r(ret, 8).alias("return_1d"), _r(F.try_divide("vol", "float_share"), 8).alias("turnover"), (F.col("vol") > 0).cast("long").alias("is_trading"), "is_suspended",
    )


@query("d01_price_features", f"""WITH {PANEL}, x AS (SELECT code, d, close, close / nullif(lag(close) OVER ({P}), 0) - 1 AS r FROM panel)
SELECT code, d, close, CASE WHEN count(close) {_frame(5)} = 5 THEN round(avg(close) {_frame(5)}, 6) END AS ma_5, round(close / nullif(lag(close, 5) OVER ({P}), 0) - 1, 8) AS roc_5,
  CASE WHEN count(r) {_frame(5)} = 5 THEN round(stddev_samp(r) {_frame(5)}, 6) END AS volatility_5, round(lead(close, 5) OVER ({P}) / nullif(close, 0) - 1, 8) AS ret_5d FROM x""")
def d01_features(spark, sf):
    c, r = F.col("close"), F.col("r")
    p = price_panel(spark, sf).withColumn("r", ts.pct_change(c, W()))
    return p.select("code", "d", "close", _r(ts.rolling_mean(c, W(), 5)).alias("ma_5"), _r(F.try_divide(c, F.lag("close", 5).over(W())) - 1, 8).alias("roc_5"), _r(ts.rolling_std(r, W(), 5)).alias("volatility_5"), _r(ts.forward_return(c, W(), 5), 8).alias("ret_5d"))


#: Boards by nation: their price limit, the limit under special treatment, and days after listing without one.
BOARDS = {0: ("main", 0.1, 0.05, 5), 1: ("growth", 0.2, 0.2, 5), 2: ("science", 0.2, 0.2, 5), 3: ("small", 0.3, 0.3, 1)}


def special_periods(spark, sf):
    """Large returned lines as periods of special treatment: code, start and end, both days included."""
    line = table(spark, sf, "lineitem", "l_suppkey", "l_shipdate", "l_returnflag", "l_quantity", "l_linenumber").where("l_returnflag = 'R' and l_quantity >= 48")
    day = F.col("l_shipdate").cast("date")
    return line.select(F.col("l_suppkey").alias("code"), day.alias("start"), F.date_add(day, F.col("l_linenumber") * 10).alias("end"))


SPECIAL = "special AS (SELECT l_suppkey AS code, CAST(l_shipdate AS DATE) AS start, CAST(l_shipdate AS DATE) + l_linenumber * 10 AS \"end\" FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 48)"


def boards(spark, sf):
    kind = F.col("s_nationkey") % 4
    pick = lambda i: F.element_at(F.array(*[F.lit(v[i]) for v in BOARDS.values()]), kind + 1)
    return table(spark, sf, "supplier", "s_suppkey", "s_nationkey").select(F.col("s_suppkey").alias("code"), pick(0).alias("market"), pick(1).alias("plain"), pick(2).alias("treated"), pick(3).alias("free_days"))


@query("d02_status", f"""WITH {PANEL}, {OPEN_DAYS}, {SPECIAL}, k AS (SELECT code, min(d) AS list_date FROM panel GROUP BY 1), b(m, market, plain, treated, free_days) AS (VALUES """
  + ", ".join(f"({m}, '{v[0]}', {v[1]}::DOUBLE, {v[2]}::DOUBLE, {v[3]})" for m, v in BOARDS.items()) + f"""), s AS (
  SELECT k.code, o.d, p.close, coalesce(p.vol, 0) AS vol, list_date FROM k CROSS JOIN open_days o LEFT JOIN panel p ON p.code = k.code AND p.d = o.d
), f AS (SELECT *, last_value(close IGNORE NULLS) OVER ({P} ROWS UNBOUNDED PRECEDING) AS last FROM s), g AS (SELECT *, lag(last) OVER ({P}) AS pre, date_diff('day', list_date, d) AS age FROM f),
h AS (SELECT *, EXISTS (SELECT 1 FROM special x WHERE x.code = g.code AND d BETWEEN x.start AND x."end") AS st FROM g WHERE last IS NOT NULL AND pre IS NOT NULL),
r AS (SELECT h.*, market, age < coalesce(free_days, 5) AS free, CASE WHEN age < coalesce(free_days, 5) THEN 1.0 WHEN st THEN coalesce(treated, 0.1) ELSE coalesce(plain, 0.1) END::DOUBLE AS ratio FROM h LEFT JOIN supplier ON s_suppkey = code LEFT JOIN b ON m = s_nationkey % 4)
SELECT code, d, st::BIGINT AS is_st, (age < 60)::BIGINT AS is_new, free::BIGINT AS is_new_no_limit, (vol > 0)::BIGINT AS is_trading, list_date, market, ratio AS limit_ratio,
  coalesce(ratio < 1 AND last >= round(pre * (1 + ratio), 2) * 0.999, false)::BIGINT AS is_limit_up, coalesce(ratio < 1 AND last <= round(pre * (1 - ratio), 2) * 1.001, false)::BIGINT AS is_limit_down FROM r""")
def d02(spark, sf):
    return status(spark, sf).drop("priced")


def status(spark, sf):
    return daily_status(price_panel(spark, sf), open_days(spark, sf), special_periods(spark, sf), boards(spark, sf), panel_parts(spark, sf))


def daily_status(prices, days, special, market, parts: int):
    """Every code on every open day from its second price on: special treatment, listing age, price limits, trading; ``priced`` says that the day has a price of its own.

    Prices and the changes of special treatment are records of a code; the days between are written out from the calendar.
    """
    p = prices.where("code is not null").select("code", "d", "close", "vol", F.min("d").over(Window.partitionBy("code")).alias("list_date"))
    p = p.join(F.broadcast(days), "d", "left_semi").join(market, "code", "left")
    before = F.last("close", ignorenulls=True).over(W().rowsBetween(Window.unboundedPreceding, -1))
    p = p.select("code", "d", F.col("close").alias("last"), F.struct("list_date", "market", "plain", "treated", "free_days").alias("of"), "vol", before.alias("pre"), F.lit(True).alias("priced"))
    treated = on_listed_days(coverage(special, "code", "start", "end", "d", "open"), days, "code", "d", ["open"], parts)
    s = stretch(p.unionByName(treated, allowMissingColumns=True), days, "code", "d", ["last", "of", "open"], ["vol", "pre", "priced"], parts=parts).select("*", "of.*")
    s = s.withColumns({"priced": F.coalesce("priced", F.lit(False)), "is_st": (F.coalesce("open", F.lit(0)) > 0).cast("int")})
    s = s.withColumn("pre", F.when(F.col("priced"), F.col("pre")).otherwise(F.col("last"))).where("last is not null and pre is not null")
    s = s.withColumn("age", F.datediff("d", "list_date")).withColumn("free", F.col("age") < F.coalesce("free_days", F.lit(5)))
    q = F.col("limit_ratio")
    s = s.withColumn("limit_ratio", F.when(F.col("free"), 1.0).when(F.col("is_st") == 1, F.coalesce("treated", F.lit(0.1))).otherwise(F.coalesce("plain", F.lit(0.1))))
    up = (q < 1) & (F.col("last") >= F.round(F.col("pre") * (1 + q), 2) * 0.999)
    down = (q < 1) & (F.col("last") <= F.round(F.col("pre") * (1 - q), 2) * 1.001)
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("long")
    return s.select(
        "code", "d", F.col("is_st").cast("long").alias("is_st"), flag(F.col("age") < 60).alias("is_new"), flag(F.col("free")).alias("is_new_no_limit"), flag(F.col("vol") > 0).alias("is_trading"),
        "list_date", "market", q.alias("limit_ratio"), flag(up).alias("is_limit_up"), flag(down).alias("is_limit_down"), "priced",
    )


QUARTERS = REPORTS + """, q AS (
  SELECT code, year(period_end) AS y, quarter(period_end) AS qt, period_end, round(sum(sum(value)) OVER (PARTITION BY code, year(period_end) ORDER BY period_end), 2) AS cum FROM reports GROUP BY 1, 2, 3, 4
), sq AS (SELECT code, y, qt, period_end, cum, round(cum - coalesce(lag(cum) OVER (PARTITION BY code, y ORDER BY qt), 0), 2) AS sq FROM q)"""


def _quarters(spark, sf):
    r = reports(spark, sf).groupBy("code", F.year("period_end").alias("y"), F.quarter("period_end").alias("qt"), "period_end").agg(F.sum("value").alias("v"))
    r = r.withColumn("cum", F.round(F.sum("v").over(Window.partitionBy("code", "y").orderBy("period_end").rowsBetween(Window.unboundedPreceding, 0)), 2))
    before = F.coalesce(F.lag("cum").over(Window.partitionBy("code", "y").orderBy("qt")), F.lit(0.0))
    return r.withColumn("sq", F.round(F.col("cum") - before, 2))


@query("d03_single_quarter", f"WITH {QUARTERS} SELECT code, period_end, cum, sq FROM sq")
def d03(spark, sf):
    return _quarters(spark, sf).select("code", "period_end", "cum", "sq")


@query("d04_trailing_year", f"WITH {QUARTERS} SELECT code, period_end, round(sq + lag(sq, 1) OVER w + lag(sq, 2) OVER w + lag(sq, 3) OVER w, 2) AS ttm FROM sq WINDOW w AS (PARTITION BY code ORDER BY period_end)")
def d04(spark, sf):
    w = Window.partitionBy("code").orderBy("period_end")
    ttm = sum((F.lag("sq", k).over(w) for k in (1, 2, 3)), F.col("sq"))  # null if any quarter is
    return _quarters(spark, sf).select("code", "period_end", F.round(ttm, 2).alias("ttm"))


PIT = f"""{OPEN_DAYS}, {REPORTS}, m AS (SELECT r.code, r.period_end, r.value, r.ann, r.o_orderkey, min(o.d) AS d FROM reports r JOIN open_days o ON o.d > r.ann GROUP BY ALL),
l AS (SELECT * FROM m QUALIFY row_number() OVER (PARTITION BY code, d ORDER BY period_end DESC, ann DESC, o_orderkey DESC) = 1),
g AS (SELECT k.code, o.d, l.value, l.period_end FROM (SELECT DISTINCT code FROM m) k CROSS JOIN open_days o LEFT JOIN l ON l.code = k.code AND l.d = o.d)"""


def _pit(spark, sf):
    """Reports on the open day after their announcement, the latest period first; one row a code and day."""
    r = cal.map_strictly_after(reports(spark, sf), calendar(spark, sf), "ann", "d")
    return J.keep_latest(r, ["code", "d"], [F.desc("period_end"), F.desc("ann"), F.desc("o_orderkey")]).select("code", "d", "value", "period_end")


def valuations(spark, sf):
    """Orders of a customer and open day as its daily valuation."""
    o = table(spark, sf, "orders", "o_custkey", "o_orderdate", "o_totalprice")
    v = o.groupBy(F.col("o_custkey").alias("code"), F.col("o_orderdate").cast("date").alias("d")).agg(F.round(F.sum("o_totalprice"), 2).alias("total_mv"), F.count("*").alias("trades"))
    return v.join(F.broadcast(open_days(spark, sf)), "d", "left_semi")


@query("d05_point_in_time", f"""WITH {PIT}, v AS (SELECT o_custkey AS code, CAST(o_orderdate AS DATE) AS d, round(sum(o_totalprice), 2) AS total_mv, count(*) AS trades FROM orders GROUP BY 1, 2)
SELECT g.code, g.d, last_value(value IGNORE NULLS) OVER w AS value, last_value(period_end IGNORE NULLS) OVER w AS report_date, total_mv, trades FROM g LEFT JOIN v ON v.code = g.code AND v.d = g.d WINDOW w AS (PARTITION BY g.code ORDER BY g.d ROWS UNBOUNDED PRECEDING)""")
def d05(spark, sf):
    r = _pit(spark, sf)
    both = r.join(valuations(spark, sf), ["code", "d"], "full_outer").join(r.select("code").distinct(), "code", "left_semi")
    out = stretch(both.withColumnRenamed("period_end", "report_date"), open_days(spark, sf), "code", "d", ["value", "report_date"], ["total_mv", "trades"])
    return out.select("code", "d", "value", "report_date", "total_mv", "trades")


@query("d06_holder_change", f"WITH {REPORTS}, l AS (SELECT * FROM reports QUALIFY row_number() OVER (PARTITION BY code, ann ORDER BY period_end DESC, o_orderkey DESC) = 1) SELECT code, ann, round(value - lag(value) OVER w, 2) AS chg, round((value - lag(value) OVER w) / nullif(lag(value) OVER w, 0), 8) AS chg_pct FROM l WINDOW w AS (PARTITION BY code ORDER BY ann)")
def d06(spark, sf):
    r = J.keep_latest(reports(spark, sf), ["code", "ann"], [F.desc("period_end"), F.desc("o_orderkey")])
    w = Window.partitionBy("code").orderBy("ann")
    return r.select("code", "ann", F.round(ts.difference(F.col("value"), w), 2).alias("chg"), _r(ts.pct_change(F.col("value"), w), 8).alias("chg_pct"))


@query("d07_report_lag", f"WITH {PIT}, f AS (SELECT code, d, last_value(period_end IGNORE NULLS) OVER ({P} ROWS UNBOUNDED PRECEDING) AS e FROM g) SELECT code, d, date_diff('day', e, d)::BIGINT AS lag_days FROM f")
def d07(spark, sf):
    dense = stretch(_pit(spark, sf), open_days(spark, sf), "code", "d", ["period_end"])
    return dense.select("code", "d", F.datediff("d", "period_end").cast("long").alias("lag_days"))


@query("d08_concentration", f"WITH {REPORTS}, r AS (SELECT code, value, row_number() OVER (PARTITION BY code ORDER BY value DESC, o_orderkey) AS rn, sum(value) OVER (PARTITION BY code) AS t FROM reports) SELECT code, round(sum(value) FILTER (rn <= 3) / nullif(max(t), 0), 8) AS top3, round(max(value) / nullif(max(t), 0), 8) AS top1 FROM r GROUP BY 1")
def d08(spark, sf):
    r = reports(spark, sf)
    w = Window.partitionBy("code").orderBy(F.desc("value"), "o_orderkey")
    g = r.withColumn("rn", F.row_number().over(w)).groupBy("code").agg(F.sum(F.when(F.col("rn") <= 3, F.col("value"))).alias("a"), F.max("value").alias("b"), F.sum("value").alias("t"))
    return g.select("code", _r(F.try_divide("a", "t"), 8).alias("top3"), _r(F.try_divide("b", "t"), 8).alias("top1"))


FLOWS = "flows AS (SELECT user_id AS code, CAST(ts AS DATE) AS d, " + ", ".join(f"round(coalesce(sum(value) FILTER (event_type = '{k}'), 0), 4) AS {k}" for k in ("view", "click", "purchase", "signup", "error")) + ", count(*) AS n FROM events GROUP BY 1, 2)"


@query("d09_flow_nets", f"WITH {FLOWS} SELECT code, d, round(purchase + signup, 4) AS main, round(view + click, 4) AS retail, round(purchase + signup - view - click, 4) AS net, CASE WHEN view + click > 0 THEN round((purchase + signup) / (view + click), 6) END AS pct FROM flows")
def d09(spark, sf):
    main, retail = F.col("purchase") + F.col("signup"), F.col("view") + F.col("click")
    return flows(spark, sf).select("code", "d", F.round(main, 4).alias("main"), F.round(retail, 4).alias("retail"), F.round(main - F.col("view") - F.col("click"), 4).alias("net"), F.when(retail > 0, _r(F.try_divide(main, retail))).alias("pct"))


SIZES = {"sm": "l_quantity <= 10", "md": "l_quantity > 10 AND l_quantity <= 25", "lg": "l_quantity > 25 AND l_quantity <= 40", "elg": "l_quantity > 40"}
SIDES = {"buy": "l_returnflag = 'A'", "sell": "l_returnflag = 'R'"}
_LEG = [(f"{side}_{size}", f"{a} AND {b}") for side, a in SIDES.items() for size, b in SIZES.items()]
TRADES = "trades AS (SELECT l_suppkey AS code, CAST(l_shipdate AS DATE) AS d, " + ", ".join(f"round(coalesce(sum(l_extendedprice) FILTER (WHERE {c}), 0), 2) AS {n}" for n, c in _LEG) + ", round(sum(l_extendedprice), 2) AS amount FROM lineitem GROUP BY 1, 2)"


def trades(spark, sf):
    """Lines as trades by side and size: the summed price of each leg by code and day."""
    line = table(spark, sf, "lineitem", "l_suppkey", "l_shipdate", "l_returnflag", "l_quantity", "l_extendedprice")
    leg = lambda c: F.round(F.coalesce(F.sum(F.when(F.expr(c), F.col("l_extendedprice"))), F.lit(0.0)), 2)
    return line.groupBy(F.col("l_suppkey").alias("code"), F.col("l_shipdate").cast("date").alias("d")).agg(*[leg(c).alias(n) for n, c in _LEG], F.round(F.sum("l_extendedprice"), 2).alias("amount"))


def _by_day(spark, sf, where: str):
    line = table(spark, sf, "lineitem", "l_suppkey", "l_shipdate", "l_returnflag", "l_quantity", "l_extendedprice", "l_linenumber").where(where)
    return line.groupBy(F.col("l_suppkey").alias("code"), F.col("l_shipdate").cast("date").alias("d"))


@query("d10_flow_assembly", f"""WITH {PANEL}, {TRADES}, {DAILY}, top AS (SELECT l_suppkey AS code, CAST(l_shipdate AS DATE) AS d, round(sum(l_extendedprice), 2) AS top_amount FROM lineitem WHERE l_quantity >= 49 GROUP BY 1, 2),
inst AS (SELECT l_suppkey AS code, CAST(l_shipdate AS DATE) AS d, round(sum(l_extendedprice), 2) AS inst_amount FROM lineitem WHERE l_quantity >= 49 AND l_linenumber = 1 GROUP BY 1, 2),
blk AS (SELECT l_suppkey AS code, CAST(l_shipdate AS DATE) AS d, round(sum(l_extendedprice), 2) AS block_amount, round(avg(l_extendedprice / l_quantity), 6) AS block_price, count(*) AS block_count FROM lineitem WHERE l_quantity >= 45 GROUP BY 1, 2),
mar AS (SELECT l_suppkey AS code, CAST(l_shipdate AS DATE) AS d, round(sum(l_extendedprice), 2) AS rz FROM lineitem WHERE l_returnflag = 'N' GROUP BY 1, 2),
nor AS (SELECT d, n AS north, sum(n) OVER (ORDER BY d ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) / 5.0 AS north_ma5 FROM daily),
j AS (SELECT p.code, p.d, t.* EXCLUDE (code, d, amount), p.amount, top_amount, inst_amount, block_amount, block_price, block_count, last_value(rz IGNORE NULLS) OVER (PARTITION BY p.code ORDER BY p.d ROWS UNBOUNDED PRECEDING) AS rz, north, north_ma5 FROM panel p
  LEFT JOIN trades t ON t.code = p.code AND t.d = p.d LEFT JOIN top ON top.code = p.code AND top.d = p.d LEFT JOIN inst ON inst.code = p.code AND inst.d = p.d LEFT JOIN blk ON blk.code = p.code AND blk.d = p.d LEFT JOIN mar ON mar.code = p.code AND mar.d = p.d LEFT JOIN nor ON nor.d = p.d)
SELECT code, d, """ + ", ".join(f"coalesce({n}, 0) AS {n}" for n, _ in _LEG) + """, coalesce(top_amount, 0) AS top_amount, (top_amount IS NOT NULL)::BIGINT AS is_top_list, coalesce(inst_amount, 0) AS inst_amount, coalesce(block_amount, 0) AS block_amount, coalesce(block_price, 0) AS block_price, coalesce(block_count, 0)::BIGINT AS block_count,
  coalesce(rz, 0) AS rz, round(coalesce(rz - lag(rz) OVER (PARTITION BY code ORDER BY d), 0), 2) + 0.0 AS rz_chg, coalesce(north, 0)::BIGINT AS north, round(coalesce(north_ma5, 0), 6) AS north_ma5, (code % 10 = 0)::BIGINT AS is_small_board,
  round(coalesce(buy_lg + buy_elg - sell_lg - sell_elg, 0), 2) + 0.0 AS net_main, round(coalesce(buy_sm + buy_md - sell_sm - sell_md, 0), 2) + 0.0 AS net_retail, round(coalesce((buy_lg + buy_elg - sell_lg - sell_elg) / nullif(amount, 0), 0), 6) + 0.0 AS net_main_pct FROM j""")
def d10(spark, sf):
    price = F.col("l_extendedprice")
    total = lambda where, name: _by_day(spark, sf, where).agg(F.round(F.sum(price), 2).alias(name))
    block = _by_day(spark, sf, "l_quantity >= 45").agg(F.round(F.sum(price), 2).alias("block_amount"), F.round(F.avg(price / F.col("l_quantity")), 6).alias("block_price"), F.count("*").alias("block_count"))
    w = Window.orderBy("d").rowsBetween(-4, 0)  # a row a day
    north = daily(spark, sf).select("d", F.col("n").alias("north"), (F.sum("n").over(w) / 5.0).alias("north_ma5"))
    return flow_assembly(price_panel(spark, sf).select("code", "d", "amount"), trades(spark, sf).drop("amount"), total("l_quantity >= 49", "top_amount"), total("l_quantity >= 49 and l_linenumber = 1", "inst_amount"), block, total("l_returnflag = 'N'", "rz"), north)


def flow_assembly(spine, legs_, top, inst, block, margin, north):
    """Six tables on the days of a code, and their nets: balances are carried forward, flows without a row are 0."""
    s = spine
    for t in (legs_, top, inst, block, margin):
        s = s.join(t, ["code", "d"], "left")
    s = s.join(F.broadcast(north), "d", "left").withColumn("is_top_list", F.col("top_amount").isNotNull().cast("long")).withColumn("rz", ts.ffill("rz", W()))
    main = F.col("buy_lg") + F.col("buy_elg") - F.col("sell_lg") - F.col("sell_elg")
    retail = F.col("buy_sm") + F.col("buy_md") - F.col("sell_sm") - F.col("sell_md")
    s = s.withColumns({"rz_chg": F.round(ts.difference(F.col("rz"), W()), 2), "net_main": F.round(main, 2), "net_retail": F.round(retail, 2), "net_main_pct": _r(F.try_divide(main, "amount")), "north_ma5": _r(F.col("north_ma5")), "is_small_board": (F.col("code") % 10 == 0).cast("long")})
    s = s.drop("amount")
    doubles = [c for c, t in s.dtypes if t == "double"]
    return s.na.fill(0.0, doubles).na.fill(0, ["block_count", "north"]).withColumns({c: F.col(c) + F.lit(0.0) for c in ("rz_chg", "net_main", "net_retail", "net_main_pct")})


@query("d11_event_windows", f"""WITH {CALENDAR}, {REPORTS}, e AS (SELECT code, coalesce(next_on_or_after, ann) AS d, 1 AS flag, sum(value) AS amount FROM reports LEFT JOIN calendar ON cal_date = ann GROUP BY 1, 2),
g AS (SELECT k.code, c.cal_date AS d, coalesce(flag, 0) AS flag, round(coalesce(amount, 0), 2) AS amount FROM (SELECT DISTINCT code FROM e) k CROSS JOIN (SELECT cal_date FROM calendar WHERE is_open = 1) c LEFT JOIN e ON e.code = k.code AND e.d = c.cal_date)
SELECT code, d, flag::BIGINT AS is_ann, amount, (sum(flag) OVER ({P} ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) > 0)::BIGINT AS in_window FROM g""")
def d11(spark, sf):
    c = calendar(spark, sf)
    e = cal.map_on_or_after(reports(spark, sf), c, "ann", "d").groupBy("code", "d").agg(F.lit(1).alias("flag"), F.sum("value").alias("amount"))
    g = event_windows(e, c.where("is_open = 1").select(F.col("cal_date").alias("d"), "pos"), 30)
    return g.select("code", "d", F.col("is_ann").cast("long").alias("is_ann"), F.round("amount", 2).alias("amount"), F.col("in_window").cast("long").alias("in_window"))


def event_windows(events, days, k: int):
    """Every code of ``events(code, d, amount)`` (one row a code and day) on every one of ``days(d, pos)``: ``is_ann`` and the amount on its days of an event, and ``in_window`` up to the ``k``-th day from one on.

    The events of a code are one short list; between them the days are written out from the calendar
    (one row, broadcast), so no dense row is joined, sorted or shuffled.
    """
    line = F.broadcast(days)  # a row a day
    every = F.broadcast(days.agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "d"))), lambda x: x["d"]).alias("days")))
    at = events.join(line, "d", "left").select("code", F.when(F.col("code").isNotNull() & F.col("pos").isNotNull(), F.struct("pos", "amount")).alias("mark"))
    lists = at.groupBy("code").agg(F.sort_array(F.collect_list("mark")).alias("marks")).join(every, how="cross")  # no nulls in it
    start = lambda i: F.coalesce(F.get("marks", i - 1)["pos"], F.lit(1))
    upto = lambda i: F.coalesce(F.get("marks", i)["pos"], F.size("days") + 1)
    spans = F.transform(F.sequence(F.lit(0), F.size("marks")), lambda i: F.struct((i > 0).alias("own"), F.get("marks", i - 1)["amount"].alias("amount"), F.slice("days", start(i), upto(i) - start(i)).alias("days")))
    rows = lists.select("code", F.explode(spans).alias("s")).select("code", "s.own", "s.amount", F.posexplode("s.days").alias("i", "d"))
    own = F.col("own") & (F.col("i") == 0)
    amount = F.when(own, F.coalesce("amount", F.lit(0.0))).otherwise(0.0)
    return rows.select("code", "d", own.cast("int").alias("is_ann"), amount.alias("amount"), (F.col("own") & (F.col("i") < k)).cast("int").alias("in_window"))


UNLOCKS = """u AS (
  SELECT l_suppkey AS code, coalesce(f.next_on_or_after, CAST(l_shipdate AS DATE)) AS d, coalesce(a.next_on_or_after, CAST(o_orderdate AS DATE)) AS seen, l_quantity AS share, l_discount AS ratio
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey LEFT JOIN calendar f ON f.cal_date = CAST(l_shipdate AS DATE) LEFT JOIN calendar a ON a.cal_date = CAST(o_orderdate AS DATE) WHERE l_returnflag = 'A' AND l_quantity >= 40
), pl AS (
  SELECT l_suppkey AS code, coalesce(c.next_on_or_after, CAST(l_shipdate AS DATE) + 5) AS d, l_quantity * 2 AS ratio, row_number() OVER (PARTITION BY l_suppkey, coalesce(c.next_on_or_after, CAST(l_shipdate AS DATE) + 5) ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC) AS rn
  FROM lineitem LEFT JOIN calendar c ON c.cal_date = CAST(l_shipdate AS DATE) + 5 WHERE l_returnflag = 'N' AND l_linenumber = 1
), o AS (SELECT cal_date AS d, pos FROM calendar WHERE is_open = 1), skel AS (SELECT k.code, o.d, o.pos FROM (SELECT DISTINCT l_suppkey AS code FROM lineitem) k CROSS JOIN o)"""


def unlocks(spark, sf):
    """Large accepted lines as share unlocks: code, float day, announcement day, share, ratio."""
    line = table(spark, sf, "lineitem", "l_orderkey", "l_suppkey", "l_shipdate", "l_quantity", "l_discount", "l_returnflag").where("l_returnflag = 'A' and l_quantity >= 40")
    o = table(spark, sf, "orders", "o_orderkey", "o_orderdate")
    return line.join(o, F.col("o_orderkey") == F.col("l_orderkey")).select(F.col("l_suppkey").alias("code"), F.col("l_shipdate").cast("date").alias("float_date"), F.col("o_orderdate").cast("date").alias("ann_date"), F.col("l_quantity").alias("share"), F.col("l_discount").alias("ratio"))


def pledges(spark, sf):
    """First lines that were not returned as pledge statistics: code, end day, ratio, and an order of arrival."""
    line = table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_quantity", "l_returnflag").where("l_returnflag = 'N' and l_linenumber = 1")
    return line.select(F.col("l_suppkey").alias("code"), F.col("l_shipdate").cast("date").alias("end_date"), (F.col("l_quantity") * 2).alias("pledge_ratio"), F.struct("l_shipdate", "l_orderkey", "l_linenumber").alias("came"))


def unlock_records(events, calendar_, parts: int):
    """Where the signals of unlocks change, as records on open days: shares and ratio of an unlock day, its place, and the next announced unlock (a place, or none)."""
    e = cal.map_on_or_after(cal.map_on_or_after(events.where("code is not null"), calendar_, "float_date", "d"), calendar_, "ann_date", "seen_day")
    e = written_once(e.select("code", "d", "seen_day", "share", "ratio"), "unlocks")
    pos = F.broadcast(calendar_.where("is_open = 1").select(F.col("cal_date").alias("_c"), F.col("pos").alias("_p")))  # a row a day
    own = e.repartition(parts, "code").groupBy("code", "d").agg(F.sum("share").alias("unlock_share"), F.sum("ratio").alias("unlock_ratio"))
    own = own.join(pos, F.col("d") == F.col("_c")).withColumnsRenamed({"_p": "unlock_at"}).drop("_c")
    at = e.join(pos, F.col("d") == F.col("_c")).withColumnsRenamed({"_p": "at"}).drop("_c")
    at = at.join(pos, F.col("seen_day") == F.col("_c"), "left").select("code", F.coalesce("_p", F.lit(-1)).alias("seen"), "at", (F.col("at") + 1).alias("past")).distinct()
    next_ = timeline(at, "code", "seen", "past", [F.asc("at")], ["at"], "pos", parts)
    next_ = next_.groupBy("code", F.greatest("pos", F.lit(1)).alias("_p")).agg(F.max_by(F.struct("at"), F.col("pos")).alias("next"))
    return own.unionByName(next_.join(pos, "_p").select("code", F.col("_c").alias("d"), "next"), allowMissingColumns=True)


def pledge_records(stats, calendar_, parts: int, lag_days: int = 5):
    """The last published pledge ratio of a day, as records; statistics are known ``lag_days`` after their day."""
    known = cal.map_on_or_after(stats.where("code is not null").withColumn("known", F.date_add("end_date", lag_days)), calendar_, "known", "d")
    return J.keep_latest(known.repartition(parts, "code"), ["code", "d"], [F.desc("came")]).select("code", "d", "pledge_ratio")


def event_signals(records, days, parts: int):
    """Dense signals of the records: unlock days, days to the next announced one (-1: none), the window of 15 days before and after, the pledge ratio and whether it is over 50."""
    s = stretch(records, days, "code", "d", ["next", "unlock_at", "pledge_ratio"], ["unlock_share", "unlock_ratio", "own"], "pos", parts)
    s = s.withColumns({
        "is_unlock_day": F.coalesce("own", F.lit(0)).cast("long"),
        "unlock_share": F.coalesce("unlock_share", F.lit(0.0)),
        "unlock_ratio": F.coalesce("unlock_ratio", F.lit(0.0)),
        "days_to_unlock": F.coalesce(F.col("next.at") - F.col("pos"), F.lit(-1)).cast("long"),
        "pledge_ratio": F.coalesce("pledge_ratio", F.lit(0.0)),
    })
    near = F.col("days_to_unlock").between(0, 15) | F.coalesce(F.col("pos") - F.col("unlock_at") < 15, F.lit(False))
    s = s.withColumns({"in_unlock_window": near.cast("long"), "pledge_ratio_high": (F.col("pledge_ratio") > 50).cast("long")})
    return s.drop("pos", "next", "unlock_at", "own")


@query("d11_unlocks_and_pledges", f"""WITH {CALENDAR}, {UNLOCKS}, own AS (SELECT code, d, sum(share) AS share, sum(ratio) AS ratio FROM u GROUP BY 1, 2),
ev AS (SELECT DISTINCT u.code, coalesce(b.pos, -1) AS seen, o.pos AS due FROM u JOIN o ON o.d = u.d LEFT JOIN o b ON b.d = u.seen),
near AS (SELECT skel.code, skel.d, min(due - pos) AS days FROM skel JOIN ev ON ev.code = skel.code AND seen <= pos AND pos <= due GROUP BY 1, 2),
j AS (SELECT skel.code, skel.d, coalesce(share, 0) AS share, coalesce(own.ratio, 0) AS ratio, (own.d IS NOT NULL)::BIGINT AS day, coalesce(days, -1) AS days, pl.ratio AS pledge
  FROM skel LEFT JOIN own ON own.code = skel.code AND own.d = skel.d LEFT JOIN near ON near.code = skel.code AND near.d = skel.d LEFT JOIN pl ON pl.code = skel.code AND pl.d = skel.d AND rn = 1),
z AS (SELECT *, (days BETWEEN 0 AND 15 OR sum(day) OVER ({P} ROWS BETWEEN 14 PRECEDING AND CURRENT ROW) > 0)::BIGINT AS win, coalesce(last_value(pledge IGNORE NULLS) OVER ({P} ROWS UNBOUNDED PRECEDING), 0) AS pr FROM j)
SELECT code, d, day AS is_unlock_day, share AS unlock_share, round(ratio, 6) AS unlock_ratio, days::BIGINT AS days_to_unlock, win AS in_unlock_window, pr AS pledge_ratio, (pr > 50)::BIGINT AS pledge_ratio_high, (win = 1)::BIGINT AS has_event, (pr > 50 OR win = 1)::BIGINT AS has_risk_event FROM z""")
def d11_legs(spark, sf):
    c, days, parts = calendar(spark, sf), open_days(spark, sf), panel_parts(spark, sf)
    codes = table(spark, sf, "lineitem", "l_suppkey").select(F.col("l_suppkey").alias("code")).distinct()
    records = unlock_records(unlocks(spark, sf), c, parts).withColumn("own", F.when(F.col("unlock_at").isNotNull(), 1))
    records = records.unionByName(pledge_records(pledges(spark, sf), c, parts), allowMissingColumns=True)
    records = records.unionByName(codes.join(F.broadcast(days.agg(F.min("d").alias("d"))), how="cross"), allowMissingColumns=True)
    s = event_signals(written_once(records, "event_records"), days, parts)
    s = s.withColumn("unlock_ratio", _r(F.col("unlock_ratio"))).withColumn("has_event", F.col("in_unlock_window"))
    s = s.withColumn("has_risk_event", ((F.col("pledge_ratio_high") == 1) | (F.col("in_unlock_window") == 1)).cast("long"))
    return s.select("code", "d", "is_unlock_day", "unlock_share", "unlock_ratio", "days_to_unlock", "in_unlock_window", "pledge_ratio", "pledge_ratio_high", "has_event", "has_risk_event")


@query("d12_category_history", f"WITH {INTERVALS}, k AS (SELECT kind, row_number() OVER (ORDER BY kind) - 1 AS idx FROM (SELECT DISTINCT kind FROM reports)) SELECT code, start, idx::BIGINT AS idx, coalesce(lag(i.kind) OVER w <> i.kind, false)::BIGINT AS changed FROM intervals i JOIN k USING (kind) WINDOW w AS (PARTITION BY code ORDER BY start, o_orderkey)")
def d12(spark, sf):
    i = intervals(spark, sf)
    return ordinal_codes(i, "kind", "idx").select("code", "start", "idx", F.coalesce(F.lag("kind").over(Window.partitionBy("code").orderBy("start", "o_orderkey")) != F.col("kind"), F.lit(False)).cast("long").alias("changed"))


NO_CLASS = "unclassified"
#: The first-level class that stands in for a base industry (here: a region's suppliers) where no membership names one.
CLASS_OF = {"AFRICA": "A1", "AMERICA": "B1", "ASIA": "A1"}
CLASS_CODE = {"A1": "c-01", "B1": "c-02", "NF": "c-03", "RF": "c-04"}


def memberships(spark, sf):
    """Large lines as memberships of a class from their day to 200 days later, end excluded; they overlap, and some name no class."""
    line = table(spark, sf, "lineitem", "l_suppkey", "l_shipdate", "l_quantity", "l_returnflag", "l_linestatus", "l_orderkey", "l_linenumber").where("l_quantity >= 46")
    day = F.col("l_shipdate").cast("date")
    name = F.when(F.col("l_linenumber") != 2, F.concat("l_returnflag", "l_linestatus"))
    code = F.when(name == "NF", F.lit(CLASS_CODE["NF"]))
    return line.select(F.col("l_suppkey").alias("code"), day.alias("in_date"), F.date_add(day, 200).alias("out_date"), name.alias("l1_name"), code.alias("l1_code"), "l_orderkey", "l_linenumber")


def industry_history(codes, days, base, members, class_of: dict[str, str], class_code: dict[str, str], parts: int):
    """A class for every code and day: the latest membership that covers the day, else the base industry's; with codes, changes and indexes (-1: none).

    Classes are found where they change; only these records are sorted, and the days between are written out.
    """
    named = lambda m, c: F.try_element_at(F.create_map(*[F.lit(x) for kv in m.items() for x in kv]), c)
    order = [F.desc("in_date"), F.desc_nulls_last("l_orderkey"), F.desc_nulls_last("l_linenumber")]
    s = timeline(members, "code", "in_date", "out_date", order, ["l1_name", "l1_code"], "d", parts)
    none = [F.lit(None).cast("string").alias(c) for c in ("l1_name", "l1_code")]
    s = s.unionByName(codes.select("code", F.to_date(F.lit("0001-01-01")).alias("d"), *none))  # no membership before the first
    s = on_listed_days(s, days, "code", "d", ["l1_name", "l1_code"], parts)
    s = s.join(base, "code", "left").withColumn("industry", F.coalesce("industry", F.lit(NO_CLASS)))
    known = F.when(F.col("l1_name") != NO_CLASS, F.col("l1_name"))
    s = s.withColumn("l1_name", F.coalesce(known, named(class_of, F.col("industry")), F.lit(NO_CLASS)))
    s = s.withColumn("l1_code", F.coalesce("l1_code", named(class_code, F.col("l1_name"))))
    before = F.lag("l1_name").over(W())
    s = s.withColumn("changed", F.coalesce((F.col("l1_name") != before) & (F.col("l1_name") != NO_CLASS) & (before != NO_CLASS), F.lit(False)).cast("long"))
    s = written_once(s, "classes")
    r = s
    for c, out in (("industry", "industry_idx"), ("l1_name", "l1_idx")):
        r = r.join(sorted_codes(s.where(F.col(c) != NO_CLASS), c, out), c, "left").na.fill(-1, [out])
    r = r.select("code", "d", F.struct("industry", "l1_name", "l1_code", "industry_idx", "l1_idx").alias("of"), "changed")
    return stretch(r, days, "code", "d", ["of"], ["changed"], parts=parts).select("code", "d", "of.*", F.coalesce("changed", F.lit(0)).alias("changed"))


@query("d12_industry", f"""WITH {OPEN_DAYS}, m AS (
  SELECT l_suppkey AS code, CAST(l_shipdate AS DATE) AS a, CAST(l_shipdate AS DATE) + 200 AS b, CASE WHEN l_linenumber <> 2 THEN l_returnflag || l_linestatus END AS n, l_orderkey AS o, l_linenumber AS l FROM lineitem WHERE l_quantity >= 46
), s AS (SELECT k.code, d FROM (SELECT DISTINCT l_suppkey AS code FROM lineitem) k CROSS JOIN open_days),
x AS (SELECT s.code, s.d, arg_max(coalesce(n, '?'), {{'a': a, 'o': o, 'l': l}}) AS n FROM s LEFT JOIN m ON m.code = s.code AND s.d >= a AND s.d < b GROUP BY 1, 2),
y AS (SELECT x.code, x.d, nullif(n, '?') AS n, coalesce(r_name, '{NO_CLASS}') AS industry FROM x LEFT JOIN supplier ON s_suppkey = code LEFT JOIN nation ON n_nationkey = s_nationkey LEFT JOIN region ON r_regionkey = n_regionkey),
z AS (SELECT code, d, industry, n AS given, coalesce(n, """ + "CASE industry " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CLASS_OF.items()) + f""" END, '{NO_CLASS}') AS l1_name FROM y),
i AS (SELECT industry, row_number() OVER (ORDER BY industry) - 1 AS i FROM (SELECT DISTINCT industry FROM z WHERE industry <> '{NO_CLASS}')), c AS (SELECT l1_name, row_number() OVER (ORDER BY l1_name) - 1 AS i FROM (SELECT DISTINCT l1_name FROM z WHERE l1_name <> '{NO_CLASS}'))
SELECT code, d, z.industry, z.l1_name, CASE z.l1_name """ + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CLASS_CODE.items()) + f""" END AS l1_code, coalesce(i.i, -1)::BIGINT AS industry_idx, coalesce(c.i, -1)::BIGINT AS l1_idx,
  coalesce(z.l1_name <> lag(z.l1_name) OVER ({P}) AND z.l1_name <> '{NO_CLASS}' AND lag(z.l1_name) OVER ({P}) <> '{NO_CLASS}', false)::BIGINT AS changed
FROM z LEFT JOIN i USING (industry) LEFT JOIN c ON c.l1_name = z.l1_name""")
def d12_industry(spark, sf):
    base = table(spark, sf, "supplier", "s_suppkey", "s_nationkey").join(table(spark, sf, "nation"), F.col("n_nationkey") == F.col("s_nationkey")).join(table(spark, sf, "region"), F.col("r_regionkey") == F.col("n_regionkey"))
    codes = table(spark, sf, "lineitem", "l_suppkey").select(F.col("l_suppkey").alias("code")).distinct()
    out = industry_history(codes, open_days(spark, sf), base.select(F.col("s_suppkey").alias("code"), F.col("r_name").alias("industry")), memberships(spark, sf), CLASS_OF, CLASS_CODE, panel_parts(spark, sf))
    return out.select("code", "d", "industry", "l1_name", "l1_code", "industry_idx", "l1_idx", "changed")


@query("d13_benchmark", f"WITH {PANEL} SELECT code, d, round((high - low) / nullif(lag(close) OVER ({P}), 0) * 100, 6) AS amplitude, round(amount / avg(amount) OVER (PARTITION BY code), 6) AS turnover FROM panel")
def d13(spark, sf):
    return price_panel(spark, sf).select("code", "d", _r(F.try_divide(F.col("high") - F.col("low"), F.lag("close").over(W())) * 100).alias("amplitude"), _r(F.try_divide(F.col("amount"), F.avg("amount").over(Window.partitionBy("code")))).alias("turnover"))


@query("d14_basis", f"WITH {PANEL}, a AS (SELECT d, max({{'v': vol, 'c': -code}}).c * -1 AS lead_code, sum(vol) AS oi FROM panel GROUP BY 1) SELECT a.d, lead_code, oi, round((p.close - m.mean) / nullif(m.mean, 0), 6) AS basis FROM a JOIN panel p ON p.code = lead_code AND p.d = a.d LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS d, round(avg(o_totalprice), 6) AS mean FROM orders GROUP BY 1) m ON m.d = a.d")
def d14(spark, sf):
    order = F.struct("vol", -F.col("code"))
    a = price_panel(spark, sf).groupBy("d").agg(F.max_by("code", order).alias("lead_code"), F.max_by("close", order).alias("f"), F.sum("vol").alias("oi"))
    return a.join(daily(spark, sf).select("d", "mean"), "d", "left").select("d", "lead_code", "oi", _r(F.try_divide(F.col("f") - F.col("mean"), F.col("mean"))).alias("basis"))


@query("d15_regime", f"""WITH {DAILY}, s AS (SELECT d, CASE WHEN n > 10 THEN 2 WHEN n > 6 THEN 1 ELSE 0 END AS pmi, coalesce(sign(total - lag(total) OVER (ORDER BY d)), 0)::INTEGER AS trend, CASE WHEN mean > 160000 THEN 1 WHEN mean < 120000 THEN -1 ELSE 0 END AS money,
  CASE WHEN mean < avg(mean) OVER (ORDER BY d ROWS BETWEEN 59 PRECEDING AND CURRENT ROW) THEN 1 ELSE 0 END AS appetite FROM daily)
SELECT d, pmi, trend, money, appetite, (pmi + trend + money + appetite)::BIGINT AS score, CASE WHEN pmi + trend + money + appetite >= 2 THEN 1 WHEN pmi + trend + money + appetite <= -2 THEN -1 ELSE 0 END AS regime FROM s""")
def d15(spark, sf):
    return regimes(daily(spark, sf)).select("d", "pmi", "trend", "money", "appetite", "score", "regime")


def regimes(series):
    """Four signals of a day (activity, trend, money, appetite), their sum, and the regime: 1 from two on, -1 from minus two on."""
    w = Window.orderBy("d")  # a row a day
    s = series.withColumns({
        "pmi": F.when(F.col("n") > 10, 2).when(F.col("n") > 6, 1).otherwise(0),
        "trend": F.coalesce(F.signum(ts.difference(F.col("total"), w)), F.lit(0.0)).cast("int"),
        "money": F.when(F.col("mean") > 160000, 1).when(F.col("mean") < 120000, -1).otherwise(0),
        "appetite": F.when(F.col("mean") < ts.rolling_mean(F.col("mean"), w, 60, 1), 1).otherwise(0),
    })
    s = s.withColumn("score", (F.col("pmi") + F.col("trend") + F.col("money") + F.col("appetite")).cast("long"))
    return s.withColumn("regime", F.when(F.col("score") >= 2, 1).when(F.col("score") <= -2, -1).otherwise(0))


#: Sixteen calendar series: name, table, value and condition; the first six carry forward, the next four do not, the last six too.
SERIES = (
    *[(f"n_{k}", "o", "1", f"o_orderpriority = '{v}'") for k, v in (("urgent", "1-URGENT"), ("high", "2-HIGH"), ("medium", "3-MEDIUM"), ("plain", "4-NOT SPECIFIED"), ("low", "5-LOW"))],
    ("n_orders", "o", "1", "true"),
    *[(f"margin_{k.lower()}", "o", "o_totalprice", f"o_orderstatus = '{k}'") for k in "FOP"],
    ("margin_all", "o", "o_totalprice", "true"),
    *[(f"amount_{k.lower()}", "l", "l_extendedprice", f"l_returnflag = '{k}'") for k in "ANR"],
    *[(f"line_{k.lower()}", "l", "l_extendedprice", f"l_linestatus = '{k}'") for k in "FO"],
    ("quantity", "l", "l_quantity", "true"),
)
LAUNCH = {"amount_r": "1996-07-01", "line_o": "1997-01-01"}
_STAY = [n for n, *_ in SERIES if n.startswith("margin")]


def _series_sql(t: str) -> str:
    return ", ".join(f"sum({v}) FILTER (WHERE {c})::DOUBLE AS {n}" for n, k, v, c in SERIES if k == t)


def _macro_column(n: str) -> str:
    c = n if n in _STAY else f"last_value({n} IGNORE NULLS) OVER w"
    c = f"round(coalesce({c}, 0), 2)"
    return f"CASE WHEN cal_date < DATE '{LAUNCH[n]}' THEN 0 ELSE {c} END AS {n}" if n in LAUNCH else f"{c} AS {n}"


@query("d16_macro_assembly", f"""WITH {CALENDAR}, {DAILY}, o AS (SELECT CAST(o_orderdate AS DATE) AS d, {_series_sql("o")} FROM orders GROUP BY 1), l AS (SELECT CAST(l_shipdate AS DATE) AS d, {_series_sql("l")} FROM lineitem GROUP BY 1),
s AS (SELECT d, CASE WHEN n > 10 THEN 2 WHEN n > 6 THEN 1 ELSE 0 END + coalesce(sign(total - lag(total) OVER (ORDER BY d)), 0) + CASE WHEN mean > 160000 THEN 1 WHEN mean < 120000 THEN -1 ELSE 0 END + CASE WHEN mean < avg(mean) OVER (ORDER BY d ROWS BETWEEN 59 PRECEDING AND CURRENT ROW) THEN 1 ELSE 0 END AS score FROM daily)
SELECT cal_date AS d, {", ".join(_macro_column(n) for n, *_ in SERIES)}, coalesce(last_value(score IGNORE NULLS) OVER w, 0)::BIGINT AS score FROM calendar LEFT JOIN o ON o.d = cal_date LEFT JOIN l ON l.d = cal_date LEFT JOIN s ON s.d = cal_date WINDOW w AS (ORDER BY cal_date ROWS UNBOUNDED PRECEDING)""")
def d16(spark, sf):
    o = table(spark, sf, "orders", "o_orderdate", "o_totalprice", "o_orderstatus", "o_orderpriority").withColumn("d", F.col("o_orderdate").cast("date"))
    line = table(spark, sf, "lineitem", "l_shipdate", "l_extendedprice", "l_quantity", "l_returnflag", "l_linestatus").withColumn("d", F.col("l_shipdate").cast("date"))
    of = lambda df, t: df.groupBy("d").agg(*[F.sum(F.when(F.expr(c), F.expr(v))).cast("double").alias(n) for n, k, v, c in SERIES if k == t])
    days = calendar(spark, sf).select(F.col("cal_date").alias("d"))
    score = regimes(daily(spark, sf)).select("d", "score")
    return macro_assembly(days, [of(o, "o"), of(line, "l"), score], {n for n, *_ in SERIES if n not in _STAY} | {"score"}, LAUNCH)


def macro_assembly(days, series, carried, launch):
    """Calendar series side by side: the ``carried`` ones hold until the next value, what is missing then is 0, and nothing has a value before its launch."""
    s = days
    for t in series:
        s = s.join(t, "d", "left")
    w = Window.orderBy("d")  # a row a day
    s = s.withColumns({c: ts.ffill(c, w) for c in s.columns if c in carried})
    s = s.na.fill(0.0).na.fill(0).withColumns({c: F.round(c, 2) for c, t in s.dtypes if t == "double"})
    return s.withColumns({c: F.when(F.col("d") < F.lit(day).cast("date"), 0.0).otherwise(F.col(c)) for c, day in launch.items()})


@query("d17_panel_merge", f"WITH {PANEL}, {DAILY}, s AS (SELECT s_suppkey AS code, s_nationkey, s_acctbal FROM supplier) SELECT code, d, close, s_nationkey::BIGINT AS nation, CASE WHEN s_acctbal > 0 THEN s_acctbal END AS bal, lagged.total FROM panel LEFT JOIN s USING (code) LEFT JOIN (SELECT d, lag(total) OVER (ORDER BY d) AS total FROM daily) lagged USING (d)")
def d17(spark, sf):
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("code"), F.col("s_nationkey").cast("long").alias("nation"), F.when(F.col("s_acctbal") > 0, F.col("s_acctbal")).alias("bal"))
    m = daily(spark, sf).select("d", F.lag("total").over(Window.orderBy("d")).alias("total"))
    return J.left_keep(J.left_keep(price_panel(spark, sf).select("code", "d", "close"), s, ["code"]), F.broadcast(m), ["d"])


@query("e01_moving_averages", f"WITH {PANEL} SELECT code, d, " + ", ".join(f"CASE WHEN count(close) {_frame(n)} = {n} THEN round(avg(close) {_frame(n)}, 6) END AS ma_{n}" for n in (5, 10, 20, 60, 120, 250)) + " FROM panel")
def e01(spark, sf):
    p = sliding(price_panel(spark, sf), "code", "d", [(f"ma_{n}", "close", "mean", n, n) for n in (60, 120, 250)])
    short = {f"ma_{n}": ts.rolling_mean(F.col("close"), W(), n) for n in (5, 10, 20)}
    return p.withColumns(short).select("code", "d", *[_r(F.col(f"ma_{n}")).alias(f"ma_{n}") for n in (5, 10, 20, 60, 120, 250)])


@query("e02_bias", f"WITH {PANEL}, m AS (SELECT code, d, close, CASE WHEN count(close) {_frame(20)} = 20 THEN avg(close) {_frame(20)} END AS ma FROM panel) SELECT code, d, round((close - ma) / nullif(ma, 0), 7) AS bias_20 FROM m")
def e02(spark, sf):
    m = price_panel(spark, sf).withColumn("ma", ts.rolling_mean(F.col("close"), W(), 20))
    return m.select("code", "d", _r(F.try_divide(F.col("close") - F.col("ma"), F.col("ma")), 7).alias("bias_20"))


@query("e03_rate_of_change", f"WITH {PANEL} SELECT code, d, " + ", ".join(f"round(close / nullif(lag(close, {n}) OVER ({P}), 0) - 1, 8) AS roc_{n}" for n in (5, 10, 20)) + " FROM panel")
def e03(spark, sf):
    return price_panel(spark, sf).select("code", "d", *[_r(F.try_divide(F.col("close"), F.lag("close", n).over(W())) - 1, 8).alias(f"roc_{n}") for n in (5, 10, 20)])


@query("e04_rsi", f"""WITH {PANEL}, m AS (SELECT code, d, close - lag(close) OVER ({P}) AS v FROM panel), g AS (SELECT code, d, CASE WHEN v IS NOT NULL THEN greatest(v, 0) END AS g, CASE WHEN v IS NOT NULL THEN greatest(-v, 0) END AS l FROM m)
SELECT code, d, """ + ", ".join(f"CASE WHEN count(g) {_frame(n)} = {n} THEN round(100 - 100 / (1 + avg(g) {_frame(n)} / (avg(l) {_frame(n)} + 1e-10)), 4) END AS rsi_{n}" for n in (6, 12, 24)) + " FROM g")
def e04(spark, sf):
    out = price_panel(spark, sf)
    for n in (6, 12, 24):
        out = out.transform(ts.rsi(F.col("close"), W(), n))
    return out.select("code", "d", *[F.round(f"rsi_{n}", 4).alias(f"rsi_{n}") for n in (6, 12, 24)])


@query("e05_macd", f"""WITH RECURSIVE {PANEL}, s AS (SELECT code, d, close, row_number() OVER ({P}) AS i FROM panel), r AS (
  SELECT code, d, i, close AS f, close AS s, 0.0::DOUBLE AS g FROM s WHERE i = 1 UNION ALL
  SELECT code, d, i, f, s, g + 0.2::DOUBLE * (f - s - g) FROM (
    SELECT s.code, s.d, s.i, r.f + 2::DOUBLE / 13 * (s.close - r.f) AS f, r.s + 2::DOUBLE / 27 * (s.close - r.s) AS s, r.g FROM r JOIN s ON s.code = r.code AND s.i = r.i + 1)
) SELECT code, d, round(f - s, 6) AS dif, round(g, 6) AS signal, round(f - s - g, 6) AS hist FROM r""")
def e05(spark, sf):
    m = ts.macd(price_panel(spark, sf).select("code", "d", "close"), "code", "d", "close")
    return m.select("code", "d", _r(F.col("dif")).alias("dif"), _r(F.col("signal")).alias("signal"), _r(F.col("dif") - F.col("signal")).alias("hist"))


@query("e06_volatility", f"WITH {PANEL}, x AS (SELECT code, d, close / nullif(lag(close) OVER ({P}), 0) - 1 AS r FROM panel) SELECT code, d, CASE WHEN count(r) {_frame(20)} = 20 THEN round(stddev_samp(r) {_frame(20)}, 6) END AS vol_20 FROM x")
def e06(spark, sf):
    return price_panel(spark, sf).withColumn("r", F.try_divide(F.col("close"), F.lag("close").over(W())) - 1).select("code", "d", _r(ts.rolling_std(F.col("r"), W(), 20)).alias("vol_20"))


@query("e07_amplitude", f"WITH {PANEL}, x AS (SELECT code, d, (high - low) / nullif(lag(close) OVER ({P}), 0) AS a FROM panel) SELECT code, d, round(a, 7) AS amplitude, CASE WHEN count(a) {_frame(10)} = 10 THEN round(avg(a) {_frame(10)}, 7) END AS amplitude_10 FROM x")
def e07(spark, sf):
    x = price_panel(spark, sf).withColumn("a", F.try_divide(F.col("high") - F.col("low"), F.lag("close").over(W())))
    return x.select("code", "d", _r(F.col("a"), 7).alias("amplitude"), _r(ts.rolling_mean(F.col("a"), W(), 10), 7).alias("amplitude_10"))


@query("e08_volume_ratio", f"WITH {PANEL} SELECT code, d, CASE WHEN count(vol) {_frame(5)} = 5 THEN round(vol / nullif(avg(vol) {_frame(5)}, 0), 7) END AS volume_ratio FROM panel")
def e08(spark, sf):
    return price_panel(spark, sf).select("code", "d", _r(F.try_divide(F.col("vol"), ts.rolling_mean(F.col("vol"), W(), 5)), 7).alias("volume_ratio"))


@query("e09_logs", f"WITH {PANEL} SELECT code, d, round(ln(1 + greatest(amount, 0)), 8) AS log_amount, round(ln(1 + greatest(vol, 0)), 8) AS log_vol FROM panel")
def e09(spark, sf):
    return price_panel(spark, sf).select("code", "d", _r(F.log1p(F.greatest("amount", F.lit(0.0))), 8).alias("log_amount"), _r(F.log1p(F.greatest("vol", F.lit(0.0))), 8).alias("log_vol"))


_NET = {"sm": "buy_sm - sell_sm", "md": "buy_md - sell_md", "lg": "buy_lg - sell_lg", "elg": "buy_elg - sell_elg", "main": "buy_lg + buy_elg - sell_lg - sell_elg", "retail": "buy_sm + buy_md - sell_sm - sell_md", "main_buy": "buy_lg + buy_elg", "main_sell": "sell_lg + sell_elg", "retail_buy": "buy_sm + buy_md", "retail_sell": "sell_sm + sell_md"}


@query("e10_flow_intensity", f"WITH {TRADES}, {DAILY} SELECT code, d, " + ", ".join(f"round(({v}) / (amount + 1e-10), 6) + 0.0 AS mf_{k}" for k, v in _NET.items()) + ", sign(round(buy_lg + buy_elg - sell_lg - sell_elg, 2))::BIGINT AS main_side, coalesce(n, 0)::BIGINT AS north_net FROM trades LEFT JOIN daily USING (d)")
def e10(spark, sf):
    north = daily(spark, sf).select("d", F.col("n").alias("north_net"))
    t = trades(spark, sf).join(F.broadcast(north), "d", "left").na.fill(0, ["north_net"])
    ratios = [(_r(F.expr(v) / (F.col("amount") + 1e-10)) + F.lit(0.0)).alias(f"mf_{k}") for k, v in _NET.items()]
    return t.select("code", "d", *ratios, F.signum(F.round(F.expr(_NET["main"]), 2)).cast("long").alias("main_side"), "north_net")


@query("e11_stability", f"WITH {REPORTS}, x AS (SELECT code, ann, o_orderkey, value, (value - lag(value) OVER w) / nullif(lag(value) OVER w, 0) AS p FROM reports WINDOW w AS (PARTITION BY code ORDER BY ann, o_orderkey)) SELECT code, o_orderkey, round(ln(value + 1), 8) AS ln_value, CASE WHEN p IS NOT NULL THEN round((0.5 + least(greatest(-p, -1), 1)) / 2, 8) END AS stability FROM x")
def e11(spark, sf):
    p = ts.pct_change(F.col("value"), Window.partitionBy("code").orderBy("ann", "o_orderkey"))
    return reports(spark, sf).select("code", "o_orderkey", _r(F.log(F.col("value") + 1), 8).alias("ln_value"), _r((0.5 + xsec.clip(-p, -1.0, 1.0)) / 2, 8).alias("stability"))


@query("e12_relative_strength", f"WITH {PANEL}, {DAILY}, b AS (SELECT d, (mean - lag(mean) OVER (ORDER BY d)) / nullif(lag(mean) OVER (ORDER BY d), 0) * 100 AS pct FROM daily) SELECT code, d, round(close / nullif(lag(close) OVER ({P}), 0) - 1 - coalesce(pct, 0) / 100, 7) AS alpha FROM panel LEFT JOIN b USING (d)")
def e12(spark, sf):
    return relative_strength(price_panel(spark, sf), daily(spark, sf).select("d", (ts.pct_change(F.col("mean"), Window.orderBy("d")) * 100).alias("pct"))).select("code", "d", _r(F.col("alpha"), 7).alias("alpha"))


def relative_strength(panel, benchmark, bench_scale: float = 0.01):
    """Return less the benchmark's; ``bench_scale`` turns its percent into a fraction (1.0: as they come)."""
    ret = F.try_divide(F.col("close"), F.lag("close").over(W())) - 1
    return panel.withColumn("ret", ret).join(F.broadcast(benchmark), "d", "left").withColumn("alpha", F.col("ret") - F.coalesce("pct", F.lit(0.0)) * F.lit(bench_scale))


INDEXES = {"csi": "signup", "large": "purchase", "small": "view"}


@query("e13_membership", "WITH x AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events), " + ", ".join(f"{k} AS (SELECT user_id, CAST(ts AS DATE) + 1 AS d, max(value) AS weight FROM events WHERE event_type = '{e}' GROUP BY 1, 2)" for k, e in INDEXES.items())
  + " SELECT x.user_id, x.d, " + ", ".join(f"({k}.weight IS NOT NULL)::BIGINT AS in_{k}, coalesce({k}.weight, 0) AS weight_{k}" for k in INDEXES) + " FROM x " + " ".join(f"ASOF LEFT JOIN {k} ON x.user_id = {k}.user_id AND x.d >= {k}.d" for k in INDEXES))
def e13(spark, sf):
    e = table(spark, sf, "events", "user_id", "ts", "event_type", "value").withColumn("d", F.col("ts").cast("date"))
    return memberships_of(e.select("user_id", "d").distinct(), e, INDEXES)


def memberships_of(rows, weights, indexes: dict[str, str], lag_days: int = 1):
    """Flag and weight for each index: the last weight known by the day, which is ``lag_days`` after its own.

    All indexes are met in one as-of join: their weights are columns of one table, carried forward.
    """
    w = weights.where(F.col("event_type").isin(*indexes.values())).groupBy("user_id", F.date_add("d", lag_days).alias("d"))
    w = w.agg(*[F.max(F.when(F.col("event_type") == e, F.col("value"))).alias(k) for k, e in indexes.items()])
    w = w.select("user_id", "d", *[ts.ffill(k, Window.partitionBy("user_id").orderBy("d")).alias(k) for k in indexes])
    j = J.asof_backward(rows, w, "user_id", "d", list(indexes))
    return j.select("user_id", "d", *[c for k in indexes for c in (F.col(k).isNotNull().cast("long").alias(f"in_{k}"), F.coalesce(k, F.lit(0.0)).alias(f"weight_{k}"))])


_MIX = {"ep_spread": "ep * (rate - disc)", "bp_spread": "bp * (rate - disc)", "amount_rate": "ln(1 + amount) * rate / 100", "vol_money": "ln(1 + vol) * n", "ep_real": "ep / (1 + disc / 100)", "growth_real": "growth / (1 + rate / 100)", "growth_gap": "growth - rate"}


@query("e14_macro_interaction", f"WITH {PANEL}, {DAILY}, r AS (SELECT CAST(l_shipdate AS DATE) AS d, round(100 * avg(l_tax), 6) AS rate, round(100 * avg(l_discount), 6) AS disc FROM lineitem GROUP BY 1), x AS (SELECT code, panel.d, amount, vol, vol / nullif(close, 0) AS ep, amount / nullif(close * 100, 0) AS bp, close / nullif(lag(close) OVER (PARTITION BY code ORDER BY panel.d), 0) - 1 AS growth, n, rate, disc FROM panel JOIN daily ON daily.d = panel.d JOIN r ON r.d = panel.d) SELECT code, d, " + ", ".join(f"round({v}, 9) + 0.0 AS {k}" for k, v in _MIX.items()) + " FROM x")
def e14(spark, sf):
    r = table(spark, sf, "lineitem", "l_shipdate", "l_tax", "l_discount").groupBy(F.col("l_shipdate").cast("date").alias("d")).agg(_r(100 * F.avg("l_tax")).alias("rate"), _r(100 * F.avg("l_discount")).alias("disc"))
    x = price_panel(spark, sf).join(F.broadcast(daily(spark, sf).select("d", "n")), "d").join(F.broadcast(r), "d")  # a row a day each
    x = x.withColumns({"ep": F.try_divide("vol", "close"), "bp": F.try_divide(F.col("amount"), F.col("close") * 100), "growth": F.try_divide("close", F.lag("close").over(W())) - 1})
    return x.select("code", "d", *[(_r(F.expr(v), 9) + F.lit(0.0)).alias(k) for k, v in _MIX.items()])


@query("e15_rolling_beta", f"WITH {PANEL} SELECT code, d, CASE WHEN count(vol) {_frame(60)} = 60 THEN round(regr_slope(amount, vol) {_frame(60)}, 4) END AS beta FROM panel")
def e15(spark, sf):
    f = W().rowsBetween(-59, 0)
    return price_panel(spark, sf).select("code", "d", F.when((F.count("vol").over(f) == 60) & (F.stddev_pop("vol").over(f) > 0), F.round(F.regr_slope("amount", "vol").over(f), 4)).alias("beta"))


@query("q01_price_clean", f"WITH {PANEL}, x AS (SELECT code, d, vol, close / nullif(lag(close) OVER ({P}), 0) - 1 AS r FROM panel) SELECT code, d, CASE WHEN r IS NOT NULL THEN round(least(greatest(r, -0.3), 1.0), 8) END AS r, (vol > 0)::BIGINT AS is_trading FROM x")
def q01(spark, sf):
    r = F.try_divide(F.col("close"), F.lag("close").over(W())) - 1
    return price_panel(spark, sf).withColumn("r", r).select("code", "d", _r(xsec.clip(F.col("r"), -0.3, 1.0), 8).alias("r"), (F.col("vol") > 0).cast("long").alias("is_trading"))


_FUND = {"value": "value", "yoy": "value / nullif(before, 0) - 1", "diff": "value - before", "root": "sqrt(value)", "share": "value / nullif(total, 0)", "lagged": "before", "age": "CAST(lag_days AS DOUBLE)"}


@query("q02_fundamental_clean", f"WITH {REPORTS}, r AS (SELECT *, lag(value) OVER w AS before, sum(value) OVER (PARTITION BY code) AS total, date_diff('day', period_end, ann) AS lag_days FROM reports WINDOW w AS (PARTITION BY code ORDER BY ann, o_orderkey)), f AS (SELECT o_orderkey, lag_days, value AS raw, " + ", ".join(f"{v} AS {k}" for k, v in _FUND.items()) + " FROM r), b AS (SELECT " + ", ".join(f"quantile_cont({k}, 0.01) AS {k}_lo, quantile_cont({k}, 0.99) AS {k}_hi" for k in _FUND) + " FROM f) SELECT o_orderkey, "
  + ", ".join(f"CASE WHEN lag_days <= 60 AND {k} IS NOT NULL THEN round(least(greatest({k}, {k}_lo), {k}_hi), 7) + 0.0 END AS {k}" for k in _FUND) + ", coalesce(CASE WHEN lag_days <= 60 THEN round(1 / greatest(raw, 1e-8), 12) END, 0) AS inv FROM f, b")
def q02(spark, sf):
    w = Window.partitionBy("code").orderBy("ann", "o_orderkey")
    r = reports(spark, sf).withColumns({"before": F.lag("value").over(w), "total": F.sum("value").over(Window.partitionBy("code")), "lag_days": F.datediff("ann", "period_end")})
    r = r.select("o_orderkey", "lag_days", F.col("value").alias("raw"), *[F.expr(v).alias(k) for k, v in _FUND.items()])
    return fundamental_clean(r, list(_FUND), "raw", 60).select("o_orderkey", *[(_r(F.col(k), 7) + F.lit(0.0)).alias(k) for k in _FUND], F.round("inv", 12).alias("inv"))


def fundamental_clean(r, fields, ratio: str, stale_days: int):
    """The inverse of a ratio as it came, fields within their 1 and 99 percent quantiles, all null where the report is stale; an inverse that is missing is 0."""
    from quantloom.functions.scalar import signed_inverse

    r = xsec.winsorize(r.withColumn("inv", signed_inverse(F.col(ratio), 1e-8)), fields)
    fresh = F.col("lag_days").isNull() | (F.col("lag_days") <= stale_days)
    return r.withColumns({c: F.when(fresh, F.col(c)) for c in (*fields, "inv")}).na.fill(0.0, ["inv"])


@query("q03_tradable", f"WITH {PANEL} SELECT code, d, (coalesce(vol > 20, false) AND NOT coalesce(close > 1500, false) AND code % 7 <> 0)::BIGINT AS is_tradable, (coalesce(close > 1500, false) OR code % 7 = 0)::BIGINT AS is_risky FROM panel")
def q03(spark, sf):
    hot, st = F.coalesce(F.col("close") > 1500, F.lit(False)), F.col("code") % 7 == 0
    return price_panel(spark, sf).select("code", "d", (F.coalesce(F.col("vol") > 20, F.lit(False)) & ~hot & ~st).cast("long").alias("is_tradable"), (hot | st).cast("long").alias("is_risky"))


@query("q04_flow_clean", f"WITH {FLOWS} SELECT code, d, CASE WHEN n < 2 THEN 0 ELSE purchase END AS purchase FROM flows")
def q04(spark, sf):
    return flows(spark, sf).select("code", "d", F.when(F.col("n") < 2, 0.0).otherwise(F.col("purchase")).alias("purchase"))


@query("q05_ratio_clean", f"WITH {DAILY}, m AS (SELECT max(n) AS top FROM daily) SELECT d, CASE WHEN top > 10 THEN least(greatest(n, 0), 10) ELSE n END::BIGINT AS n FROM daily, m")
def q05(spark, sf):
    s = daily(spark, sf)
    return s.join(F.broadcast(s.agg(F.max("n").alias("top"))), how="cross").select("d", F.when(F.col("top") > 10, F.least(F.greatest("n", F.lit(0)), F.lit(10))).otherwise(F.col("n")).alias("n"))


@query("q06_category_clean", "SELECT c_custkey, coalesce(CASE WHEN c_nationkey < 20 THEN c_nationkey END, -1)::BIGINT AS idx FROM customer")
def q06(spark, sf):
    return table(spark, sf, "customer", "c_custkey", "c_nationkey").select("c_custkey", F.coalesce(F.when(F.col("c_nationkey") < 20, F.col("c_nationkey")), F.lit(-1)).cast("long").alias("idx"))


@query("q07_macro_clean", f"WITH {CALENDAR}, {DAILY}, s AS (SELECT cal_date, lag(total) OVER (ORDER BY cal_date) AS t FROM calendar LEFT JOIN daily ON d = cal_date) SELECT cal_date AS d, last_value(t IGNORE NULLS) OVER (ORDER BY cal_date ROWS UNBOUNDED PRECEDING) AS total FROM s")
def q07(spark, sf):
    w = Window.orderBy("cal_date")
    s = calendar(spark, sf).join(daily(spark, sf), F.col("cal_date") == F.col("d"), "left").select("cal_date", F.lag("total").over(w).alias("t"))
    return s.select(F.col("cal_date").alias("d"), ts.ffill("t", w).alias("total"))


@query("q08_event_clean", f"WITH {FLOWS} SELECT code, d, least(greatest(coalesce(error, 0), 0), 100) AS pledge, (signup > 0)::BIGINT AS flag FROM flows")
def q08(spark, sf):
    return flows(spark, sf).select("code", "d", xsec.clip(F.coalesce("error", F.lit(0.0)), 0.0, 100.0).alias("pledge"), (F.col("signup") > 0).cast("long").alias("flag"))


_MA = (5, 10, 20, 60, 120, 250)


@query("k01_indicators", f"""WITH RECURSIVE {PANEL}, v AS (SELECT *, close - lag(close) OVER ({P}) AS v FROM panel), x AS (
  SELECT code, d, close, row_number() OVER ({P}) AS i, (close - min(low) {_frame(9)}) / nullif(max(high) {_frame(9)} - min(low) {_frame(9)}, 0) * 100 AS rsv, stddev_samp(close) {_frame(20)} AS sd, """
  + ", ".join(f"avg(close) {_frame(n)} AS ma{n}" for n in _MA) + ", "
  + ", ".join(f"avg(CASE WHEN v > 0 THEN v ELSE 0 END) {_frame(n)} AS g{n}, avg(CASE WHEN v < 0 THEN -v ELSE 0 END) {_frame(n)} AS l{n}" for n in (6, 12, 24)) + """ FROM v
), r AS (
  SELECT code, i, close AS f, close AS s, 0.0::DOUBLE AS g, rsv AS k, 1.0::DOUBLE AS w, rsv AS dd FROM x WHERE i = 1 UNION ALL
  SELECT code, i, f, s, g + 0.2::DOUBLE * (f - s - g), k, w, CASE WHEN dd IS NULL THEN k ELSE dd + (k - dd) / 3 END FROM (
    SELECT x.code, x.i, r.f + 2::DOUBLE / 13 * (x.close - r.f) AS f, r.s + 2::DOUBLE / 27 * (x.close - r.s) AS s, r.g, r.dd,
      CASE WHEN rsv IS NULL THEN r.k WHEN r.k IS NULL THEN rsv ELSE (r.w * 2 / 3 * r.k + rsv / 3) / (r.w * 2 / 3 + 1::DOUBLE / 3) END AS k,
      CASE WHEN rsv IS NULL AND r.k IS NOT NULL THEN r.w * 2 / 3 ELSE 1 END AS w
    FROM r JOIN x ON x.code = r.code AND x.i = r.i + 1)
) SELECT code, d, """ + ", ".join(f"round(ma{n}, 6) AS ma{n}" for n in _MA) + ", round(f, 6) AS ema12, round(s, 6) AS ema26, round(f - s, 6) AS macd_dif, round(g, 6) AS macd_dea, round(2 * (f - s - g), 6) AS macd, "
  + ", ".join(f"round(100 - 100 / (1 + g{n} / nullif(l{n}, 0)), 5) AS rsi{n}" for n in (6, 12, 24)) + ", round(ma20, 6) AS boll_mid, round(ma20 + 2 * sd, 5) AS boll_upper, round(ma20 - 2 * sd, 5) AS boll_lower, round(k, 5) AS kdj_k, round(dd, 5) AS kdj_d, round(3 * k - 2 * dd, 5) AS kdj_j FROM x JOIN r USING (code, i)")
def k01(spark, sf):
    out = indicators(price_panel(spark, sf), panel_parts(spark, sf))
    digits = lambda c: 5 if c[:3] in ("rsi", "kdj") or c in ("boll_upper", "boll_lower") else 6
    return out.select("code", "d", *[_r(F.col(c), digits(c)).alias(c) for c in out.columns if c not in ("code", "d")])


def indicators(panel, parts=None):
    """Moving and exponential means, MACD, RSI, Bollinger bands and KDJ of (code, d, high, low, close), frames filling up from one row."""
    c, w = F.col("close"), W()
    move = ts.difference(c, w)
    p = panel.select("code", "d", "high", "low", "close", F.when(move > 0, move).otherwise(0.0).alias("gain"), F.when(move < 0, -move).otherwise(0.0).alias("loss"))
    p = sliding(p, "code", "d", [(f"ma{n}", "close", "mean", n, 1) for n in _MA if n > 20])
    p = p.withColumns({f"ma{n}": ts.rolling_mean(c, w, n, 1) for n in _MA if n <= 20})
    lo, hi = ts.rolling(F.min, F.col("low"), w, 9, 1), ts.rolling(F.max, F.col("high"), w, 9, 1)
    rs = lambda n: F.try_divide(ts.rolling_mean(F.col("gain"), w, n, 1), ts.rolling_mean(F.col("loss"), w, n, 1))
    p = p.withColumns({"rsv": F.try_divide(c - lo, hi - lo) * 100, "sd": ts.rolling_std(c, w, 20, 2), **{f"rsi{n}": 100 - F.try_divide(F.lit(100.0), 1 + rs(n)) for n in (6, 12, 24)}})
    third = 1 / 3
    p = exponential_means(p, "code", "d", [("ema12", "close", 2 / 13), ("ema26", "close", 2 / 27), ("macd_dea", ("ema12", "ema26"), 0.2), ("kdj_k", "rsv", third), ("kdj_d", "kdj_k", third)], parts)
    dif = F.col("ema12") - F.col("ema26")
    return p.select(
        "code", "d", *[f"ma{n}" for n in _MA], "ema12", "ema26", dif.alias("macd_dif"), "macd_dea", (2 * (dif - F.col("macd_dea"))).alias("macd"), "rsi6", "rsi12", "rsi24",
        F.col("ma20").alias("boll_mid"), (F.col("ma20") + 2 * F.col("sd")).alias("boll_upper"), (F.col("ma20") - 2 * F.col("sd")).alias("boll_lower"), "kdj_k", "kdj_d", (3 * F.col("kdj_k") - 2 * F.col("kdj_d")).alias("kdj_j"),
    )


@query("k02_consensus", f"WITH {REPORTS} SELECT code, year(ann)::BIGINT AS y, round(avg(value), 6) AS mean, count(DISTINCT kind) AS sources, max(ann) AS latest FROM reports GROUP BY 1, 2")
def k02(spark, sf):
    return reports(spark, sf).groupBy("code", F.year("ann").cast("long").alias("y")).agg(_r(F.avg("value")).alias("mean"), F.count_distinct("kind").alias("sources"), F.max("ann").alias("latest"))


@query("k03_rating_summary", f"WITH {REPORTS} SELECT code, count(*) AS n, count(*) FILTER (kind IN ('1-URGENT', '2-HIGH')) AS buy, count(*) FILTER (contains(kind, 'LOW')) AS sell, round(avg(value), 6) AS target FROM reports GROUP BY 1")
def k03(spark, sf):
    return reports(spark, sf).groupBy("code").agg(F.count("*").alias("n"), F.count_if(F.col("kind").isin("1-URGENT", "2-HIGH")).alias("buy"), F.count_if(F.contains("kind", F.lit("LOW"))).alias("sell"), _r(F.avg("value")).alias("target"))


@query("k04_name_periods", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'small%' OR p_name LIKE 'red%' OR p_name LIKE '%ring%'")
def k04(spark, sf):
    return table(spark, sf, "part", "p_partkey", "p_name").where("p_name like 'small%' or p_name like 'red%' or contains(p_name, 'ring')")


@query("k05_flow_sums", "SELECT event_id, coalesce(try_cast(json_extract_string(props, '$.k') AS DOUBLE), 0) + coalesce(value, 0) AS north, coalesce(try_cast(json_extract_string(props, '$.absent') AS DOUBLE), 0) + coalesce(try_cast(event_type AS DOUBLE), 0) + coalesce(user_id, 0) AS south FROM events")
def k05(spark, sf):
    number = lambda c: F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string").try_cast("double"), F.lit(0.0))
    e = table(spark, sf, "events", "event_id", "event_type", "user_id", "value", "props")
    return e.select("event_id", (number(F.get_json_object("props", "$.k")) + number("value")).alias("north"), (number(F.get_json_object("props", "$.absent")) + number("event_type") + number("user_id")).alias("south"))


@query("k06_previous_open_day", f"WITH {OPEN_DAYS} SELECT d AS cal_date, lag(d) OVER (ORDER BY d) AS prev_open FROM open_days")
def k06(spark, sf):
    return cal.previous_open_day(calendar(spark, sf))


@query("k07_share_below", f"""WITH {PANEL}, m AS (SELECT max(d) AS d FROM panel GROUP BY date_trunc('month', d)), x AS (SELECT panel.d, close / 1200 AS pb, CASE WHEN code % 2 = 0 THEN 'even' ELSE 'odd' END AS board FROM panel JOIN m USING (d))
SELECT d, count(*) AS n, count(*) FILTER (pb < 1) AS below, count(*) FILTER (pb < 1 AND board = 'even') AS below_even, count(*) FILTER (pb < 1 AND board = 'odd') AS below_odd, round(100 * avg((pb < 1)::INTEGER), 2) AS pct FROM x GROUP BY 1""")
def k07(spark, sf):
    """Codes below a ratio of one on the last day of each month, in all and by board."""
    p = price_panel(spark, sf).select("code", "d", (F.col("close") / 1200).alias("pb"))
    last = p.groupBy(F.trunc("d", "month")).agg(F.max("d").alias("d")).select("d")
    low, even = F.col("pb") < 1, F.col("code") % 2 == 0
    return p.join(F.broadcast(last), "d").groupBy("d").agg(F.count("*").alias("n"), F.count_if(low).alias("below"), F.count_if(low & even).alias("below_even"), F.count_if(low & ~even).alias("below_odd"), F.round(100 * F.avg(low.cast("int")), 2).alias("pct"))
