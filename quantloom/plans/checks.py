"""Data-quality plans C01-C18 over the proxies."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quantloom.operators import ts
from quantloom.operators.checks import Check, Measure, measure, profile, run_checks, same_rows
from quantloom.operators.comoments import co_moments
from quantloom.operators.quantiles import exact_quantiles
from quantloom.operators.stats import safe_corr, sample_kurtosis, sample_skewness
from quantloom.plans import detail as _detail
from quantloom.plans.base import CALENDAR, DAILY, ORACLES, PANEL, QUERIES, REPORTS, calendar, daily, panel_parts, price_panel, query, reports, table, with_day_volume
from quantloom.plans.labels import RET, labelled
from quantloom.sources import parts_of, written_once

W = ts.per_code
P = "PARTITION BY code ORDER BY d"


def checks_sql(ctes: str, source: str, rules: list[tuple[str, str, float, str, str]]) -> str:
    """The twin of ``run_checks``: (name, broken, limit, severity, among)."""
    parts = [f"SELECT '{n}' AS name, '{s}' AS sev, count(*) FILTER (coalesce({b}, false) AND coalesce({a}, false)) AS n, count(*) FILTER (coalesce({a}, false)) AS total, {lim}::DOUBLE AS lim FROM {source}" for n, b, lim, s, a in rules]
    return f"WITH {ctes}, u AS ({' UNION ALL '.join(parts)}), v AS (SELECT *, coalesce(n::DOUBLE / nullif(total, 0), 0) AS value FROM u) SELECT name, CASE WHEN value <= lim THEN 'PASS' ELSE sev END AS severity, (value <= lim)::BIGINT AS passed, n, round(value, 8) AS value FROM v"


def register(name, ctes, source, frame, rules):
    """A plan and its twin from rules in the SQL that both engines read."""

    @query(name, checks_sql(ctes, source, rules))
    def plan(spark, sf):
        return run_checks(frame(spark, sf), [Check(n, F.expr(b), lim, s, F.expr(a)) for n, b, lim, s, a in rules])

    return plan


def measures_sql(ctes: str, parts: list[tuple[str, list]]) -> str:
    """The twin of ``measure`` over several sources: (source, [(name, value, least, most, severity)])."""
    num = lambda x: "NULL" if x is None else f"{float(x)}::DOUBLE"
    rows = [f"SELECT '{n}' AS name, '{sev}' AS sev, ({v})::DOUBLE AS value, {num(lo)} AS lo, {num(hi)} AS hi FROM {source}" for source, rules in parts for n, v, lo, hi, sev in rules]
    return f"WITH {ctes}, u AS ({' UNION ALL '.join(rows)}), f AS (SELECT *, coalesce(value >= lo, true) AND coalesce(value <= hi, true) AS fits FROM u) SELECT name, CASE WHEN fits THEN 'PASS' ELSE sev END AS severity, fits::BIGINT AS passed, round(value, 6) AS value FROM f"


def register_measures(name, ctes, parts, shared=None):
    """A plan and its twin from measures in the SQL that both engines read; ``parts`` are (source of the twin, frame, measures).

    ``shared`` makes what several parts read, once; their frames then take it as a third argument.
    """

    @query(name, measures_sql(ctes, [(source, rules) for source, _, rules in parts]))
    def plan(spark, sf):
        base = () if shared is None else (shared(spark, sf),)
        found = [measure(frame(spark, sf, *base), [Measure(n, F.expr(v), lo, hi, sev) for n, v, lo, hi, sev in rules]) for _, frame, rules in parts]
        out = found[0]
        for x in found[1:]:
            out = out.unionByName(x)
        return out

    return plan


def share(broken: str, among: str = "true") -> str:
    return f"count(*) FILTER (WHERE ({broken}) AND ({among})) * 1.0 / nullif(count(*) FILTER (WHERE {among}), 0)"


def corr_sql(a: str, b: str) -> str:
    return f"covar_pop({a}, {b}) / nullif(stddev_pop(CASE WHEN {b} IS NOT NULL THEN {a} END) * stddev_pop(CASE WHEN {a} IS NOT NULL THEN {b} END), 0)"


def registered(name: str):
    """Another plan as a source."""
    return lambda spark, sf: QUERIES[name](spark, sf)


def _returns(spark, sf):
    return price_panel(spark, sf).withColumn("r", F.try_divide(F.col("close"), F.lag("close").over(W())) - 1)


R = f"{PANEL}, x AS (SELECT *, close / nullif(lag(close) OVER ({P}), 0) - 1 AS r FROM panel)"
register("c01_generic_rules", "l AS (SELECT * FROM lineitem)", "l", lambda s, d: table(s, d, "lineitem"), [
    ("null rate", "l_quantity IS NULL", 0, "ERROR", "true"), ("range", "NOT l_discount BETWEEN 0 AND 0.08", 0.1, "WARNING", "true"), ("positive", "l_extendedprice <= 0", 0, "CRITICAL", "true"), ("domain", "l_returnflag NOT IN ('A', 'N', 'R')", 0, "ERROR", "true")])


@query("c02_keys_and_dates", "SELECT 'duplicates' AS name, (SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1))::BIGINT AS value UNION ALL SELECT 'weekend', count(*) FILTER (dayofweek(l_shipdate) IN (0, 6)) FROM lineitem UNION ALL SELECT 'days', count(DISTINCT CAST(l_shipdate AS DATE)) FROM lineitem")
def c02(spark, sf):
    line = table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_shipdate")
    dup = line.groupBy("l_orderkey", "l_linenumber").count().where("count > 1").agg(F.coalesce(F.sum("count"), F.lit(0)).alias("value")).select(F.lit("duplicates").alias("name"), "value")
    day = F.col("l_shipdate").cast("date")
    both = line.agg(F.count_if(F.dayofweek(day).isin(1, 7)).alias("w"), F.count_distinct(day).alias("d"))
    return dup.union(both.select(F.explode(F.array(F.struct(F.lit("weekend").alias("name"), F.col("w").alias("value")), F.struct(F.lit("days").alias("name"), F.col("d").alias("value")))).alias("x")).select("x.*"))


def _profile_sql(cols, extended=False):
    more = ", count(*) FILTER ({c}::DOUBLE = 0) AS zeros, round(skewness({c}), 4) AS skew, round(kurtosis({c}), 4) AS kurt" if extended else ""
    one = "SELECT '{c}' AS \"column\", count({c}) AS n, count(*) FILTER ({c} IS NULL) AS nulls, count(DISTINCT {c}) AS kinds, min({c})::DOUBLE AS lo, max({c})::DOUBLE AS hi, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std, round(quantile_cont({c}::DOUBLE, 0.5), 4) AS median" + more + " FROM lineitem"
    return " UNION ALL ".join(one.format(c=c) for c in cols)


@query("c03_profile", _profile_sql(["l_quantity", "l_extendedprice", "l_discount"]))
def c03(spark, sf):
    return profile(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])


@query("c04_extended_profile", _profile_sql(["l_quantity", "l_tax"], True))
def c04(spark, sf):
    return profile(table(spark, sf, "lineitem"), ["l_quantity", "l_tax"], extended=True)


register("c05_price_rules", R, "x", _returns, [
    ("high is highest", "high < greatest(low, open, close)", 0, "CRITICAL", "true"), ("low is lowest", "low > least(high, open, close)", 0, "CRITICAL", "true"), ("positive", "close <= 0", 0, "CRITICAL", "true"), ("jump", "abs(r) > 1", 0.2, "ERROR", "r IS NOT NULL"), ("implied price", "abs(amount / vol / close - 1) > 0.2", 0.01, "WARNING", "vol > 0")])
FUNDS = f"{REPORTS}, q AS (SELECT quantile_cont(value, 0.01) AS lo, quantile_cont(value, 0.99) AS hi FROM reports), fu AS (SELECT r.*, CASE WHEN value BETWEEN lo AND hi THEN value END AS trimmed, sum(value) OVER (PARTITION BY code) AS total FROM reports r, q)"


def _funds(spark, sf):
    r = reports(spark, sf)
    lo, hi = exact_quantiles(r, ["value"], (0.01, 0.99))["value"]
    return r.withColumn("trimmed", F.when(F.col("value").between(lo, hi), F.col("value"))).withColumn("total", F.sum("value").over(Window.partitionBy("code")))


register_measures("c06_fundamental_rules", FUNDS, [("fu", _funds, [
    ("unit", "log10(abs(avg(value)) + 1e-10)", 4, 9, "ERROR"), ("trimmed unit", "log10(abs(avg(trimmed)) + 1e-10)", 4, 9, "ERROR"), ("part over whole", share("value > total * 1.0001"), None, 0, "CRITICAL"),
    ("cold start", share("value IS NULL", "ann < DATE '1996-01-01'"), None, 0.5, "WARNING"), ("missing", share("value IS NULL"), None, 0.05, "ERROR"), ("extreme", share("value > 400000"), None, 0.001, "WARNING"),
    ("negative", share("value < 0"), None, 0, "ERROR"), ("infinite", share("abs(value) > 1e300"), None, 0, "CRITICAL")])])
register_measures("c07_status_rules", f"st AS ({ORACLES['d02_status']})", [("st", registered("d02_status"), [
    ("limit ratio domain", share("NOT (abs(limit_ratio - 0.05) < 0.001 OR abs(limit_ratio - 0.1) < 0.001 OR abs(limit_ratio - 0.2) < 0.001 OR abs(limit_ratio - 0.3) < 0.001 OR limit_ratio = 1)"), None, 0, "ERROR"),
    ("boards", "count(DISTINCT market)", 4, None, "ERROR"), ("special off its ratio", share("abs(limit_ratio - 0.05) > 0.001", "is_st = 1 AND is_new_no_limit = 0 AND market = 'main'"), None, 0.3, "WARNING"),
    ("special share", share("is_st = 1"), None, 0.2, "WARNING"), ("limit days", share("is_limit_up = 1 OR is_limit_down = 1"), None, 0.2, "WARNING")])])

LEGS = """legs AS (SELECT l_suppkey AS code, CAST(l_shipdate AS DATE) AS d, round(coalesce(sum(l_extendedprice) FILTER (WHERE l_returnflag = 'A'), 0), 2) AS buy, round(coalesce(sum(l_extendedprice) FILTER (WHERE l_returnflag = 'R'), 0), 2) AS sell,
  round(coalesce(sum(l_extendedprice) FILTER (WHERE l_quantity >= 40), 0), 2) AS block, round(sum(CASE l_returnflag WHEN 'A' THEN l_extendedprice WHEN 'R' THEN -l_extendedprice ELSE 0 END), 2) AS net, round(sum(l_extendedprice), 2) AS amount FROM lineitem GROUP BY 1, 2)"""


def legs(spark, sf):
    """Lines as flows by code and day: accepted ones buy, returned ones sell, large ones are block trades."""
    line = table(spark, sf, "lineitem", "l_suppkey", "l_shipdate", "l_returnflag", "l_quantity", "l_extendedprice")
    price, some = F.col("l_extendedprice"), lambda c: F.round(F.coalesce(F.sum(F.when(c, F.col("l_extendedprice"))), F.lit(0.0)), 2)
    flag = F.col("l_returnflag")
    net = F.round(F.sum(F.when(flag == "A", price).when(flag == "R", -price).otherwise(0.0)), 2)
    line = line.select(F.col("l_suppkey").alias("code"), F.col("l_shipdate").cast("date").alias("d"), "l_returnflag", "l_quantity", "l_extendedprice").repartition(panel_parts(spark, sf), "code", "d")
    return line.groupBy("code", "d").agg(some(flag == "A").alias("buy"), some(flag == "R").alias("sell"), some(F.col("l_quantity") >= 40).alias("block"), net.alias("net"), F.round(F.sum(price), 2).alias("amount"))


register_measures("c08_flow_rules", LEGS, [("legs", legs, [
    ("magnitude", "log10(abs(avg(amount)) + 1e-10)", 4, None, "ERROR"), ("non-negative", share("buy < 0 OR sell < 0 OR block < 0"), None, 0, "ERROR"), ("net is buy less sell", f"CASE WHEN count(*) >= 100 THEN {corr_sql('net', 'buy - sell')} END", 0.99, None, "ERROR"),
    ("year ratio", "avg(amount) FILTER (WHERE year(d) = 2000) / nullif(avg(amount) FILTER (WHERE year(d) = 1996), 0)", 0.1, 10, "WARNING"), ("block days", share("block > 0"), 0.01, None, "WARNING")])])
register("c09_report_lag_rules", REPORTS, "reports", reports, [
    ("leak", "period_end > ann", 0, "CRITICAL", "true"), ("strict lag", "period_end >= ann", 0, "CRITICAL", "true"), ("whole", "o_orderkey <> floor(o_orderkey)", 0, "ERROR", "true")])
register_measures("c10_event_rules", f"ev AS ({ORACLES['d11_unlocks_and_pledges']}), yearly AS (SELECT year(d) AS y, count(*) FILTER (WHERE is_unlock_day = 1) AS n FROM ev GROUP BY 1)", [
    ("ev", lambda s, d, x: x, [
        ("unlock without shares", share("unlock_share <= 0", "is_unlock_day = 1"), None, 0, "ERROR"), ("shares without unlock", share("unlock_share > 0", "is_unlock_day = 0"), None, 0, "ERROR"), ("pledge range", share("NOT pledge_ratio BETWEEN 0 AND 100"), None, 0, "ERROR"),
        ("sparsity", share("is_unlock_day = 1"), None, 0.5, "WARNING"), ("days to unlock", "min(days_to_unlock)", -1, None, "ERROR")]),
    ("yearly", lambda s, d, x: x.groupBy(F.year("d").alias("y")).agg(F.count_if(F.col("is_unlock_day") == 1).alias("n")), [("yearly spread", "min(n) * 1.0 / nullif(max(n), 0)", 0.1, None, "WARNING")])], shared=registered("d11_unlocks_and_pledges"))


def _series(spark, sf):
    w = Window.orderBy("d")
    return daily(spark, sf).withColumn("gap", F.datediff("d", F.lag("d").over(w))).withColumn("jump", F.abs(ts.pct_change(F.col("total"), w)))


MACRO = f"{DAILY}, x AS (SELECT daily.*, date_diff('day', lag(d) OVER (ORDER BY d), d) AS gap, abs((total - lag(total) OVER (ORDER BY d)) / nullif(lag(total) OVER (ORDER BY d), 0)) AS jump, t.rate FROM daily LEFT JOIN (SELECT CAST(l_shipdate AS DATE) AS sd, round(100 * avg(l_tax), 6) AS rate FROM lineitem GROUP BY 1) t ON sd = d)"


def _macro(spark, sf):
    t = table(spark, sf, "lineitem", "l_shipdate", "l_tax").groupBy(F.col("l_shipdate").cast("date").alias("d")).agg(F.round(100 * F.avg("l_tax"), 6).alias("rate"))
    return _series(spark, sf).join(F.broadcast(t), "d", "left")  # a row a day


register_measures("c11_macro_rules", MACRO, [("x", _macro, [
    ("nulls", share("total IS NULL OR mean IS NULL OR n IS NULL"), None, 0, "ERROR"), ("growth range", share("NOT n BETWEEN -20 AND 30"), None, 0.05, "ERROR"), ("level range", share("NOT mean BETWEEN 10000 AND 500000"), None, 0.05, "ERROR"), ("rate range", share("NOT rate BETWEEN 0 AND 15", "rate IS NOT NULL"), None, 0, "ERROR"),
    ("magnitude", "log10(abs(avg(total)) + 1e-10)", 5, None, "WARNING"), ("gap", share("gap > 7", "gap IS NOT NULL"), None, 0, "WARNING"), ("jump", share("jump > 0.5", "jump IS NOT NULL"), None, 0.01, "WARNING")])])
register_measures("c12_category_rules", f"ind AS ({ORACLES['d12_industry']}), per_day AS (SELECT d, sum(changed) AS changes, avg(CASE WHEN l1_idx >= 0 THEN 1.0 ELSE 0.0 END) AS covered FROM ind GROUP BY 1)", [
    ("ind", lambda s, d, x: x, [("unknown", share("industry_idx IS NULL OR industry_idx = -1"), None, 0.01, "ERROR"), ("range", share("NOT l1_idx BETWEEN -1 AND 31"), None, 0, "ERROR"), ("change rate", share("changed = 1"), None, 0.01, "WARNING")]),
    ("per_day", lambda s, d, x: x.groupBy("d").agg(F.sum("changed").alias("changes"), F.avg(F.when(F.col("l1_idx") >= 0, 1.0).otherwise(0.0)).alias("covered")), [("changes a day", "max(changes)", None, 100, "WARNING"), ("least coverage", "min(covered)", 0.95, None, "ERROR")])], shared=registered("d12_industry"))


CROSS = f"""{PANEL}, {DAILY}, {LEGS}, st AS ({ORACLES['d02_status']}), days AS (SELECT DISTINCT d FROM panel), cover AS (SELECT p.d, (m.d IS NOT NULL) AS macro, (s.d IS NOT NULL) AS status FROM days p LEFT JOIN daily m USING (d) LEFT JOIN (SELECT DISTINCT d FROM st) s ON s.d = p.d),
bo AS (SELECT p.*, s.is_trading, s.limit_ratio, lag(p.close) OVER (PARTITION BY p.code ORDER BY p.d) AS pre, s.code IS NOT NULL AS known FROM panel p LEFT JOIN st s ON s.code = p.code AND s.d = p.d),
day_cover AS (SELECT d, avg(CASE WHEN known THEN 1.0 ELSE 0.0 END) AS covered FROM bo WHERE dayofweek(d) BETWEEN 1 AND 5 GROUP BY 1),
implied AS (SELECT code, count(*) AS n, stddev_samp(amount / close) / nullif(avg(amount / close), 0) AS cv, {corr_sql('close', 'close / (vol + 1)')} AS r FROM panel GROUP BY 1),
fl AS (SELECT l.code, l.d, l.buy, l.net, p.amount, p.close / nullif(lag(p.close) OVER (PARTITION BY p.code ORDER BY p.d), 0) - 1 AS ret FROM panel p JOIN legs l ON l.code = p.code AND l.d = p.d),
med AS (SELECT quantile_cont(buy / nullif(amount, 0), 0.5) AS ratio FROM fl WHERE buy > 0)"""


def _crossed(spark, sf):
    """What the checks read, each written once: days with a status, the panel with the status of its rows, and flows with returns."""
    st = _detail.status(spark, sf).select("code", "d", "is_trading", "limit_ratio", "priced")
    days = written_once(st.select("d").distinct(), "status_days")
    parts = panel_parts(spark, sf)
    p = price_panel(spark, sf).withColumn("pre", F.lag("close").over(W())).repartition(parts, "code", "d")
    known = st.where("priced").drop("priced").withColumn("known", F.lit(True))  # rows of the panel are on days of a price
    both = p.join(known.repartition(parts, "code", "d"), ["code", "d"], "left").withColumn("known", F.coalesce("known", F.lit(False)))
    both = written_once(both, "crossed")
    flows_ = both.select("code", "d", "amount", F.try_divide("close", "pre").alias("q")).withColumn("ret", F.col("q") - 1).drop("q")
    flows_ = flows_.repartition(parts, "code", "d").join(legs(spark, sf).select("code", "d", "buy", "net"), ["code", "d"])
    return days, both, written_once(flows_, "flow_returns")


def _cover(spark, sf, status_days, both):
    m = daily(spark, sf).select("d", F.lit(True).alias("macro"))
    return both.select("d").distinct().join(m, "d", "left").join(status_days.withColumn("status", F.lit(True)), "d", "left").na.fill(False)


def _implied(both):
    shares = F.try_divide("amount", "close")
    p = both.withColumn("pe", F.col("close") / (F.col("vol") + 1))
    return p.groupBy("code").agg(F.count("*").alias("n"), F.try_divide(F.stddev_samp(shares), F.avg(shares)).alias("cv"), safe_corr("close", "pe").alias("r"))


def _median_ratio(spark, flows_):
    ratio = flows_.where("buy > 0").select(F.try_divide("buy", "amount").alias("ratio"))
    return spark.range(1).select(F.lit(exact_quantiles(ratio, ["ratio"], (0.5,))["ratio"][0]).cast("double").alias("ratio"))


register_measures("c13_cross_table", CROSS, [
    ("cover", lambda s, d, x: _cover(s, d, x[0], x[1]), [("macro days", share("macro"), 0.99, None, "ERROR"), ("status days", share("status"), 0.99, None, "ERROR")]),
    ("day_cover", lambda s, d, x: x[1].where("dayofweek(d) BETWEEN 2 AND 6").groupBy("d").agg(F.avg(F.when(F.col("known"), 1.0).otherwise(0.0)).alias("covered")), [("codes a day", "avg(covered)", 0.99, None, "ERROR")]),
    ("bo", lambda s, d, x: x[1], [("volume while suspended", share("vol > 0 AND is_trading = 0", "known"), None, 0.01, "ERROR"), ("limit breach", share("close > pre * (1 + limit_ratio) * 1.01 OR close < pre * (1 - limit_ratio) / 1.01", "known AND pre IS NOT NULL AND limit_ratio < 1"), None, 0.005, "WARNING")]),
    ("implied", lambda s, d, x: _implied(x[1]), [("unstable shares", share("cv > 0.5", "n >= 100"), None, 0.05, "ERROR"), ("price follows ratio", share("r > 0", "n >= 100 AND r IS NOT NULL"), 0.55, None, "WARNING")]),
    ("med", lambda s, d, x: _median_ratio(s, x[2]), [("median flow ratio", "max(ratio)", 0.01, 100, "ERROR")]),
    ("fl", lambda s, d, x: x[2], [("flow and return", f"abs({corr_sql('net', 'ret')})", None, 0.1, "WARNING")])], shared=_crossed)


MERGED = f"""{PANEL}, {DAILY}, mp AS (SELECT p.code, p.d, p.high, p.low, p.open, p.close, p.vol, p.amount, p.close / nullif(lag(p.close) OVER (PARTITION BY p.code ORDER BY p.d), 0) - 1 AS r, p.amount / nullif(p.vol, 0) AS vwap, m.total, (p.vol > 20)::BIGINT AS is_tradable, p.vol / nullif(sum(p.vol) OVER (PARTITION BY p.d), 0) AS weight, 1 / nullif(p.close, 0) AS inv, 0 AS suffixed FROM panel p LEFT JOIN daily m USING (d)),
keys AS (SELECT code, d, count(*) AS n FROM mp GROUP BY 1, 2), macro_day AS (SELECT d, count(DISTINCT total) AS kinds FROM mp GROUP BY 1), drift AS (SELECT (SELECT count(*) FROM mp) * 1.0 / (SELECT count(*) FROM panel) - 1 AS drift)"""


def merged_panel(spark, sf):
    """The panel with the series of its day and what the preprocessing adds."""
    p = price_panel(spark, sf).join(F.broadcast(daily(spark, sf).select("d", "total")), "d", "left")
    doubled = sum(c.endswith(("_x", "_y")) for c in p.columns)  # what a careless join leaves
    p = with_day_volume(p, spark, sf, "_volume")
    return p.withColumns({"suffixed": F.lit(doubled), "r": F.try_divide("close", F.lag("close").over(W())) - 1, "vwap": F.try_divide("amount", "vol"), "is_tradable": (F.col("vol") > 20).cast("long"), "weight": F.try_divide("vol", "_volume"), "inv": F.try_divide(F.lit(1.0), F.col("close"))}).drop("_volume")


register_measures("c14_merged_rules", MERGED, [
    ("mp", lambda s, d, x: x, [
        ("core fields", share("close IS NULL OR vol IS NULL OR amount IS NULL"), None, 0, "CRITICAL"), ("suffixed columns", "max(suffixed)", None, 0, "ERROR"), ("magnitude", "log10(abs(avg(amount)) + 1e-10)", 3, 12, "ERROR"), ("vwap near close", corr_sql("vwap", "close"), 0.9, None, "WARNING"),
        ("price order", share("high < low OR close > high OR close < low"), None, 0, "CRITICAL"), ("return range", share("NOT r BETWEEN -0.9 AND 10", "r IS NOT NULL"), None, 0.01, "WARNING"), ("flags", share("is_tradable NOT IN (0, 1)"), None, 0, "ERROR"), ("ratios", share("NOT weight BETWEEN 0 AND 1"), None, 0, "ERROR"),
        ("inverse", share("abs(inv * close - 1) > 1e-6"), None, 0, "ERROR"), ("extremes", share("abs(amount) > 1e12"), None, 0, "WARNING")]),
    ("keys", lambda s, d, x: keys_of(x), [("keys twice", share("n > 1"), None, 0, "CRITICAL")]),
    ("macro_day", lambda s, d, x: x.groupBy("d").agg(F.count_distinct("total").alias("kinds")), [("macro values a day", "max(kinds)", None, 1, "ERROR")]),
    ("drift", lambda s, d, x: row_drift(x, price_panel(s, d)), [("row drift", "max(abs(drift))", None, 0.05, "ERROR")])], shared=lambda s, d: written_once(merged_panel(s, d), "merged"))


FEATURES = ("close", "vol", "amount", "ma_5", "rsi_6", "weight", "total")
_F5, _F6 = f"OVER ({P} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)", f"OVER ({P} ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)"
TRAIN = f"""{RET}, {DAILY}, mv AS (SELECT lab.*, close - lag(close) OVER ({P}) AS v, vol / nullif(sum(vol) OVER (PARTITION BY d), 0) AS weight FROM lab),
tr AS (SELECT code, d, close, vol, amount, r5, CASE WHEN r5 IS NULL THEN NULL WHEN r5 < -0.02 THEN 0 WHEN r5 > 0.02 THEN 2 ELSE 1 END AS cls, CASE WHEN count(close) {_F5} = 5 THEN avg(close) {_F5} END AS ma_5,
  CASE WHEN count(v) {_F6} = 6 THEN 100 - 100 / (1 + avg(greatest(v, 0)) {_F6} / (avg(greatest(-v, 0)) {_F6} + 1e-10)) END AS rsi_6, weight, total, row_number() OVER (PARTITION BY code ORDER BY d DESC) AS back, row_number() OVER (PARTITION BY code ORDER BY d) AS fwd FROM mv LEFT JOIN (SELECT d AS dd, total FROM daily) ON dd = d),
keys AS (SELECT code, d, count(*) AS n FROM tr GROUP BY 1, 2), cl AS (SELECT cls, count(*) * 1.0 / sum(count(*)) OVER () AS pct FROM tr WHERE cls IS NOT NULL GROUP BY 1),
dm AS (SELECT d, avg(close) AS m, count(DISTINCT code) AS codes FROM tr GROUP BY 1), dl AS (SELECT *, m - lag(m) OVER (ORDER BY d) AS step, codes - lag(codes) OVER (ORDER BY d) AS more FROM dm), ye AS (SELECT year(d) AS y, avg(codes) AS codes FROM dm GROUP BY 1),
co AS (SELECT * FROM (VALUES """ + ", ".join(f"('{f}')" for f in FEATURES) + ") f(feature)), cr AS (" + " UNION ALL ".join(f"SELECT '{f}' AS feature, count(*) FILTER ({f} IS NOT NULL AND r5 IS NOT NULL) AS n, corr({f}, r5) AS corr FROM tr" for f in FEATURES) + "), nl AS (" + " UNION ALL ".join(f"SELECT '{f}' AS feature, avg(CASE WHEN {f} IS NULL THEN 1.0 ELSE 0.0 END) AS missing, max({f}) - min({f}) AS span, skewness({f}) AS skew, kurtosis({f}) AS kurt FROM tr" for f in FEATURES) + "), dr AS (SELECT (SELECT count(*) FROM tr) * 1.0 / (SELECT count(*) FROM panel) - 1 AS drift)"


def train_set(spark, sf):
    """Labels with features, and the place of a row from the end and the start of its code."""
    x = labelled(spark, sf).transform(ts.rsi(F.col("close"), W(), 6))
    cls = F.when(F.col("r5").isNull(), None).when(F.col("r5") < -0.02, 0).when(F.col("r5") > 0.02, 2).otherwise(1)
    fwd = F.row_number().over(W())  # a code has one row a day
    x = x.withColumns({"cls": cls, "ma_5": ts.rolling_mean(F.col("close"), W(), 5), "back": F.count("*").over(Window.partitionBy("code")) - fwd + 1, "fwd": fwd})
    x = with_day_volume(x, spark, sf, "_volume").withColumn("weight", F.try_divide("vol", "_volume")).drop("_volume")
    return x.join(F.broadcast(daily(spark, sf).select("d", "total")), "d", "left")


def _class_shares(train):
    c = train.where("cls is not null").groupBy("cls").agg(F.count("*").alias("n"))
    return c.withColumn("pct", F.col("n") * 1.0 / F.sum("n").over(Window.partitionBy(F.lit(1))))  # three rows


def _daily_means(train):
    w = Window.orderBy("d")  # one row a day
    d = train.repartition(parts_of(train), "d").groupBy("d").agg(F.avg("close").alias("m"), F.count_distinct("code").alias("codes"))
    return d.withColumns({"step": F.col("m") - F.lag("m").over(w), "more": F.col("codes") - F.lag("codes").over(w)})


def label_correlations(train):
    """Correlation of each feature with the label, from the matrix of all."""
    m = co_moments(train.select("r5", *FEATURES), ["r5", *FEATURES])
    return m.where("a = 'r5'").select(F.col("b").alias("feature"), "n", "corr")


def _shapes(x):
    """Missing share, span and shape of each feature; a row a feature first, so that one small set of aggregates does for all."""
    long = x.select(F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("x")) for f in FEATURES])).alias("p")).select("p.*")
    return long.groupBy("feature").agg(F.avg(F.when(F.col("x").isNull(), 1.0).otherwise(0.0)).alias("missing"), (F.max("x") - F.min("x")).alias("span"), sample_skewness("x").alias("skew"), sample_kurtosis("x").alias("kurt"))


def _trained(spark, sf):
    """The training set and its daily means, each written once for the checks that read it."""
    train = written_once(train_set(spark, sf), "train")
    return train, written_once(_daily_means(train), "means")


def keys_of(rows):
    """Number of rows of each code and day, in partitions that do not grow with the table."""
    return rows.select("code", "d").repartition(parts_of(rows), "code").groupBy("code", "d").agg(F.count("*").alias("n"))


def row_drift(rows, panel):
    """Share of rows that a table has more than the panel it was made from."""
    return rows.agg(F.count("*").alias("a")).join(panel.agg(F.count("*").alias("b")), how="cross").select((F.col("a") * 1.0 / F.col("b") - 1).alias("drift"))


register_measures("c15_label_rules", TRAIN, [
    ("dr", lambda s, d, x: row_drift(x[0], price_panel(s, d)), [("row drift", "max(abs(drift))", None, 0.1, "ERROR")]),
    ("keys", lambda s, d, x: keys_of(x[0]), [("keys twice", share("n > 1"), None, 0, "CRITICAL")]),
    ("nl", lambda s, d, x: _shapes(x[0]), [("empty features", "count(*) FILTER (WHERE missing = 1)", None, 0, "ERROR"), ("mostly empty features", "count(*) FILTER (WHERE missing > 0.5)", None, 0, "WARNING"), ("wide features", "count(*) FILTER (WHERE span > 1e6 AND feature NOT IN ('amount', 'vol', 'total'))", None, 0, "WARNING"), ("skewed features", "count(*) FILTER (WHERE abs(skew) > 10)", None, 0, "WARNING"), ("peaked features", "count(*) FILTER (WHERE kurt > 100)", None, 0, "WARNING")]),
    ("tr", lambda s, d, x: x[0], [
        ("infinite values", share("abs(close) > 1e300 OR abs(amount) > 1e300 OR abs(ma_5) > 1e300"), None, 0, "ERROR"), ("early nulls", share("ma_5 IS NULL", "fwd > 5"), None, 0, "WARNING"), ("inner label nulls", share("r5 IS NULL AND back > 5"), None, 0.01, "WARNING"), ("tail labels", share("r5 IS NOT NULL", "back <= 5"), None, 0, "CRITICAL"),
        ("indicator range", share("NOT rsi_6 BETWEEN 0 AND 100", "rsi_6 IS NOT NULL"), None, 0, "ERROR"), ("ratio range", share("NOT weight BETWEEN 0 AND 1"), None, 0.01, "WARNING"), ("macro fill", share("total IS NULL"), None, 0.5, "WARNING")]),
    ("cl", lambda s, d, x: _class_shares(x[0]), [("largest class", "max(pct)", None, 0.9, "ERROR"), ("smallest class", "min(pct)", 0.02, None, "WARNING")]),
    ("cr", lambda s, d, x: label_correlations(x[0]), [("leaking features", "count(*) FILTER (WHERE n >= 1000 AND abs(corr) > 0.9)", None, 0, "CRITICAL"), ("strong features", "count(*) FILTER (WHERE n >= 1000 AND abs(corr) > 0.5)", None, 10, "WARNING"), ("strongest feature", "max(abs(corr))", None, 0.9, "CRITICAL")]),
    ("dl", lambda s, d, x: x[1], [("daily mean varies", "stddev_samp(m) / nullif(avg(m), 0)", None, 1, "WARNING"), ("daily mean jumps", "max(abs(step)) / nullif(avg(m), 0)", None, 5, "WARNING"), ("coverage drops", "min(more)", -500, None, "WARNING")]),
    ("ye", lambda s, d, x: x[1].groupBy(F.year("d").alias("y")).agg(F.avg("codes").alias("codes")), [("yearly coverage", "min(codes) / nullif(max(codes), 0)", 0.1, None, "WARNING")])], shared=_trained)


@query("c15_feature_correlations", f"WITH {TRAIN} SELECT feature, n, round(corr, 6) AS corr FROM cr")
def c15_matrix(spark, sf):
    return label_correlations(written_once(train_set(spark, sf), "train")).select("feature", "n", F.round("corr", 6).alias("corr"))


@query("c16_sequence_rules", f"WITH {PANEL}, z AS (SELECT (vol - avg(vol) OVER (PARTITION BY d)) / coalesce(nullif(stddev_samp(vol) OVER (PARTITION BY d), 0), 1e-10) AS z, date_diff('day', lag(d) OVER ({P}), d) AS gap FROM panel) SELECT round(max(abs(z)), 5) AS top, round(abs(avg(z)), 4) AS mean, round(stddev_samp(z), 5) AS std, max(gap)::BIGINT AS gap FROM z")
def c16(spark, sf):
    from quantloom.operators.xsec import zscore

    z = price_panel(spark, sf).select(zscore(F.col("vol"), "d").alias("z"), F.datediff("d", F.lag("d").over(W())).alias("gap"))
    return z.agg(F.round(F.max(F.abs("z")), 5).alias("top"), F.round(F.abs(F.avg("z")), 4).alias("mean"), F.round(F.stddev_samp("z"), 5).alias("std"), F.max("gap").cast("long").alias("gap"))


@query("c17_tree_rules", f"WITH {RET} SELECT count(*) AS n, count(r5) AS labelled, round(skewness(amount), 4) AS skew, (abs(avg(vol)) > 1)::BIGINT AS raw_scale FROM lab")
def c17(spark, sf):
    return labelled(spark, sf).agg(F.count("*").alias("n"), F.count("r5").alias("labelled"), F.round(sample_skewness("amount"), 4).alias("skew"), (F.abs(F.avg("vol")) > 1).cast("long").alias("raw_scale"))


@query("c18_same_rows", "SELECT 'left' AS side, (SELECT count(*) FROM (SELECT * FROM orders EXCEPT ALL SELECT * FROM orders WHERE o_orderkey % 10 > 0)) AS n UNION ALL SELECT 'right', 0")
def c18(spark, sf):
    o = table(spark, sf, "orders")
    return same_rows(o, o.where("o_orderkey % 10 > 0"))


@query("c19_calendar_coverage", f"WITH {CALENDAR}, {PANEL} SELECT count(*) AS missing FROM calendar WHERE is_open = 1 AND cal_date NOT IN (SELECT d FROM panel)")
def c19(spark, sf):
    return calendar(spark, sf).where("is_open = 1").join(price_panel(spark, sf).select("d").distinct(), F.col("cal_date") == F.col("d"), "left_anti").agg(F.count("*").alias("missing"))
