"""Projections and predicates P01-P21."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from quantloom import schema as S
from quantloom.operators.xsec import clip
from quantloom.plans.base import DAILY, PANEL, REPORTS, daily, price_panel, query, reports, table


@query("p01_select_existing", "SELECT l_orderkey, l_quantity FROM lineitem")
def p01(spark, sf):
    return S.select_existing(table(spark, sf, "lineitem"), ["l_orderkey", "no_such", "l_quantity"])


@query("p02_rename_existing", "SELECT r_regionkey AS id, r_name AS name FROM region")
def p02(spark, sf):
    return S.rename_existing(table(spark, sf, "region"), {"r_regionkey": "id", "r_name": "name", "gone": "x"})


@query("p03_date_range", "SELECT o_orderkey, o_totalprice FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'")
def p03(spark, sf):
    day = F.col("o_orderdate")
    return table(spark, sf, "orders", "o_orderkey", "o_totalprice", "o_orderdate").where((day >= F.lit("1996-01-01").cast("timestamp_ntz")) & (day < F.lit("1997-01-01").cast("timestamp_ntz"))).drop("o_orderdate")


@query("p04_in_set", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH')")
def p04(spark, sf):
    o = table(spark, sf, "orders", "o_orderkey", "o_orderstatus", "o_orderpriority")
    return o.where((F.col("o_orderstatus") == "F") & F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).drop("o_orderpriority")


@query("p05_drop_nulls", f"WITH {PANEL}, x AS (SELECT code, d, close, lag(close, 3) OVER (PARTITION BY code ORDER BY d) AS b FROM panel) SELECT * FROM x WHERE b IS NOT NULL AND close IS NOT NULL")
def p05(spark, sf):
    from quantloom.operators.ts import per_code

    return price_panel(spark, sf).select("code", "d", "close", F.lag("close", 3).over(per_code()).alias("b")).na.drop(subset=["b", "close"])


@query("p06_causality", f"WITH {REPORTS} SELECT o_orderkey, ann, period_end FROM reports WHERE period_end <= ann")
def p06(spark, sf):
    return reports(spark, sf).where("period_end <= ann").select("o_orderkey", "ann", "period_end")


@query("p07_cascade", "SELECT p_partkey, CASE WHEN p_size >= 40 THEN 3 WHEN p_type = 'ECONOMY' THEN 2 WHEN p_retailprice > 1000 THEN 1 ELSE 0 END::BIGINT AS board FROM part")
def p07(spark, sf):
    rules = [(F.col("p_retailprice") > 1000, 1), (F.col("p_type") == "ECONOMY", 2), (F.col("p_size") >= 40, 3)]
    return table(spark, sf, "part").select("p_partkey", last_match(rules, 0).cast("long").alias("board"))


def last_match(rules, default):
    """Assignments in order, of which the last that fits holds."""
    out = F.lit(default)
    for test, value in rules:
        out = F.when(test, value).otherwise(out)
    return out


@query("p08_clip", "SELECT c_custkey, CASE WHEN c_acctbal IS NOT NULL THEN least(greatest(c_acctbal, 0), 5000) END AS bal FROM customer")
def p08(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", clip(F.col("c_acctbal"), 0.0, 5000.0).alias("bal"))


@query("p09_fill_columns", "SELECT o.o_orderkey, coalesce(x.n, 0)::BIGINT AS n, coalesce(x.q, -1.0) AS q FROM orders o LEFT JOIN (SELECT l_orderkey, count(*) AS n, sum(l_quantity) AS q FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) x ON l_orderkey = o_orderkey")
def p09(spark, sf):
    x = table(spark, sf, "lineitem", "l_orderkey", "l_quantity", "l_returnflag").where("l_returnflag = 'R'").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"), F.sum("l_quantity").alias("q"))
    return table(spark, sf, "orders", "o_orderkey").join(x, "o_orderkey", "left").na.fill({"n": 0, "q": -1.0})


@query("p10_fill_numeric", f"WITH {DAILY} SELECT d, coalesce(total - lag(total) OVER (ORDER BY d), 0) AS a, coalesce(n - lag(n) OVER (ORDER BY d), 0)::BIGINT AS b FROM daily")
def p10(spark, sf):
    from pyspark.sql import Window

    w = Window.orderBy("d")
    return S.fill_numeric(daily(spark, sf).select("d", (F.col("total") - F.lag("total").over(w)).alias("a"), (F.col("n") - F.lag("n").over(w)).alias("b")))


@query("p11_drop_matching", "SELECT l_orderkey, l_quantity, l_extendedprice, l_returnflag FROM lineitem")
def p11(spark, sf):
    return S.drop_matching(table(spark, sf, "lineitem"), ["key", "line", "dis", "tax", "status", "date"], protected=["l_orderkey"])


@query("p12_universe", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IS DISTINCT FROM 'MACHINERY' AND c_acctbal >= 100")
def p12(spark, sf):
    return universe(table(spark, sf, "customer", "c_custkey", "c_mktsegment", "c_acctbal"), {"c_mktsegment": "MACHINERY", "is_suspended": 1}, ("c_acctbal", 100)).select("c_custkey", "c_mktsegment")


def universe(df, banned, least):
    """Rows without a banned value (null is none), and of at least some age; absent columns are no test."""
    for c, v in banned.items():
        if c in df.columns:
            df = df.where(~F.col(c).eqNullSafe(v))
    c, n = least
    return df.where(F.col(c) >= n) if c in df.columns else df


@query("p13_exclude_range", f"WITH {DAILY} SELECT d, n::BIGINT AS n FROM daily WHERE NOT (d BETWEEN DATE '1995-01-01' AND DATE '1995-12-31')")
def p13(spark, sf):
    return daily(spark, sf).where(~F.col("d").between(date(1995, 1, 1), date(1995, 12, 31))).select("d", "n")


@query("p14_stale_mask", f"WITH {REPORTS} SELECT o_orderkey, CASE WHEN date_diff('day', period_end, ann) <= 45 THEN value END AS value FROM reports")
def p14(spark, sf):
    lag = F.datediff("ann", "period_end")
    return reports(spark, sf).select("o_orderkey", F.when((lag <= 45) | lag.isNull(), F.col("value")).alias("value"))


@query("p15_affixes", "SELECT p_partkey, p_name FROM part WHERE p_brand LIKE '%5' AND p_name LIKE 's%'")
def p15(spark, sf):
    p = table(spark, sf, "part")
    named = [c for c in p.columns if c.startswith(("p_p", "p_n", "p_b"))]
    return p.select(*named).where(F.endswith("p_brand", F.lit("5")) & F.startswith("p_name", F.lit("s"))).select("p_partkey", "p_name")


@query("p16_single_precision", "SELECT c_custkey, round(c_acctbal::FLOAT::DOUBLE, 2) AS bal FROM customer")
def p16(spark, sf):
    return S.floats_to_single(table(spark, sf, "customer", "c_custkey", "c_acctbal")).select("c_custkey", F.round(F.col("c_acctbal").cast("double"), 2).alias("bal"))


@query("p17_units", f"WITH {PANEL} SELECT code, d, round(vol * 100, 4) AS vol, round(amount * 1000, 2) AS amount FROM panel")
def p17(spark, sf):
    return price_panel(spark, sf).select("code", "d", F.round(F.col("vol") * 100, 4).alias("vol"), F.round(F.col("amount") * 1000, 2).alias("amount"))


@query("p18_unit_inference", f"WITH {DAILY} SELECT d, round(CASE WHEN abs(coalesce(total, 0)) >= 500000 THEN total * 1e4 ELSE total * 1e6 END, 2) AS total FROM daily")
def p18(spark, sf):
    ref = F.coalesce("total", F.lit(0.0))
    return daily(spark, sf).select("d", F.round(F.when(F.abs(ref) >= 500000, ref * 1e4).otherwise(ref * 1e6), 2).alias("total"))


@query("p19_before_launch", f"WITH {DAILY} SELECT d, CASE WHEN d < DATE '1998-01-01' THEN 0 ELSE mean END AS mean FROM daily")
def p19(spark, sf):
    return daily(spark, sf).select("d", F.when(F.col("d") < date(1998, 1, 1), 0.0).otherwise(F.col("mean")).alias("mean"))


@query("p20_drop_constant", "SELECT n_nationkey, n_regionkey FROM nation")
def p20(spark, sf):
    df = table(spark, sf, "nation", "n_nationkey", "n_regionkey").withColumn("one", F.lit(1)).withColumn("none", F.lit(None).cast("double"))
    return df.drop(*S.constant_columns(df))


@query("p21_inf_to_null", "SELECT c_custkey, CASE WHEN c_acctbal > 5000 THEN NULL ELSE c_acctbal END AS bal FROM customer")
def p21(spark, sf):
    c = table(spark, sf, "customer", "c_custkey", "c_acctbal").withColumn("bal", F.when(F.col("c_acctbal") > 5000, F.lit(float("inf"))).otherwise(F.col("c_acctbal")))
    return S.inf_to_null(c, ["bal"]).select("c_custkey", "bal")
