"""Aggregations A01-A19, sorts and limits O01-O07, set operations U01-U04."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quantloom.operators.quantiles import exact_quantiles
from quantloom.operators import xsec
from quantloom.operators.stats import safe_corr, sample_kurtosis, sample_skewness
from quantloom.plans.base import DAILY, PANEL, REPORTS, daily, price_panel, query, reports, table

LINE = ("l_orderkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag", "l_shipdate")


@query("a01_sums", "SELECT l_suppkey, round(coalesce(sum(l_quantity), 0), 2) AS q, round(coalesce(sum(l_extendedprice), 0), 2) AS amount, 1::BIGINT AS is_listed FROM lineitem GROUP BY 1")
def a01(spark, sf):
    return table(spark, sf, "lineitem", *LINE).groupBy("l_suppkey").agg(F.round(F.coalesce(F.sum("l_quantity"), F.lit(0.0)), 2).alias("q"), F.round(F.coalesce(F.sum("l_extendedprice"), F.lit(0.0)), 2).alias("amount")).withColumn("is_listed", F.lit(1).cast("long"))


@query("a02_mixed", "SELECT l_suppkey, CAST(l_shipdate AS DATE) AS d, round(sum(l_extendedprice), 2) AS amount, round(avg(l_extendedprice), 4) AS mean, count(*) AS n FROM lineitem GROUP BY 1, 2")
def a02(spark, sf):
    return table(spark, sf, "lineitem", *LINE).groupBy("l_suppkey", F.col("l_shipdate").cast("date").alias("d")).agg(F.round(F.sum("l_extendedprice"), 2).alias("amount"), F.round(F.avg("l_extendedprice"), 4).alias("mean"), F.count("*").alias("n"))


@query("a03_by_date", f"WITH {DAILY} SELECT d, total, n::BIGINT AS n FROM daily")
def a03(spark, sf):
    return daily(spark, sf).select("d", "total", "n")


@query("a04_top_n_sum", f"WITH {REPORTS}, r AS (SELECT code, value, row_number() OVER (PARTITION BY code ORDER BY value DESC, o_orderkey) AS rn FROM reports) SELECT code, round(least(sum(value), 1000000), 2) AS top FROM r WHERE rn <= 10 GROUP BY 1")
def a04(spark, sf):
    w = Window.partitionBy("code").orderBy(F.desc("value"), "o_orderkey")
    return reports(spark, sf).withColumn("rn", F.row_number().over(w)).where("rn <= 10").groupBy("code").agg(F.round(F.least(F.sum("value"), F.lit(1e6)), 2).alias("top"))


@query("a05_conditional_sum", f"WITH {REPORTS} SELECT code, round(coalesce(sum(value) FILTER (regexp_matches(kind, 'URGENT|HIGH')), 0), 2) AS strong FROM reports GROUP BY 1")
def a05(spark, sf):
    return reports(spark, sf).groupBy("code").agg(F.round(F.coalesce(F.sum(F.when(F.col("kind").rlike("URGENT|HIGH"), F.col("value"))), F.lit(0.0)), 2).alias("strong"))


@query("a06_arg_max", "SELECT CAST(o_orderdate AS DATE) AS d, max({'v': o_totalprice, 'k': -o_orderkey}).k * -1 AS leader, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1")
def a06(spark, sf):
    return table(spark, sf, "orders", "o_orderkey", "o_orderdate", "o_totalprice").groupBy(F.col("o_orderdate").cast("date").alias("d")).agg(F.max_by("o_orderkey", F.struct("o_totalprice", -F.col("o_orderkey"))).alias("leader"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("a07_per_code_summary", f"WITH {REPORTS} SELECT code, round(avg(value), 6) AS mean, count(DISTINCT kind) AS kinds, max(value) AS hi, min(value) AS lo, count(*) AS n, count(*) FILTER (contains(kind, 'LOW')) AS low FROM reports GROUP BY 1")
def a07(spark, sf):
    return reports(spark, sf).groupBy("code").agg(F.round(F.avg("value"), 6).alias("mean"), F.count_distinct("kind").alias("kinds"), F.max("value").alias("hi"), F.min("value").alias("lo"), F.count("*").alias("n"), F.count_if(F.contains("kind", F.lit("LOW"))).alias("low"))


@query("a08_quantiles", "SELECT round(quantile_cont(o_totalprice, 0.01), 4) AS q01, round(quantile_cont(o_totalprice, 0.5), 4) AS q50, round(quantile_cont(o_totalprice, 0.99), 4) AS q99 FROM orders")
def a08(spark, sf):
    found = exact_quantiles(table(spark, sf, "orders", "o_totalprice"), ["o_totalprice"], (0.01, 0.5, 0.99))["o_totalprice"]
    return spark.range(1).select(*[F.round(F.lit(v).cast("double"), 4).alias(n) for n, v in zip(("q01", "q50", "q99"), found, strict=True)])


@query("a09_group_quantile", f"WITH {PANEL} SELECT d, round(quantile_cont(close, 0.3), 8) AS q30, round(quantile_cont(close, 0.7), 8) AS q70 FROM panel GROUP BY 1")
def a09(spark, sf):
    return price_panel(spark, sf).groupBy("d").agg(F.round(F.percentile("close", 0.3), 8).alias("q30"), F.round(F.percentile("close", 0.7), 8).alias("q70"))


@query("a10_group_zscore", f"WITH {PANEL} SELECT code, d, round((vol - avg(vol) OVER (PARTITION BY d)) / coalesce(nullif(stddev_samp(vol) OVER (PARTITION BY d), 0), 1e-10), 6) AS z FROM panel")
def a10(spark, sf):
    return price_panel(spark, sf).select("code", "d", F.round(xsec.zscore(F.col("vol"), "d"), 6).alias("z"))


@query("a11_top_values", "SELECT p_brand, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, p_brand LIMIT 5")
def a11(spark, sf):
    return table(spark, sf, "part", "p_brand").groupBy("p_brand").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "p_brand").limit(5)


@query("a12_skew_kurtosis", f"WITH {PANEL} SELECT round(skewness(vol), 6) AS skew, round(kurtosis(vol), 6) AS kurt FROM panel")
def a12(spark, sf):
    return price_panel(spark, sf).agg(F.round(sample_skewness("vol"), 6).alias("skew"), F.round(sample_kurtosis("vol"), 6).alias("kurt"))


@query("a13_correlation", f"WITH {PANEL} SELECT code, round(corr(vol, amount), 6) AS r FROM panel GROUP BY 1")
def a13(spark, sf):
    return price_panel(spark, sf).groupBy("code").agg(F.round(safe_corr("vol", "amount"), 6).alias("r"))


@query("a14_mean_of_means", f"WITH {REPORTS} SELECT kind, round(avg(m), 4) AS m FROM (SELECT kind, code, avg(value) AS m FROM reports GROUP BY 1, 2) GROUP BY 1")
def a14(spark, sf):
    return reports(spark, sf).groupBy("kind", "code").agg(F.avg("value").alias("m")).groupBy("kind").agg(F.round(F.avg("m"), 4).alias("m"))


@query("a15_coverage_by_year", f"WITH {PANEL}, y AS (SELECT year(d)::BIGINT AS y, count(DISTINCT d) AS days, count(*) AS n FROM panel GROUP BY 1) SELECT y, days, n, (n - lag(n) OVER (ORDER BY y))::BIGINT AS more FROM y")
def a15(spark, sf):
    y = price_panel(spark, sf).groupBy(F.year("d").cast("long").alias("y")).agg(F.count_distinct("d").alias("days"), F.count("*").alias("n"))
    return y.withColumn("more", F.col("n") - F.lag("n").over(Window.orderBy("y")))


@query("a16_month_end", f"WITH {DAILY} SELECT strftime(d, '%Y%m') AS ym, max(d) AS last FROM daily GROUP BY 1")
def a16(spark, sf):
    return daily(spark, sf).groupBy(F.date_format("d", "yyyyMM").alias("ym")).agg(F.max("d").alias("last"))


@query("a17_duplicate_keys", "SELECT count(*) AS keys, sum(n)::BIGINT AS total FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)")
def a17(spark, sf):
    return table(spark, sf, "lineitem", "l_orderkey", "l_linenumber").groupBy("l_orderkey", "l_linenumber").count().where("count > 1").agg(F.count("*").alias("keys"), F.sum("count").alias("total"))


@query("a18_grouping_sets", "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def a18(spark, sf):
    return table(spark, sf, "lineitem", "l_returnflag", "l_linestatus").rollup("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))


@query("a19_pivot", "SELECT CAST(o_orderdate AS DATE) AS d, round(avg(o_totalprice) FILTER (o_orderstatus = 'F'), 4) AS f, round(avg(o_totalprice) FILTER (o_orderstatus = 'O'), 4) AS o, round(avg(o_totalprice) FILTER (o_orderstatus = 'P'), 4) AS p FROM orders GROUP BY 1")
def a19(spark, sf):
    got = table(spark, sf, "orders", "o_orderdate", "o_orderstatus", "o_totalprice").groupBy(F.col("o_orderdate").cast("date").alias("d")).pivot("o_orderstatus", ["F", "O", "P"]).agg(F.round(F.avg("o_totalprice"), 4))
    return got.toDF("d", "f", "o", "p")


@query("o01_multi_key_sort", "SELECT p_brand, p_size, p_partkey FROM part ORDER BY p_brand, p_size DESC, p_partkey")
def o01(spark, sf):
    return table(spark, sf, "part", "p_brand", "p_size", "p_partkey").orderBy("p_brand", F.desc("p_size"), "p_partkey")


@query("o02_top_n_rank", "SELECT s_suppkey, s_acctbal, row_number() OVER (ORDER BY s_acctbal DESC, s_suppkey)::BIGINT AS place FROM supplier ORDER BY s_acctbal DESC, s_suppkey LIMIT 20")
def o02(spark, sf):
    top = table(spark, sf, "supplier", "s_suppkey", "s_acctbal").orderBy(F.desc("s_acctbal"), "s_suppkey").limit(20)
    return top.withColumn("place", F.row_number().over(Window.orderBy(F.desc("s_acctbal"), "s_suppkey")).cast("long"))


@query("o03_selected_union", "WITH t AS (SELECT p_type AS f, avg(p_retailprice) AS m FROM part GROUP BY 1), a AS (SELECT f FROM t ORDER BY m DESC, f LIMIT 3) SELECT f FROM a UNION SELECT f FROM t WHERE f LIKE 'S%'")
def o03(spark, sf):
    t = table(spark, sf, "part", "p_type", "p_retailprice").groupBy(F.col("p_type").alias("f")).agg(F.avg("p_retailprice").alias("m"))
    return t.orderBy(F.desc("m"), "f").limit(3).select("f").union(t.where("f like 'S%'").select("f")).distinct()


@query("o05_violators", "SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem WHERE l_discount > 0.09 ORDER BY l_orderkey, l_linenumber, l_partkey, l_extendedprice LIMIT 10")
def o05(spark, sf):
    keys = ("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return table(spark, sf, "lineitem", *keys, "l_discount").where("l_discount > 0.09").select(*keys).orderBy(*keys).limit(10)


@query("o06_extremes", "SELECT array_to_string(list_sort(list(o_orderkey))[1:5], ',') AS least, array_to_string(list_reverse_sort(list(o_orderkey))[1:5], ',') AS most FROM orders")
def o06(spark, sf):
    o = table(spark, sf, "orders", "o_orderkey")
    five = lambda order, name: o.orderBy(order).limit(5).agg(F.collect_list("o_orderkey").alias("x")).select(F.array_join(F.sort_array("x", name == "least").cast("array<string>"), ",").alias(name))
    return five(F.asc("o_orderkey"), "least").join(five(F.desc("o_orderkey"), "most"), how="cross")


@query("o07_bounded_sample", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5(o_orderkey::VARCHAR), o_orderkey LIMIT 1000")
def o07(spark, sf):
    """A sampling operator: the rows of the 1,000 smallest hashes, the same ones each time."""
    return table(spark, sf, "orders", "o_orderkey", "o_totalprice").orderBy(F.md5(F.col("o_orderkey").cast("string").cast("binary")), "o_orderkey").limit(1000)


@query("u01_union_by_name", "SELECT s_suppkey AS id, s_acctbal AS bal, NULL::VARCHAR AS seg FROM supplier UNION ALL SELECT c_custkey, c_acctbal, c_mktsegment FROM customer")
def u01(spark, sf):
    a = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("bal"))
    b = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("seg"), F.col("c_acctbal").alias("bal"))
    return a.unionByName(b, allowMissingColumns=True)


@query("u02_distinct", "SELECT DISTINCT p_brand, p_type FROM part")
def u02(spark, sf):
    return table(spark, sf, "part", "p_brand", "p_type").distinct()


@query("u03_set_difference", "SELECT 'without' AS side, count(*) AS n FROM (SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders) UNION ALL SELECT 'with', count(*) FROM (SELECT c_custkey FROM customer INTERSECT SELECT o_custkey FROM orders)")
def u03(spark, sf):
    c, o = table(spark, sf, "customer", "c_custkey"), table(spark, sf, "orders", "o_custkey")
    return c.subtract(o).agg(F.count("*").alias("n")).select(F.lit("without").alias("side"), "n").union(c.intersect(o).agg(F.count("*").alias("n")).select(F.lit("with"), "n"))


@query("u04_unexpected_values", "SELECT DISTINCT o_orderstatus AS unexpected FROM orders WHERE o_orderstatus NOT IN ('F', 'O')")
def u04(spark, sf):
    got = table(spark, sf, "orders", "o_orderstatus").agg(F.collect_set("o_orderstatus").alias("s"))  # a set of codes
    return got.select(F.explode(F.array_except("s", F.array(F.lit("F"), F.lit("O")))).alias("unexpected"))
