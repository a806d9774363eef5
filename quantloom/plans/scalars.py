"""Scalar functions F01-F30."""

from __future__ import annotations

from pyspark.sql import functions as F

from quantloom.functions import scalar as fn
from quantloom.sources import spread
from quantloom.plans.base import PANEL, REPORTS, price_panel, query, reports, table

def _orders(spark, sf):
    return table(spark, sf, "orders", "o_orderkey", "o_orderdate", "o_totalprice", "o_orderpriority", "o_custkey").withColumn("day", F.col("o_orderdate").cast("date"))


@query("f01_normalise_date", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders")
def f01(spark, sf):
    text = F.when(F.col("o_orderkey") % 2 == 0, F.date_format("day", "yyyyMMdd")).otherwise(F.date_format("day", "yyyy-MM-dd"))
    return _orders(spark, sf).withColumn("text", text).select("o_orderkey", fn.parse_day(F.col("text")).alias("day"))


@query("f02_date_cascade", "SELECT o_orderkey, CASE o_orderkey % 4 WHEN 3 THEN 'n/a' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders")
def f02(spark, sf):
    k = F.col("o_orderkey") % 4
    text = F.when(k == 0, F.date_format("day", "yyyyMMdd")).when(k == 1, F.date_format("day", "yyyy/MM/dd")).when(k == 2, F.date_format("day", "yyyy-MM-dd")).otherwise("n/a")
    parsed = F.coalesce(*[F.try_to_date("text", f) for f in ("yyyyMMdd", "yyyy/MM/dd", "yyyy-MM-dd")])
    return _orders(spark, sf).withColumn("text", text).select("o_orderkey", F.coalesce(F.date_format(parsed, "yyyy-MM-dd"), "text").alias("day"))


@query("f03_quarter_code", "SELECT o_orderkey, CASE WHEN month(o_orderdate) IN (3, 6, 9, 12) THEN month(o_orderdate) // 3 ELSE 0 END::BIGINT AS q FROM orders")
def f03(spark, sf):
    return _orders(spark, sf).select("o_orderkey", fn.quarter_code(F.col("day")).cast("long").alias("q"))


@query("f04_publication_day", "SELECT o_orderkey, CASE quarter(o_orderdate) WHEN 1 THEN make_date(year(o_orderdate), 4, 30) WHEN 2 THEN make_date(year(o_orderdate), 7, 31) WHEN 3 THEN make_date(year(o_orderdate), 10, 31) ELSE make_date(year(o_orderdate) + 1, 1, 31) END AS gdp, CAST(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH AS DATE) + 14 AS cpi FROM orders")
def f04(spark, sf):
    return _orders(spark, sf).select("o_orderkey", fn.quarter_publication(F.year("day"), F.quarter("day")).alias("gdp"), fn.month_publication(F.trunc("day", "month"), 15).alias("cpi"))


@query("f05_day_difference", f"WITH {REPORTS} SELECT o_orderkey, date_diff('day', period_end, ann)::BIGINT AS lag FROM reports")
def f05(spark, sf):
    return reports(spark, sf).select("o_orderkey", F.datediff("ann", "period_end").cast("long").alias("lag"))


@query("f06_add_days", "SELECT o_orderkey, CAST(o_orderdate AS DATE) + 5 AS later FROM orders")
def f06(spark, sf):
    return _orders(spark, sf).select("o_orderkey", F.date_add("day", 5).alias("later"))


@query("f07_month_ranges", "SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)), max(o_orderdate), INTERVAL 1 MONTH))::DATE AS month FROM orders")
def f07(spark, sf):
    ends = _orders(spark, sf).agg(F.min("day").alias("a"), F.max("day").alias("b"))
    return ends.select(F.explode(F.sequence(F.trunc("a", "month"), F.col("b"), F.expr("interval 1 month"))).alias("month"))


@query("f08_weekend", "SELECT o_orderkey, (dayofweek(o_orderdate) IN (0, 6))::BIGINT AS weekend FROM orders")
def f08(spark, sf):
    return _orders(spark, sf).select("o_orderkey", F.dayofweek("day").isin(1, 7).cast("long").alias("weekend"))


NUM = "SELECT c_custkey, c_acctbal AS x FROM customer"


def _num(spark, sf):
    return table(spark, sf, "customer", "c_custkey", "c_acctbal").withColumn("x", F.col("c_acctbal"))


@query("f09_signed_log", f"SELECT c_custkey, round(sign(x) * ln(abs(x) + 1e-8), 8) AS y FROM ({NUM})")
def f09(spark, sf):
    return _num(spark, sf).select("c_custkey", F.round(fn.signed_log(F.col("x")), 8).alias("y"))


@query("f10_signed_log1p", f"SELECT c_custkey, round(sign(x) * ln(1 + abs(x)), 8) AS y FROM ({NUM})")
def f10(spark, sf):
    return _num(spark, sf).select("c_custkey", F.round(fn.signed_log1p(F.col("x")), 8).alias("y"))


@query("f11_positive_log1p", f"SELECT c_custkey, round(ln(1 + greatest(x, 0)), 8) AS y FROM ({NUM})")
def f11(spark, sf):
    return _num(spark, sf).select("c_custkey", F.round(fn.positive_log1p(F.col("x")), 8).alias("y"))


@query("f12_signed_inverse", f"SELECT c_custkey, round(sign(x) / greatest(abs(x), 1e-8), 10) AS y FROM ({NUM})")
def f12(spark, sf):
    return _num(spark, sf).select("c_custkey", F.round(fn.signed_inverse(F.col("x")), 10).alias("y"))


@query("f13_price_limit", "SELECT p_partkey, round(p_retailprice * 1.1, 2) AS upper, (p_size * 40 >= round(p_retailprice * 1.1, 2) * 0.999)::BIGINT AS hit FROM part")
def f13(spark, sf):
    up = F.round(F.col("p_retailprice") * 1.1, 2)
    return table(spark, sf, "part").select("p_partkey", up.alias("upper"), (F.col("p_size") * 40 >= up * 0.999).cast("long").alias("hit"))


@query("f14_safe_ratio", f"WITH {PANEL} SELECT code, d, round(amount / (vol + 1e-10), 6) AS r FROM panel")
def f14(spark, sf):
    return price_panel(spark, sf).select("code", "d", F.round(fn.safe_ratio(F.col("amount"), F.col("vol")), 6).alias("r"))


@query("f15_vwap", f"WITH {PANEL} SELECT code, d, CASE WHEN vol > 5 THEN round(amount / (vol * 100), 11) END AS vwap FROM panel")
def f15(spark, sf):
    return price_panel(spark, sf).select("code", "d", F.when(F.col("vol") > 5, F.round(F.try_divide(F.col("amount"), F.col("vol") * 100), 11)).alias("vwap"))


@query("f16_magnitude", "SELECT round(log10(abs(avg(o_totalprice)) + 1e-10), 6) AS m FROM orders")
def f16(spark, sf):
    return _orders(spark, sf).agg(F.round(F.log10(F.abs(F.avg("o_totalprice")) + 1e-10), 6).alias("m"))


@query("f17_contains_any", "SELECT p_partkey FROM part WHERE regexp_matches(p_name, 'ring|bolt|red')")
def f17(spark, sf):
    return table(spark, sf, "part", "p_partkey", "p_name").where(F.col("p_name").rlike("ring|bolt|red")).select("p_partkey")


@query("f07_day_chunks", "WITH b AS (SELECT min(CAST(o_orderdate AS DATE)) AS a, max(CAST(o_orderdate AS DATE)) AS z FROM orders), k AS (SELECT unnest(range(0, (z - a) // 30 + 1)) AS chunk, a, z FROM b) SELECT chunk::BIGINT AS chunk, (a + (chunk * 30)::INTEGER)::DATE AS start, least(a + (chunk * 30)::INTEGER + 29, z)::DATE AS \"end\" FROM k")
def f07_chunks(spark, sf):
    from quantloom.operators.ts import day_chunks

    return day_chunks(_orders(spark, sf), "day", 30).withColumn("chunk", F.col("chunk").cast("long"))


#: Six things read out of a text by their first group; the patterns of one are tried in order.
EXTRACTS = {
    "amount": (r"([0-9]+(?:[.][0-9]+)?) *[kmb]",),
    "percent": (r"([0-9]+(?:[.][0-9]+)?) *%",),
    "number": (r"([A-Z]+-[A-Z]+ [0-9.]+[0-9])", r"[Vv]ersion ([0-9]+(?:[.][0-9]+)*)"),
    "day": (r"([0-9]{4}-[0-9]{2}-[0-9]{2})", r"([0-9]{8})"),
    "score": (r"[Ss]core *[:=] *(-?[0-9]{1,3})", r"token *= *([A-Za-z0-9_-]+)"),
    "address": (r"([0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3})",),
}


@query("f18_extract", "SELECT doc_id, " + ", ".join("coalesce(" + ", ".join(f"nullif(regexp_extract(coalesce(text, ''), '{p}', 1), '')" for p in ps) + f") AS {k}" for k, ps in EXTRACTS.items()) + " FROM documents")
def f18(spark, sf):
    return spread(table(spark, sf, "documents", "doc_id", "text")).select("doc_id", *[first_group(F.coalesce("text", F.lit("")), ps).alias(k) for k, ps in EXTRACTS.items()])


def first_group(text, patterns):
    """The first group of the first pattern that finds one; null if none does."""
    return F.coalesce(*[F.nullif(F.regexp_extract(text, p, 1), F.lit("")) for p in patterns])


@query("f19_replace_chain", "SELECT o_orderkey, lower(regexp_replace(regexp_replace(o_orderpriority, '^[0-9]+-', ''), '\\s+', '_', 'g')) AS p FROM orders")
def f19(spark, sf):
    return _orders(spark, sf).select("o_orderkey", F.lower(F.regexp_replace(F.regexp_replace("o_orderpriority", "^[0-9]+-", ""), r"\s+", "_")).alias("p"))


@query("f20_digest_ids", "SELECT o_orderkey, md5(concat_ws('_', o_orderkey::VARCHAR, o_orderpriority)) AS id, left(md5(concat_ws('_', o_orderkey::VARCHAR, o_orderpriority)), 16) AS short_id FROM orders")
def f20(spark, sf):
    parts = (F.col("o_orderkey").cast("string"), F.col("o_orderpriority"))
    return _orders(spark, sf).select("o_orderkey", fn.digest_id(*parts).alias("id"), fn.digest_id(*parts, length=16).alias("short_id"))


@query("f21_tags", "SELECT p_partkey, array_to_string(list_filter([CASE WHEN p_name LIKE '%ring%' THEN 'ring' END, CASE WHEN p_size > 25 THEN 'large' END, CASE WHEN p_type = 'ECONOMY' THEN 'cheap' END], lambda x: x IS NOT NULL), ',') AS tags FROM part")
def f21(spark, sf):
    tags = F.array_compact(F.array(F.when(F.contains("p_name", F.lit("ring")), "ring"), F.when(F.col("p_size") > 25, "large"), F.when(F.col("p_type") == "ECONOMY", "cheap")))
    return table(spark, sf, "part").select("p_partkey", F.array_join(tags, ",").alias("tags"))


@query("f22_value_map", "SELECT c_custkey, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 0 WHEN 'BUILDING' THEN 1 ELSE -1 END::BIGINT AS code FROM customer")
def f22(spark, sf):
    return table(spark, sf, "customer", "c_custkey", "c_mktsegment").select("c_custkey", fn.value_map(F.col("c_mktsegment"), {"AUTOMOBILE": 0, "BUILDING": 1}).cast("long").alias("code"))


@query("f23_ordinal_codes", "SELECT p_partkey, k.i::BIGINT AS idx FROM part JOIN (SELECT p_brand, row_number() OVER (ORDER BY p_brand) - 1 AS i FROM (SELECT DISTINCT p_brand FROM part)) k USING (p_brand)")
def f23(spark, sf):
    from quantloom.plans.detail import ordinal_codes

    return ordinal_codes(table(spark, sf, "part", "p_partkey", "p_brand"), "p_brand", "idx").select("p_partkey", "idx")


@query("f24_json", """SELECT event_id, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k, '{"' || event_type || '":' || coalesce(json_extract_string(props, '$.k'), 'null') || ',"twice":' || coalesce((2 * try_cast(json_extract_string(props, '$.k') AS BIGINT))::VARCHAR, 'null') || '}' AS scores FROM events""")
def f24(spark, sf):
    k = F.from_json(F.regexp_extract("props", r"(?s)\{.*\}", 0), "k bigint")["k"]
    return table(spark, sf, "events", "event_id", "event_type", "props").select("event_id", k.alias("k"), F.to_json(F.create_map(F.col("event_type"), k, F.lit("twice"), 2 * k)).alias("scores"))


@query("f25_array_ops", "SELECT p_partkey, array_to_string(list_sort(list_distinct(string_split(p_name, ' ')))[1:2], '|') AS words, len(string_split(p_name, ' '))::BIGINT AS n FROM part")
def f25(spark, sf):
    w = F.split("p_name", " ")
    return table(spark, sf, "part", "p_partkey", "p_name").select("p_partkey", F.concat_ws("|", F.slice(F.array_sort(F.array_distinct(w)), 1, 2)).alias("words"), F.size(w).cast("long").alias("n"))


@query("f26_code_suffix", "SELECT s_suppkey, lpad(s_suppkey::VARCHAR, 6, '0') || CASE left(lpad(s_suppkey::VARCHAR, 6, '0'), 1) WHEN '6' THEN '.SH' WHEN '9' THEN '.SH' WHEN '4' THEN '.BJ' WHEN '8' THEN '.BJ' ELSE '.SZ' END AS code FROM supplier")
def f26(spark, sf):
    return table(spark, sf, "supplier", "s_suppkey").select("s_suppkey", fn.exchange_suffix(F.col("s_suppkey").cast("string")).alias("code"))


@query("f27_rating", "SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'buy' WHEN contains(o_orderpriority, 'LOW') THEN 'sell' ELSE 'hold' END AS rating FROM orders")
def f27(spark, sf):
    p = F.col("o_orderpriority")
    return _orders(spark, sf).select("o_orderkey", F.when(p.isin("1-URGENT", "2-HIGH"), "buy").when(F.contains(p, F.lit("LOW")), "sell").otherwise("hold").alias("rating"))


@query("f28_split_part", "SELECT o_orderkey, split_part(o_orderpriority, '-', 2) AS p FROM orders")
def f28(spark, sf):
    return _orders(spark, sf).select("o_orderkey", F.split_part("o_orderpriority", F.lit("-"), F.lit(2)).alias("p"))


@query("f29_normalise_text", "SELECT p_partkey, lpad(regexp_replace(trim(lower('  ' || p_name || '   X ')), '\\s+', ' ', 'g'), 20, '*') AS t FROM part")
def f29(spark, sf):
    raw = F.concat(F.lit("  "), "p_name", F.lit("   X "))
    return table(spark, sf, "part", "p_partkey", "p_name").select("p_partkey", F.lpad(F.regexp_replace(F.trim(F.lower(raw)), r"\s+", " "), 20, "*").alias("t"))


@query("f30_numeric_coercion", "SELECT p_partkey, try_cast(split_part(p_brand, '#', 2) AS DOUBLE) AS num, try_cast(p_type AS DOUBLE) AS none FROM part")
def f30(spark, sf):
    return table(spark, sf, "part", "p_partkey", "p_brand", "p_type").select("p_partkey", F.split_part("p_brand", F.lit("#"), F.lit(2)).try_cast("double").alias("num"), F.col("p_type").try_cast("double").alias("none"))
