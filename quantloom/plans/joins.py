"""Join operators J01-J20."""

from __future__ import annotations

from pyspark.sql import functions as F

from quantloom.operators import calendar as cal
from quantloom.operators import joins as J
from quantloom.plans.base import CALENDAR, DAILY, INTERVALS, OPEN_DAYS, PANEL, REPORTS, calendar, daily, intervals, open_days, price_panel, query, reports, table

FACT = "fact AS (SELECT l_suppkey AS code, CAST(l_shipdate AS DATE) AS d, count(*) AS lines FROM lineitem GROUP BY 1, 2)"


def _fact(spark, sf):
    return table(spark, sf, "lineitem", "l_suppkey", "l_shipdate").groupBy(F.col("l_suppkey").alias("code"), F.col("l_shipdate").cast("date").alias("d")).agg(F.count("*").alias("lines"))


@query("j01_left_join", f"WITH {PANEL}, {FACT} SELECT p.code, p.d, close, lines FROM panel p LEFT JOIN (SELECT * FROM fact WHERE lines > 1) f USING (code, d)")
def j01(spark, sf):
    return price_panel(spark, sf).join(_fact(spark, sf).where("lines > 1"), ["code", "d"], "left").select("code", "d", "close", "lines")


@query("j02_broadcast_join", f"WITH {PANEL}, {DAILY} SELECT code, d, close, total FROM panel LEFT JOIN daily USING (d)")
def j02(spark, sf):
    return price_panel(spark, sf).join(F.broadcast(daily(spark, sf)), "d", "left").select("code", "d", "close", "total")  # a row a day


@query("j03_skeleton", f"WITH {OPEN_DAYS} SELECT DISTINCT s_suppkey AS code, d FROM supplier CROSS JOIN open_days")
def j03(spark, sf):
    return J.skeleton(open_days(spark, sf), table(spark, sf, "supplier").select(F.col("s_suppkey").alias("code")))


@query("j04_interval_closed", f"""WITH {INTERVALS},
days AS (SELECT DISTINCT code, ann + 7 AS d FROM reports)
SELECT code, d, (EXISTS (SELECT 1 FROM intervals i WHERE i.kind = '1-URGENT' AND i.code = days.code AND days.d >= i.start AND (i."end" IS NULL OR days.d <= i."end")))::BIGINT AS urgent FROM days""")
def j04(spark, sf):
    days = reports(spark, sf).select("code", F.date_add("ann", 7).alias("d")).distinct()
    got = J.covered_by_interval(days, intervals(spark, sf).where("kind = '1-URGENT'"), "code", "d", "start", "end", "urgent")
    return got.select("code", "d", F.col("urgent").cast("long").alias("urgent"))


@query("j05_interval_half_open", f"""WITH {INTERVALS}, days AS (SELECT DISTINCT code, ann + 7 AS d FROM reports)
SELECT days.code, days.d, max({{'s': i.start, 'o': i.o_orderkey, 'k': i.kind}}).k AS kind FROM days LEFT JOIN intervals i ON i.code = days.code AND days.d >= i.start AND (i."end" IS NULL OR days.d < i."end") GROUP BY 1, 2""")
def j05(spark, sf):
    days = reports(spark, sf).select("code", F.date_add("ann", 7).alias("d")).distinct()
    return J.latest_interval(days, intervals(spark, sf), "code", "d", "start", "end", ["kind"], tie=["o_orderkey"])


@query("j06_full_outer", f"""WITH {REPORTS}, a AS (SELECT code, period_end, max(value) AS hi FROM reports WHERE kind < '3' GROUP BY 1, 2), b AS (SELECT code, period_end, min(value) AS lo FROM reports WHERE kind >= '3' GROUP BY 1, 2)
SELECT code, period_end, hi, lo FROM a FULL OUTER JOIN b USING (code, period_end)""")
def j06(spark, sf):
    r = reports(spark, sf)
    a = r.where("kind < '3'").groupBy("code", "period_end").agg(F.max("value").alias("hi"))
    b = r.where("kind >= '3'").groupBy("code", "period_end").agg(F.min("value").alias("lo"))
    return a.join(b, ["code", "period_end"], "full_outer")


@query("j07_outer_fold", "WITH s AS (SELECT CAST(o_orderdate AS DATE) AS d, o_orderpriority AS k, o_totalprice AS v FROM orders) SELECT d, max(v) FILTER (k = '1-URGENT') AS urgent, max(v) FILTER (k = '2-HIGH') AS high, max(v) FILTER (k = '5-LOW') AS low FROM s WHERE k IN ('1-URGENT', '2-HIGH', '5-LOW') GROUP BY 1")
def j07(spark, sf):
    o = table(spark, sf, "orders", "o_orderdate", "o_orderpriority", "o_totalprice").withColumn("d", F.col("o_orderdate").cast("date"))
    part = lambda k, name: o.where(F.col("o_orderpriority") == k).groupBy("d").agg(F.max("o_totalprice").alias(name))
    return J.outer_fold([part("1-URGENT", "urgent"), part("2-HIGH", "high"), part("5-LOW", "low")], "d")


@query("j08_inner_join", f"WITH {PANEL}, {FACT} SELECT code, d, close, lines FROM panel JOIN fact USING (code, d) WHERE lines >= 2")
def j08(spark, sf):
    return price_panel(spark, sf).join(_fact(spark, sf).where("lines >= 2"), ["code", "d"]).select("code", "d", "close", "lines")


@query("j09_asof_backward", """WITH p AS (SELECT user_id, ts, max(value) AS weight FROM events WHERE event_type = 'purchase' GROUP BY 1, 2), v AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'view')
SELECT v.event_id, v.user_id, p.weight FROM v ASOF LEFT JOIN p ON v.user_id = p.user_id AND v.ts >= p.ts""")
def j09(spark, sf):
    e = table(spark, sf, "events", "event_id", "user_id", "ts", "event_type", "value")
    right = e.where("event_type = 'purchase'").groupBy("user_id", "ts").agg(F.max("value").alias("weight"))
    return J.asof_backward(e.where("event_type = 'view'").select("event_id", "user_id", "ts"), right, "user_id", "ts", ["weight"]).select("event_id", "user_id", "weight")


@query("j10_strictly_after", f"WITH {OPEN_DAYS}, {REPORTS} SELECT o_orderkey, ann, min(d) AS day FROM reports JOIN open_days ON d > ann GROUP BY 1, 2")
def j10(spark, sf):
    return cal.map_strictly_after(reports(spark, sf), calendar(spark, sf), "ann", "day").select("o_orderkey", "ann", "day")


@query("j11_on_or_after", f"WITH {CALENDAR}, {REPORTS} SELECT o_orderkey, ann, coalesce(next_on_or_after, ann) AS day FROM reports LEFT JOIN calendar ON cal_date = ann")
def j11(spark, sf):
    return cal.map_on_or_after(reports(spark, sf), calendar(spark, sf), "ann", "day").select("o_orderkey", "ann", "day")


@query("j12_nearest_visible", f"""WITH {CALENDAR}, e AS (
  SELECT l_suppkey AS code, a.pos AS seen, s.pos AS due FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN calendar a ON a.cal_date = CAST(o_orderdate AS DATE) JOIN calendar s ON s.cal_date = CAST(l_shipdate AS DATE)
), k AS (SELECT DISTINCT l_suppkey AS code, c.pos FROM lineitem JOIN calendar c ON c.cal_date = CAST(l_shipdate AS DATE))
SELECT k.code, k.pos::BIGINT AS pos, coalesce(min(due - k.pos), -1)::BIGINT AS days_to FROM k LEFT JOIN e ON e.code = k.code AND seen <= k.pos AND k.pos <= due GROUP BY 1, 2""")
def j12(spark, sf):
    c = F.broadcast(calendar(spark, sf).select("cal_date", "pos"))  # a row a day
    line = table(spark, sf, "lineitem", "l_orderkey", "l_suppkey", "l_shipdate")
    orders = table(spark, sf, "orders", "o_orderkey", "o_orderdate")
    seen, at = c.select(F.col("cal_date").alias("a"), F.col("pos").alias("seen")), c.select(F.col("cal_date").alias("s"), F.col("pos").alias("at"))
    e = line.join(orders, F.col("o_orderkey") == F.col("l_orderkey")).join(F.broadcast(seen), F.col("a") == F.col("o_orderdate").cast("date")).join(F.broadcast(at), F.col("s") == F.col("l_shipdate").cast("date"))
    e = e.select(F.col("l_suppkey").alias("code"), "seen", "at")
    rows = line.join(c, F.col("cal_date") == F.col("l_shipdate").cast("date")).select(F.col("l_suppkey").alias("code"), "pos").distinct()
    return J.nearest_visible_event(rows, e, "code", "pos", "seen", "at", "days_to").select("code", F.col("pos").cast("long").alias("pos"), F.col("days_to").cast("long").alias("days_to"))


@query("j13_anti_by_event", "SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL AND o_orderpriority = '1-URGENT')")
def j13(spark, sf):
    urgent = table(spark, sf, "orders", "o_custkey", "o_orderpriority").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return J.not_in(table(spark, sf, "customer", "c_custkey", "c_mktsegment"), urgent, "c_custkey")


@query("j14_anti_processed", "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def j14(spark, sf):
    return J.not_in(table(spark, sf, "documents", "doc_id", "source"), table(spark, sf, "labels", "doc_id"), "doc_id")


SEGMENTS = {"AUTOMOBILE": "machines", "MACHINERY": "machines", "BUILDING": "homes", "FURNITURE": "homes"}


@query("j15_lookup_fill", "SELECT c_custkey, coalesce(CASE WHEN c_nationkey > 12 THEN 'far' END, CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'machines' WHEN 'MACHINERY' THEN 'machines' WHEN 'BUILDING' THEN 'homes' WHEN 'FURNITURE' THEN 'homes' END, 'none') AS grp FROM customer")
def j15(spark, sf):
    lookup = F.create_map(*[F.lit(x) for kv in SEGMENTS.items() for x in kv])
    own = F.when(F.col("c_nationkey") > 12, "far")
    return table(spark, sf, "customer", "c_custkey", "c_mktsegment", "c_nationkey").select("c_custkey", F.coalesce(own, F.try_element_at(lookup, F.col("c_mktsegment")), F.lit("none")).alias("grp"))


@query("j16_left_columns_win", "SELECT s_suppkey AS id, s_nationkey AS nation, n_name AS name FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey")
def j16(spark, sf):
    left = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("nation"))
    right = table(spark, sf, "nation").select(F.col("n_nationkey").alias("nation"), F.col("n_regionkey").alias("id"), F.col("n_name").alias("name"))
    return J.left_keep(left, right, ["nation"]).select("id", "nation", "name")


@query("j17_fill_from", "SELECT o.o_orderkey, coalesce(CASE WHEN o.o_totalprice > 200000 THEN o.o_totalprice END, x.v) AS value FROM orders o LEFT JOIN (SELECT l_orderkey, round(sum(l_extendedprice), 2) AS v FROM lineitem GROUP BY 1) x ON x.l_orderkey = o.o_orderkey")
def j17(spark, sf):
    left = table(spark, sf, "orders", "o_orderkey", "o_totalprice").select("o_orderkey", F.when(F.col("o_totalprice") > 200000, F.col("o_totalprice")).alias("value"))
    right = table(spark, sf, "lineitem", "l_orderkey", "l_extendedprice").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.round(F.sum("l_extendedprice"), 2).alias("value"))
    return J.fill_from(left, right, ["o_orderkey"], ["value"])


@query("j18_containment", """SELECT a.p_partkey, a.p_name, min({'k': b.p_partkey, 'n': b.p_brand}).k AS first_key FROM part a JOIN part b ON a.p_brand = b.p_brand AND b.p_partkey < a.p_partkey AND contains(b.p_name, split_part(a.p_name, ' ', 1)) GROUP BY 1, 2""")
def j18(spark, sf):
    a = table(spark, sf, "part", "p_partkey", "p_name", "p_brand")
    word = F.split_part("p_name", F.lit(" "), F.lit(1))
    found = J.least_containing(a.select("p_brand", word.alias("word")), a.select("p_brand", "p_name", F.col("p_partkey").alias("first_key")), "p_brand", "word", "p_name", "first_key")
    hit = a.withColumn("word", word).join(found, ["p_brand", "word"]).where(F.col("first_key") < F.col("p_partkey"))
    return hit.groupBy("p_partkey", "p_name").agg(F.min("first_key").alias("first_key"))


@query("j19_safe_merge", "SELECT r_regionkey, r_name FROM region")
def j19(spark, sf):
    region = table(spark, sf, "region")
    return safe_merge(region, region.select("r_regionkey").limit(0), ["r_regionkey"])


def safe_merge(left, right, on):
    """A left join; an empty side gives the other one as it is."""
    if right.isEmpty():
        return left
    return right if left.isEmpty() else left.join(right, on, "left")


@query("j20_right_and_theta", "SELECT n.n_nationkey, s.s_suppkey, (SELECT count(*) FROM region r WHERE r.r_regionkey < n.n_regionkey)::BIGINT AS before FROM (SELECT * FROM supplier WHERE s_acctbal > 9000) s RIGHT JOIN nation n ON s.s_nationkey = n.n_nationkey")
def j20(spark, sf):
    n, s, r = table(spark, sf, "nation"), table(spark, sf, "supplier").where("s_acctbal > 9000"), table(spark, sf, "region")
    less = n.join(F.broadcast(r), F.col("r_regionkey") < F.col("n_regionkey"), "left").groupBy("n_nationkey").agg(F.count("r_regionkey").alias("before"))  # five regions
    return s.join(n, F.col("s_nationkey") == F.col("n_nationkey"), "right").join(less, "n_nationkey").select("n_nationkey", "s_suppkey", "before")
