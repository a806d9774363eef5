"""Labels L01-L08, post-processing Z01-Z06, folds V01-V08 and evaluation M01-M07."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quantloom import schema as S
from quantloom.operators import evaluation as E
from quantloom.operators import ts, xsec
from quantloom.operators.boosting import boost
from quantloom.operators.stats import safe_corr
from quantloom.plans.base import DAILY, OPEN_DAYS, PANEL, daily, open_days, panel_parts, price_panel, query

W = ts.per_code
P = "PARTITION BY code ORDER BY d"
RET = f"{PANEL}, lab AS (SELECT code, d, close, vol, amount, CASE WHEN lead(close, 5) OVER ({P}) IS NOT NULL THEN round(least(greatest(lead(close, 5) OVER ({P}) / nullif(close, 0) - 1, -0.5), 0.5), 8) END AS r5 FROM panel)"


def labelled(spark, sf):
    r = xsec.clip(ts.forward_return(F.col("close"), W(), 5), -0.5, 0.5)
    return price_panel(spark, sf).select("code", "d", "close", "vol", "amount", F.round(r, 8).alias("r5"))


@query("l01_forward_returns", f"WITH {PANEL} SELECT code, d, " + ", ".join(f"round(lead(close, {k}) OVER ({P}) / nullif(close, 0) - 1, 8) AS ret_{k}d" for k in (1, 5, 10, 20)) + " FROM panel")
def l01(spark, sf):
    return price_panel(spark, sf).select("code", "d", *[F.round(ts.forward_return(F.col("close"), W(), k), 8).alias(f"ret_{k}d") for k in (1, 5, 10, 20)])


@query("l02_clipped_returns", f"WITH {RET} SELECT code, d, r5 FROM lab")
def l02(spark, sf):
    return labelled(spark, sf).select("code", "d", "r5")


@query("l03_invalid_samples", f"WITH {RET} SELECT code, d, CASE WHEN coalesce(sum((vol < 10)::INTEGER) OVER ({P} ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING), 0) <= 2 THEN r5 END AS r5 FROM lab")
def l03(spark, sf):
    return labelled(spark, sf).select("code", "d", F.when(ts.future_sum((F.col("vol") < 10).cast("int"), W(), 5) <= 2, F.col("r5")).alias("r5"))


@query("l04_three_classes", f"WITH {RET} SELECT code, d, CASE WHEN r5 IS NULL THEN NULL WHEN r5 < -0.02 THEN 0 WHEN r5 > 0.02 THEN 2 ELSE 1 END::BIGINT AS cls FROM lab")
def l04(spark, sf):
    r = F.col("r5")
    return labelled(spark, sf).select("code", "d", F.when(r.isNull(), None).when(r < -0.02, 0).when(r > 0.02, 2).otherwise(1).cast("long").alias("cls"))


BOTH = f"{PANEL}, two AS (SELECT code, d, " + ", ".join(f"CASE WHEN lead(close, {k}) OVER ({P}) IS NOT NULL THEN round(least(greatest(lead(close, {k}) OVER ({P}) / nullif(close, 0) - 1, -0.5), 0.5), 8) END AS r{k}" for k in (5, 10)) + " FROM panel)"


def two_horizons(spark, sf):
    """Clipped forward returns over 5 and 10 rows."""
    r = {f"r{k}": F.round(xsec.clip(ts.forward_return(F.col("close"), W(), k), -0.5, 0.5), 8) for k in (5, 10)}
    return price_panel(spark, sf).withColumns(r).select("code", "d", "r5", "r10")


@query("l05_excess_return", f"WITH {BOTH}, b AS (SELECT d, round(avg(close), 8) AS m FROM panel GROUP BY 1), f AS (SELECT d, lead(m, 5) OVER (ORDER BY d) / nullif(m, 0) - 1 AS b5, lead(m, 10) OVER (ORDER BY d) / nullif(m, 0) - 1 AS b10 FROM b) SELECT code, d, round(r5 - coalesce(b5, 0), 6) AS excess, round(r10 - coalesce(b10, 0), 6) AS excess_10 FROM two LEFT JOIN f USING (d)")
def l05(spark, sf):
    b = price_panel(spark, sf).groupBy("d").agg(F.round(F.avg("close"), 8).alias("m"))
    b = b.select("d", *[ts.forward_return(F.col("m"), Window.orderBy("d"), k).alias(f"b{k}") for k in (5, 10)])  # a row a day
    x = two_horizons(spark, sf).join(F.broadcast(b), "d", "left")
    over = lambda k: F.round(F.col(f"r{k}") - F.coalesce(f"b{k}", F.lit(0.0)), 6)
    return x.select("code", "d", over(5).alias("excess"), over(10).alias("excess_10"))


@query("l06_rank_label", f"WITH {BOTH} SELECT code, d, " + ", ".join(f"CASE WHEN r{k} IS NOT NULL THEN round((rank() OVER (PARTITION BY d ORDER BY r{k} NULLS LAST) + (count(*) OVER (PARTITION BY d, r{k}) - 1) / 2.0) / count(r{k}) OVER (PARTITION BY d), 8) END AS rank_r{k}" for k in (5, 10)) + " FROM two")
def l06(spark, sf):
    two = two_horizons(spark, sf).repartition(panel_parts(spark, sf), "d")  # partitions of days that do not grow with the table
    return two.select("code", "d", *[F.round(xsec.pct_rank(F.col(f"r{k}"), "d"), 8).alias(f"rank_r{k}") for k in (5, 10)])


@query("l07_sharpe_label", f"WITH {RET}, v AS (SELECT code, d, r5, CASE WHEN count(r5) OVER f >= 2 THEN stddev_samp(r5) OVER f END AS v FROM lab WINDOW f AS ({P} ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING)) SELECT code, d, CASE WHEN r5 IS NULL THEN NULL WHEN v > 1e-4 THEN round(least(greatest(r5 / v, -10), 10), 5) ELSE 0 END AS sharpe FROM v")
def l07(spark, sf):
    x = labelled(spark, sf).withColumn("v", ts.future_std(F.col("r5"), W(), 5))
    s = F.when(F.col("v") > 1e-4, F.round(xsec.clip(F.try_divide("r5", "v"), -10.0, 10.0), 5)).otherwise(0.0)
    return x.select("code", "d", F.when(F.col("r5").isNotNull(), s).alias("sharpe"))


@query("l08_tercile_label", f"WITH {RET} SELECT code, d, CASE WHEN r5 IS NULL THEN NULL WHEN r5 >= quantile_cont(r5, 0.7) OVER (PARTITION BY d) THEN 2 WHEN r5 <= quantile_cont(r5, 0.3) OVER (PARTITION BY d) THEN 0 ELSE 1 END::BIGINT AS bin FROM lab")
def l08(spark, sf):
    return labelled(spark, sf).select("code", "d", xsec.tercile_label(F.col("r5"), "d").cast("long").alias("bin"))


@query("z01_common_clean", f"WITH {RET} SELECT code, d, close, vol, r5 FROM lab WHERE r5 IS NOT NULL")
def z01(spark, sf):
    x = labelled(spark, sf).drop("amount").withColumns({"zero": F.lit(0.0), "name": F.lit("x")})
    x = S.inf_to_null(x.drop("name")).na.drop(subset=["r5"])
    return x.drop(*S.constant_columns(x, exclude=["code", "r5"]))


@query("z02_tree_set", f"WITH {RET} SELECT code, d, coalesce(CASE WHEN code % 5 > 0 THEN code % 5 END, -1)::BIGINT AS cat, r5 FROM lab WHERE NOT d BETWEEN DATE '1995-01-01' AND DATE '1995-06-30'")
def z02(spark, sf):
    x = labelled(spark, sf).withColumn("cat", F.coalesce(F.when(F.col("code") % 5 > 0, F.col("code") % 5), F.lit(-1)))
    return x.where("not d between date'1995-01-01' and date'1995-06-30'").select("code", "d", F.col("cat").cast("long").alias("cat"), "r5")


SPLIT, WARM = "1998-12-31", ("1995-01-01", "1995-06-30")


@query("z03_sequence_set", f"""WITH {RET}, {DAILY}, x AS (SELECT code, lab.d, sign(amount) * ln(1 + abs(amount)) AS a, sign(vol) * ln(1 + abs(vol)) AS v, coalesce(last_value(total IGNORE NULLS) OVER (PARTITION BY code ORDER BY lab.d ROWS UNBOUNDED PRECEDING), 0) AS t, r5 FROM lab LEFT JOIN daily ON daily.d = lab.d),
q AS (SELECT quantile_cont(a, 0.01) AS al, quantile_cont(a, 0.99) AS ah, quantile_cont(v, 0.01) AS vl, quantile_cont(v, 0.99) AS vh FROM x WHERE d <= DATE '{SPLIT}'),
c AS (SELECT code, d, least(greatest(a, al), ah) AS a, least(greatest(v, vl), vh) AS v, t, r5 FROM x, q), m AS (SELECT d, round(max(t), 2) AS m FROM c GROUP BY 1),
z AS (SELECT d, CASE WHEN count(m) OVER w >= 30 AND stddev_samp(m) OVER w > 0 THEN (m - avg(m) OVER w) / stddev_samp(m) OVER w ELSE 0 END AS total FROM m WINDOW w AS (ORDER BY d ROWS BETWEEN 249 PRECEDING AND CURRENT ROW)),
f AS (SELECT code, d, coalesce(least(greatest((a - avg(a) OVER w) / coalesce(nullif(stddev_samp(a) OVER w, 0), 1e-10), -3), 3), 0) AS amount, coalesce(least(greatest((v - avg(v) OVER w) / coalesce(nullif(stddev_samp(v) OVER w, 0), 1e-10), -3), 3), 0) AS vol, coalesce(r5, 0) AS r5 FROM c WINDOW w AS (PARTITION BY d))
SELECT code, d, round(amount, 4) + 0.0 AS amount, round(vol, 4) + 0.0 AS vol, round(total, 5) + 0.0 AS total, r5 FROM f JOIN z USING (d) WHERE NOT d BETWEEN DATE '{WARM[0]}' AND DATE '{WARM[1]}'""")
def z03(spark, sf):
    x = labelled(spark, sf).join(F.broadcast(daily(spark, sf).select("d", "total")), "d", "left")
    return sequence_set(x, ["close"], ["amount", "vol"], ["total"], ["r5"], SPLIT, WARM).select("code", "d", *[(F.round(c, k) + F.lit(0.0)).alias(c) for c, k in (("amount", 4), ("vol", 4), ("total", 5))], "r5")


def sequence_set(x, drifting, sizes, series, labels, train_end, warm_up):
    """A standardised set for sequence models from a merged panel.

    Columns that drift are dropped; sizes get signed logarithms; series are carried forward;
    what is missing is 0 but in the labels.  Sizes are clipped to quantiles of the days for training,
    series become scores of their own past (250 days, 30 at least), sizes scores among the codes of
    a day, within 3.  Then labels are filled, the days of the warm-up go, and rows are sorted in their tasks.
    """
    from quantloom.functions.scalar import signed_log1p

    x = x.drop(*drifting).withColumns({c: signed_log1p(F.col(c)) for c in sizes})
    x = x.withColumns({c: ts.ffill(c, W()) for c in series}).na.fill(0.0, [*sizes, *series])
    x = xsec.winsorize(x, sizes, train=F.col("d") <= F.lit(train_end).cast("date"))
    w = Window.orderBy("d")  # one row a day
    s = x.groupBy("d").agg(*[F.round(F.max(c), 2).alias(c) for c in series])
    score = lambda c: F.when(ts.rolling_std(F.col(c), w, 250, 30) > 0, (F.col(c) - ts.rolling_mean(F.col(c), w, 250, 30)) / ts.rolling_std(F.col(c), w, 250, 30)).otherwise(0.0)
    s = s.select("d", *[score(c).alias(c) for c in series])
    x = x.drop(*series).withColumns({c: xsec.zscore(F.col(c), "d", 3.0) for c in sizes}).join(F.broadcast(s), "d")
    x = x.na.fill(0.0, [*sizes, *series, *labels]).where(~F.col("d").between(*[F.lit(t).cast("date") for t in warm_up]))
    return x.sortWithinPartitions("code", "d")


@query("z04_train_quantile_clip", f"WITH {PANEL}, b AS (SELECT quantile_cont(vol, 0.01) AS lo, quantile_cont(vol, 0.99) AS hi FROM panel WHERE d <= DATE '1998-12-31') SELECT code, d, round(least(greatest(vol, lo), hi), 4) AS vol FROM panel, b")
def z04(spark, sf):
    out = xsec.winsorize(price_panel(spark, sf), ["vol"], train=F.col("d") <= F.lit("1998-12-31").cast("date"))
    return out.select("code", "d", F.round("vol", 4).alias("vol"))


@query("z05_bounded_zscore", f"WITH {PANEL} SELECT code, d, round(least(greatest((vol - avg(vol) OVER w) / coalesce(nullif(stddev_samp(vol) OVER w, 0), 1e-10), -2), 2), 6) AS z FROM panel WINDOW w AS (PARTITION BY d)")
def z05(spark, sf):
    return price_panel(spark, sf).select("code", "d", F.round(xsec.zscore(F.col("vol"), "d", 2.0), 6).alias("z"))


@query("z06_one_pass", f"WITH {RET}, c AS (SELECT code, d, vol, r5 FROM lab WHERE r5 IS NOT NULL AND d >= DATE '1995-07-01') SELECT code, d, round((vol - avg(vol) OVER w) / coalesce(nullif(stddev_samp(vol) OVER w, 0), 1e-10), 6) AS vol, r5 FROM c WINDOW w AS (PARTITION BY d)")
def z06(spark, sf):
    x = labelled(spark, sf).where("r5 is not null and d >= date'1995-07-01'")
    return x.select("code", "d", F.round(xsec.zscore(F.col("vol"), "d"), 6).alias("vol"), "r5")


def _folds_sql(train: int, valid: int, gap: int, warm: int, start: str) -> str:
    """SQL: all folds that the calendar could begin, up to the first that is too short."""
    return f"""WITH {OPEN_DAYS}, o AS (SELECT d, row_number() OVER (ORDER BY d) - 1 AS i FROM open_days), b AS (SELECT min(d) AS a, max(d) AS z FROM o),
        k AS (SELECT a, z, unnest(range(0, date_diff('month', a, z) // {valid} + 2)) AS fold FROM b),
        e AS (SELECT fold, z, ({start})::DATE AS train_start, (a + to_months(({train} + fold * {valid})::INTEGER) - INTERVAL 1 DAY)::DATE AS train_end FROM k),
        f AS (SELECT e.*, o.d AS valid_start, least((train_end + INTERVAL {valid} MONTH)::DATE, z) AS valid_end FROM e LEFT JOIN o ON o.i = (SELECT count(*) FROM o x WHERE x.d <= e.train_end) + {gap}),
        g AS (SELECT *, bool_and(valid_start IS NOT NULL AND valid_end - valid_start >= {15 * valid}) OVER (ORDER BY fold) AS whole FROM f),
        w AS (SELECT *, greatest(0, (SELECT count(*) FROM o WHERE d < train_start) - {warm}) AS ti, greatest(0, (SELECT count(*) FROM o WHERE d < valid_start) - {warm}) AS vi FROM g WHERE whole)
        SELECT fold, train_start, train_end, valid_start, valid_end, t.d AS train_warm, v.d AS valid_warm FROM w JOIN o t ON t.i = ti JOIN o v ON v.i = vi"""


@query("v01_walk_forward_folds", _folds_sql(24, 6, 5, 0, "a"))
def v01(spark, sf):
    return E.fold_table(open_days(spark, sf), "d", 24, 6, gap=5, kind="expanding")


@query("v02_sequence_folds", _folds_sql(24, 6, 20, 60, "a + to_months((fold * 6)::INTEGER)"))
def v02(spark, sf):
    return E.fold_table(open_days(spark, sf), "d", 24, 6, gap=20, kind="rolling", warm_up=60)


@query("v03_sequence_windows", f"WITH {PANEL}, s AS (SELECT code, d, list(vol) OVER ({P} ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS seq FROM panel) SELECT code, d, array_to_string(list_transform(seq, lambda x: x::BIGINT), ',') AS seq FROM s WHERE len(seq) = 10 AND d >= DATE '1999-01-01'")
def v03(spark, sf):
    s = price_panel(spark, sf).withColumn("seq", F.collect_list("vol").over(W().rowsBetween(-9, 0)))
    return s.where((F.size("seq") == 10) & (F.col("d") >= F.lit("1999-01-01").cast("date"))).select("code", "d", F.array_join(F.transform("seq", lambda x: x.cast("long").cast("string")), ",").alias("seq"))


@query("v04_target_zscore", f"WITH {RET} SELECT code, d, CASE WHEN r5 IS NOT NULL THEN round(least(greatest((r5 - avg(r5) OVER w) / (CASE WHEN stddev_samp(r5) OVER w > 0 THEN stddev_samp(r5) OVER w ELSE 1 END), -3), 3), 6) END AS y FROM lab WINDOW w AS (PARTITION BY d)")
def v04(spark, sf):
    return labelled(spark, sf).select("code", "d", F.round(xsec.zscore(F.col("r5"), "d", 3.0, floor=1.0), 6).alias("y"))


@query("v05_negative_categories", "WITH c AS (SELECT c_custkey, CASE WHEN c_nationkey < 3 THEN -c_nationkey - 1 ELSE c_nationkey END AS k FROM customer), m AS (SELECT max(k) AS top FROM c) SELECT c_custkey, (CASE WHEN k < 0 THEN abs(k) + top ELSE k END)::BIGINT AS k FROM c, m")
def v05(spark, sf):
    from quantloom.plans.base import table

    c = table(spark, sf, "customer").select("c_custkey", F.when(F.col("c_nationkey") < 3, -F.col("c_nationkey") - 1).otherwise(F.col("c_nationkey")).alias("k"))
    return c.join(F.broadcast(c.agg(F.max("k").alias("top"))), how="cross").select("c_custkey", F.when(F.col("k") < 0, F.abs("k") + F.col("top")).otherwise(F.col("k")).cast("long").alias("k"))


@query("v06_feature_selection", f"WITH {RET} SELECT code, d, close, vol FROM lab")
def v06(spark, sf):
    x = labelled(spark, sf)
    return x.select(*[c for c in x.columns if not c.startswith(("r", "am"))])


def _boosted(spark, sf):
    """A model of the label from three features: trained to mid-1998, stopped by the second half of it."""
    x = labelled(spark, sf).na.drop().where("d < date'1999-01-01'").withColumn("valid", F.col("d") >= F.lit("1998-07-01").cast("date"))
    return boost(x, ["close", "vol", "amount"], "r5", "valid", loss="huber", trees=6, depth=3, rate=0.3, delta=0.2, patience=3)


@query("v07_boosted_trees")
def v07(spark, sf):
    """Predictions of the boosted trees for the days from 1999 on."""
    later = labelled(spark, sf).na.drop().where("d >= date'1999-01-01'")
    return _boosted(spark, sf).predict(later, "y_pred").select("code", "d", F.col("r5").alias("y_true"), "y_pred")


@query("v07_feature_gains")
def v07_gains(spark, sf):
    """What each feature gained in the trees that were kept, and the loss on the validation days before and after them."""
    m = _boosted(spark, sf)
    rows = [F.struct(F.lit(k).alias("feature"), F.lit(float(g)).alias("gain")) for k, g in m.gains.items()]
    return labelled(spark, sf).agg(F.count("r5").alias("rows")).select(F.explode(F.array(*rows)).alias("x"), "rows", F.lit(len(m.trees)).alias("trees"), F.lit(m.curve[0]).alias("loss_before"), F.lit(m.curve[len(m.trees)]).alias("loss_after")).select("x.*", "rows", "trees", "loss_before", "loss_after")


@query("v08_ensemble", f"WITH {RET}, p AS (SELECT code, d, close AS a, vol AS b, amount AS c FROM lab) SELECT code, d, round((0.4 * (a + b) / 2 + 0.6 * c) / (0.4 + 0.6), 7) AS y FROM p")
def v08(spark, sf):
    return labelled(spark, sf).select("code", "d", F.round(E.ensemble([F.col("close"), F.col("vol")], F.col("amount"), 0.4, 0.6), 7).alias("y"))


PAIRS = f"{RET}, pairs AS (SELECT d, code, r5 AS y, close AS p FROM lab WHERE r5 IS NOT NULL AND close IS NOT NULL)"
IC = f"{PAIRS}, ic AS (SELECT d, corr(y, p) AS ic FROM pairs GROUP BY 1 HAVING count(*) >= 3 AND isfinite(corr(y, p)))"


def _pairs(spark, sf):
    return labelled(spark, sf).select("d", "code", F.col("r5").alias("y"), F.col("close").alias("p")).na.drop()


@query("m01_daily_ic", f"WITH {IC} SELECT d, round(ic, 6) + 0.0 AS ic FROM ic")
def m01(spark, sf):
    return E.daily_ic(_pairs(spark, sf), "d", "y", "p").select("d", (F.round("ic", 6) + F.lit(0.0)).alias("ic"))


@query("m02_daily_rank_ic", f"WITH {PAIRS}, r AS (SELECT d, rank() OVER (PARTITION BY d ORDER BY y) + (count(*) OVER (PARTITION BY d, y) - 1) / 2.0 AS a, rank() OVER (PARTITION BY d ORDER BY p) + (count(*) OVER (PARTITION BY d, p) - 1) / 2.0 AS b FROM pairs) SELECT d, round(corr(a, b), 6) + 0.0 AS rank_ic FROM r GROUP BY 1 HAVING count(*) >= 3 AND isfinite(corr(a, b))")
def m02(spark, sf):
    return E.daily_rank_ic(_pairs(spark, sf), "d", "y", "p").select("d", (F.round("rank_ic", 6) + F.lit(0.0)).alias("rank_ic"))


#: SQL: the two-sided p-value of the mean of ic, as ``two_sided_p`` has it.
P_VALUE = """SELECT greatest(0, 1 - 2 * scale * h / 3 * list_sum(list_transform(range(0, 2001), lambda i: CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END * pow(1 + i * h * i * h / v, -(v + 1) / 2)))) AS p FROM (
  SELECT v, abs(t) / 2000 AS h, r * list_product(list_transform(range(0, 10), lambda k: (x + k) / (x + k + 0.5))) / sqrt(v * pi()) AS scale FROM (
    SELECT v, x, t, sqrt(x + 10) * (1 - 1 / (8 * (x + 10)) + 1 / (128 * (x + 10) ** 2) + 5 / (1024 * (x + 10) ** 3) - 21 / (32768 * (x + 10) ** 4)) AS r FROM (
      SELECT (count(*) - 1)::DOUBLE AS v, (count(*) - 1) / 2.0::DOUBLE AS x, avg(ic) / (stddev_samp(ic) / sqrt(count(*))) AS t FROM ic)))"""


@query("m03_ic_summary", f"WITH {IC} SELECT count(*) AS n, round(avg(ic), 6) AS mean, round(stddev_samp(ic), 6) AS std, round(avg(ic) / stddev_samp(ic), 6) AS icir, round(avg((ic > 0)::INTEGER), 6) AS positive, round(avg(ic) / (stddev_samp(ic) / sqrt(count(*))), 5) AS t, round(p, 6) AS p FROM ic, (" + P_VALUE + ") GROUP BY p")
def m03(spark, sf):
    return E.ic_summary(E.daily_ic(_pairs(spark, sf), "d", "y", "p"), "ic")


GROUPS = f"{PAIRS}, r AS (SELECT d, y, row_number() OVER (PARTITION BY d ORDER BY p, code) AS rn, count(*) OVER (PARTITION BY d) AS n FROM pairs), g AS (SELECT d, greatest(1, ceil((rn - 1) * 5.0 / (n - 1)))::BIGINT AS grp, avg(y) AS r FROM r WHERE n >= 5 GROUP BY 1, 2)"


def _groups(spark, sf):
    return E.group_returns(_pairs(spark, sf), "d", "y", "p", 5, F.col("code"))


@query("m04_group_returns", f"WITH {GROUPS} SELECT d, grp, round(r, 12) AS r FROM g")
def m04(spark, sf):
    return _groups(spark, sf).select("d", "grp", F.round("r", 12).alias("r"))


@query("m05_long_short", f"WITH {GROUPS} SELECT d, round(max(r) FILTER (grp = 5) - max(r) FILTER (grp = 1), 11) AS ls FROM g GROUP BY 1")
def m05(spark, sf):
    return E.long_short(_groups(spark, sf), "d", 5).select("d", F.round("ls", 11).alias("ls"))


@query("m06_monotonicity", f"WITH {GROUPS}, m AS (SELECT grp, avg(r) AS r FROM g GROUP BY 1) SELECT round(corr(grp, k), 6) AS mono FROM (SELECT grp, rank() OVER (ORDER BY r) AS k FROM m)")
def m06(spark, sf):
    m = _groups(spark, sf).groupBy("grp").agg(F.avg("r").alias("r")).withColumn("k", F.rank().over(Window.orderBy("r")))
    return m.agg(F.round(safe_corr("grp", "k"), 6).alias("mono"))


@query("m07_long_short_summary", f"WITH {GROUPS}, s AS (SELECT d, max(r) FILTER (grp = 5) - max(r) FILTER (grp = 1) AS ls FROM g GROUP BY 1) SELECT round(avg(ls), 9) AS mean, round(product(1 + ls) - 1, 6) AS cumulative, round(avg(ls) / stddev_samp(ls) * sqrt(252), 5) AS sharpe FROM s")
def m07(spark, sf):
    ls = E.long_short(_groups(spark, sf), "d", 5)
    return ls.agg(F.round(F.avg("ls"), 9).alias("mean"), F.round(F.product(1 + F.col("ls")) - 1, 6).alias("cumulative"), F.round(F.avg("ls") / F.stddev_samp("ls") * F.sqrt(F.lit(252.0)), 5).alias("sharpe"))
