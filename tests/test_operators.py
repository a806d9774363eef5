"""Micro-fixtures for semantics that an oracle over bulk data does not show."""

from datetime import date, datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from quantloom.functions import scalar
from quantloom.functions import text as X
from quantloom.operators import calendar as cal
from quantloom.operators import evaluation as E
from quantloom.operators import joins as J
from quantloom.operators import ts, xsec
from quantloom.operators.checks import Check, run_checks

MON = date(2024, 1, 1)


def days(n):
    return [MON + timedelta(days=i) for i in range(n)]


@pytest.fixture(scope="module")
def week(spark):
    return cal.calendar_dim(spark.createDataFrame([(d,) for d in days(10) if d.weekday() < 5], "d date"))


def test_point_in_time_boundaries(spark, week):
    ann = spark.createDataFrame([(MON + timedelta(days=k),) for k in (2, 4, 5)], "ann date")  # Wednesday, Friday, Saturday
    strict = [r.day for r in cal.map_strictly_after(ann, week, "ann", "day").orderBy("ann").collect()]
    near = [r.day for r in cal.map_on_or_after(ann, week, "ann", "day").orderBy("ann").collect()]
    thu, wed, fri, mon = MON + timedelta(3), MON + timedelta(2), MON + timedelta(4), MON + timedelta(7)
    assert strict == [thu, mon, mon]
    assert near == [wed, fri, mon]


def test_interval_ends(spark):
    rows = spark.createDataFrame([(1, d) for d in days(4)], "k int, d date")
    span = spark.createDataFrame([(1, days(4)[0], days(4)[2], "a")], "k int, s date, e date, v string")
    closed = J.covered_by_interval(rows, span, "k", "d", "s", "e", "f").orderBy("d").collect()
    half = J.latest_interval(rows, span, "k", "d", "s", "e", ["v"]).orderBy("d").collect()
    assert [r.f for r in closed] == [1, 1, 1, 0]
    assert [r.v for r in half] == ["a", "a", None, None]


def test_asof_exact_earlier_and_none(spark):
    left = spark.createDataFrame([(1, 10), (1, 15), (1, 20), (2, 5)], "k int, t int")
    right = spark.createDataFrame([(1, 5, "x"), (1, 15, "y")], "k int, t int, v string")
    assert [r.v for r in J.asof_backward(left, right, "k", "t", ["v"]).orderBy("k", "t").collect()] == ["x", "y", "y", None]


def test_nearest_visible_event(spark):
    rows = spark.createDataFrame([(1, 3), (1, 9)], "k int, pos int")
    events = spark.createDataFrame([(1, 5, 6), (1, 1, 8), (1, 2, 5), (1, 1, 2)], "k int, seen int, at int")
    assert [r.n for r in J.nearest_visible_event(rows, events, "k", "pos", "seen", "at", "n").orderBy("pos").collect()] == [2, -1]


def test_ids_without_value_stay(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "id int")
    assert sorted(str(r.id) for r in J.not_in(left, left.where("id = 1"), "id").collect()) == ["2", "None"]


def test_rolling_needs_full_window(spark):
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate([1.0, 2.0, None, 4.0, 5.0, 6.0])], "code int, d int, v double")
    got = [r.m for r in df.select("d", ts.rolling_mean(F.col("v"), ts.per_code(), 3).alias("m")).orderBy("d").collect()]
    assert got == [None, None, None, None, None, 5.0]


def test_ewm_forms_agree_with_pandas(spark):
    v = [3.0, 1.0, 4.0, 1.0, 5.0]
    df = spark.createDataFrame([(1, i, x) for i, x in enumerate(v)], "code int, d int, v double")
    want = pd.Series(v).ewm(alpha=0.4, adjust=False).mean().tolist()
    a = [r.e for r in ts.ewm(df, "code", "d", "v", 0.4, "e").orderBy("d").collect()]
    b = [r.e for r in ts.ewm_grouped(df, "code", "d", "v", {"e": 0.4}).orderBy("d").collect()]
    assert a == pytest.approx(want) and b == pytest.approx(want)


def test_rank_ties_and_nulls(spark):
    v = [3.0, 1.0, 1.0, 2.0, None, 2.0, 2.0]
    df = spark.createDataFrame([(1, i, x) for i, x in enumerate(v)], "d int, i int, v double")
    got = [r.r for r in df.select("i", xsec.pct_rank(F.col("v"), "d").alias("r")).orderBy("i").collect()]
    want = pd.Series(v).rank(pct=True).tolist()
    assert [None if x is None else round(x, 9) for x in got] == [None if x != x else round(x, 9) for x in want]


def test_quantile_bucket_sizes(spark):
    df = spark.createDataFrame([(1, i, float(i)) for i in range(5)], "d int, i int, v double")
    got = df.select(xsec.quantile_bucket(F.col("v"), "d", 3, F.col("i")).alias("b")).groupBy("b").count().orderBy("b").collect()
    assert [r["count"] for r in got] == [2, 1, 2]


def test_tied_terciles_and_clip(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 0.5), (1, None)], "d int, v double")
    got = [r.b for r in df.select(xsec.tercile_label(F.col("v"), "d").alias("b"), "v").orderBy(F.col("v").asc_nulls_last()).collect()]
    assert got == [2, 2, None]
    assert [r[0] for r in df.select(xsec.clip(F.col("v"), 0.0, 0.1)).collect()].count(None) == 1


def test_signed_transforms(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (None,)], "x double")
    log, log1p, inv = zip(*df.select(scalar.signed_log(F.col("x")), scalar.signed_log1p(F.col("x")), scalar.signed_inverse(F.col("x"))).collect(), strict=True)
    assert log[2] == 0 and log1p[2] is None and inv[2] is None and inv[1] == 0 and inv[0] == -1


def test_rule_priority(spark):
    rules = (X.Rule("up", 50, "gain", 5), X.Rule("down", -50, "loss", 5), X.Rule("halt", 0, "halt", 9))
    df = spark.createDataFrame([("UP and down",), ("up",), ("up halt",), ("none",)], "t string")
    assert [r.c for r in df.select(X.score_by_rules(F.col("t"), rules)["category"].alias("c")).collect()] == ["loss", "gain", "halt", None]


def test_chunks_cover_and_number(spark):
    text = "\n".join(["a" * 30, "b" * 30, "c" * 80, "d"])
    got = spark.createDataFrame([(text,), ("",)], "t string").select(X.paragraph_chunks(F.col("t"), 64, 5).alias("c")).collect()
    assert [c.content.split("\n")[-1][0] for c in got[0].c][:2] == ["b", "c"] and got[0].c[0].total == len(got[0].c) and got[1].c == []


def test_walk_forward_gap_and_warm_up(spark):
    cal_days = spark.createDataFrame([(date(2020, 1, 1) + timedelta(days=i),) for i in range(900)], "d date")
    folds = E.fold_table(cal_days, "d", 12, 3, gap=5, kind="rolling", warm_up=10).orderBy("fold").collect()
    for f in folds:
        assert (f["valid_start"] - f["train_end"]).days == 6 and (f["valid_start"] - f["valid_warm"]).days == 10
    assert [f["fold"] for f in folds] == list(range(len(folds))) and len(folds) > 3 and folds[0]["train_warm"] == date(2020, 1, 1)
    assert E.fold_table(cal_days.limit(0), "d", 12, 3, gap=5).collect() == []


@pytest.mark.parametrize("t,v,p", [(2.0, 10, 0.073388), (2.0, 1, 0.295167), (-1.96, 5000, 0.050051), (0.0, 4, 1.0), (5.0, 30, 0.0000234)])
def test_student_p_value(spark, t, v, p):
    from quantloom.operators.stats import two_sided_p

    got = spark.range(1).select(two_sided_p(F.lit(t), F.lit(v)).alias("p")).first().p
    assert got == pytest.approx(p, abs=2e-6)


def test_checks_on_bad_rows(spark):
    df = spark.createDataFrame([(1.0,), (-1.0,), (None,)], "x double")
    got = {r.name: (r.severity, r.n) for r in run_checks(df, [Check("positive", F.col("x") < 0), Check("none", F.col("x").isNull(), limit=0.5)]).collect()}
    assert got == {"positive": ("ERROR", 1), "none": ("PASS", 1)}


def test_stream_agrees_with_batch(spark, tmp_path):
    from quantloom import streaming as T

    rows = [(i, datetime(2024, 1, 1, i // 4, (i * 7) % 60), i % 3, "ab"[i % 2], float(i)) for i in range(40)]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "in"))
    q = T.tumbling(T.event_stream(spark, str(tmp_path / "in"), schema)).writeStream.format("memory").queryName("tumbled").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    batch = T.tumbling(spark.read.parquet(str(tmp_path / "in")).withColumn("ts", F.col("ts").cast("timestamp")))
    assert sorted(map(tuple, spark.table("tumbled").collect())) == sorted(map(tuple, batch.collect()))


def test_event_windows_write_out_the_days_between(spark):
    """Against a plain count, with codes that have no event on an open day; no dense row is shuffled."""
    from quantloom.plans.detail import event_windows

    open_ = [d for d in days(20) if d.weekday() < 5]
    line = spark.createDataFrame([(d, i + 1) for i, d in enumerate(open_)], "d date, pos int")
    events = [(1, open_[0], 2.0), (1, open_[4], None), (2, open_[-1], 3.0), (3, days(6)[5], 4.0), (4, None, 5.0), (None, open_[2], 6.0), (5, open_[1], 1.0), (5, open_[2], 1.5)]
    got = event_windows(spark.createDataFrame(events, "code long, d date, amount double"), line, 3)
    assert "Exchange hashpartitioning(code" in (plan := got._sc._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "simple")) and plan.count("Exchange hashpartitioning") == 1
    known = {(c, d): a for c, d, a in events if c is not None}
    want = []
    for c in {c for c, _, _ in events}:
        for i, d in enumerate(open_):
            want.append((c, d, int((c, d) in known), known.get((c, d)) or 0.0, int(any((c, e) in known for e in open_[max(0, i - 2) : i + 1]))))
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


def test_batches_of_texts_are_bounded(spark):
    from quantloom.sources import score_with, spread

    docs = spark.range(0, 4000, 1, 1).select(F.lit("x").alias("text"))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    sized = F.pandas_udf(lambda t: pd.Series([len(t)] * len(t)), "long")
    try:
        for made in (lambda: score_with(docs, "text", lambda t: pd.Series([float(len(t))] * len(t), index=t.index), "n"), lambda: spread(docs).select(sized("text").alias("n"))):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
            assert made().agg(F.max("n")).first()[0] <= 1000
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
