"""Scans, sliding aggregates and timelines against plain versions."""

import numpy as np
import pandas as pd
import pytest

from quantloom.operators import ts
from quantloom.operators.scan import Mean, affine_prefixes, exponential_means
from quantloom.operators.sliding import sliding


def test_affine_prefixes_compose_in_order():
    r = np.random.default_rng(5)
    for n in (0, 1, 63, 64, 65, 5000):
        a, b = r.normal(size=n) * 0.9, r.normal(size=n)
        y, want = 0.7, []
        for p, q in zip(a, b, strict=True):
            y = p * y + q
            want.append(y)
        up, add = affine_prefixes(a.copy(), b.copy())
        assert np.allclose(up * 0.7 + add, want)


@pytest.mark.parametrize("alpha", (0.1, 1 / 3, 1.0))
def test_means_with_gaps_agree_with_pandas_across_batches(alpha):
    r = np.random.default_rng(6)
    for _ in range(40):
        n = int(r.integers(1, 300))
        x, codes = r.normal(size=n), np.sort(r.integers(0, 4, n))
        x[r.random(n) < r.choice([0, 0.4, 0.95])] = np.nan
        want = pd.Series(x).groupby(codes).transform(lambda s: s.ewm(alpha=alpha, adjust=False).mean()).to_numpy()
        first, mean, got, i = np.concatenate([[True], codes[1:] != codes[:-1]]), Mean(alpha), [], 0
        while i < n:
            k = int(r.integers(1, 90))
            got.append(mean.step(x[i : i + k], first[i : i + k]))
            i += k
        assert np.allclose(np.concatenate(got), want, equal_nan=True)


def test_exponential_means_in_spark(spark):
    r = np.random.default_rng(7)
    rows = [(c, d, None if r.random() < 0.2 else float(r.normal())) for c in ("a", None, "b") for d in range(200)]
    df = spark.createDataFrame(rows, "code string, d int, x double").repartition(6)
    out = exponential_means(df, "code", "d", [("f", "x", 0.4), ("s", "x", 0.1), ("g", ("f", "s"), 0.2)]).toPandas().sort_values(["code", "d"])
    for _, part in out.groupby("code", dropna=False):
        f, s = part.x.ewm(alpha=0.4, adjust=False).mean(), part.x.ewm(alpha=0.1, adjust=False).mean()
        assert np.allclose(part.f, f, equal_nan=True) and np.allclose(part.g, (f - s).ewm(alpha=0.2, adjust=False).mean(), equal_nan=True)
    assert exponential_means(df.where("d < 0"), "code", "d", [("f", "x", 0.4)]).collect() == []
    m = ts.macd(df.where("code = 'a'"), "code", "d", "x").toPandas().sort_values("d")
    assert np.allclose(m.dif, m.x.ewm(span=12, adjust=False).mean() - m.x.ewm(span=26, adjust=False).mean(), equal_nan=True)


def test_sliding_agrees_with_pandas(spark):
    r = np.random.default_rng(8)
    rows = [(c, d, None if r.random() < 0.3 else 1e6 + float(r.normal())) for c in "ab" for d in range(70)]
    rows += [("c", 1, 2.0), ("d", 1, None)]
    specs = [(f"{kind}{n}_{least}", "x", kind, n, least) for kind in ("mean", "std", "min", "max") for n, least in ((7, 7), (7, 2), (20, 1), (100, 3))]
    out = sliding(spark.createDataFrame(rows, "code string, d int, x double"), "code", "d", specs).toPandas().sort_values(["code", "d"])
    assert list(out.columns) == ["code", "d", "x", *[s[0] for s in specs]]
    for name, _, kind, n, least in specs:
        want = out.groupby("code").x.transform(lambda s, n=n, least=least, kind=kind: getattr(s.rolling(n, min_periods=least), kind)())
        assert np.allclose(out[name], want, equal_nan=True, rtol=1e-9, atol=1e-6), name


def test_sliding_plan_has_no_wide_frame(spark):
    plan = sliding(spark.createDataFrame([("a", 1, 1.0)], "code string, d int, x double"), "code", "d", [("m", "x", "mean", 250, 250)])._jdf.queryExecution().toString()
    assert "RowFrame, -249, currentrow" not in plan and "unboundedpreceding" in plan


def _open(spans, t):
    return [s for s in spans if s[0] <= t and (s[1] is None or t < s[1])]


def test_timelines_agree_with_brute_force(spark):
    import random

    from pyspark.sql import functions as F

    from quantloom.operators import joins as J

    r = random.Random(9)
    spans = [(k, a, None if r.random() < 0.1 else a + r.randint(-1, 12), r.randint(0, 3), f"n{r.randint(0, 2)}") for k in range(4) for a in [r.randint(0, 40) for _ in range(r.choice((0, 1, 25)))]]
    spans += [(None, 1, 9, 1, "lost"), (1, None, 9, 1, "lost"), *spans[:3]]
    rows = [(k, t) for k in range(6) for t in range(-2, 60)] + [(None, 3), (2, 3)]
    s = spark.createDataFrame(spans, "k int, a int, b int, p int, n string").repartition(5)
    d = spark.createDataFrame(rows, "k int, t int").repartition(3)
    own = lambda k: [x[1:] for x in spans if x[0] == k and k is not None and x[1] is not None]

    got = sorted(map(repr, (tuple(x) for x in J.latest_interval(d, s, "k", "t", "a", "b", ["p", "n"], tie=["p", "n"]).select("k", "t", "p", "n").collect())))
    best = lambda k, t: max(_open(own(k), t), key=lambda x: (x[0], x[2], x[3]), default=None)
    assert got == sorted(repr((k, t, *((None, None) if (b := best(k, t)) is None else b[2:]))) for k, t in rows)

    got = sorted(repr((x.k, x.t, x.f)) for x in J.covered_by_interval(d, s, "k", "t", "a", "b", "f").collect())
    assert got == sorted(repr((k, t, int(any(x[0] <= t and (x[1] is None or t <= x[1]) for x in own(k))))) for k, t in rows)

    due = s.where("b is not null")
    got = sorted(repr((x.k, x.t, x.n)) for x in J.nearest_visible_event(d, due.select("k", F.col("a").alias("seen"), F.col("b").alias("due")), "k", "t", "seen", "due", "n").collect())
    near = lambda k, t: min((x[1] - t for x in own(k) if x[1] is not None and x[0] <= t <= x[1]), default=-1)
    assert got == sorted(repr((k, t, near(k, t))) for k, t in rows)


def test_sweep_keeps_only_open_intervals():
    from quantloom.operators.timeline import Sweep

    sweep, most = Sweep(), 0
    for i in range(5000):
        list(sweep.add(i, i + 3, 5000 - i, (i,)))
        most = max(most, len(sweep.open))
    assert most <= 64 and list(sweep.finish())[-1][1] is None


def test_stretch_and_sorted_codes(spark):
    from datetime import date, timedelta

    from quantloom.operators.numbering import ordinal_codes
    from quantloom.operators.pointintime import stretch

    days = [date(2024, 1, 1) + timedelta(i) for i in range(9)]
    rec = [("a", days[2], 1.0, None), ("a", days[4], None, 7), ("a", days[5], 2.0, 8), ("b", days[8], None, 9)]
    out = stretch(spark.createDataFrame(rec, "c string, d date, v double, once int"), spark.createDataFrame([(d,) for d in days], "d date"), "c", "d", ["v"], ["once"]).orderBy("c", "d").collect()
    assert [r.d for r in out] == days * 2
    assert [r.v for r in out if r.c == "a"] == [None, None, 1.0, 1.0, 1.0, 2.0, 2.0, 2.0, 2.0] and [r.v for r in out if r.c == "b"] == [None] * 9
    assert [r.once for r in out] == [None] * 4 + [7, 8] + [None] * 3 + [None] * 8 + [9]
    words = [f"w{i % 57:02d}é" for i in range(300)] + [None, "", "Z"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    order = {w: i for i, w in enumerate(sorted({w for w in words if w is not None}))}
    assert sorted((r.w or "", r.i) for r in ordinal_codes(df, "w", "i").collect()) == sorted((w or "", order.get(w, -1)) for w in words)


def test_exact_quantiles_agree_with_pandas(spark):
    from pyspark.sql import functions as F

    from quantloom.operators.quantiles import exact_quantiles
    from quantloom.operators.xsec import winsorize
    from quantloom.schema import nan_to_null

    r = np.random.default_rng(11)
    n = 6000
    pdf = pd.DataFrame({"a": r.normal(size=n), "heavy": r.standard_cauchy(n) ** 3, "ties": r.integers(0, 3, n).astype(float), "one": 7.0, "ints": r.integers(-50, 50, n)})
    pdf.loc[r.random(n) < 0.2, "a"] = np.nan
    df = spark.createDataFrame(pdf.astype({"ints": "int64"})).withColumn("none", F.lit(None).cast("double")).repartition(5)
    qs = (0.0, 0.01, 0.25, 0.5, 0.99, 1.0)
    for few in (20, 50_000):  # many rounds of narrowing, or none
        got = exact_quantiles(df, [*pdf.columns, "none"], qs, few)
        assert got.pop("none") == [None] * len(qs)
        for c, found in got.items():
            assert np.allclose(found, pdf[c].quantile(qs), rtol=1e-12, atol=0), (c, few)
    assert exact_quantiles(df.where("ints > 99"), ["a"], (0.5,)) == {"a": [None]}
    out = winsorize(nan_to_null(df.select("a", "one", "none")), ["a", "one", "none"], 0.1, 0.9).toPandas()
    lo, hi = pdf.a.quantile([0.1, 0.9])
    assert np.isclose(out.a.min(), lo) and np.isclose(out.a.max(), hi) and (out.one == 7).all() and out.a.isna().sum() == pdf.a.isna().sum()


def test_co_moments_agree_with_pandas_pair_by_pair(spark):
    from quantloom.operators.comoments import co_moments

    r = np.random.default_rng(12)
    n = 3000
    a = r.normal(size=n)
    pdf = pd.DataFrame({"a": a + 1e7, "b": 2 * a + r.normal(size=n), "c": r.integers(0, 5, n).astype(float), "one": 3.0, "gap": r.normal(size=n)})
    pdf.loc[r.random(n) < 0.3, "gap"] = np.nan
    pdf.loc[r.random(n) < 0.5, "b"] = np.nan
    pdf.loc[0, "c"] = np.inf
    out = co_moments(spark.createDataFrame(pdf).repartition(4), list(pdf.columns)).collect()
    clean = pdf.replace(np.inf, np.nan)
    assert len(out) == 10
    for x in out:
        both = clean[[x.a, x.b]].dropna()
        assert x.n == len(both) and np.isclose(x.mean_a, both[x.a].mean()) and np.isclose(x["cov"], both[x.a].cov(both[x.b]), atol=1e-9)
        want = both[x.a].corr(both[x.b]) if "one" not in (x.a, x.b) else None
        assert (x.corr is None) if want is None else np.isclose(x.corr, want, atol=1e-9)
    assert all(x.n == 0 and x.corr is None for x in co_moments(spark.createDataFrame(pdf).where("one > 5"), ["a", "b"]).collect())
