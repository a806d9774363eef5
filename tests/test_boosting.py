"""Boosting by histograms against a plain version that holds all rows."""

import numpy as np
import pytest

from quantloom.operators.boosting import Booster, Tree, best_splits, boost, gradients, losses


def plain(x, y, valid, loss, trees, depth, rate, n_bins, least, ridge, delta, patience):
    own = ~valid
    edges = [sorted({v for v in np.quantile(c[own & ~np.isnan(c)], [k / n_bins for k in range(1, n_bins)])}) for c in x.T]
    base = y[own].mean()
    if loss == "binary":
        base = np.log(base / (1 - base))
    m = Booster([str(i) for i in range(x.shape[1])], [[float(v) for v in e] for e in edges], loss, float(base), [], {}, [])
    bins = m.bins(list(x.T))
    width = max(map(len, edges)) + 2
    f = np.full(len(y), base)
    curve, made = [losses(loss, y[valid], f[valid], delta).mean()], []
    for _ in range(trees):
        tree, open_, known = Tree(), [0], {}
        g, h = gradients(loss, y, f, delta)
        for level in range(depth + 1):
            node, sums = tree.nodes(bins), {}
            for k in open_:
                at = own & (node == k)
                s = np.zeros((x.shape[1], width, 3))
                for i in range(x.shape[1]):
                    for j, w in enumerate((g, h, np.ones_like(g))):
                        s[i, :, j] = np.bincount(bins[at, i], w[at], width)
                sums[k] = s
                known[k] = -rate * g[at].sum() / (h[at].sum() + ridge)
            splits = best_splits(sums, least, ridge) if level < depth else {}
            for k, (a, b, _g) in splits.items():
                tree.feature[k], tree.cut[k] = a, b
            open_ = [c for k in splits for c in (2 * k + 1, 2 * k + 2)]
            if not open_:
                break
        tree.value = {k: v for k, v in known.items() if k not in tree.feature}
        f = f + tree.predict(bins)
        made.append(tree)
        curve.append(losses(loss, y[valid], f[valid], delta).mean())
        if len(curve) - 1 - int(np.argmin(curve)) >= patience:
            break
    best = int(np.argmin(curve))
    m.trees = made[:best]
    return m, curve, bins


def rows(seed=1, n=900):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, 3))
    x[r.random(n) < 0.1, 1] = np.nan
    y = np.sin(2 * x[:, 0]) + (np.nan_to_num(x[:, 1]) > 0.3) + 0.2 * r.normal(size=n)
    return x, y, r.random(n) < 0.3


@pytest.mark.parametrize("loss", ("squared", "huber", "binary"))
def test_boosting_agrees_with_the_plain_version(spark, loss):
    x, y, valid = rows()
    if loss == "binary":
        y = (y > 0.6).astype(float)
    if loss == "huber":
        y[:5] += 100
    data = [(*[None if np.isnan(v) else float(v) for v in a], float(b), bool(c)) for a, b, c in zip(x, y, valid, strict=True)]
    df = spark.createDataFrame([*data, (1.0, 1.0, 1.0, None, False)], "a double, b double, c double, y double, valid boolean").repartition(3)
    settings = {"trees": 4, "depth": 2, "rate": 0.3, "n_bins": 8, "least": 10, "ridge": 1.0, "delta": 0.5, "patience": 2}
    got = boost(df, ["a", "b", "c"], "y", "valid", loss, **settings)
    want, curve, bins = plain(x, y, valid, loss, **settings)
    assert np.allclose(got.curve, curve) and len(got.trees) == len(want.trees)
    for a, b in zip(got.trees, want.trees, strict=True):
        assert a.feature == b.feature and a.cut == b.cut and np.allclose([a.value[k] for k in sorted(a.value)], [b.value[k] for k in sorted(b.value)])
    assert got.gains["a"] > got.gains["c"] and got.gains["b"] > got.gains["c"]
    f = want.raw(bins)
    f = 1 / (1 + np.exp(-f)) if loss == "binary" else f
    out = got.predict(df.where("y is not null")).select("a", "prediction").collect()
    assert np.allclose(sorted(r.prediction for r in out), sorted(f))


def test_early_stopping_keeps_the_best_trees(spark):
    r = np.random.default_rng(2)
    data = [(float(a), float(b), i % 2 == 0) for i, (a, b) in enumerate(r.normal(size=(200, 2)))]  # nothing to learn
    m = boost(spark.createDataFrame(data, "a double, y double, v boolean"), ["a"], "y", "v", trees=30, depth=2, rate=0.5, n_bins=8, least=5, patience=2)
    assert len(m.curve) < 31 and len(m.trees) == int(np.argmin(m.curve))


def test_no_rows_for_validation_or_none_at_all(spark):
    df = spark.createDataFrame([(float(i), float(i % 2), False) for i in range(60)], "a double, y double, v boolean")
    assert len(boost(df, ["a"], "y", "v", trees=2, depth=1, n_bins=4, least=5).trees) == 2
    empty = boost(df.limit(0), ["a"], "y", "v", trees=2, depth=1, n_bins=4, least=5)
    assert [r.prediction for r in empty.predict(df.limit(1)).collect()] == [0.0]


def test_rows_are_made_once(spark):
    from pyspark.sql import functions as F

    from quantloom.operators.boosting import boost

    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    rows = spark.range(0, 400, 1, 2).mapInArrow(count, "id long").select((F.col("id") % 7).alias("x"), (F.col("id") % 5).alias("y"), (F.col("id") % 4 == 0).alias("v"))
    assert boost(rows, ["x"], "y", "v", trees=2, depth=2).trees is not None
    assert made.value == 400


def test_ranks_of_a_bracket_share_a_sketch(spark, monkeypatch):
    from pyspark.sql import functions as F

    from quantloom.operators import quantiles as Q

    made, plain = [], F.percentile_approx
    monkeypatch.setattr(Q.F, "percentile_approx", lambda c, at, n: made.append(at) or plain(c, at, n))
    df = spark.range(0, 3000, 1, 3).select((F.col("id") * 7919 % 3000).cast("double").alias("a"), F.when(F.col("id") % 2 == 0, F.col("id") % 10).alias("b"))
    got = Q.exact_quantiles(df, ["a", "b"], [k / 32 for k in range(1, 32)], few=20)
    assert got["a"] == pytest.approx([k / 32 * 2999 for k in range(1, 32)])
    values = sorted([0, 2, 4, 6, 8] * 300)
    assert got["b"] == [float(values[int(k / 32 * 1499)] + (values[min(1499, int(k / 32 * 1499) + 1)] - values[int(k / 32 * 1499)]) * (k / 32 * 1499 % 1)) for k in range(1, 32)]
    assert len(made) < 20
