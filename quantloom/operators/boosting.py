"""Gradient boosting of regression trees by histograms, with losses, early stopping and gains.

Features are cut once into bins at exact quantiles.  A level of a tree is one aggregate: each
task sums gradients by (node, feature, bin) and sends that many numbers, whatever its rows;
the best splits are chosen from the sums.  Predictions are written after each tree, so the
work of a tree does not grow with the trees before it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quantloom.operators.quantiles import exact_quantiles
from quantloom.sources import scratch_path


def gradients(loss: str, y: np.ndarray, f: np.ndarray, delta: float) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives of the loss: squared, huber (of width ``delta``) or binary (log-likelihood of 0 and 1)."""
    if loss == "squared":
        return f - y, np.ones_like(y)
    if loss == "huber":
        return np.clip(f - y, -delta, delta), np.ones_like(y)
    if loss == "binary":
        p = 1 / (1 + np.exp(-np.clip(f, -40, 40)))
        return p - y, p * (1 - p)
    raise ValueError(f"no such loss: {loss}")


def losses(loss: str, y: np.ndarray, f: np.ndarray, delta: float) -> np.ndarray:
    if loss == "squared":
        return (f - y) ** 2
    if loss == "huber":
        a = np.abs(f - y)
        return np.where(a <= delta, a * a / 2, delta * (a - delta / 2))
    return np.logaddexp(0, f) - y * f


@dataclass
class Tree:
    """Node k has children 2k+1 and 2k+2; an inner node sends bins up to ``cut`` of its feature to the left."""

    feature: dict[int, int] = field(default_factory=dict)
    cut: dict[int, int] = field(default_factory=dict)
    value: dict[int, float] = field(default_factory=dict)

    def nodes(self, bins: np.ndarray) -> np.ndarray:
        node = np.zeros(len(bins), np.int64)
        for k in sorted(self.feature):  # parents come first
            at = node == k
            node[at] = np.where(bins[at, self.feature[k]] <= self.cut[k], 2 * k + 1, 2 * k + 2)
        return node

    def predict(self, bins: np.ndarray) -> np.ndarray:
        nodes, out = self.nodes(bins), np.zeros(len(bins))
        for k, v in self.value.items():
            out[nodes == k] = v
        return out


def best_splits(sums: dict[int, np.ndarray], least: int, ridge: float) -> dict[int, tuple[int, int, float]]:
    """For each node with a gain its best (feature, last bin of the left, gain); ``sums`` has (feature, bin, [gradient, curvature, rows]).

    Of equal gains the first feature and bin count.
    """
    out = {}
    for node, s in sums.items():
        left = s.cumsum(1)
        total = left[:, -1:, :]
        right = total - left
        score = lambda x: x[..., 0] ** 2 / (x[..., 1] + ridge)
        gain = score(left) + score(right) - score(total)
        gain[(left[..., 2] < least) | (right[..., 2] < least)] = -np.inf
        k = int(gain.argmax())
        f, b = divmod(k, s.shape[1])
        if gain[f, b] > 1e-12:
            out[node] = f, b, float(gain[f, b])
    return out


@dataclass
class Booster:
    features: list[str]
    edges: list[list[float]]
    loss: str
    base: float
    trees: list[Tree]
    gains: dict[str, float]
    #: Mean loss on the rows for validation after 0, 1, ... trees; the model keeps the trees of the best.
    curve: list[float]

    def bins(self, columns: Sequence[np.ndarray]) -> np.ndarray:
        """Bins of feature values; a missing one has the last bin of its own."""
        out = []
        for x, e in zip(columns, self.edges, strict=True):
            b = np.searchsorted(np.array(e), x, "left")
            out.append(np.where(np.isnan(x), len(e) + 1, b))
        return np.column_stack(out).astype(np.int64) if out else np.zeros((0, 0), np.int64)

    def raw(self, bins: np.ndarray) -> np.ndarray:
        out = np.full(len(bins), self.base)
        for t in self.trees:
            out += t.predict(bins)
        return out

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """``df`` with predictions: probabilities for the binary loss."""
        model, names = self, self.features

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                f = model.raw(model.bins([batch.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in names]))
                y = 1 / (1 + np.exp(-f)) if model.loss == "binary" else f
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(y)], names=[*batch.schema.names, out])

        return df.mapInArrow(work, df.withColumn(out, F.lit(0.0)).schema)


def _columns(batch: pa.RecordBatch, names: Sequence[str]) -> list[np.ndarray]:
    return [batch.column(c).to_numpy(zero_copy_only=False) for c in names]


def boost(
    df: DataFrame, features: Sequence[str], label: str, valid: str, loss: str = "squared", trees: int = 50, depth: int = 3, rate: float = 0.1, n_bins: int = 32, least: int = 20, ridge: float = 1.0, delta: float = 1.0, patience: int = 10
) -> Booster:
    """Fits on the rows of ``df`` where the boolean column ``valid`` is false; trees end when the loss on the others has not fallen for ``patience`` trees.

    Rows without a label or ``valid`` are left out; missing feature values have a bin of their own.  Without rows for
    validation all trees are kept.
    """
    spark, features = df.sparkSession, list(features)
    p = len(features)
    rows = df.where(F.col(label).isNotNull() & F.col(valid).isNotNull()).select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)], F.col(label).cast("double").alias("y"), F.col(valid).alias("valid"))
    made = rows
    path = scratch_path(spark, "boosting")
    made.write.parquet(path)  # what makes the rows runs once, not once a pass
    rows = spark.read.schema(made.schema).parquet(path)
    own = rows.where(~F.col("valid"))
    cuts = exact_quantiles(own, [f"x{i}" for i in range(p)], [k / n_bins for k in range(1, n_bins)])
    edges = [sorted({v for v in cuts[f"x{i}"] if v is not None}) for i in range(p)]
    width = max(map(len, edges), default=0) + 2
    mean = own.agg(F.avg("y")).first()[0]
    base = 0.0 if mean is None else float(mean)
    if loss == "binary":
        base = float(np.log(np.clip(base, 1e-6, 1 - 1e-6) / (1 - np.clip(base, 1e-6, 1 - 1e-6))))
    model = Booster(features, edges, loss, base, [], dict.fromkeys(features, 0.0), [])
    names = [f"b{i}" for i in range(p)]
    state_schema = ", ".join([*[f"b{i} int" for i in range(p)], "y double", "valid boolean", "f double"])

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            b = model.bins([c.astype(float) for c in _columns(batch, [f"x{i}" for i in range(p)])])
            yield pa.RecordBatch.from_arrays([*[pa.array(b[:, i].astype(np.int32)) for i in range(p)], batch.column("y"), batch.column("valid"), pa.array(np.full(len(b), base))], names=[*names, "y", "valid", "f"])

    def written(made: DataFrame) -> DataFrame:
        path = scratch_path(spark, "boosting")
        made.write.parquet(path)
        return spark.read.schema(made.schema).parquet(path)

    def histogram(tree: Tree, open_: list[int]):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            place = {k: i for i, k in enumerate(open_)}
            sums = np.zeros((len(open_) * p * width, 3))
            for batch in batches:
                mine = ~batch.column("valid").to_numpy(zero_copy_only=False).astype(bool)
                bins = np.column_stack(_columns(batch, names))[mine]
                y, f = (c[mine] for c in _columns(batch, ["y", "f"]))
                g, h = gradients(loss, y, f, delta)
                nodes = tree.nodes(bins)
                at = np.full(len(nodes), -1, np.int64)
                for k, i in place.items():
                    at[nodes == k] = i
                for i in range(p):
                    ok = at >= 0
                    cell = (at[ok] * p + i) * width + bins[ok, i]
                    for j, w in enumerate((g, h, np.ones_like(g))):
                        sums[:, j] += np.bincount(cell, w[ok], len(sums))
            used = np.flatnonzero(sums[:, 2])
            yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int64)), *[pa.array(sums[used, j]) for j in range(3)]], names=["cell", "g", "h", "n"])

        return work

    def moved(tree: Tree):
        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                f = batch.column("f").to_numpy(zero_copy_only=False) + tree.predict(np.column_stack(_columns(batch, names)))
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in (*names, "y", "valid")], pa.array(f)], names=[*names, "y", "valid", "f"])

        return work

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = 0.0, 0
        for batch in batches:
            at = batch.column("valid").to_numpy(zero_copy_only=False).astype(bool)
            y, f = (c[at] for c in _columns(batch, ["y", "f"]))
            total, n = total + float(losses(loss, y, f, delta).sum()), n + len(y)
        yield pa.RecordBatch.from_arrays([pa.array([total]), pa.array([n], pa.int64())], names=["loss", "n"])

    def judge(state: DataFrame) -> float | None:
        r = state.mapInArrow(judged, "loss double, n long").agg(F.sum("loss"), F.sum("n")).first()
        return None if not r[1] else r[0] / r[1]

    state = written(rows.mapInArrow(binned, state_schema))
    model.curve.append(judge(state))
    gains: list[dict[int, float]] = []
    for _ in range(trees):
        tree, open_, gained, known = Tree(), [0], {i: 0.0 for i in range(p)}, {}
        for level in range(depth + 1):
            sums = {k: np.zeros((p, width, 3)) for k in open_}
            for r in state.mapInArrow(histogram(tree, open_), "cell long, g double, h double, n double").groupBy("cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n")).collect():  # nodes x features x bins
                node, rest = divmod(r.cell, p * width)
                sums[open_[node]][rest // width, rest % width] = r.g, r.h, r.n
            for k, s in sums.items():
                g, h, _n = s[0].sum(0)
                known[k] = -rate * g / (h + ridge)
            splits = best_splits(sums, least, ridge) if level < depth else {}
            for k, (f, b, gain) in splits.items():
                tree.feature[k], tree.cut[k] = f, b
                gained[f] += gain
            open_ = [c for k in splits for c in (2 * k + 1, 2 * k + 2)]
            if not open_:
                break
        tree.value = {k: v for k, v in known.items() if k not in tree.feature}
        state = written(state.mapInArrow(moved(tree), state_schema))
        model.trees.append(tree)
        gains.append(gained)
        model.curve.append(judge(state))
        best = min(range(len(model.curve)), key=lambda i: (model.curve[i] if model.curve[i] is not None else 0.0, i))
        if model.curve[-1] is not None and len(model.curve) - 1 - best >= patience:
            break
    if model.curve[0] is not None:
        best = min(range(len(model.curve)), key=lambda i: (model.curve[i], i))
        model.trees, gains = model.trees[:best], gains[:best]
    for g in gains:
        for i, x in g.items():
            model.gains[features[i]] += x
    return model
