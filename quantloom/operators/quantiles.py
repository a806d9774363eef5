"""Exact quantiles of many columns by distributed selection: no task sorts or holds a column.

A quantile is one or two order statistics.  A sketch of the column brackets each of them;
the rows below and inside the bracket are counted, which proves that the wanted rank lies in
it, and the bracket is narrowed until it holds few rows; those are sorted.  Every pass is one
aggregate for all columns and quantiles, of fixed size whatever the rows are.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a bracket that are sorted in one place at most.
FEW = 50_000
#: Accuracy of the sketches: a rank is off by at most a row in so many.
ACCURACY = 10_000


@dataclass
class _Target:
    """The ``rank``-th smallest value (from 0) of a column lies in [lo, hi], with ``below`` rows less than lo and ``inside`` in it."""

    column: str
    rank: int
    lo: float
    hi: float
    below: int
    inside: int


def _value(c: str) -> Column:
    """A column as double; NaN counts as missing."""
    return F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))


def _within(t: _Target) -> Column:
    return F.when(_value(t.column).between(t.lo, t.hi), _value(t.column))


def _narrowed(df: DataFrame, targets: Sequence[_Target]) -> None:
    """Brackets the ranks anew within their brackets; one pass for the sketches, one for the counts.

    Ranks that share a bracket share its sketch: a row meets one sketch a column at first, however many ranks are wanted.
    """
    shared: dict[tuple, list[int]] = {}
    for i, t in enumerate(targets):
        shared.setdefault((t.column, t.lo, t.hi), []).append(i)
    cuts = []
    for k, mine in enumerate(shared.values()):
        at = []
        for t in (targets[i] for i in mine):
            place, slack = (t.rank - t.below) / max(1, t.inside - 1), 2 / ACCURACY
            at += [max(0.0, place - slack), min(1.0, place + slack)]
        cuts.append(F.percentile_approx(_within(targets[mine[0]]), at, ACCURACY).alias(f"s{k}"))
    sketched = df.agg(*cuts).first()
    row = {f"t{i}": sketched[f"s{k}"][2 * n : 2 * n + 2] for k, mine in enumerate(shared.values()) for n, i in enumerate(mine)}
    counts = []
    for i, t in enumerate(targets):
        lo, hi = row[f"t{i}"]
        inner = _within(t)
        counts += [F.count_if(inner < lo).alias(f"b{i}"), F.count_if(inner.between(lo, hi)).alias(f"n{i}")]
    found = df.agg(*counts).first()
    for i, t in enumerate(targets):
        (lo, hi), under, n = row[f"t{i}"], found[f"b{i}"], found[f"n{i}"]
        rank = t.rank - t.below
        if rank < under:
            hi, n, under = math.nextafter(lo, -math.inf), under, 0
            lo = t.lo
        elif rank >= under + n:
            under, n = under + n, t.inside - under - n
            lo, hi = math.nextafter(hi, math.inf), t.hi
        t.lo, t.hi, t.below, t.inside = lo, hi, t.below + under, n


def order_statistics(df: DataFrame, wanted: Iterable[tuple[str, int]], known: dict[str, tuple[int, float, float]], few: int = FEW) -> dict[tuple[str, int], float]:
    """Values of (column, rank from 0); ``known`` has the number of values of each column, the least and the greatest."""
    targets = [_Target(c, k, known[c][1], known[c][2], 0, known[c][0]) for c, k in dict.fromkeys(wanted)]
    while wide := [t for t in targets if t.inside > few and t.lo < t.hi]:
        _narrowed(df, wide)
    out = {(t.column, t.rank): t.lo for t in targets if t.lo == t.hi}
    rest = [t for t in targets if t.lo < t.hi]
    if rest:
        columns = list(dict.fromkeys(t.column for t in rest))
        near = [reduce(or_, (_value(c).between(lo, hi) for lo, hi in dict.fromkeys((t.lo, t.hi) for t in rest if t.column == c))) for c in columns]
        lists = df.agg(*[F.sort_array(F.collect_list(F.when(n, _value(c)))).alias(f"l{k}") for k, (c, n) in enumerate(zip(columns, near, strict=True))])
        own = lambda t: F.filter(f"l{columns.index(t.column)}", lambda v: v.between(t.lo, t.hi))
        row = lists.select(*[F.get(own(t), F.lit(t.rank - t.below)).alias(f"v{i}") for i, t in enumerate(rest)]).first()
        out |= {(t.column, t.rank): row[f"v{i}"] for i, t in enumerate(rest)}
    return out


def exact_quantiles(df: DataFrame, columns: Sequence[str], qs: Sequence[float], few: int = FEW) -> dict[str, list[float | None]]:
    """For each column its quantiles, linear between order statistics; None where a column has no value.

    Runs a few aggregate jobs; the driver gets some numbers for each column and quantile.
    """
    columns = list(columns)
    ends = df.agg(*[e for i, c in enumerate(columns) for e in (F.count(_value(c)).alias(f"n{i}"), F.min(_value(c)).alias(f"a{i}"), F.max(_value(c)).alias(f"z{i}"))]).first()
    known = {c: (ends[f"n{i}"], ends[f"a{i}"], ends[f"z{i}"]) for i, c in enumerate(columns)}
    places = {(c, q): q * (known[c][0] - 1) for c in columns if known[c][0] for q in qs}
    wanted = [(c, k) for (c, _), p in places.items() for k in (math.floor(p), math.ceil(p))]
    stats = order_statistics(df, wanted, known, few) if wanted else {}

    def at(c: str, q: float) -> float | None:
        if (c, q) not in places:
            return None
        p = places[c, q]
        lo, hi = stats[c, math.floor(p)], stats[c, math.ceil(p)]
        return lo if lo == hi else lo + (hi - lo) * (p - math.floor(p))

    return {c: [at(c, q) for q in qs] for c in columns}
