"""Sliding aggregates whose time does not grow with the width of the frame.

A frame of n rows that ends at row i lies in at most two blocks of n rows: it is the end of
the one before (a suffix, known at the frame's first row) and the start of its own (a
prefix, known at row i).  Prefixes and suffixes are running windows, so a row costs the same
for 20 rows as for 250; nothing is subtracted, so nothing cancels.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: (output, column, kind of MEAN, STD, MIN, MAX, rows of the frame, least number of values)
Spec = tuple[str, str, str, int, int]

_PARTS = {"mean": ("n", "mean"), "std": ("n", "mean", "var"), "min": ("n", "lo"), "max": ("n", "hi")}
_AGG = {"n": F.count, "mean": F.avg, "var": F.var_pop, "lo": F.min, "hi": F.max}


def _merge(kind: str, p: dict[str, Column], s: dict[str, Column], least: int) -> Column:
    """Prefix and suffix as one; a null suffix counts as none."""
    a, b = p["n"], F.coalesce(s["n"], F.lit(0))
    n = a + b
    if kind == "min":
        out = F.least(p["lo"], s["lo"])
    elif kind == "max":
        out = F.greatest(p["hi"], s["hi"])
    else:
        mean = lambda x: F.coalesce(x, F.lit(0.0))
        if kind == "mean":
            out = F.try_divide(mean(p["mean"]) * a + mean(s["mean"]) * b, n)
        else:
            gap = F.when((a > 0) & (b > 0), p["mean"] - s["mean"]).otherwise(0.0)
            squares = mean(p["var"]) * a + mean(s["var"]) * b + F.coalesce(F.try_divide(gap * gap * a * b, n), F.lit(0.0))
            out = F.sqrt(F.try_divide(squares, n - 1))
    return F.when(n >= max(least, 2 if kind == "std" else 1), out)


def sliding(df: DataFrame, code: str, day: str, specs: Sequence[Spec]) -> DataFrame:
    """Adds aggregates of the last n rows of a code: mean, sample deviation, least or greatest value, null below ``least`` values.

    One shuffle by code; each width sorts its blocks forwards and backwards.
    """
    w = Window.partitionBy(code).orderBy(day)
    out = df.withColumn("_rn", F.row_number().over(w) - 1)
    helpers, wanted = ["_rn"], []
    for n in sorted({s[3] for s in specs}):
        block = f"_b{n}"
        out = out.withColumn(block, F.floor(F.col("_rn") / n))
        helpers.append(block)
        parts = dict.fromkeys((c, part) for _, c, kind, m, _ in specs if m == n for part in _PARTS[kind])
        for way, order in (("p", F.col(day).asc()), ("s", F.col(day).desc())):
            frame = Window.partitionBy(code, block).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
            out = out.withColumns({f"_{way}{n}_{c}_{part}": _AGG[part](c).over(frame) for c, part in parts})
        out = out.withColumns({f"_l{n}_{c}_{part}": F.when((F.col("_rn") + 1) % n != 0, F.lag(f"_s{n}_{c}_{part}", n - 1).over(w)) for c, part in parts})
        helpers += [f"_{way}{n}_{c}_{part}" for way in "psl" for c, part in parts]
        wanted += [(name, _merge(kind, {q: F.col(f"_p{n}_{c}_{q}") for q in _PARTS[kind]}, {q: F.col(f"_l{n}_{c}_{q}") for q in _PARTS[kind]}, least)) for name, c, kind, m, least in specs if m == n]
    found = dict(wanted)
    return out.withColumns({s[0]: found[s[0]] for s in specs}).drop(*helpers)
