"""Schema-driven helpers; none of them runs a job."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_FLOATS = (T.FloatType, T.DoubleType)


def existing(df: DataFrame, columns: Iterable[str]) -> list[str]:
    """The declared columns that are there, in the declared order."""
    have = set(df.columns)
    return [c for c in columns if c in have]


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    out = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in out]


def select_existing(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.select(*existing(df, columns))


def rename_existing(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed({a: b for a, b in names.items() if a in df.columns})


def drop_matching(df: DataFrame, patterns: Iterable[str], protected: Iterable[str] = ()) -> DataFrame:
    """Without the columns whose names contain a pattern, but for the protected ones."""
    patterns, protected = list(patterns), set(protected)
    return df.drop(*[c for c in df.columns if c not in protected and any(p in c for p in patterns)])


def nan_to_null(df: DataFrame) -> DataFrame:
    return df.withColumns({f.name: F.nanvl(f.name, F.lit(None).cast(f.dataType)) for f in df.schema if isinstance(f.dataType, _FLOATS)} or {})


def inf_to_null(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Without infinities and NaN in the float columns."""
    chosen = set(columns) if columns is not None else {f.name for f in df.schema if isinstance(f.dataType, _FLOATS)}
    inf = F.lit(float("inf"))
    return df.withColumns({c: F.when((F.abs(c) < inf), F.col(c)) for c in df.columns if c in chosen})


def floats_to_single(df: DataFrame) -> DataFrame:
    return df.withColumns({f.name: F.col(f.name).cast("float") for f in df.schema if isinstance(f.dataType, T.DoubleType)})


def fill_numeric(df: DataFrame, value: float = 0, exclude: Iterable[str] = ()) -> DataFrame:
    return df.na.fill(value, numeric_columns(df, exclude))


def constant_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Numeric columns without two different values: one aggregate job, a list on the driver."""
    columns = numeric_columns(df, exclude)
    if not columns:
        return []
    row = df.agg(*[F.stddev_samp(c).alias(c) for c in columns]).first()
    return [c for c in columns if row[c] is None or row[c] == 0]
