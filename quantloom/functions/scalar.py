"""Scalar transforms of numbers, dates and codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def signed_log(c: Column, eps: float = 1e-8) -> Column:
    """sign(x) ln(|x| + eps); null counts as zero."""
    x = F.coalesce(c, F.lit(0.0))
    return F.signum(x) * F.log(F.abs(x) + eps)


def signed_log1p(c: Column) -> Column:
    return F.signum(c) * F.log1p(F.abs(c))


def positive_log1p(c: Column) -> Column:
    return F.when(c.isNotNull(), F.log1p(F.greatest(c, F.lit(0.0))))


def signed_inverse(c: Column, eps: float = 1e-8) -> Column:
    """sign(x) / max(|x|, eps); null stays null, zero gives zero."""
    return F.when(c.isNotNull(), F.signum(c) / F.greatest(F.abs(c), F.lit(eps)))


def safe_ratio(a: Column, b: Column, eps: float = 1e-10) -> Column:
    return F.try_divide(a, b + eps)


def parse_day(c: Column) -> Column:
    """A day from ``yyyyMMdd`` or ``yyyy-MM-dd``; else null."""
    return F.coalesce(F.try_to_date(c, "yyyyMMdd"), F.try_to_date(c, "yyyy-MM-dd"))


def quarter_code(day: Column) -> Column:
    """1 to 4 for days in a quarter's last month, else 0."""
    m = F.month(day)
    return F.when(m.isin(3, 6, 9, 12), (m / 3).cast("int")).otherwise(0)


def quarter_publication(year: Column, quarter: Column) -> Column:
    """Day by which a quarter's figures are out."""
    return F.when(quarter == 1, F.make_date(year, F.lit(4), F.lit(30))).when(quarter == 2, F.make_date(year, F.lit(7), F.lit(31))).when(quarter == 3, F.make_date(year, F.lit(10), F.lit(31))).when(quarter == 4, F.make_date(year + 1, F.lit(1), F.lit(31)))


def month_publication(month_start: Column, day: int) -> Column:
    """The given day of the month after."""
    return F.date_add(F.add_months(month_start, 1), day - 1)


def exchange_suffix(code: Column) -> Column:
    """Code of six digits with the suffix of its exchange."""
    c = F.lpad(code, 6, "0")
    first = F.substring(c, 1, 1)
    return F.concat(c, F.when(first.isin("6", "9"), ".SH").when(first.isin("4", "8"), ".BJ").otherwise(".SZ"))


def value_map(c: Column, pairs: dict[str, int], default: int = -1) -> Column:
    lookup = F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])
    return F.coalesce(F.try_element_at(lookup, c), F.lit(default))


def digest_id(*parts: Column, length: int | None = None) -> Column:
    """MD5 of the parts joined by ``_``, or its first ``length`` digits."""
    h = F.md5(F.concat_ws("_", *parts))
    return h if length is None else F.substring(h, 1, length)
