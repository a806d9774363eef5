"""Registered plans: each applies an operator to the driver's tables and has an SQL twin."""

from __future__ import annotations

from importlib import import_module

from quantloom.plans.base import ORACLES, QUERIES

_FAMILIES = ("scans", "predicates", "joins", "aggregates", "windows", "scalars", "detail", "labels", "texts", "checks", "streams")


def _load() -> None:
    for name in _FAMILIES:
        import_module(f"quantloom.plans.{name}")


def queries() -> dict:
    _load()
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    _load()
    return dict(ORACLES)


def flagship(spark, sf_dir):
    """Price panel with moving average, momentum, volatility and the five-day forward return."""
    _load()
    return QUERIES["d01_price_features"](spark, sf_dir)
