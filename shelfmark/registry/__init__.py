"""Named queries over the supplied tables, each with the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from shelfmark.registry.base import ORACLE, QUERIES

MODULES = (
    "analytic",
    "cleaning",
    "validation",
    "privacy",
    "loading",
    "extraction",
    "geocoding",
    "storage",
    "runs",
)


def load() -> tuple[dict[str, Callable[[SparkSession, str], DataFrame]], dict[str, str]]:
    for name in MODULES:
        import_module(f"shelfmark.registry.{name}")
    return dict(QUERIES), dict(ORACLE)
