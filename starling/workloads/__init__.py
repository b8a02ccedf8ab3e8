"""The library's operators applied to the driver tables, each next to the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_MODULES = ["reports", "columns", "matching", "rows", "star", "serving", "loads", "files", "checks", "whole_jobs", "standing"]


def registered() -> dict[str, tuple[Query, str | None]]:
    """Query and SQL (None where SQL cannot express it) by name."""
    found: dict[str, tuple[Query, str | None]] = {}
    for module in _MODULES:
        found.update(import_module(f"{__name__}.{module}").QUERIES)
    return found
