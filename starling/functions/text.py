"""Text and coercion functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DataType


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lower(c: Column | str) -> Column:
    return F.lower(_col(c))


def coalesce(*cols: Column | str) -> Column:
    return F.coalesce(*map(_col, cols))


def try_cast(c: Column | str, to: str | DataType) -> Column:
    """Cast that yields NULL for a value that does not parse (a plain cast fails the job)."""
    return _col(c).try_cast(to)


def as_text(c: Column | str) -> Column:
    return _col(c).cast("string")


def drop_fraction(c: Column | str, rounding: str = "half_up") -> Column:
    """A number as ``decimal(18,0)``, either rounded half up or truncated toward zero."""
    value = _col(c)
    if rounding == "truncate":
        value = F.when(value < 0, F.ceil(value)).otherwise(F.floor(value))
    elif rounding != "half_up":
        raise ValueError(f"unknown rounding {rounding!r}")
    return value.try_cast("decimal(18,0)")
