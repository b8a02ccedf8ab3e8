"""Duplicate removal."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F

_RANK = "__starling_rank"


def distinct(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Whole-row DISTINCT over ``cols``; a hash aggregate that combines before the shuffle."""
    return (df.select(*cols) if cols is not None else df).distinct()


def dedup(
    df: DataFrame, keys: Iterable[str], order_by: Iterable[str | Column], keep: str = "first"
) -> DataFrame:
    """One row per key: the first (or last) in ``order_by``, which should be a total order.

    ``row_number() = 1`` is planned with a group limit on both sides of the shuffle, so at most one
    row per key leaves each map task and a key that fills a third of the input stays cheap.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    if keep == "last":
        order = [c.desc() for c in order]
    elif keep != "first":
        raise ValueError(f"keep must be 'first' or 'last', not {keep!r}")
    by_key = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(by_key)).where(F.col(_RANK) == 1).drop(_RANK)
