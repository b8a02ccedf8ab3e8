"""Rows told apart by what they hold and by their place among equal rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..functions import hash_key

# Time, digest and number of a row among its equals.
AT, EVENT, COPY = "__at", "__event", "__copy"
MARKS = (AT, EVENT, COPY)
_BLOCK = 1024


def told_apart(rows: DataFrame, at: str, columns: list[str]) -> DataFrame:
    """The rows with their time and with a digest of 128 bits of what they hold in ``columns``.

    Rows that a comparison takes for equal, two NULLs or the two zeros included, have equal digests.
    """
    def same(name: str) -> Column:
        # Adding zero makes the two zeros one.
        kind = rows.schema[name].dataType
        value = F.col(f"`{name}`")
        return value + F.lit(0.0).cast(kind) if isinstance(kind, (DoubleType, FloatType)) else value

    return rows.withColumns({
        AT: F.coalesce(F.col(f"`{at}`").cast("bigint"), F.lit(0)),
        EVENT: F.unhex(hash_key(*[same(c) for c in columns])),
    })


def copies_of(
    rows: DataFrame, at: str, file: str, place: str | None = None,
    kept: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Each row as often as in the ``file`` that holds it most often, with ``MARKS`` and without ``file``.

    Equal rows are counted before they move and numbered after, in blocks that are dealt among tasks,
    so one row with a large share of a file meets no window and no long array. NULLs are equal to
    each other. Columns must be of types that can be grouped by (no maps). Rows that bring time and
    digest need no other columns. Of the column ``place`` equal rows get the smallest value. ``kept``
    may store the counts, one row for all equal ones, and return them.
    """
    columns = [c for c in rows.columns if c not in (file, place)]
    quoted = [F.col(f"`{c}`") for c in columns]
    first_place = [F.min(place).alias(place)] if place else []
    counted = (
        rows.groupBy(file, *quoted).agg(F.count(F.lit(1)).alias("__n"), *first_place)
        .groupBy(*quoted).agg(F.max("__n").alias("__n"), *first_place)
    )
    counted = kept(counted) if kept else counted
    marked = counted if EVENT in columns else told_apart(counted, at, columns)
    last = F.expr(f"(__n - 1) div {_BLOCK}")
    first = F.col("__block") * _BLOCK
    numbers = F.sequence(first, F.least(first + _BLOCK, F.col("__n")) - 1)
    alone = marked.withColumn("__block", F.lit(0).cast("bigint"))
    # Nothing but a row that repeats very often has a second block.
    later = F.explode(F.sequence(F.lit(1).cast("bigint"), last))
    dealt = marked.where(f"__n > {_BLOCK}").withColumn("__block", later).repartition(EVENT, "__block")
    return (
        alone.unionByName(dealt).withColumn(COPY, F.explode(numbers)).drop("__n", "__block")
    )
