"""Surrogate keys."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import hash_key
from ..session import scratch_path, scratch_scope

_SLICE, _POSITION, _ROWS, _OFFSET, _FILE, _ROW = (
    f"__starling_{n}" for n in ("slice", "pos", "rows", "offset", "file", "row")
)
# monotonically_increasing_id() keeps the row's position in its partition in the low 33 bits.
_POSITION_BITS = 33


def surrogate_key(
    df: DataFrame,
    order_by: Iterable[str | Column] | None = None,
    name: str = "id",
    dense: bool = True,
    start: int = 1,
) -> DataFrame:
    """Number the rows ``start, start + 1, ...``, or hash ``order_by`` if not ``dense``.

    A dense number is the row's position in its task's slice plus the sizes of the slices before.
    The rows are written once to the shared scratch folder with slice and position, so that the
    numbers stay the same however often the result is evaluated; only the slice sizes, one row per
    task, meet in one place. Without ``order_by`` rows keep their tasks, as is enough for an id.
    With it they are range-sorted first, which takes a written copy to draw the range boundaries
    from. Ties go by the place in that copy, so that any number of equal rows spreads over slices.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order_by or ()]
    if not dense:
        return df.select(hash_key(*order).alias(name), "*")

    spark, columns = df.sparkSession, df.columns
    path = scratch_path(spark, "numbered")
    if order:
        with scratch_scope(spark):
            unsorted = scratch_path(spark, "unsorted")
            df.write.parquet(unsorted)
            copy = spark.read.parquet(unsorted)
            place = [F.xxhash64("_metadata.file_name"), F.col("_metadata.row_index")]
            placed = copy.withColumns(dict(zip([_FILE, _ROW], place)))
            _write_positions(placed.orderBy(*order, _FILE, _ROW).select(*columns), path)
    else:
        _write_positions(df, path)
    rows = spark.read.parquet(path)
    sizes = rows.groupBy(_SLICE).agg(F.count(F.lit(1)).alias(_ROWS))
    before = Window.partitionBy(F.lit(0)).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col(_SLICE), F.coalesce(F.sum(_ROWS).over(before), F.lit(0)).alias(_OFFSET)
    )
    # Bounded by the number of tasks that wrote the rows: one row of two numbers for each.
    numbered = rows.join(F.broadcast(offsets), _SLICE)
    return numbered.select(
        (F.col(_OFFSET) + F.col(_POSITION) + F.lit(start)).alias(name), *columns
    )


def _write_positions(df: DataFrame, path: str) -> None:
    (
        df.withColumn(_POSITION, F.monotonically_increasing_id())
        .withColumn(_SLICE, F.shiftright(F.col(_POSITION), _POSITION_BITS))
        .withColumn(_POSITION, F.col(_POSITION).bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)))
        .write.parquet(path)
    )
