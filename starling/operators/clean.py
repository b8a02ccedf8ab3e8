"""Projections, filters and coercions: narrow operators that reach the scan as pushed filters."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StringType, StructType

# Columns kept by the preprocessing step (fixed values).
EVENT_FIELDS = [
    "artist", "firstName", "gender", "itemInSession", "lastName", "length", "level", "location",
    "sessionId", "song", "userId",
]
PLAY_PAGE = "NextSong"


def project(df: DataFrame, cols: Iterable[str | Column]) -> DataFrame:
    return df.select(*cols)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def project_positions(df: DataFrame, positions: Mapping[int, str]) -> DataFrame:
    """Pick columns by position and name them."""
    return df.select(*[F.col(df.columns[i]).alias(name) for i, name in positions.items()])


def project_events(df: DataFrame) -> DataFrame:
    """The eleven event columns that the serving tables are built from."""
    return df.select(*EVENT_FIELDS)


def only_plays(df: DataFrame, page_col: str = "page", value: str = PLAY_PAGE) -> DataFrame:
    return df.where(F.col(page_col) == F.lit(value))


def drop_blank(df: DataFrame, col: str) -> DataFrame:
    """Drop rows whose value is empty text or NULL (a CSV reader turns the one into the other)."""
    return df.where(F.col(col).isNotNull() & (F.col(col) != ""))


def not_null_rows(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols]))


def eq(df: DataFrame, col: str, value) -> DataFrame:
    return df.where(F.col(col) == F.lit(value))


def lookup(table: DataFrame, order_by: Iterable[str | Column] = (), **key) -> DataFrame:
    """Point read on a compound key, optionally ordered by the clustering columns."""
    for col, value in key.items():
        table = eq(table, col, value)
    order_by = list(order_by)
    return table.orderBy(*order_by) if order_by else table


def for_date(df: DataFrame, date: dt.date | str, ts_col: str = "start_time") -> DataFrame:
    """Rows of one calendar day (UTC), as a half-open range on the column itself, so that a scan can
    skip other days. The column is a timestamp or holds epoch milliseconds."""
    day = dt.date.fromisoformat(date) if isinstance(date, str) else date
    days = [day, day + dt.timedelta(days=1)]
    if isinstance(df.schema[ts_col].dataType, LongType):
        start, stop = (F.lit((d - dt.date(1970, 1, 1)).days * 86_400_000) for d in days)
    else:
        start, stop = (F.lit(f"{d} 00:00:00").cast("timestamp_ntz") for d in days)
    return df.where((F.col(ts_col) >= start) & (F.col(ts_col) < stop))


def coerce(df: DataFrame, schema: StructType) -> DataFrame:
    """Cast to ``schema`` by column name; values that do not parse become NULL."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name).try_cast(f.dataType) if f.name in present
             else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema
        ]
    )


def parse_text(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast the named columns where they are still text, as in an untyped CSV scan."""
    return df.withColumns(
        {c: F.col(c).try_cast(t) for c, t in types.items()
         if isinstance(df.schema[c].dataType, StringType)}
    )
