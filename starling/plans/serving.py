"""Serving tables: one table per question, keyed for its lookup. The last write per key wins."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators import dedup, drop_blank, parse_text, project_events
from ..sinks import layout, write_table
from ..sources import read_csv_dir, read_table

_SESSION_ORDER = ["sessionId", "itemInSession", "artist", "song", "length", "firstName", "lastName"]


def preprocess_events(events: DataFrame) -> DataFrame:
    """The eleven columns the serving tables need, of events that name an artist."""
    return project_events(drop_blank(events, "artist"))


def _typed(events: DataFrame) -> DataFrame:
    """The same events, typed, with whatever column the order of writes goes by."""
    return parse_text(
        drop_blank(events, "artist"),
        {"sessionId": "int", "itemInSession": "int", "userId": "int", "length": "double"},
    )


def _last_write(
    events: DataFrame, key: list[str], columns: dict[str, str], order_by: Iterable[str | Column]
) -> DataFrame:
    last = dedup(_typed(events), key, order_by, keep="last")
    return last.select(*[F.col(source).alias(name) for name, source in columns.items()])


def build_song_session_history(
    events: DataFrame, order_by: Iterable[str | Column] = _SESSION_ORDER
) -> DataFrame:
    """What was played at each position of each session."""
    return _last_write(
        events, ["sessionId", "itemInSession"],
        {"session_id": "sessionId", "item_in_session": "itemInSession", "artist": "artist",
         "song": "song", "length": "length"},
        order_by,
    )


def build_user_artist_history(
    events: DataFrame, order_by: Iterable[str | Column] = _SESSION_ORDER
) -> DataFrame:
    """What each user played, by session and position."""
    return _last_write(
        events, ["userId", "sessionId", "itemInSession"],
        {"user_id": "userId", "session_id": "sessionId", "item_in_session": "itemInSession",
         "artist": "artist", "song": "song", "first_name": "firstName", "last_name": "lastName"},
        order_by,
    )


def build_user_song_history(
    events: DataFrame, order_by: Iterable[str | Column] = _SESSION_ORDER
) -> DataFrame:
    """Who played each song."""
    return _last_write(
        events, ["song", "userId"],
        {"song": "song", "user_id": "userId", "first_name": "firstName", "last_name": "lastName"},
        order_by,
    )


# Distribution key and clustering key of each serving table (fixed by the questions they answer).
SERVING_LAYOUT = {
    "song_session_history": (["session_id"], ["session_id", "item_in_session"]),
    "user_artist_history": (["user_id", "session_id"], ["user_id", "session_id", "item_in_session"]),
    "user_song_history": (["song"], ["song", "user_id"]),
}


def save_serving(
    df: DataFrame, table: str, name: str | None = None, buckets: int = 64,
    files_per_bucket: int | None = None, location: str | None = None,
) -> DataFrame:
    """Save a serving table bucketed on its lookup key and sorted on its clustering key."""
    dist, sort = SERVING_LAYOUT[table]
    return layout(df, name or table, dist, sort, buckets, files_per_bucket, location)


def run_serving(
    spark: SparkSession,
    source: str,
    root: str,
    prefix: str = "",
    order_by: Iterable[str | Column] = _SESSION_ORDER,
    buckets: int = 64,
) -> dict[str, DataFrame]:
    """The query-first job: a tree of CSV files becomes the three serving tables below ``root``.

    The files are read once, preprocessed and kept as one Parquet set; each table is built from it,
    saved under ``prefix`` and its name, and returned by name, ready for its lookup.
    """
    events = preprocess_events(read_csv_dir(spark, source))
    write_table(events, root, "preprocessed_events")
    events = read_table(spark, root, "preprocessed_events")
    build = {
        "song_session_history": build_song_session_history,
        "user_artist_history": build_user_artist_history,
        "user_song_history": build_user_song_history,
    }
    return {
        table: save_serving(make(events, order_by), table, prefix + table, buckets, location=f"{root}/{table}")
        for table, make in build.items()
    }
