"""The standard questions asked of the star schema and the serving tables.

Where a report joins the fact with a dimension only to count by one of its attributes, the fact is
first reduced to one row per join key. The count of a group is then the sum over its keys, so a hot
key costs one row per map task, and a dimension with repeated keys still multiplies as it should.
The aggregate leaves the rows where the join wants them, so it adds no shuffle. Distinct users are
counted after the join: making (time, user) pairs distinct before would shuffle the fact twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import eq, largest, lookup, not_null_rows, preview, star_join, top_k, users_by


def _counted(fact: DataFrame, dim: DataFrame, key: str, by: str) -> DataFrame:
    per_key = fact.groupBy(key).agg(F.count(F.lit(1)).alias("plays"))
    joined = star_join(per_key, dim.select(key, by), key)
    return joined.groupBy(by).agg(F.sum("plays").alias("plays"))


def _distinct_users(fact: DataFrame, time: DataFrame, by: str) -> DataFrame:
    pairs = fact.select("start_time", "user_id")
    return users_by(star_join(pairs, time.select("start_time", by), "start_time"), [by])


def paid_plays_by_month(fact: DataFrame, time: DataFrame) -> DataFrame:
    return _counted(eq(fact, "level", "paid"), time, "start_time", "month").orderBy("month")


def paid_users_by_hour(fact: DataFrame, time: DataFrame) -> DataFrame:
    return _distinct_users(eq(fact, "level", "paid"), time, "hour")


def paid_users_by_month(fact: DataFrame, time: DataFrame) -> DataFrame:
    return _distinct_users(eq(fact, "level", "paid"), time, "month").orderBy("month")


def top_locations(fact: DataFrame, k: int = 5) -> DataFrame:
    return top_k(fact, "location", k)


def top_artists(fact: DataFrame, artists: DataFrame, k: int = 5) -> DataFrame:
    return largest(_counted(fact, artists, "artist_id", "name"), "name", k)


def resolved_plays(fact: DataFrame, n: int | None = None, order_by=None) -> DataFrame:
    """Plays whose song and artist are both known; all of them unless ``n`` is given."""
    rows = not_null_rows(fact, ["song_id", "artist_id"])
    return rows if n is None else preview(rows, n, order_by)


def play_detail(
    fact: DataFrame, songs: DataFrame, n: int | None = 10, order_by=None
) -> DataFrame:
    """Plays with the attributes of their song. The song's artist comes as ``song_artist_id``."""
    songs = songs.withColumnRenamed("artist_id", "song_artist_id")
    clash = [c for c in songs.columns if c in fact.columns and c != "song_id"]
    detail = star_join(fact, songs.withColumnsRenamed({c: f"song_{c}" for c in clash}), "song_id")
    return detail if n is None else preview(detail, n, order_by)


def session_item(history: DataFrame, session_id: int, item: int) -> DataFrame:
    hit = lookup(history, session_id=session_id, item_in_session=item)
    return hit.select("artist", "song", "length")


def user_session_history(history: DataFrame, user_id: int, session_id: int) -> DataFrame:
    rows = lookup(history, ["item_in_session"], user_id=user_id, session_id=session_id)
    return rows.select("item_in_session", "artist", "song", "first_name", "last_name")


def song_listeners(history: DataFrame, song: str) -> DataFrame:
    return lookup(history, song=song).select("user_id", "first_name", "last_name")
