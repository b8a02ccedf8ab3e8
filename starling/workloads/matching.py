"""Catalogue matching, star joins and anti joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import epoch_s
from ..operators import catalogue, match_plays, not_in, only_new, replicate, star_join
from ..plans import build_artists, build_songs
from .stand_ins import (
    CUTOFF, ENTRIES, PLAYS, REPEATED_ENTRIES, STORED_USERS, entries, plays, repeated_entries,
    stored_users, table,
)

_IDS = ["userId", "sessionId", "itemInSession", "ts", "song_id", "artist_id"]
_ID_SQL = "userId, sessionId, itemInSession, ts, song_id, artist_id"


def match_exact(spark, sf):
    return match_plays(plays(spark, sf), entries(spark, sf), "inner", "exact").select(*_IDS)


def match_lower(spark, sf):
    shouted = plays(spark, sf).withColumn("song", F.upper("song"))
    return match_plays(shouted, entries(spark, sf), "inner", "lower").select(*_IDS)


def match_left_guard(spark, sf):
    log = plays(spark, sf)
    gapped = log.withColumn("sessionId", F.when(F.col("level") == "paid", F.col("sessionId")))
    timed = gapped.withColumn("start_time", epoch_s("ts"))
    return match_plays(
        timed, entries(spark, sf), "left", "exact", left_guard=["sessionId", "start_time"]
    ).select(*_IDS)


def match_first(spark, sf):
    return match_plays(
        plays(spark, sf), entries(spark, sf), "left", "exact", first_match=True
    ).select(*_IDS)


def match_first_lower(spark, sf):
    return match_plays(
        plays(spark, sf), entries(spark, sf), "left", "lower", first_match=True
    ).select(*_IDS)


def _match_rounded(rounding):
    def query(spark, sf):
        return match_plays(
            plays(spark, sf), entries(spark, sf), "left", "rounded", rounding=rounding
        ).select(*_IDS)
    return query


def match_none(spark, sf):
    return match_plays(plays(spark, sf), entries(spark, sf), "left_anti", "exact").select(
        "userId", "sessionId", "itemInSession", "ts"
    )


def match_hot_titles(spark, sf):
    """A third of all plays is of one title, which has fifty entries."""
    hot = F.pmod(F.col("sessionId") + F.col("itemInSession"), F.lit(3)) == 0
    log = plays(spark, sf).withColumns({
        "song": F.when(hot, "Hit").otherwise(F.col("song")), "artist": F.when(hot, "Star").otherwise(F.col("artist")),
    })
    found = entries(spark, sf)
    fifty = table(spark, sf, "part").where("p_partkey <= 50").select(F.col("p_partkey").cast("string").alias("__id"))
    hits = found.limit(0).unionByName(
        fifty.select(F.concat(F.lit("hit-"), "__id").alias("song_id"), F.lit("HIT").alias("title"),
                     F.lit("Star").alias("artist_id"), F.lit("Star").alias("artist_name")),
        allowMissingColumns=True,
    )
    matched = match_plays(log, found.unionByName(hits), "left", "lower", hot_share=0.01)
    return matched.groupBy("song_id", "level").agg(
        F.count(F.lit(1)).alias("n"), F.sum("sessionId").alias("sessions")
    )


def catalogue_join(spark, sf):
    raw = repeated_entries(spark, sf)
    return catalogue(build_songs(raw), build_artists(raw)).select(
        "song_id", "artist_id", "artist_name"
    )


def catalogue_suppliers(spark, sf):
    songs = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("song_id"), F.col("s_nationkey").alias("artist_id")
    )
    artists = table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("artist_id"), F.col("n_name").alias("name")
    )
    return catalogue(songs, artists)


def only_new_facts(spark, sf):
    orders = table(spark, sf, "orders")
    stored = orders.where(F.col("o_orderdate") < F.lit(CUTOFF).cast("timestamp_ntz"))
    return only_new(orders, stored, ["o_custkey", "o_orderstatus", "o_orderpriority"]).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"
    )


def _events(spark, sf):
    return table(spark, sf, "events").select("event_id", "user_id", "event_type")


def not_in_dim(spark, sf):
    return not_in(_events(spark, sf), stored_users(spark, sf), "user_id")


def not_in_poisoned(spark, sf):
    """A stored NULL leaves nothing; with an empty dimension everything passes, NULLs too."""
    events = _events(spark, sf).withColumn(
        "user_id", F.when(F.col("event_type") != "error", F.col("user_id"))
    )
    stored = stored_users(spark, sf)
    poisoned = stored.unionByName(stored.select(F.lit(None).cast("bigint").alias("user_id")))
    nothing = stored.where(F.col("user_id") < 0)
    cases = {"poisoned": poisoned, "stored": stored, "empty": nothing}
    parts = [
        not_in(events, dim, "user_id").agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit(case).alias("dim"), "n_rows")
        for case, dim in cases.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def not_in_plain(spark, sf):
    events = _events(spark, sf).withColumn(
        "user_id", F.when(F.col("event_type") != "error", F.col("user_id"))
    )
    return not_in(events, stored_users(spark, sf), "user_id", null_aware=False)


def star_join_detail(spark, sf):
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment"
    )
    return star_join(table(spark, sf, "orders"), customers, "o_custkey")


def star_join_replicated(spark, sf):
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"
    )
    lines = table(spark, sf, "lineitem").select("l_suppkey", "l_orderkey")
    return (
        star_join(lines, suppliers, "l_suppkey", replicate_under=64 << 20)
        .join(replicate(table(spark, sf, "nation").select(
            F.col("n_nationkey").alias("s_nationkey"), "n_name")), "s_nationkey")
        .groupBy("n_name").agg(F.count(F.lit(1)).alias("plays"))
    )


def _match_sql(how, condition, right=ENTRIES, left=PLAYS):
    return f"SELECT {_ID_SQL} FROM ({left}) p {how} JOIN ({right}) e ON {condition}"


EXACT = "song = title AND artist = artist_name AND length = duration"
LOWER = "lower(song) = lower(title) AND lower(artist) = lower(artist_name)"
ROUNDED = ("song = title AND artist = artist_name "
           "AND CAST(length AS DECIMAL(18,0)) = CAST(duration AS DECIMAL(18,0))")
FLOORED = "song = title AND artist = artist_name AND floor(length) = floor(duration)"


def first_sql(keys):
    """Catalogue entries reduced to the smallest id per match key."""
    return f"""
      SELECT * FROM ({ENTRIES}) QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY song_id) = 1
    """


_LAKE_SONGS = f"""
  SELECT * FROM (SELECT song_id, title, artist_id, year, duration FROM ({REPEATED_ENTRIES}))
  QUALIFY row_number() OVER (PARTITION BY song_id, artist_id ORDER BY title, year, duration) = 1
"""
_LAKE_ARTISTS = f"""
  SELECT artist_id, min(artist_name) AS artist_name FROM ({REPEATED_ENTRIES}) GROUP BY artist_id
"""

QUERIES = {
    "match_exact": (match_exact, _match_sql("", EXACT)),
    "match_lower": (match_lower, _match_sql("", LOWER)),
    "match_left_guard": (match_left_guard, f"""
        SELECT userId, CASE WHEN level = 'paid' THEN sessionId END AS sessionId, itemInSession, ts,
               song_id, artist_id
        FROM ({PLAYS}) p LEFT JOIN ({ENTRIES}) e ON {EXACT} AND p.level = 'paid'"""),
    "match_first": (
        match_first, _match_sql("LEFT", EXACT, first_sql("title, artist_name, duration"))),
    "match_first_lower": (
        match_first_lower,
        _match_sql("LEFT", LOWER, first_sql("lower(title), lower(artist_name)"))),
    "match_rounded": (_match_rounded("truncate"), _match_sql("LEFT", FLOORED)),
    "match_rounded_half_up": (_match_rounded("half_up"), _match_sql("LEFT", ROUNDED)),
    "match_hot_titles": (match_hot_titles, f"""
        SELECT song_id, level, count(*) AS n, CAST(sum(sessionId) AS BIGINT) AS sessions
        FROM (SELECT sessionId, level, CASE WHEN hot THEN 'Hit' ELSE song END AS song,
                     CASE WHEN hot THEN 'Star' ELSE artist END AS artist
              FROM (SELECT *, (sessionId + itemInSession) % 3 = 0 AS hot FROM ({PLAYS}))) p
        LEFT JOIN (SELECT song_id, title, artist_name FROM ({ENTRIES})
                   UNION ALL SELECT 'hit-' || p_partkey, 'HIT', 'Star' FROM part WHERE p_partkey <= 50) e
        ON {LOWER} GROUP BY song_id, level"""),
    "match_none": (match_none, f"""
        SELECT userId, sessionId, itemInSession, ts FROM ({PLAYS}) p
        WHERE NOT EXISTS (SELECT 1 FROM ({ENTRIES}) e WHERE {EXACT})"""),
    "catalogue_join": (catalogue_join, f"""
        SELECT song_id, artist_id, artist_name FROM ({_LAKE_SONGS}) JOIN ({_LAKE_ARTISTS})
        USING (artist_id)"""),
    "catalogue_suppliers": (catalogue_suppliers, """
        SELECT s_suppkey AS song_id, s_nationkey AS artist_id, n_name AS artist_name
        FROM supplier JOIN nation ON n_nationkey = s_nationkey"""),
    "only_new_facts": (only_new_facts, f"""
        SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders o
        WHERE NOT EXISTS (
          SELECT 1 FROM orders s WHERE s.o_orderdate < TIMESTAMP '{CUTOFF}'
             AND s.o_custkey = o.o_custkey AND s.o_orderstatus = o.o_orderstatus
             AND s.o_orderpriority = o.o_orderpriority)"""),
    "not_in_dim": (not_in_dim, f"""
        SELECT event_id, user_id, event_type FROM events
        WHERE user_id NOT IN ({STORED_USERS})"""),
    "not_in_dim_poisoned": (not_in_poisoned, f"""
        WITH e AS (SELECT CASE WHEN event_type <> 'error' THEN user_id END AS user_id FROM events)
        SELECT 'poisoned' AS dim, count(*) AS n_rows FROM e
        WHERE user_id NOT IN (SELECT user_id FROM ({STORED_USERS}) UNION ALL SELECT NULL)
        UNION ALL
        SELECT 'stored', count(*) FROM e WHERE user_id NOT IN ({STORED_USERS})
        UNION ALL
        SELECT 'empty', count(*) FROM e
        WHERE user_id NOT IN (SELECT user_id FROM ({STORED_USERS}) WHERE user_id < 0)"""),
    "not_in_dim_plain": (not_in_plain, f"""
        WITH e AS (SELECT event_id, event_type,
                          CASE WHEN event_type <> 'error' THEN user_id END AS user_id FROM events)
        SELECT event_id, user_id, event_type FROM e
        WHERE NOT EXISTS (SELECT 1 FROM ({STORED_USERS}) s WHERE s.user_id = e.user_id)"""),
    "star_join_detail": (star_join_detail, """
        SELECT o.*, c_name, c_mktsegment FROM orders o JOIN customer ON c_custkey = o_custkey"""),
    "star_join_replicated": (star_join_replicated, """
        SELECT n_name, count(*) AS plays FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
        JOIN nation ON n_nationkey = s_nationkey GROUP BY n_name"""),
}
