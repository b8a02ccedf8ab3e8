"""The end-user reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import plans as P
from ..functions import epoch_ms, time_parts
from ..operators import preview
from .stand_ins import CLICKS, clicks, entries, ENTRIES, plays, PLAYS, table


def _lines(spark, sf):
    return table(spark, sf, "lineitem").select(F.col("l_partkey").alias("artist_id"))


def _artists(spark, sf):
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("artist_id"), F.col("p_brand").alias("name")
    )


def top5_artists(spark, sf):
    return P.top_artists(_lines(spark, sf), _artists(spark, sf), 5)


def _order_facts(spark, sf):
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("n_nationkey")
    )
    nations = table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("location"))
    return (
        table(spark, sf, "orders").join(customers, "o_custkey").join(nations, "n_nationkey")
        .select("o_orderkey", "location")
    )


def top5_locations(spark, sf):
    return P.top_locations(_order_facts(spark, sf), 5)


def _orders_as_fact(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderdate").alias("start_time"),
        F.col("o_custkey").alias("user_id"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "paid").otherwise("free")
        .alias("level"),
    )


_ORDER_FACT = """
  SELECT o_orderdate AS start_time, o_custkey AS user_id,
         CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'paid' ELSE 'free' END AS level
  FROM orders
"""


def _clicks_as_fact(spark, sf):
    return clicks(spark, sf).select(
        epoch_ms("ts").alias("start_time"), F.col("userId").alias("user_id"),
        F.when(F.col("page") == "NextSong", "paid").otherwise("free").alias("level"),
    )


_CLICK_FACT = f"""
  SELECT make_timestamp(ts * 1000) AS start_time, userId AS user_id,
         CASE WHEN page = 'NextSong' THEN 'paid' ELSE 'free' END AS level
  FROM ({CLICKS})
"""


def _time_of(fact):
    return time_parts(fact.select("start_time").distinct(), base="mon0")


def _time_sql(fact):
    return f"""
      SELECT DISTINCT start_time, CAST(extract(hour FROM start_time) AS INTEGER) AS hour,
             CAST(extract(month FROM start_time) AS INTEGER) AS month
      FROM ({fact})
    """


def paid_by_month(spark, sf):
    fact = _orders_as_fact(spark, sf)
    return P.paid_plays_by_month(fact, _time_of(fact))


def paid_users_by_month(spark, sf):
    fact = _orders_as_fact(spark, sf)
    return P.paid_users_by_month(fact, _time_of(fact))


def paid_users_by_hour(spark, sf):
    fact = _clicks_as_fact(spark, sf)
    return P.paid_users_by_hour(fact, _time_of(fact))


def _report_sql(fact, by, what):
    return f"""
      SELECT t.{by}, {what} FROM ({fact}) f JOIN ({_time_sql(fact)}) t USING (start_time)
      WHERE level = 'paid' GROUP BY t.{by} ORDER BY t.{by}
    """


def resolved_plays(spark, sf):
    fact = P.build_songplays(plays(spark, sf), entries(spark, sf), variant="scheduled")
    return P.resolved_plays(fact).groupBy("song_id", "artist_id").agg(
        F.count(F.lit(1)).alias("plays")
    )


def play_detail(spark, sf):
    fact = P.build_songplays(plays(spark, sf), entries(spark, sf), variant="scheduled")
    songs = P.build_songs(entries(spark, sf), variant="lake")
    detail = P.play_detail(
        fact, songs, 10, ["start_time", "session_id", "user_id", "song_id", "user_agent"]
    )
    return detail.select("start_time", "session_id", "user_id", "song_id", "user_agent", "title",
                         "duration", "song_artist_id")


_ROUNDED = f"""
  SELECT make_timestamp((ts // 1000) * 1000000) AS start_time, p.userId AS user_id,
         p.sessionId AS session_id, p.userAgent AS user_agent, e.song_id, e.artist_id
  FROM ({PLAYS}) p LEFT JOIN ({ENTRIES}) e
    ON p.song = e.title AND p.artist = e.artist_name
   AND CAST(p.length AS DECIMAL(18,0)) = CAST(e.duration AS DECIMAL(18,0))
"""


def preview_orders(spark, sf):
    return preview(table(spark, sf, "orders"), 5, ["o_orderkey"])


QUERIES = {
    "top5_artists": (top5_artists, """
        SELECT p_brand AS name, count(*) AS plays FROM lineitem JOIN part ON p_partkey = l_partkey
        GROUP BY p_brand ORDER BY plays DESC, name LIMIT 5"""),
    "top5_locations": (top5_locations, """
        SELECT n_name AS location, count(*) AS plays
        FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
        GROUP BY n_name ORDER BY plays DESC, location LIMIT 5"""),
    "paid_by_month": (
        paid_by_month, _report_sql(_ORDER_FACT, "month", "count(*) AS plays")),
    "paid_users_by_month": (
        paid_users_by_month, _report_sql(_ORDER_FACT, "month", "count(DISTINCT user_id) AS users")),
    "paid_users_by_hour": (
        paid_users_by_hour, _report_sql(_CLICK_FACT, "hour", "count(DISTINCT user_id) AS users")),
    "resolved_plays": (resolved_plays, f"""
        SELECT song_id, artist_id, count(*) AS plays FROM ({_ROUNDED})
        WHERE song_id IS NOT NULL AND artist_id IS NOT NULL GROUP BY ALL"""),
    "play_detail": (play_detail, f"""
        SELECT start_time, session_id, user_id, f.song_id, user_agent, title, duration,
               s.artist_id AS song_artist_id
        FROM ({_ROUNDED}) f JOIN ({ENTRIES}) s ON s.song_id = f.song_id
        ORDER BY start_time, session_id, user_id, f.song_id, user_agent LIMIT 10"""),
    "preview_orders": (preview_orders, "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5"),
}
