"""Serving tables and the lookups they are built for."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import plans as P
from ..session import scratch_path
from ..sinks import write_csv
from ..sources import read_csv_dir
from .stand_ins import PLAYS, plays

# Rows of one key are written in this order; it leaves no ties.
_ORDER = ["ts", "userId", "song", "artist", "length", "userAgent"]
_SQL_ORDER = ", ".join(f"{c} DESC" for c in _ORDER)


def preprocess(spark, sf):
    log = plays(spark, sf)
    return P.preprocess_events(
        log.withColumn("artist", F.when(F.col("userAgent") != "R", F.col("artist")))
    )


def hist_session(spark, sf):
    return P.build_song_session_history(plays(spark, sf), _ORDER)


def hist_user(spark, sf):
    return P.build_user_artist_history(plays(spark, sf), _ORDER)


def hist_song(spark, sf):
    return P.build_user_song_history(plays(spark, sf), _ORDER)


def _saved(spark, df, table):
    """The serving table as stored: bucketed on its lookup key, so that a lookup opens one bucket."""
    path = scratch_path(spark, table)
    name = "serving_" + path.rsplit("-", 1)[1]
    return P.save_serving(df, table, name, buckets=8, location=path)


def lookup_session(spark, sf):
    history = _saved(spark, hist_session(spark, sf), "song_session_history")
    return P.session_item(history, 338, 5)


def lookup_user(spark, sf):
    history = _saved(spark, hist_user(spark, sf), "user_artist_history")
    return P.user_session_history(history, 92, 4809)


def lookup_song(spark, sf):
    history = _saved(spark, hist_song(spark, sf), "user_song_history")
    return P.song_listeners(history, "Title 5")


def serving_from_csv(spark, sf):
    """CSV files, preprocessed into another CSV, from which a serving table is built."""
    raw, clean = scratch_path(spark, "raw"), scratch_path(spark, "clean")
    log = plays(spark, sf)
    gapped = log.withColumn("artist", F.when(F.col("userAgent") != "R", F.col("artist")))
    write_csv(gapped.where("location = 'F'"), raw + "/2018/one")
    write_csv(gapped.where("location <> 'F'"), raw + "/2018/two")
    write_csv(P.preprocess_events(read_csv_dir(spark, raw)), clean)
    return P.build_song_session_history(
        read_csv_dir(spark, clean), ["userId", "song", "artist", "length"]
    )


def serving_job(spark, sf):
    """From CSV files to three stored tables and a lookup in each, as one job."""
    base = scratch_path(spark, "serving-job")
    log = plays(spark, sf)
    gapped = log.withColumn("artist", F.when(F.col("userAgent") != "R", F.col("artist")))
    kept = {"compression": "gzip", "max_records_per_file": 1_000_000}
    write_csv(gapped.where("location = 'F'"), base + "/raw/one", **kept)
    write_csv(gapped.where("location <> 'F'"), base + "/raw/two", **kept)
    order = ["userId", "song", "artist", "length", "sessionId", "itemInSession"]
    prefix = "job_" + base.rsplit("-", 1)[1] + "_"
    tables = P.run_serving(spark, base + "/raw", base + "/tables", prefix, order, buckets=8)
    found = {
        "session": P.session_item(tables["song_session_history"], 338, 5),
        "user": P.user_session_history(tables["user_artist_history"], 92, 4809),
        "song": P.song_listeners(tables["user_song_history"], "Title 5"),
    }
    texts = [
        df.select(F.lit(name).alias("name"), F.concat_ws("|", *[F.col(c).cast("string") for c in df.columns]).alias("row"))
        for name, df in found.items()
    ]
    return texts[0].unionByName(texts[1]).unionByName(texts[2])


_JOB_ORDER = "userId DESC, song DESC, artist DESC, length DESC, sessionId DESC, itemInSession DESC"


def _job_last(keys):
    return f"""SELECT * FROM ({PLAYS}) WHERE userAgent <> 'R'
      QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {_JOB_ORDER}) = 1"""


def _last(keys):
    return f"""
      SELECT * FROM ({PLAYS})
      QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY {_SQL_ORDER}) = 1
    """


_SESSION = f"""
  SELECT sessionId AS session_id, itemInSession AS item_in_session, artist, song, length
  FROM ({_last('sessionId, itemInSession')})
"""
_USER = f"""
  SELECT userId AS user_id, sessionId AS session_id, itemInSession AS item_in_session, artist, song,
         firstName AS first_name, lastName AS last_name
  FROM ({_last('userId, sessionId, itemInSession')})
"""
_SONG = f"""
  SELECT song, userId AS user_id, firstName AS first_name, lastName AS last_name
  FROM ({_last('song, userId')})
"""

QUERIES = {
    "preprocess_events": (preprocess, f"""
        SELECT artist, firstName, gender, itemInSession, lastName, length, level, location,
               sessionId, song, userId FROM ({PLAYS}) WHERE userAgent <> 'R'"""),
    "hist_session": (hist_session, _SESSION),
    "hist_user": (hist_user, _USER),
    "hist_song": (hist_song, _SONG),
    "serving_from_csv": (serving_from_csv, f"""
        SELECT CAST(sessionId AS INTEGER) AS session_id, itemInSession AS item_in_session, artist,
               song, length
        FROM ({PLAYS}) WHERE userAgent <> 'R'
        QUALIFY row_number() OVER (PARTITION BY sessionId, itemInSession
          ORDER BY userId DESC, song DESC, artist DESC, length DESC) = 1"""),
    "serving_job": (serving_job, f"""
        SELECT 'session' AS name, artist || '|' || song || '|' || length AS row
        FROM ({_job_last('sessionId, itemInSession')}) WHERE sessionId = 338 AND itemInSession = 5
        UNION ALL
        SELECT 'user', itemInSession || '|' || artist || '|' || song || '|' || firstName || '|' || lastName
        FROM ({_job_last('userId, sessionId, itemInSession')}) WHERE userId = 92 AND sessionId = 4809
        UNION ALL
        SELECT 'song', userId || '|' || firstName || '|' || lastName
        FROM ({_job_last('song, userId')}) WHERE song = 'Title 5'"""),
    "lookup_session": (lookup_session, f"""
        SELECT artist, song, length FROM ({_SESSION})
        WHERE session_id = 338 AND item_in_session = 5"""),
    "lookup_user": (lookup_user, f"""
        SELECT item_in_session, artist, song, first_name, last_name FROM ({_USER})
        WHERE user_id = 92 AND session_id = 4809 ORDER BY item_in_session"""),
    "lookup_song": (lookup_song, f"""
        SELECT user_id, first_name, last_name FROM ({_SONG}) WHERE song = 'Title 5'"""),
}
