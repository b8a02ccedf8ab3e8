"""The driver tables in the roles of plays, catalogue, users and stored rows.

Every role has a DataFrame function and the SQL text of the same relation, so that a query and its
SQL start from the same rows and share nothing after that. Timestamps finer than a millisecond are
cut, not rounded, on their way to epoch milliseconds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import to_epoch_ms


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Four parts share a title, whatever their number, and some are spelled in capitals in the catalogue:
# a match without case finds few entries more than one, at any size.
def _title():
    return F.concat(F.lit("Title "), F.expr("p_partkey div 4").cast("string"))


def played_at() -> Column:
    return to_epoch_ms("l_shipdate") + F.col("l_linenumber") * 300


# Plays: order lines carrying the part's title, brand and price as song, artist and length. ``deal`` may
# move the lines with their parts' columns: anything else is made after.
def plays(spark: SparkSession, sf_dir: str, deal: Callable[[DataFrame], DataFrame] = lambda lines: lines) -> DataFrame:
    # What follows from a line is made after the join: where that is a shuffle, only the raw columns move.
    lines = table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_shipdate", "l_returnflag", "l_linestatus"
    )
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("l_partkey"),
        _title().alias("song"),
        F.col("p_brand").alias("artist"),
        F.col("p_retailprice").alias("length"),
    )
    return deal(lines.join(parts, "l_partkey")).select(
        F.col("l_suppkey").alias("userId"),
        F.col("l_orderkey").alias("sessionId"),
        F.col("l_linenumber").alias("itemInSession"),
        played_at().alias("ts"),
        F.when(F.col("l_returnflag") == "A", "paid").otherwise("free").alias("level"),
        F.col("l_linestatus").alias("location"),
        F.col("l_returnflag").alias("userAgent"),
        F.concat(F.lit("First "), F.col("l_suppkey")).alias("firstName"),
        F.concat(F.lit("Last "), F.col("l_suppkey")).alias("lastName"),
        F.col("l_linestatus").alias("gender"),
        F.lit("NextSong").alias("page"),
        "song",
        "artist",
        "length",
    )


PLAYS = """
  SELECT l_suppkey AS userId, l_orderkey AS sessionId, l_linenumber AS itemInSession,
         epoch_us(l_shipdate) // 1000 + l_linenumber * 300 AS ts,
         CASE WHEN l_returnflag = 'A' THEN 'paid' ELSE 'free' END AS level,
         l_linestatus AS location, l_returnflag AS userAgent,
         'First ' || l_suppkey AS firstName, 'Last ' || l_suppkey AS lastName,
         l_linestatus AS gender, 'NextSong' AS page,
         'Title ' || (p_partkey // 4) AS song, p_brand AS artist, p_retailprice AS length
  FROM lineitem JOIN part ON p_partkey = l_partkey
"""


# Catalogue: the smaller parts only, so that some plays have no entry.
def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").where("p_size <= 25").select(
        F.col("p_partkey").cast("string").alias("song_id"),
        F.when(F.col("p_partkey") % 7 == 0, F.upper(_title())).otherwise(_title()).alias("title"),
        F.col("p_brand").alias("artist_id"),
        F.col("p_brand").alias("artist_name"),
        F.col("p_retailprice").alias("duration"),
        F.col("p_size").cast("smallint").alias("year"),
        F.col("p_type").alias("artist_location"),
        F.col("p_size").cast("string").alias("artist_latitude"),
        F.col("p_type").alias("artist_longitude"),
    )


ENTRIES = """
  SELECT CAST(p_partkey AS VARCHAR) AS song_id,
         CASE WHEN p_partkey % 7 = 0 THEN 'TITLE ' ELSE 'Title ' END || (p_partkey // 4) AS title,
         p_brand AS artist_id,
         p_brand AS artist_name, p_retailprice AS duration, CAST(p_size AS SMALLINT) AS year,
         p_type AS artist_location, CAST(p_size AS VARCHAR) AS artist_latitude,
         p_type AS artist_longitude
  FROM part WHERE p_size <= 25
"""


# Catalogue with repeated ids: the part's name is the song id, so many entries share one.
def repeated_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_name").alias("song_id"),
        F.col("p_type").alias("title"),
        F.col("p_brand").alias("artist_id"),
        F.upper("p_name").alias("artist_name"),
        F.col("p_retailprice").alias("duration"),
        F.col("p_size").cast("smallint").alias("year"),
        F.col("p_type").alias("artist_location"),
        F.col("p_retailprice").cast("string").alias("artist_latitude"),
        F.when(F.col("p_size") > 25, F.col("p_size").cast("string")).otherwise(F.col("p_type"))
        .alias("artist_longitude"),
    )


REPEATED_ENTRIES = """
  SELECT p_name AS song_id, p_type AS title, p_brand AS artist_id, upper(p_name) AS artist_name,
         p_retailprice AS duration, CAST(p_size AS SMALLINT) AS year, p_type AS artist_location,
         CAST(p_retailprice AS VARCHAR) AS artist_latitude,
         CASE WHEN p_size > 25 THEN CAST(p_size AS VARCHAR) ELSE p_type END AS artist_longitude
  FROM part
"""


# Visits: one event per order, by its customer. Orders in status P are not plays.
def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("userId"),
        F.concat(F.lit("First "), F.col("o_custkey")).alias("firstName"),
        F.concat(F.lit("Last "), F.col("o_custkey")).alias("lastName"),
        F.col("o_orderstatus").alias("gender"),
        F.col("o_orderpriority").alias("level"),
        F.when(F.col("o_orderstatus") == "P", "Home").otherwise("NextSong").alias("page"),
        to_epoch_ms("o_orderdate").alias("ts"),
    )


VISITS = """
  SELECT o_custkey AS userId, 'First ' || o_custkey AS firstName, 'Last ' || o_custkey AS lastName,
         o_orderstatus AS gender, o_orderpriority AS level,
         CASE WHEN o_orderstatus = 'P' THEN 'Home' ELSE 'NextSong' END AS page,
         epoch_us(o_orderdate) // 1000 AS ts
  FROM orders
"""


# Clicks: the event stream. A purchase is a play.
def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("user_id").alias("userId"),
        F.when(F.col("event_type") == "purchase", "NextSong").otherwise(F.col("event_type"))
        .alias("page"),
        to_epoch_ms("ts").alias("ts"),
        F.col("value").alias("length"),
        F.col("props").alias("song"),
    )


CLICKS = """
  SELECT event_id, user_id AS userId,
         CASE WHEN event_type = 'purchase' THEN 'NextSong' ELSE event_type END AS page,
         epoch_us(ts) // 1000 AS ts, value AS length, props AS song
  FROM events
"""


# Users stored already: the customers of one segment.
def stored_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(
        F.col("c_custkey").alias("user_id")
    )


STORED_USERS = "SELECT c_custkey AS user_id FROM customer WHERE c_mktsegment = 'BUILDING'"

# Orders up to here count as loaded by earlier runs.
CUTOFF = "1997-01-01 00:00:00"
# The same moment in epoch milliseconds.
CUTOFF_MS = 852_076_800_000
