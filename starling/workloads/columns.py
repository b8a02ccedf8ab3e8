"""Projections, filters and column functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import (
    as_text, coalesce, concat, drop_fraction, epoch_ms, epoch_s, lower, md5_key, sha2_key,
    time_parts, try_cast,
)
from ..operators import (
    coerce, drop_blank, eq, for_date, not_null_rows, only_plays, project, project_events,
    project_positions, rename, surrogate_key,
)
from ..operators.joins import match_plays
from ..schemas import STAGED_EVENTS
from .stand_ins import (
    CLICKS, ENTRIES, PLAYS, VISITS, clicks, entries, plays, table, visits,
)


def filter_plays(spark, sf):
    events = rename(table(spark, sf, "events"), {"event_type": "page", "user_id": "userId"})
    return project(only_plays(events, value="purchase"), ["event_id", "userId", "ts", "value"])


def drop_blank_rows(spark, sf):
    events = table(spark, sf, "events")
    blanked = events.withColumn(
        "artist", F.when(F.col("event_type") == "error", "").otherwise(F.col("event_type"))
    )
    return drop_blank(blanked, "artist").select("event_id", "artist")


def not_null_pairs(spark, sf):
    matched = match_plays(plays(spark, sf), entries(spark, sf), "left", "exact")
    return not_null_rows(matched, ["song_id", "artist_id"]).select(
        "sessionId", "itemInSession", "userId", "song_id", "artist_id"
    )


def project_positional(spark, sf):
    picked = project_positions(table(spark, sf, "events"), {0: "id", 2: "user", 4: "amount"})
    return picked.select(
        "id", try_cast("user", "int").alias("user"), F.col("amount").cast("float").cast("double")
        .alias("amount"),
    )


def project_event_fields(spark, sf):
    return project_events(plays(spark, sf))


def paid_only(spark, sf):
    return eq(table(spark, sf, "orders"), "o_orderpriority", "1-URGENT")


def for_one_date(spark, sf):
    return for_date(table(spark, sf, "orders"), "1998-10-03", "o_orderdate")


def epoch_ms_ts(spark, sf):
    return clicks(spark, sf).select("event_id", epoch_ms("ts").alias("start_time"))


def epoch_s_ts(spark, sf):
    return clicks(spark, sf).select("event_id", epoch_s("ts").alias("start_time"))


def _parts(base, as_text_too=False):
    def query(spark, sf):
        events = table(spark, sf, "events").select("event_id", F.col("ts").alias("start_time"))
        return time_parts(events, base=base, as_text=as_text_too)
    return query


def order_calendar(spark, sf):
    dates = table(spark, sf, "orders").select(F.col("o_orderdate").alias("start_time")).distinct()
    return time_parts(dates, base="mon0")


_DOW = {"mon0": "isodow({0}) - 1", "sun0": "dayofweek({0})", "sun1": "dayofweek({0}) + 1"}


def parts_sql(ts, base, text=False):
    """Calendar columns of ``ts`` in SQL."""
    def part(expr, name):
        whole = f"CAST({expr} AS INTEGER)"
        if text and name in ("month", "weekday"):
            whole = f"CAST({whole} AS VARCHAR)"
        return f"{whole} AS {name}"

    names = {"hour": "hour", "day": "day", "week": "week", "month": "month", "year": "year"}
    columns = [part(f"extract({field} FROM {ts})", name) for name, field in names.items()]
    return ", ".join([*columns, part(_DOW[base].format(ts), "weekday")])


def _parts_sql(base, text=False):
    return f"SELECT event_id, ts AS start_time, {parts_sql('ts', base, text)} FROM events"


def md5_play_id(spark, sf):
    timed = clicks(spark, sf).withColumn("start_time", epoch_s("ts"))
    return timed.select(
        "event_id", md5_key("userId", "start_time").alias("play_id"),
        md5_key("userId", F.when(F.col("page") == "NextSong", F.col("start_time")))
        .alias("play_only_id"),
    )


def sha2_play_id(spark, sf):
    timed = clicks(spark, sf).withColumn("start_time", epoch_s("ts"))
    page = F.when(F.col("page") != "error", F.col("page"))
    return timed.select(
        "event_id", sha2_key("start_time", "userId", page, "song").alias("play_id"),
        sha2_key("start_time", "userId", page, "song", null_safe=True).alias("safe_id"),
    )


def lower_coalesce(spark, sf):
    part = table(spark, sf, "part")
    return part.select(
        "p_partkey", lower("p_brand").alias("brand"),
        coalesce(F.when(F.col("p_size") > 25, F.col("p_type")), F.lit("none")).alias("kind"),
        concat("p_brand", F.lit("-"), "p_size").alias("label"),
        as_text("p_size").alias("size_text"),
    )


def try_cast_float(spark, sf):
    events = table(spark, sf, "events")
    text = F.when(F.col("event_type") == "error", "").when(
        F.col("event_type") == "view", F.col("event_type")
    ).otherwise(F.get_json_object("props", "$.k"))
    return events.select("event_id", try_cast(text, "double").alias("k"))


def drop_fraction_both(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", drop_fraction("p_retailprice").alias("rounded"),
        drop_fraction("p_retailprice", "truncate").alias("cut"),
    )


def coerce_visits(spark, sf):
    typed = coerce(visits(spark, sf).withColumn("userId", F.col("userId").cast("string")),
                   STAGED_EVENTS)
    return typed.select("userId", "firstName", "level", "page", "ts", "length", "status")


def surrogate_key_orders(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return surrogate_key(orders, ["o_orderdate", "o_orderkey"], "id")


def surrogate_hash_orders(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    hashed = surrogate_key(orders, ["o_orderkey"], "id", dense=False)
    return hashed.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct("id").alias("n_ids"),
    )


QUERIES = {
    "filter_plays": (filter_plays, """
        SELECT event_id, user_id AS userId, ts, value FROM events
        WHERE event_type = 'purchase'"""),
    "drop_blank": (drop_blank_rows, """
        SELECT event_id, event_type AS artist FROM events WHERE event_type <> 'error'"""),
    "not_null_pairs": (not_null_pairs, f"""
        SELECT sessionId, itemInSession, userId, song_id, artist_id
        FROM ({PLAYS}) p LEFT JOIN ({ENTRIES}) e
          ON song = title AND artist = artist_name AND length = duration
        WHERE song_id IS NOT NULL AND artist_id IS NOT NULL"""),
    "project_positional": (project_positional, """
        SELECT event_id AS id, CAST(user_id AS INTEGER) AS "user",
               CAST(CAST(value AS FLOAT) AS DOUBLE) AS amount FROM events"""),
    "project_events": (project_event_fields, f"""
        SELECT artist, firstName, gender, itemInSession, lastName, length, level, location,
               sessionId, song, userId FROM ({PLAYS})"""),
    "paid_only": (paid_only, "SELECT * FROM orders WHERE o_orderpriority = '1-URGENT'"),
    "for_date": (for_one_date, """
        SELECT * FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1998-10-03'"""),
    "epoch_ms_ts": (epoch_ms_ts, """
        SELECT event_id, date_trunc('millisecond', ts) AS start_time FROM events"""),
    "epoch_s_ts": (epoch_s_ts, """
        SELECT event_id, date_trunc('second', ts) AS start_time FROM events"""),
    "time_parts_mon0": (_parts("mon0"), _parts_sql("mon0")),
    "time_parts_sun0": (_parts("sun0", True), _parts_sql("sun0", True)),
    "time_parts_sun1": (_parts("sun1"), _parts_sql("sun1")),
    "order_calendar": (order_calendar, f"""
        SELECT DISTINCT o_orderdate AS start_time, {parts_sql('o_orderdate', 'mon0')}
        FROM orders"""),
    "md5_play_id": (md5_play_id, f"""
        SELECT event_id, md5(userId || CAST(make_timestamp(ts // 1000 * 1000000) AS VARCHAR))
                 AS play_id,
               CASE WHEN page = 'NextSong'
                    THEN md5(userId || CAST(make_timestamp(ts // 1000 * 1000000) AS VARCHAR)) END
                 AS play_only_id
        FROM ({CLICKS})"""),
    "sha2_play_id": (sha2_play_id, f"""
        SELECT event_id,
               sha256(concat_ws('||', CAST(start_time AS VARCHAR), CAST(userId AS VARCHAR), kind,
                                song)) AS play_id,
               sha256(concat_ws('||', CAST(start_time AS VARCHAR), CAST(userId AS VARCHAR),
                                coalesce(kind, '\\N'), song)) AS safe_id
        FROM (SELECT *, make_timestamp(ts // 1000 * 1000000) AS start_time,
                     nullif(page, 'error') AS kind FROM ({CLICKS}))"""),
    "lower_coalesce": (lower_coalesce, """
        SELECT p_partkey, lower(p_brand) AS brand,
               coalesce(CASE WHEN p_size > 25 THEN p_type END, 'none') AS kind,
               p_brand || '-' || p_size AS label, CAST(p_size AS VARCHAR) AS size_text
        FROM part"""),
    "try_cast_float": (try_cast_float, """
        SELECT event_id, TRY_CAST(CASE event_type WHEN 'error' THEN '' WHEN 'view' THEN 'view'
               ELSE json_extract_string(props, '$.k') END AS DOUBLE) AS k FROM events"""),
    "drop_fraction": (drop_fraction_both, """
        SELECT p_partkey, CAST(p_retailprice AS DECIMAL(18,0)) AS rounded,
               CAST(floor(p_retailprice) AS DECIMAL(18,0)) AS cut FROM part"""),
    "coerce_visits": (coerce_visits, f"""
        SELECT CAST(userId AS INTEGER) AS userId, firstName, level, page, ts,
               CAST(NULL AS DOUBLE) AS length, CAST(NULL AS SMALLINT) AS status
        FROM ({VISITS})"""),
    "surrogate_key_orders": (surrogate_key_orders, """
        SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS id, o_orderkey, o_custkey,
               o_orderdate FROM orders"""),
    "surrogate_key_hashed": (surrogate_hash_orders, """
        SELECT count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_ids FROM orders"""),
}
