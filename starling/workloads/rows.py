"""Duplicate removal, counts and top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import (
    count_where, dedup, distinct, file_counts, lookup, plays_by, preview, profile, top_k, users_by,
)
from .stand_ins import table


def distinct_tuple(spark, sf):
    return distinct(table(spark, sf, "part"), ["p_name", "p_brand", "p_type"])


def dedup_first(spark, sf):
    orders = table(spark, sf, "orders")
    return dedup(orders, ["o_custkey", "o_orderpriority"], ["o_orderdate", "o_orderkey"])


def dedup_last(spark, sf):
    orders = table(spark, sf, "orders")
    return dedup(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], keep="last")


def count_by(spark, sf):
    return plays_by(table(spark, sf, "orders"), ["o_orderpriority", "o_orderstatus"], ordered=True)


def count_distinct_by(spark, sf):
    events = table(spark, sf, "events").withColumn("hour", F.hour("ts"))
    return users_by(events, ["hour"], ordered=True)


def row_profile(spark, sf):
    names = ["orders", "events", "lineitem"]
    rows = [profile(table(spark, sf, n)).select(F.lit(n).alias("name"), "n_rows") for n in names]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def rows_per_file(spark, sf):
    scan = spark.read.parquet(f"{sf}/orders.parquet", f"{sf}/orders.parquet")
    per_file = file_counts(scan)
    return per_file.select(F.element_at(F.split("file", "/"), -1).alias("file"), "n_rows")


def top3_users(spark, sf):
    return top_k(table(spark, sf, "events"), "user_id", 3)


def ordered_lookup(spark, sf):
    orders = table(spark, sf, "orders")
    return lookup(orders, ["o_orderdate", "o_orderkey"], o_custkey=10, o_orderstatus="F")


def count_where_many(spark, sf):
    return count_where(table(spark, sf, "orders"), {
        "cheap": F.col("o_totalprice") < 100_000,
        "urgent": F.col("o_orderpriority") == "1-URGENT",
        "no_customer": F.col("o_custkey").isNull(),
    })


def preview_events(spark, sf):
    return preview(table(spark, sf, "events"), 3, ["event_id"])


QUERIES = {
    "distinct_tuple": (distinct_tuple, "SELECT DISTINCT p_name, p_brand, p_type FROM part"),
    "dedup_first": (dedup_first, """
        SELECT * FROM orders QUALIFY row_number() OVER (
          PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate, o_orderkey) = 1"""),
    "dedup_last": (dedup_last, """
        SELECT * FROM orders QUALIFY row_number() OVER (
          PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1"""),
    "count_by": (count_by, """
        SELECT o_orderpriority, o_orderstatus, count(*) AS plays FROM orders
        GROUP BY ALL ORDER BY ALL"""),
    "count_distinct_by": (count_distinct_by, """
        SELECT CAST(extract(hour FROM ts) AS INTEGER) AS hour, count(DISTINCT user_id) AS users
        FROM events GROUP BY 1 ORDER BY 1"""),
    "row_profile": (row_profile, """
        SELECT 'orders' AS name, count(*) AS n_rows FROM orders
        UNION ALL SELECT 'events', count(*) FROM events
        UNION ALL SELECT 'lineitem', count(*) FROM lineitem"""),
    "rows_per_file": (rows_per_file, """
        SELECT 'orders.parquet' AS file, 2 * count(*) AS n_rows FROM orders"""),
    "top3_users": (top3_users, """
        SELECT user_id, count(*) AS plays FROM events GROUP BY user_id
        ORDER BY plays DESC, user_id LIMIT 3"""),
    "ordered_lookup": (ordered_lookup, """
        SELECT * FROM orders WHERE o_custkey = 10 AND o_orderstatus = 'F'
        ORDER BY o_orderdate, o_orderkey"""),
    "count_where": (count_where_many, """
        SELECT count(*) FILTER (o_totalprice < 100000) AS cheap,
               count(*) FILTER (o_orderpriority = '1-URGENT') AS urgent,
               count(*) FILTER (o_custkey IS NULL) AS no_customer FROM orders"""),
    "preview_events": (preview_events, "SELECT * FROM events ORDER BY event_id LIMIT 3"),
}
