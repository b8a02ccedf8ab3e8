"""Data-quality operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import (
    conform, duplicate_keys, max_length, not_null, null_counts, null_key_checks, run_checks,
)
from ..schemas import _struct
from ..session import scratch_path
from .stand_ins import table


def _gapped_orders(spark, sf):
    return table(spark, sf, "orders").withColumns({
        "o_custkey": F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")),
        "o_orderdate": F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderdate")),
    })


def null_key_counts(spark, sf):
    return null_counts(_gapped_orders(spark, sf), ["o_orderkey", "o_custkey", "o_orderdate"])


def duplicate_line_keys(spark, sf):
    return duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def not_null_split(spark, sf):
    good, rejects = not_null(_gapped_orders(spark, sf), ["o_custkey", "o_orderdate"])
    return good.select("o_orderkey", F.lit(True).alias("accepted")).unionByName(
        rejects.select("o_orderkey", F.lit(False).alias("accepted"))
    )


def too_long(spark, sf):
    return max_length(
        table(spark, sf, "documents").select("doc_id", "text", "lang", "source"),
        {"text": 2000, "lang": 2, "source": 256},
    ).select("doc_id")


def _text_events(spark, sf):
    return table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.when(F.col("event_type") == "error", "").otherwise(F.col("user_id").cast("string"))
        .alias("user_id"),
        F.when(F.col("event_type") == "view", "n/a").otherwise(F.col("value").cast("string"))
        .alias("value"),
    )


_TYPED = _struct("event_id bigint, user_id int, value double")


def conform_typed(spark, sf):
    return conform(_text_events(spark, sf), _TYPED)[0]


def conform_rejects(spark, sf):
    rejects = conform(_text_events(spark, sf), _TYPED)[1]
    return rejects.withColumn("rejected_columns", F.concat_ws(",", "rejected_columns"))


def check_report(spark, sf):
    """Null-key checks over views, one of which fails on purpose."""
    suffix = scratch_path(spark, "v").rsplit("-", 1)[1]
    _gapped_orders(spark, sf).createOrReplaceTempView(f"gapped_{suffix}")
    table(spark, sf, "lineitem").createOrReplaceTempView(f"lines_{suffix}")
    checks = null_key_checks({f"gapped_{suffix}": "o_custkey", f"lines_{suffix}": "l_orderkey"})
    report = run_checks(spark, checks, fail_fast=False)
    return report.withColumn("query", F.replace("query", F.lit(f"_{suffix}"), F.lit("")))


QUERIES = {
    "null_counts": (null_key_counts, """
        SELECT CAST(0 AS BIGINT) AS o_orderkey,
               count(*) FILTER (o_orderstatus = 'P') AS o_custkey,
               count(*) FILTER (o_orderpriority = '5-LOW') AS o_orderdate FROM orders"""),
    "duplicate_keys": (duplicate_line_keys, """
        SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
        GROUP BY ALL HAVING count(*) > 1"""),
    "not_null_split": (not_null_split, """
        SELECT o_orderkey, o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW' AS accepted
        FROM orders"""),
    "max_length": (too_long, """
        SELECT doc_id FROM documents
        WHERE length(text) > 2000 OR length(lang) > 2 OR length(source) > 256"""),
    "conform_typed": (conform_typed, """
        SELECT event_id, CAST(user_id AS INTEGER) AS user_id, value FROM events
        WHERE event_type NOT IN ('error', 'view')"""),
    "conform_rejects": (conform_rejects, """
        SELECT CAST(event_id AS VARCHAR) AS event_id,
               CASE event_type WHEN 'error' THEN '' ELSE CAST(user_id AS VARCHAR) END AS user_id,
               CASE event_type WHEN 'view' THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS value,
               CASE event_type WHEN 'error' THEN 'user_id' ELSE 'value' END AS rejected_columns
        FROM events WHERE event_type IN ('error', 'view')"""),
    "check_report": (check_report, """
        SELECT 'SELECT count(1) FROM gapped WHERE o_custkey IS NULL' AS query, '0' AS expected,
               CAST(count(*) AS VARCHAR) AS actual, count(*) = 0 AS passed
        FROM orders WHERE o_orderstatus = 'P'
        UNION ALL
        SELECT 'SELECT count(1) FROM lines WHERE l_orderkey IS NULL', '0', '0', true"""),
}
