"""The physical plans the operators rely on, and their behaviour under a hot key."""

import re

import pytest
from core_helpers import optimized, physical, rows
from pyspark.sql import functions as F

from starling import operators as O
from starling import plans as P
from starling.functions import epoch_ms, epoch_s, time_parts
from starling.sinks import drop_table, write_table
from starling.sources import read_table
from starling.workloads import registered

SF = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_filters_and_columns_reach_the_scan(spark):
    plan = physical(registered()["filter_plays"][0](spark, SF))
    assert "EqualTo(event_type,purchase)" in plan
    assert "props" not in plan.split("ReadSchema")[1]


def test_time_functions_stay_in_generated_code(spark):
    df = spark.range(10).select((F.col("id") * 1000).alias("ts"))
    plan = physical(time_parts(df.select(epoch_ms("ts").alias("start_time"), epoch_s("ts"))))
    assert "EvalPython" not in plan and plan.startswith("*(1) Project")


def test_dedup_limits_groups_before_the_shuffle(spark):
    plan = physical(O.dedup(spark.range(10).withColumn("k", F.col("id") % 3), ["k"], ["id"]))
    below = plan.split("Exchange")[1]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_counts_are_partial_before_the_shuffle(spark):
    plan = physical(O.plays_by(spark.read.parquet(f"{SF}/orders.parquet"), ["o_orderstatus"]))
    assert "partial_count" in plan


def test_not_in_never_becomes_a_broadcast_nested_loop(spark, no_broadcast):
    batch, stored = spark.range(100).withColumnRenamed("id", "k"), spark.range(50)
    plan = physical(O.not_in(batch, stored, "k", "id"))
    assert "NestedLoop" not in plan and "BroadcastHashJoin" not in plan and "LeftAnti" in plan


def test_matching_is_an_equi_join_without_broadcast_too(spark, no_broadcast):
    for name in ("match_exact", "match_lower", "match_left_guard", "match_first", "match_rounded"):
        plan = physical(registered()[name][0](spark, SF))
        assert "Cartesian" not in plan and "NestedLoop" not in plan, name


def test_no_registered_plan_holds_a_product_or_python(spark):
    names = ["top5_artists", "paid_by_month", "paid_users_by_hour", "fact_plays_lake",
             "fact_plays_scheduled", "hist_user", "insert_if_absent", "upsert_last", "dim_time_lake"]
    for name in names:
        plan = physical(registered()[name][0](spark, SF))
        assert "Cartesian" not in plan and "NestedLoop" not in plan and "EvalPython" not in plan, name


def test_artist_report_counts_before_it_joins(spark, no_broadcast):
    plan = optimized(registered()["top5_artists"][0](spark, SF))
    assert plan.index("Join") < plan.rindex("Aggregate")


def test_upsert_moves_no_stored_row_for_a_small_batch(spark):
    stored = spark.read.parquet(f"{SF}/orders.parquet")
    plan = physical(O.upsert(stored, stored.limit(5), ["o_orderkey"], ["o_orderdate"]))
    assert "LeftAnti, BuildRight" in plan


def test_partition_pruning(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "2018 + CAST(id % 3 AS INT) AS year")
    write_table(df, str(tmp_path), "t", ["year"])
    plan = physical(read_table(spark, str(tmp_path), "t").where("year = 2019"))
    assert "PartitionFilters: [isnotnull(year" in plan


def test_point_lookup_opens_one_bucket(spark, tmp_path):
    history = spark.range(1000).selectExpr(
        "CAST(id % 50 AS INT) AS session_id", "CAST(id AS INT) AS item_in_session", "'a' AS artist",
        "'s' AS song", "1.0D AS length")
    table = P.save_serving(history, "song_session_history", "ssh", 8, location=str(tmp_path / "h"))
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        plan = physical(P.session_item(table, 7, 57))
        assert "SelectedBucketsCount: 1 out of 8" in plan
        assert P.session_item(table, 7, 57).count() == 1
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
        drop_table(spark, "ssh")


def test_point_lookup_reads_no_other_bucket(spark, tmp_path):
    """Also where the plan does not spell it out: the other buckets' files can be gone."""
    history = spark.range(1000).selectExpr(
        "CAST(id % 50 AS INT) AS session_id", "CAST(id AS INT) AS item_in_session", "'a' AS artist",
        "'s' AS song", "1.0D AS length")
    table = P.save_serving(history, "song_session_history", "ssh2", 8, location=str(tmp_path / "h"))
    used = {r["f"].rsplit("/", 1)[1] for r in table.where("session_id = 7")
            .select(F.col("_metadata.file_path").alias("f")).distinct().collect()}
    hits = P.session_item(table, 7, 57)
    assert hits.count() == 1 and len(used) == 1
    for file in (tmp_path / "h").glob("part-*.parquet"):
        if file.name not in used:
            file.unlink()
    assert P.session_item(table, 7, 57).count() == 1
    drop_table(spark, "ssh2")


def test_tables_with_one_layout_join_without_a_shuffle(spark, tmp_path, no_broadcast):
    from starling.sinks import layout
    df = spark.range(1000).selectExpr("CAST(id AS INT) AS k", "id AS v")
    left = layout(df, "lay_a", ["k"], ["k"], 4, location=str(tmp_path / "a"))
    right = layout(df.withColumnRenamed("v", "w"), "lay_b", ["k"], ["k"], 4, location=str(tmp_path / "b"))
    plan = physical(left.join(right, "k"))
    assert "Exchange" not in plan
    drop_table(spark, "lay_a")
    drop_table(spark, "lay_b")


@pytest.fixture(scope="module")
def hot(spark):
    """Plays of which a third are of one song, and a third have no song at all."""
    return spark.range(30_000).selectExpr(
        "CASE id % 3 WHEN 0 THEN 'hot' WHEN 1 THEN CONCAT('s', id % 97) END AS song",
        "CASE id % 3 WHEN 0 THEN 'a' WHEN 1 THEN CONCAT('a', id % 97) END AS artist",
        "1.0D AS length", "CAST(id % 11 AS INT) AS userId", "id AS ts")


def test_hot_key_match_equals_brute_force(spark, hot, no_broadcast):
    entries = [("hot", "a", "S0"), *[(f"s{i}", f"a{i}", f"S{i}") for i in range(50)]]
    songs = spark.createDataFrame([(t, a, 1.0, s, s) for t, a, s in entries],
                                  "title string, artist_name string, duration double, song_id string, artist_id string")
    skewed = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
              "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
              "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    for key, value in skewed.items():
        spark.conf.set(key, value)
    try:
        matched = O.match_plays(hot.repartition(4), songs, "left").select("ts", "song_id")
        got = {tuple(r) for r in matched.collect()}
        plan = physical(matched)
    finally:
        for key in skewed:
            spark.conf.unset(key)
    ids = {(t, a): s for t, a, s in entries}
    expected = {(r["ts"], ids.get((r["song"], r["artist"]))) for r in hot.collect()}
    assert got == expected
    assert "skew=true" in plan


def test_hot_group_counts_and_dedup_equal_brute_force(hot):
    found = hot.collect()
    counts = {}
    first = {}
    for r in found:
        counts[r["song"]] = counts.get(r["song"], 0) + 1
        first[r["song"]] = min(first.get(r["song"], r["ts"]), r["ts"])
    assert dict(rows(O.plays_by(hot, ["song"]))) == counts
    assert dict(rows(O.dedup(hot, ["song"], ["ts"]), "song", "ts")) == first


def test_a_small_batch_moves_no_stored_row(spark, tmp_path):
    """The batch's keys are copied to where the stored rows are read, and only keys that meet go on."""
    from starling.operators import absent_rows, only_new
    spark.range(50_000).selectExpr("id AS k", "id AS v").write.parquet(str(tmp_path / "stored"))
    spark.range(5).selectExpr("id * 20000 AS k", "id AS v").write.parquet(str(tmp_path / "batch"))
    stored, batch = (spark.read.parquet(str(tmp_path / n)) for n in ("stored", "batch"))
    for fresh in (only_new(batch, stored, ["k"]), absent_rows(stored, batch, ["k"], ["v"])):
        plan = physical(fresh)
        assert re.search(r"BroadcastHashJoin \[\w+#\d+L\], \[__written_k#\d+L\], LeftSemi, BuildRight", plan)
        assert sorted(r.k for r in fresh.collect()) == [60_000, 80_000]


def test_relational_plays_match_the_log_once(spark, tmp_path):
    from starling.plans import build_songplays
    log = spark.range(10).selectExpr(
        "'NextSong' AS page", "id AS ts", "'s' AS song", "'a' AS artist", "1.0D AS length", "1 AS userId",
        "'free' AS level", "1 AS sessionId", "'l' AS location", "'u' AS userAgent")
    log.write.parquet(str(tmp_path / "log"))
    entries = spark.createDataFrame(
        [("S1", "s", "A1", "a", 1.0)], "song_id string, title string, artist_id string, artist_name string, duration double")
    fact = build_songplays(
        spark.read.parquet(str(tmp_path / "log")), entries, variant="relational", entries=entries, surrogate=False)
    assert physical(fact).count("FileScan parquet") == 1
    assert fact.count() == 10
