import pytest
from core_helpers import rows

from starling import schemas
from starling.operators import CheckFailed, run_checks
from starling.sinks import (
    append, atomic_load, drop_table, ensure_loads, ensure_table, layout, load_absent, load_upsert,
    read_loads, rebuild_all, refresh, register, write_table,
)
from starling.sinks.loads import committed_loads
from starling.sources import read_existing, read_table, register_all

SCHEMA = "k int, v string, o int"


def frame(spark, *values):
    return spark.createDataFrame(list(values), SCHEMA)


@pytest.fixture
def root(tmp_path):
    return str(tmp_path)


def test_append_then_refresh(spark, root):
    assert read_loads(spark, root, "t") is None
    append(frame(spark, (1, "a", 0)), root, "t")
    append(frame(spark, (2, "b", 0)), root, "t")
    assert rows(read_table(spark, root, "t")) == [(1, "a", 0), (2, "b", 0)]
    refresh(read_table(spark, root, "t").where("k = 2"), root, "t")
    assert rows(read_table(spark, root, "t")) == [(2, "b", 0)]
    refresh(frame(spark, (3, "c", 0)), root, "t", recreate=False)
    assert rows(read_table(spark, root, "t")) == [(2, "b", 0), (3, "c", 0)]


def test_refresh_is_idempotent(spark, root):
    for _ in range(2):
        refresh(frame(spark, (1, "a", 0)), root, "t")
    assert rows(read_table(spark, root, "t")) == [(1, "a", 0)]


def test_tagged_load_happens_once(spark, root):
    for _ in range(3):
        append(frame(spark, (1, "a", 0)), root, "t", tag="b.1")
    assert read_table(spark, root, "t").count() == 1


def test_failed_load_changes_nothing_and_raises(spark, root):
    atomic_load(frame(spark, (1, "a", 0)), root, "t")

    def refuse(rows_):
        raise CheckFailed("no")

    with pytest.raises(CheckFailed):
        atomic_load(frame(spark, (2, "b", 0)), root, "t", recreate=True, check=refuse)
    bad = frame(spark, (2, "b", 0)).selectExpr("k", "raise_error('x') AS v", "o")
    with pytest.raises(Exception):
        atomic_load(bad, root, "t")
    assert rows(read_table(spark, root, "t")) == [(1, "a", 0)]
    assert len(committed_loads(spark, root, "t")) == 1
    atomic_load(frame(spark, (3, "c", 0)), root, "t")
    assert rows(read_table(spark, root, "t")) == [(1, "a", 0), (3, "c", 0)]


def test_more_than_ten_loads_stay_in_order(spark, root):
    for i in range(11):
        refresh(frame(spark, (i, "a", 0)), root, "t")
    assert rows(read_table(spark, root, "t")) == [(10, "a", 0)]


def test_partitioned_loads_recover_their_columns(spark, root):
    append(frame(spark, (1, "a", 2018), (2, "b", 2019)), root, "t", partition_by=["o"])
    append(frame(spark, (3, "c", 2019)), root, "t", partition_by=["o"])
    table = read_table(spark, root, "t")
    assert rows(table, "k", "o") == [(1, 2018), (2, 2019), (3, 2019)]
    assert set(table.columns) == {"k", "v", "o"}


def test_load_absent(spark, root):
    load_absent(frame(spark, (1, "a", 2), (1, "b", 1), (None, "n", 0)), root, "t", ["k"], ["o"])
    load_absent(frame(spark, (1, "c", 0), (2, "d", 0)), root, "t", ["k"], ["o"])
    assert rows(read_table(spark, root, "t")) == [(None, "n", 0), (1, "b", 1), (2, "d", 0)]


def test_load_upsert(spark, root):
    load_upsert(frame(spark, (1, "a", 1), (1, "b", 2)), root, "t", ["k"], ["o"])
    load_upsert(frame(spark, (1, "c", 0), (2, "d", 0)), root, "t", ["k"], ["o"])
    assert rows(read_table(spark, root, "t")) == [(1, "c", 0), (2, "d", 0)]


def test_ensure_loads_and_read_existing(spark, root):
    assert rows(read_existing(spark, root, "users", schemas.USERS)) == []
    ensure_loads(spark, root, schemas.targets("relational"))
    ensure_loads(spark, root, schemas.targets("relational"))
    assert len(committed_loads(spark, root, "time")) == 1
    stored = read_existing(spark, root, "time", schemas.TIME)
    assert stored.schema["start_time"].dataType.simpleString() == "bigint" and stored.count() == 0


def test_plain_write_modes(spark, root):
    write_table(frame(spark, (1, "a", 1), (2, "b", 2)), root, "p", ["o"])
    write_table(frame(spark, (3, "c", 1)), root, "p", ["o"], mode="append")
    assert rows(read_table(spark, root, "p"), "k", "o") == [(1, 1), (2, 2), (3, 1)]
    write_table(frame(spark, (4, "d", 1)), root, "p", [])
    assert rows(read_table(spark, root, "p"), "k") == [(4,)]


def test_one_hot_directory_is_split_over_several_files(spark, root):
    hot = spark.range(4000).selectExpr("CAST(id AS INT) AS k", "'x' AS v", "1 AS o")
    # At this size the runtime would rightly merge the small tasks again.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    write_table(hot, root, "hot", ["o"], files_per_partition=4)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    table = read_table(spark, root, "hot")
    per_file = [r["n"] for r in table.groupBy("_metadata.file_path").count()
                .withColumnRenamed("count", "n").collect()]
    assert len(per_file) <= 4 and len(per_file) > 1 and sum(per_file) == 4000


def test_catalog_tables(spark, root):
    ensure_table(spark, "cat_users", schemas.USERS, location=f"{root}/cat_users")
    spark.sql("INSERT INTO cat_users VALUES (1, 'a', 'b', 'F', 'free')")
    ensure_table(spark, "cat_users", schemas.USERS, location=f"{root}/cat_users")
    assert spark.table("cat_users").count() == 1
    rebuild_all(spark, {"cat_users": schemas.USERS}, f"{root}/again")
    assert spark.table("cat_users").count() == 0
    drop_table(spark, "cat_users")
    drop_table(spark, "cat_users")
    assert not spark.catalog.tableExists("cat_users")
    ensure_table(spark, "cat_parts", schemas.USERS, ["level"], f"{root}/cat_parts")
    assert spark.table("cat_parts").columns[-1] == "level"


def test_layout_spreads_a_hot_bucket(spark, root):
    hot = spark.range(3000).selectExpr("CAST(IF(id % 3 = 0, 7, id) AS INT) AS k", "CAST(id AS INT) AS i")
    saved = layout(hot, "hot_layout", ["k"], ["i"], 4, files_per_bucket=3, location=f"{root}/hot")
    assert rows(saved) == rows(hot)
    files = saved.where("k = 7").select("_metadata.file_path").distinct().count()
    assert files > 1
    drop_table(spark, "hot_layout")


def test_layout_splits_a_hot_key_by_size(spark, root):
    """With the defaults, and equal rows only."""
    hot = spark.range(0, 60_000, 1, 6).selectExpr("CAST(IF(id % 3 = 0, id, 7) AS INT) AS k", "'same' AS v")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    saved = layout(hot, "hot_default", ["k"], buckets=4, location=f"{root}/hot_default")
    spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert saved.groupBy("k").count().where("k = 7").first()["count"] == 40_000
    assert saved.where("k = 7").select("_metadata.file_path").distinct().count() > 1
    drop_table(spark, "hot_default")


def test_load_tables_are_dropped_rebuilt_and_compacted(spark, root):
    from starling.sinks import compact_loads, drop_loads, rebuild_loads
    schema = spark.createDataFrame([], SCHEMA).schema
    for i in range(4):
        append(frame(spark, (i, "a", 0)), root, "t")
    compact_loads(spark, root, "t")
    assert len(committed_loads(spark, root, "t")) == 1
    append(frame(spark, (9, "a", 0)), root, "t")
    assert rows(read_table(spark, root, "t"), "k") == [(0,), (1,), (2,), (3,), (9,)]
    rebuild_loads(spark, root, {"t": schema})
    assert rows(read_table(spark, root, "t")) == []
    drop_loads(spark, root, "t")
    assert read_loads(spark, root, "t") is None


def test_register_and_checks(spark, root):
    refresh(frame(spark, (1, "a", 0), (None, "b", 0)), root, "reg_t")
    register_all(spark, root, ["reg_t"])
    register(frame(spark, (1, "a", 0)), "reg_v")
    checks = [
        {"query": "SELECT count(1) FROM reg_v WHERE k IS NULL", "expected_result": 0},
        {"query": "SELECT k FROM reg_v WHERE k = 99", "expected_result": 5},  # no rows: passes
        {"query": "SELECT count(1) FROM reg_t WHERE k IS NULL", "expected_result": 0},
        {"query": "SELECT nonsense FROM nowhere", "expected_result": 0},
    ]
    with pytest.raises(CheckFailed, match="expected 0, got 1"):
        run_checks(spark, checks)  # stops before the query that cannot run
    report = run_checks(spark, checks[:3], fail_fast=False)
    assert [(r["actual"], r["passed"]) for r in report.collect()] == [
        ("0", True), (None, True), ("1", False)]
