"""Files of bounded size, and tasks that share a write evenly."""

import re

import numpy as np
import pyarrow as pa
import pytest
from core_helpers import physical, rows

from starling.operators import absent_rows
from starling.session import scratch_path
from starling.sinks import drop_table, layout, write_csv, write_table
from starling.sources import quoted, read_csv_dir, read_json
from starling.workloads.stand_ins import plays
from starling.workloads.whole_jobs import _deliver, _write_json


def tasks(df):
    """The numbers of the tasks that wrote a table's files."""
    files = df.select("_metadata.file_name").distinct().collect()
    return sorted({int(re.match(r"part-(\d+)", r[0]).group(1)) for r in files})


def counts(df):
    return [r["count"] for r in df.groupBy("_metadata.file_name").count().collect()]


def test_every_slot_of_a_bucket_has_a_task(spark, tmp_path):
    lines = spark.range(4000).selectExpr("id AS k", "id % 7 AS v")
    saved = layout(lines, "dealt_layout", ["k"], ["v"], 8, files_per_bucket=2, location=str(tmp_path / "t"))
    assert tasks(saved) == list(range(16)) and rows(saved) == rows(lines)
    drop_table(spark, "dealt_layout")


def test_large_directories_do_not_share_a_task(spark, tmp_path):
    lines = spark.range(40_000).selectExpr("id AS k", "id % 20 AS o")
    conf = {"spark.sql.shuffle.partitions": "200", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {key: spark.conf.get(key) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    write_table(lines, str(tmp_path), "t", ["o"], files_per_partition=2)
    for key, value in before.items():
        spark.conf.set(key, value)
    saved = spark.read.parquet(str(tmp_path / "t"))
    assert len(tasks(saved)) == 40 and rows(saved, "k", "o") == rows(lines, "k", "o")


def test_raw_files_are_compressed_and_bounded(spark):
    lines = spark.range(0, 1000, 1, 2).selectExpr("id", "cast(id AS string) AS v")
    path = scratch_path(spark, "raw")
    _write_json(lines, path, per_file=300)
    names = [r[0] for r in read_json(spark, path).select("_metadata.file_name").distinct().collect()]
    assert len(names) == 4 and all(n.endswith(".json.gz") for n in names)
    assert rows(read_json(spark, path, lines.schema)) == rows(lines)


@pytest.mark.parametrize("parts, per_file, least", [(1, 10_000, 3), (30, 100, 10)])
def test_a_delivery_has_three_files_or_more_that_are_bounded(spark, parts, per_file, least):
    lines = spark.range(0, 1000, 1, parts)
    path = scratch_path(spark, "delivery")
    _deliver(lines, path, per_file, compressed=True)
    found = counts(read_json(spark, path, lines.schema))
    assert len(found) >= least and max(found) <= 3 * per_file // 2 and sum(found) == 1000


def test_csv_files_are_compressed_and_bounded(spark, tmp_path):
    lines = spark.range(0, 1000, 1, 2).selectExpr("id", "concat('a', chr(10), id) AS v")
    path = write_csv(lines, str(tmp_path / "csv"), compression="gzip", max_records_per_file=300)
    assert len(list((tmp_path / "csv").glob("*.csv.gz"))) == 4
    assert rows(read_csv_dir(spark, path, lines.schema)) == rows(lines)


def test_states_of_lines_by_columns():
    draw = np.random.default_rng(0)
    for n in (1, 2, 50):
        opens, stays = draw.integers(0, 2, n) > 0, draw.integers(0, 2, n) > 0
        lines = pa.RecordBatch.from_pydict({"opens": pa.array(opens), "stays": pa.array(stays)})
        for state in (False, True):
            found, expected, now = quoted._states(lines, state), [], state
            for a, b in zip(opens, stays):
                now = bool(b if now else a)
                expected.append(now)
            assert found.tolist() == expected


def test_rows_with_keys_of_their_own_are_not_brought_together(spark):
    batch = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    stored = batch.where("k = 2")
    fresh = absent_rows(stored, batch, ["k"], ["v"], nulls_distinct=False, unique=True)
    assert rows(fresh) == [(1, "a"), (3, "c")] and "Window" not in physical(fresh)
    assert physical(absent_rows(None, batch, ["k"], ["v"], unique=True)).count("Exchange") == 0


def test_only_raw_columns_of_a_line_move_to_their_part(spark, tmp_path):
    spark.sql("""SELECT id AS l_orderkey, id % 5 AS l_partkey, id % 3 AS l_suppkey, 1 AS l_linenumber,
                 'A' AS l_returnflag, 'F' AS l_linestatus, TIMESTAMP_NTZ '1995-01-01' AS l_shipdate
                 FROM range(20)""").write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.sql("SELECT id AS p_partkey, 'b' AS p_brand, 1.5D AS p_retailprice FROM range(5)").write.parquet(
        str(tmp_path / "part.parquet"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    found = plays(spark, str(tmp_path))
    plan = physical(found)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Join" in plan and plan.index("concat(First") < plan.index("Join") and found.count() == 20
