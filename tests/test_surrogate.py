import pytest
from core_helpers import rows
from pyspark.sql import functions as F

from starling.operators import surrogate_key


@pytest.mark.parametrize("partitions", [1, 3, 7])
def test_dense_numbers_follow_the_order(spark, partitions):
    df = spark.range(500).select((F.lit(1000) - F.col("id")).alias("k")).repartition(partitions)
    got = [tuple(r) for r in surrogate_key(df, ["k"], "id", start=11).orderBy("k").collect()]
    assert got == [(i + 11, k) for i, k in enumerate(range(501, 1001))]


def test_dense_numbers_without_an_order(spark):
    df = spark.range(300).repartition(5).select((F.col("id") % 3).alias("k"))
    numbered = surrogate_key(df)
    assert sorted(r["id"] for r in numbered.collect()) == list(range(1, 301))
    assert rows(numbered) == rows(numbered)
    assert numbered.groupBy("k").count().where("count = 100").count() == 3


def test_numbers_do_not_change_between_evaluations(spark):
    df = spark.range(400).repartition(6).withColumn("r", F.rand())
    numbered = surrogate_key(df, ["r"], "n")
    assert rows(numbered) == rows(numbered)
    assert rows(numbered.where("n <= 10")) == rows(numbered)[:10]


def test_ties_and_nulls_still_get_one_number_each(spark):
    df = spark.createDataFrame([(None,), (None,), (1,), (1,)], "k int")
    assert rows(surrogate_key(df, ["k"])) == [(1, None), (2, None), (3, 1), (4, 1)]


def test_equal_rows_do_not_share_one_slice(spark, monkeypatch):
    """A third of the rows are copies of one row; they are numbered by several tasks."""
    from starling.operators import surrogate
    paths = []
    write = surrogate._write_positions
    monkeypatch.setattr(surrogate, "_write_positions", lambda df, p: (paths.append(p), write(df, p)))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df = spark.range(6000).selectExpr("IF(id % 3 = 0, 7, id + 10) AS k", "'x' AS v").repartition(5)
    numbered = surrogate_key(df, ["k", "v"], "n")
    got = rows(numbered.select("n", "k"))
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [r[0] for r in got] == list(range(1, 6001))
    assert [r[1] for r in got] == sorted(r[1] for r in got)
    per_slice = spark.read.parquet(paths[0]).where("k = 7").groupBy("__starling_slice").count()
    assert per_slice.count() > 1


def test_no_rows(spark):
    assert surrogate_key(spark.createDataFrame([], "k int"), ["k"]).count() == 0


def test_hash_is_a_function_of_the_key(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string")
    got = rows(surrogate_key(df, ["k"], dense=False))
    assert len({r[0] for r in got}) == 2
