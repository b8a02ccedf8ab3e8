"""Catalog tables: creation and removal with a fixed schema, bucketed layout, temporary views."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def _ddl(schema: StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def ensure_table(
    spark: SparkSession,
    name: str,
    schema: StructType,
    partition_by: Iterable[str] = (),
    location: str | None = None,
) -> None:
    """Create a Parquet table unless it exists."""
    partitions = ", ".join(f"`{c}`" for c in partition_by)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_quoted(name)} ({_ddl(schema)}) USING parquet"
        + (f" PARTITIONED BY ({partitions})" if partitions else "")
        + (f" LOCATION '{location}'" if location else "")
    )


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(name)}")


def rebuild_all(
    spark: SparkSession, tables: Mapping[str, StructType], root: str | None = None
) -> None:
    """Drop and create every table; with ``root`` as external tables below that path."""
    for name, schema in tables.items():
        drop_table(spark, name)
        ensure_table(spark, name, schema, location=f"{root}/{name}" if root else None)


def register(df: DataFrame, name: str) -> DataFrame:
    """Make a result available to SQL under ``name``."""
    df.createOrReplaceTempView(name)
    return df


def layout(
    df: DataFrame,
    name: str,
    dist: Iterable[str],
    sort: Iterable[str] = (),
    buckets: int = 64,
    files_per_bucket: int | None = None,
    location: str | None = None,
) -> DataFrame:
    """Save as a table hash-distributed on ``dist`` and sorted on ``sort`` in every file.

    Tables with the same ``dist`` and ``buckets`` join on it without a shuffle, and a lookup on it
    opens one bucket. Rows are rebalanced by bucket: the number of writing tasks follows from the
    size of the table, and a bucket above the advisory size is cut, equal rows included, so that a
    key holding a large share of the rows is not written by one task. ``files_per_bucket`` deals
    each bucket over that many tasks instead.
    """
    dist, sort = list(dist), list(sort)
    bucket = F.pmod(F.hash(*dist), F.lit(buckets))
    if files_per_bucket is None:
        keyed = df.withColumn("__bucket", bucket).hint("rebalance", "__bucket")
        # A task holds several buckets; sorted by bucket, it writes one file at a time.
        dealt = keyed.sortWithinPartitions("__bucket", *sort).drop("__bucket")
    else:
        # The number itself says which task: a hash of it would bring some of them together.
        slot = F.floor(F.rand(0) * files_per_bucket).cast("int")
        dealt = df.repartitionById(buckets * files_per_bucket, bucket * files_per_bucket + slot)
    out = dealt.write.format("parquet").bucketBy(buckets, *dist)
    if sort:
        out = out.sortBy(*sort)
    if location:
        out = out.option("path", location)
    out.mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)
