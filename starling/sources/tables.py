"""Reading tables back."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..sinks.loads import read_loads


def read_table(
    spark: SparkSession, root: str, name: str, schema: StructType | None = None
) -> DataFrame:
    """A Parquet table below ``root``; partition columns come back from the directory names."""
    loaded = read_loads(spark, root, name, schema)
    if loaded is not None:
        return loaded
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{root.rstrip('/')}/{name}")


def read_existing(spark: SparkSession, root: str, name: str, schema: StructType) -> DataFrame:
    """The stored rows of a target, or no rows when it has not been written yet."""
    try:
        return read_table(spark, root, name)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], schema)


def register_all(spark: SparkSession, root: str, names: Iterable[str]) -> None:
    """Make tables available to SQL under their own names."""
    for name in names:
        read_table(spark, root, name).createOrReplaceTempView(name)
