"""Plain file sinks: partitioned Parquet, and CSV."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, DataFrameWriter, functions as F


def spread(
    df: DataFrame,
    partition_by: Iterable[str] = (),
    files_per_partition: int | None = None,
    sort: Iterable[str] = (),
) -> DataFrame:
    """Arrange rows for a write, so that a directory gets few files and no task gets a whole one.

    By default rows are rebalanced on the partition columns: a directory up to the advisory size gets
    one file and a larger one is cut there. ``files_per_partition`` above 1 sets the upper number
    instead, dealing the rows of a directory over that many tasks, equal rows too; 1 asks for what
    the default does, also without partition columns, as one task should not write a large table: a
    directory above the advisory size then still gets several files.
    """
    partition_by, sort = list(partition_by), list(sort)
    if files_per_partition is not None and files_per_partition > 1:
        if partition_by:
            # By ranges, as a hash brings the rows of some directories together in one task.
            df = df.repartitionByRange(*partition_by, F.floor(F.rand(0) * files_per_partition))
        else:
            df = df.repartition(files_per_partition)
    elif partition_by or files_per_partition == 1:
        df = df.hint("rebalance", *partition_by)
    return df.sortWithinPartitions(*partition_by, *sort) if sort else df


def writer(
    df: DataFrame,
    partition_by: Iterable[str] = (),
    files_per_partition: int | None = None,
    sort: Iterable[str] = (),
    max_records_per_file: int | None = None,
) -> DataFrameWriter:
    partition_by = list(partition_by)
    out = spread(df, partition_by, files_per_partition, sort).write
    if max_records_per_file:
        out = out.option("maxRecordsPerFile", max_records_per_file)
    return out.partitionBy(*partition_by) if partition_by else out


def write_table(
    df: DataFrame,
    root: str,
    name: str,
    partition_by: Iterable[str] = (),
    mode: str = "overwrite",
    files_per_partition: int | None = None,
    sort: Iterable[str] = (),
    max_records_per_file: int | None = None,
) -> str:
    """Write Parquet to ``root/name``, partitioned or not. Returns the path.

    ``files_per_partition`` is an upper number above 1, and a wish at 1 (see :func:`spread`).
    The write replaces files in place: to change a table that is being read, or to load all or
    nothing, use :mod:`starling.sinks.loads`.
    """
    path = f"{root.rstrip('/')}/{name}"
    out = writer(df, partition_by, files_per_partition, sort, max_records_per_file)
    out.mode(mode).parquet(path)
    return path


def write_csv(
    df: DataFrame, path: str, mode: str = "overwrite", compression: str = "none",
    max_records_per_file: int = 0,
) -> str:
    """CSV with a header in every file and every field quoted and its blanks kept; NULL becomes an
    empty field. A reader cannot split compressed files, so bound them by ``max_records_per_file``."""
    (
        df.write.mode(mode).option("compression", compression)
        .option("maxRecordsPerFile", max_records_per_file)
        .option("header", True).option("quoteAll", True).option("escape", '"')
        .option("emptyValue", "").option("nullValue", "").option("encoding", "UTF-8")
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path
