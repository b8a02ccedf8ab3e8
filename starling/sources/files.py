"""Scans of raw files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from .quoted import any_line_end_in_quotes, read_split

_CSV = {"encoding": "UTF-8", "quote": '"', "escape": '"'}


def read_json(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | None = None,
    recursive: bool = False,
    pattern: str | None = None,
) -> DataFrame:
    """JSON lines from a path, a glob, or (``recursive``) a whole tree filtered by file name.

    Give a schema where it is known: inferring one reads the entire input first.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.json(path)


def read_csv_dir(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    pattern: str | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """All CSV files of a tree: UTF-8, a header line in each, quoted fields may hold commas.

    Columns go by the names in the header, in any order; those of ``schema`` are typed, a value that
    does not parse becoming NULL, and others left out. A name that no header holds raises, as does a
    file whose header differs from the first one's: nothing is ever taken by position. Without a
    schema every column is read as text, which is what the files hold.

    Quoted fields may hold line ends. A file is split among tasks all the same (see
    :mod:`starling.sources.quoted`), at the cost of a scan that looks for such line ends;
    ``multi_line=False`` spares it where there are none. Records end with a line feed, or with a
    carriage return and a line feed; line ends in fields stay as they are.
    """
    split = multi_line and any_line_end_in_quotes(spark, path, pattern)
    reader = (
        spark.read.option("header", True).option("recursiveFileLookup", True).options(**_CSV)
        .option("multiLine", split).option("enforceSchema", False)
    )
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    text = reader.csv(path)
    if split:
        text = read_split(spark, path, text.columns, pattern, **_CSV)
    else:
        # With the columns spelled out, every file's header is compared with them.
        text = reader.schema(text.schema).csv(path)
    if schema is None:
        return text
    if missing := [f.name for f in schema if f.name not in text.columns]:
        raise ValueError(f"no column {', '.join(missing)} in the header of {path}")
    return text.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema])
