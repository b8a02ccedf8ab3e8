"""Files that are sent again, under another name, in another batch or cut anew.

A watermark would bound what a stream remembers, but it drops what comes later than that. Here a row
is told by its contents and its place among equal rows, and a batch meets the stored rows through
their loads' key ranges and Bloom filters: rows of another time are not read, however old a repeat
is, and no late row is lost.

Rows do not move for it. Their digests do, each with the place where its row lies; what is to be added
comes back as a bit per row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..operators.resent import AT, COPY, EVENT, MARKS, copies_of, told_apart
from ..session import scratch_path, scratch_scope
from ..sinks import load_absent, read_load
from ..sinks.keyfilters import is_set
from ..sinks.loads import current_loads, filter_of, loaded_before

# The file that a row came with, by number, and where the row lies now.
SENT, _PLACE = "__sent", "__place"
_KEYS = [AT, EVENT, COPY]
# Places of a file's rows, and rows that share a bitmap.
_FILE_ROWS, _BITS = 1 << 40, 1 << 15
# Bitmaps are copied to the executors up to this size; above it rows meet them in a shuffle.
_COPIED = 64 << 20


def append_once(batch: DataFrame, root: str, name: str, at: str, file: str, tag: str | None = None) -> str:
    """Append to a table the rows that earlier loads do not hold yet.

    A row stands in the table as often as in the file that holds it most often: repeats within a file
    are kept, a file that is sent again adds nothing, and one that is sent again with rows added adds
    these. ``file`` tells the file of a row and is not stored, ``at`` its time (NULL: 0). The table
    gets the columns of ``operators.resent.MARKS`` besides and must have been filled by this function from the start.
    """
    spark = batch.sparkSession
    if tag is not None and (done := loaded_before(spark, root, name, tag)):
        return done
    with scratch_scope(spark):
        # Parsed once; the load reads it twice.
        path = scratch_path(spark, "resent")
        sent = batch.withColumn(SENT, F.xxhash64(file)).drop(file)
        with_marks(sent, at).write.parquet(path)
        return append_marked(spark, [path], root, name, tag)


def with_marks(batch: DataFrame, at: str) -> DataFrame:
    """The rows with time and digest. The column ``SENT`` has a number for the file of each, 64 bits of a
    hash of its name."""
    return told_apart(batch, at, [c for c in batch.columns if c != SENT])


def append_marked(spark: SparkSession, paths: list[str], root: str, name: str, tag: str | None = None) -> str:
    """As :func:`append_once`, for rows of :func:`with_marks` that lie as Parquet in some folders."""
    _refuse_others(spark, root, name)
    rows = _placed(spark.read.parquet(*paths))
    with scratch_scope(spark):
        def kept(counts: DataFrame) -> DataFrame:
            path = scratch_path(spark, "counts")
            counts.write.parquet(path)
            return spark.read.parquet(path)

        marks = copies_of(rows.select(AT, EVENT, SENT, _PLACE), AT, SENT, _PLACE, kept)
        return load_absent(
            marks, root, name, _KEYS, [COPY], tag=tag, unique=True, rows_of=lambda fresh: _rows_at(rows, fresh))


def _refuse_others(spark: SparkSession, root: str, name: str) -> None:
    for load in current_loads(spark, root, name):
        said = filter_of(spark, root, name, load)
        kinds = dict(zip(said["keys"], said["types"]) if said else read_load(spark, root, name, load).dtypes)
        if kinds.get(EVENT) != "binary":
            raise ValueError(f"{name} holds loads whose rows are not told apart; stage it anew")


def _placed(rows: DataFrame) -> DataFrame:
    """Rows of Parquet files with a number for the place of each: that of its file, then its own."""
    schema = StructType([StructField("__name", StringType()), StructField("__start", LongType())])
    names = sorted({path.rsplit("/", 1)[1] for path in rows.inputFiles()})
    starts = rows.sparkSession.createDataFrame([(n, i * _FILE_ROWS) for i, n in enumerate(names)], schema)
    found = rows.select("*", F.col("_metadata.file_name").alias("__name"), F.col("_metadata.row_index").alias("__index"))
    return (
        found.join(F.broadcast(starts), "__name").withColumn(_PLACE, F.col("__start") + F.col("__index"))
        .drop("__name", "__start", "__index")
    )


def _rows_at(rows: DataFrame, fresh: DataFrame) -> DataFrame:
    """The rows at the places of ``fresh``, read where they lie, with their numbers among equal ones."""
    spark = rows.sparkSession
    path = scratch_path(spark, "fresh")
    fresh.select(_PLACE, COPY).write.parquet(path)
    fresh = spark.read.parquet(path)
    path = scratch_path(spark, "places")
    block = F.shiftright(_PLACE, 15).alias("__block")
    at = F.pmod(_PLACE, F.lit(_BITS)).cast("int")
    (
        fresh.where(F.col(COPY) == 0).select(block, at.alias("__at_bit"))
        .repartition("__block").groupBy("__block").agg(F.bitmap_construct_agg("__at_bit").alias("__bits"))
    ).write.parquet(path)
    bits = spark.read.parquet(path)
    if bits.count() * _BITS // 8 <= _COPIED:
        bits = F.broadcast(bits)
    columns = [c for c in rows.columns if c not in (SENT, _PLACE)]
    first = (
        rows.withColumn("__block", block).join(bits, "__block").where(is_set(F.col("__bits"), at))
        .select(*columns, F.lit(0).cast("bigint").alias(COPY))
    )
    more = fresh.where(F.col(COPY) > 0)
    if more.isEmpty():
        return first
    return first.unionByName(rows.join(more, _PLACE).select(*columns, COPY))


def without_marks(rows: DataFrame) -> DataFrame:
    """The rows as they came."""
    return rows.drop(*MARKS)
