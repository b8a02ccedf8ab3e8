"""Pieces that several operators share: column helpers, stored steps, tree sums of vectors."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import scratch_path, scratch_scope

# White space between words: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
BYTE_WORD = rb"[^\x20\x09-\x0D]+"
# Arrow batches of whole texts are held by the executor and by its Python worker, some of them twice.
_BATCH_BYTES = 4 << 20
_BATCH_BYTES_NAME = "spark.sql.execution.arrow.maxBytesPerBatch"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def whole_text(name: str = "text") -> Column:
    """The text; NULL counts as empty."""
    return F.coalesce(F.col(name), F.lit(""))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def lower_bytes(text: str | None) -> bytes:
    """UTF-8 with only A-Z lowered (``bytes.lower`` leaves every other byte as it is)."""
    return (text or "").encode("utf-8").lower()


def byte_words(text: str | None) -> list[bytes]:
    """The words of a text, A-Z lowered. ``bytes.split`` cuts at exactly the six blanks of WORD."""
    return lower_bytes(text).split()


def crc_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's text, modulo; NULL ids count as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % F.lit(modulus)


def pinned(value: Column) -> Column:
    """The value, in a projection that the optimiser neither merges nor pushes filters through.

    A filter on a statistic of a text would otherwise be rewritten in terms of the text, and a list
    made from it be made anew for each element that a lambda looks at.
    """
    return F.when(F.monotonically_increasing_id() >= 0, value)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once however often the body's lambdas use it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


@contextmanager
def bounded_batches(spark: SparkSession) -> Iterator[None]:
    """What runs inside hands rows to Python in batches of a few MB, unless the session says how large."""
    if _BATCH_BYTES_NAME in spark.conf.getAll:
        yield
        return
    spark.conf.set(_BATCH_BYTES_NAME, str(_BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.unset(_BATCH_BYTES_NAME)


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with bounded_batches(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def alone(spark: SparkSession, label: str, build: Callable[[], DataFrame]) -> DataFrame:
    """``stored(build(), label)``; the steps that ``build`` stores on its way are deleted."""
    path = scratch_path(spark, label)
    with scratch_scope(spark):
        rows = build()
        with bounded_batches(spark):
            rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def texts_of(batch: pa.RecordBatch, rows: int = 512) -> Iterator[list[list]]:
    """The columns of a batch as Python values, some rows at a time, so that few are held twice."""
    for low in range(0, batch.num_rows, rows):
        yield [column.to_pylist() for column in batch.slice(low, rows).columns]


def single_thread() -> None:
    """Keep native libraries in a task to the one core that Spark gave it."""
    for name in ("OMP_NUM_THREADS", "OPENBLAS_NUM_THREADS", "MKL_NUM_THREADS"):
        os.environ.setdefault(name, "1")
    os.environ["TOKENIZERS_PARALLELISM"] = "false"


def tree_sum(vectors: DataFrame, column: str, dtype: str, size: int) -> np.ndarray:
    """Sum binary vectors of one fixed size over all rows, combined in a tree of tasks.

    Every task keeps one vector, and so does the driver: ``size`` is fixed by the caller and does
    not grow with the rows.
    """
    def add_up(rows: Iterable) -> Iterator[np.ndarray]:
        total = None
        for row in rows:
            part = np.frombuffer(row[0], dtype=dtype)
            total = part.copy() if total is None else total.__iadd__(part)
        if total is not None:
            yield total

    # None is where each sum starts, as a vector of zeros would travel with every task.
    def plus(one: np.ndarray | None, two: np.ndarray | None) -> np.ndarray | None:
        return two if one is None else one if two is None else one + two

    total = None
    with bounded_batches(vectors.sparkSession):
        rdd = vectors.select(column).rdd.mapPartitions(add_up)
        if rdd.getNumPartitions():
            total = rdd.treeAggregate(None, plus, plus, 3)
    return np.zeros(size, dtype=dtype) if total is None else total


def batch_of(schema: pa.Schema, columns: dict[str, object]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], type=f.type) for f in schema], schema=schema
    )
