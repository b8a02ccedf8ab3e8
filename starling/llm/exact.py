"""Exact duplicates by a tree merge of sorted digest runs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.joins import replicate
from .common import alone, stored, whole_text

# monotonically_increasing_id() holds the task's number above the row's 33 bits.
_TASK_BIT = 33
_RUN = ["digest", "size", "check", "doc_id", "row", "copies", "at"]


def normalised(text: Column) -> Column:
    """Every run of blanks as one space. Only runs that differ from a single space are touched."""
    return F.regexp_replace(text, r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def merge_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per digest out of rows sorted by digest and identifier: the first, copies added up.

    Equal digests are verified by the text's length and a second hash. Holds one batch and the
    last digest's row, whatever the size of the run.
    """
    carry: pa.RecordBatch | None = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        batch = pa.RecordBatch.from_arrays(batch.columns, names=batch.schema.names)
        table = pa.Table.from_batches([batch] if carry is None else [carry, batch])
        rows = table.combine_chunks().to_batches()[0]
        new = np.ones(rows.num_rows, dtype=bool)
        digest = rows.column("digest")
        at = rows.column("at").to_numpy()
        same = pc.equal(digest[1:], digest[:-1]).to_numpy(zero_copy_only=False)
        same &= at[1:] == at[:-1]
        for name in ("size", "check"):
            other = rows.column(name)
            agrees = pc.equal(other[1:], other[:-1]).to_numpy(zero_copy_only=False)
            if (same & ~agrees).any():
                raise ValueError("different texts share a digest")
        new[1:] = ~same
        first = np.flatnonzero(new)
        copies = np.add.reduceat(rows.column("copies").to_numpy(), first)
        merged = rows.take(pa.array(first))
        merged = merged.set_column(
            merged.schema.get_field_index("copies"), "copies", pa.array(copies, pa.int64())
        )
        yield merged.slice(0, merged.num_rows - 1)
        carry = merged.slice(merged.num_rows - 1)
    if carry is not None:
        yield carry


def _runs(rows: DataFrame) -> DataFrame:
    """Each partition's rows as one sorted run without repeated digests."""
    order = ["at", "digest", F.col("doc_id").asc_nulls_last(), "row"]
    return rows.select(*_RUN).sortWithinPartitions(*order).mapInArrow(
        merge_sorted, rows.select(*_RUN).schema
    )


def tree_merge(leaves: DataFrame, partitions: int, fan_in: int, rounds: int) -> DataFrame:
    """Merge the leaves' runs until every digest has one row.

    A digest's home is a number of ``rounds`` digits in base ``fan_in``. In round r every partition
    deals its run to the ``fan_in`` partitions that differ from it in digit r only and have the
    home's digit there (with a fan-in of two: the binomial exchange), and merges what it receives.
    Partial winners leave each level, so a digest takes at most one row per partition and level.
    """
    home = F.pmod(F.conv(F.hex(F.substring("digest", 1, 6)), 16, 10).cast("long"), F.lit(partitions))
    runs = leaves
    for r in range(rounds):
        step = fan_in**r
        digit = lambda c: F.pmod(F.floor(c / F.lit(step)), F.lit(fan_in)) * F.lit(step)
        at = (F.col("at") - digit(F.col("at")) + digit(home)).cast("int")
        runs = _runs(runs.withColumn("at", at).repartitionById(partitions, F.col("at")))
    return runs


def exact_duplicates(docs: DataFrame, fan_in: int = 4, partitions: int | None = None) -> DataFrame:
    """Which document stays of all with the same text.

    Texts are equal when they are identical after each run of blanks became one space; a NULL text
    counts as empty. Of equal texts the row with the smallest ``doc_id`` stays (NULL ids last); of
    several rows with that same id exactly one stays. Every row of ``docs`` gets a row: ``doc_id,
    keep_id, group_size, kept, text_sha256, row``. An empty table gives no rows; columns other than
    ``doc_id`` and ``text`` are not looked at.

    Partitions sort their digests into runs and exchange them in rounds (``tree_merge``). The way
    back is salted by the leaf that a row came from, so a group with a third of all rows returns to
    as many partitions as held it.
    """
    spark = docs.sparkSession
    wanted = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rounds = 1
    while fan_in**rounds < wanted:
        rounds += 1
    count = fan_in**rounds
    text = normalised(whole_text())
    rows = stored(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            text.alias("norm"),
        ).select(
            "doc_id",
            F.unhex(F.sha2("norm", 256)).alias("digest"),
            F.octet_length("norm").cast("long").alias("size"),
            F.xxhash64("norm").alias("check"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "digests",
    ).withColumn("at", F.pmod(F.shiftright("row", _TASK_BIT), F.lit(count)).cast("int"))
    leaves = stored(_runs(rows.withColumn("copies", F.lit(1).cast("long"))), "runs")
    winners = tree_merge(leaves, count, fan_in, rounds).where("copies > 1").select(
        "digest", F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row"), "copies"
    )
    # Tasks share a leaf's number, or a leaf is read back by several: its digests may then stand twice.
    back = leaves.select("at", "digest").join(winners, "digest").dropDuplicates(["at", "digest"])
    return rows.join(back, ["at", "digest"], "left").select(
        "doc_id",
        F.when(F.col("copies").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("copies", F.lit(1).cast("long")).alias("group_size"),
        F.coalesce(F.col("row") == F.col("keep_row"), F.lit(True)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "row",
    )


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``exact_duplicates`` keeps, with all their columns.

    Texts stay where they are: the dropped rows' keys go to them, copied to the executors up to
    64 MB by measurement and joined by a shuffle above that. Of rows that agree in id and text any
    one stays.
    """
    keys = ["__key_id", "__key_null", "__key_digest"]
    found = alone(docs.sparkSession, "dropped", lambda: (
        exact_duplicates(docs).where("NOT kept").select(
            F.coalesce("doc_id", F.lit(-1)).alias(keys[0]), F.col("doc_id").isNull().alias(keys[1]),
            F.unhex("text_sha256").alias(keys[2]), F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("again"),
        ).distinct()
    ))
    keyed = docs.withColumns({
        keys[0]: F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)),
        keys[1]: F.col("doc_id").isNull(),
        keys[2]: F.unhex(F.sha2(normalised(whole_text()), 256)),
    })
    again = found.where("again").drop("again")
    rest = keyed.join(replicate(found.drop("again"), 64 << 20), keys, "left_anti")
    if again.isEmpty():
        return rest.select(*docs.columns)
    # The row that stays is one of several with its id and text.
    one = keyed.join(replicate(again, 64 << 20), keys, "left_semi").dropDuplicates(keys)
    return rest.unionByName(one).select(*docs.columns)
