"""Equi joins whose hot keys are dealt among tasks before they meet."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (
    AtomicType, DoubleType, FloatType, NumericType, StructField, StructType, LongType, IntegerType,
)

SALT = "__salt"
_KEY, _PIECES = "__hot_key", "__hot_pieces"


def _known(names: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names])


def _key(df: DataFrame, names: list[str], types: list) -> Column:
    """The hash of a key, alike for equal keys of both sides; NULL if a part is NULL."""
    parts = []
    for name, kind in zip(names, types):
        part = F.col(name).cast(kind)
        # Adding zero makes the two zeros one.
        parts.append(part + F.lit(0.0).cast(kind) if isinstance(kind, (DoubleType, FloatType)) else part)
    return F.when(_known(names), F.xxhash64(*parts))


def _common_types(left: DataFrame, right: DataFrame, names: list[str], others: list[str]) -> list | None:
    """The types in which the sides' keys compare; None if these are not alike."""
    ours, theirs = ([df.schema[n].dataType for n in some] for df, some in ((left, names), (right, others)))
    for a, b in zip(ours, theirs):
        if a != b and not (isinstance(a, NumericType) and isinstance(b, NumericType)):
            return None
    both = left.select(*names).limit(0).union(right.select(*others).limit(0))
    return [f.dataType for f in both.schema]


def _frequent(df: DataFrame, key: Column, share: float) -> tuple[int, list[int]]:
    """The number of rows, and all key hashes that ``share`` of these or more may have.

    A frequency sketch of fixed size finds them, which tasks fill and merge; it may name some that
    are rarer.
    """
    most, tracked = math.ceil(2 / share), math.ceil(8 / share)
    found = df.select(key.alias(_KEY)).agg(
        F.count(F.lit(1)).alias("rows"), F.expr(f"approx_top_k({_KEY}, {most}, {tracked})").alias("top")
    ).first()
    top = found["top"] or []
    least = share * found["rows"] / 2
    return found["rows"], [r["item"] for r in top if r["item"] is not None and r["count"] >= least]


def _counts(df: DataFrame, key: Column, wanted: DataFrame) -> dict[int, int]:
    """How often each wanted key occurs: a number per key leaves a task."""
    met = df.select(key.alias(_KEY)).join(F.broadcast(wanted), _KEY)
    return {r[_KEY]: r["count"] for r in met.groupBy(_KEY).count().collect()}


def dealt(
    left: DataFrame, right: DataFrame, names: list[str], others: list[str], share: float = 0.001,
    at_most_one: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Both sides of an equi join with a column ``__salt``, which the join must compare as well.

    A key is hot if it has ``share`` of either side's rows. It is dealt into as many pieces as bring a
    piece's output down to ``share`` of the whole: left rows fall into them by a hash of all their
    columns, right rows are copied to each. Left rows with a NULL in the key, which match nothing, are
    dealt as well. Every left row still meets exactly the right rows of its key, so inner, left, semi
    and anti joins give the same rows; right and full ones would repeat what does not match.

    Each side's key columns are read twice, for the sketch and for exact counts of what it names: at
    most ``4 / share`` keys, which is also what is copied to the executors. Right rows are copied at
    most once per ``share`` of the output, so copies are a small part of what the join returns. A
    piece is known from the row alone, so a task that is run again deals alike; it also follows that
    left rows equal in all columns stay together. ``at_most_one`` says that no key repeats on the
    right. If the sides' keys are of different kinds, nothing is dealt.
    """
    types = _common_types(left, right, names, others)
    if types is None:
        return left.withColumn(SALT, F.lit(0)), right.withColumn(SALT, F.lit(0))
    spark = left.sparkSession
    ours, theirs = _key(left, names, types), _key(right, others, types)
    total, hot = _frequent(left, ours, share)
    if not at_most_one:
        hot = sorted({*hot, *_frequent(right, theirs, share)[1]})
    pieces = {}
    if hot:
        wanted = spark.createDataFrame([(h,) for h in hot], StructType([StructField(_KEY, LongType())]))
        plays, entries = _counts(left, ours, wanted), _counts(right, theirs, wanted)
        output = {h: plays.get(h, 0) * max(1, entries.get(h, 0)) for h in hot}
        whole = total + sum(output[h] - plays.get(h, 0) for h in hot)
        pieces = {h: min(plays[h], math.ceil(n / (share * whole))) for h, n in output.items() if n > share * whole}
    keys = spark.createDataFrame(
        list(pieces.items()), StructType([StructField(_KEY, LongType()), StructField(_PIECES, IntegerType())])
    )
    plain = [f.name for f in left.schema if isinstance(f.dataType, AtomicType)]
    spread = F.when(_known(names), F.coalesce(_PIECES, F.lit(1))).otherwise(math.ceil(1 / share))
    # The seed sets the hash apart from the one that deals rows to tasks.
    salt = F.pmod(F.xxhash64(F.lit(11), *[F.col(f"`{n}`") for n in plain]), spread).cast("int")
    left = left.withColumn(_KEY, ours).join(F.broadcast(keys), _KEY, "left").withColumn(SALT, salt)
    right = right.withColumn(_KEY, theirs).join(F.broadcast(keys), _KEY, "left").withColumn(
        SALT, F.explode(F.sequence(F.lit(0), F.coalesce(_PIECES, F.lit(1)) - 1))
    )
    return left.drop(_KEY, _PIECES), right.drop(_KEY, _PIECES)
