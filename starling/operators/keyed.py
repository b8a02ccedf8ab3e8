"""Keyed loads as set operations: insert-if-absent and upsert."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .dedup import dedup


def _any_null(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def met_keys(
    existing: DataFrame, batch: DataFrame, keys: list[str], null_safe: bool = False
) -> DataFrame:
    """The stored keys that a batch holds, too, as columns ``__stored_<key>``.

    Stored rows are filtered by the batch's keys first. Those of a small batch are copied to where
    the stored rows lie, which then do not move; only keys that meet go on.
    """
    stored = existing.select(*[F.col(k).alias(f"__stored_{k}") for k in keys])
    return stored.join(
        distinct_keys(batch, keys), _equal(keys, "__stored_", "__written_", null_safe), "left_semi"
    ).distinct()


def _equal(keys: list[str], left: str, right: str, null_safe: bool) -> Column:
    def pair(k: str) -> Column:
        a, b = F.col(f"{left}{k}"), F.col(f"{right}{k}")
        return a.eqNullSafe(b) if null_safe else a == b

    return reduce(lambda a, b: a & b, map(pair, keys))


def absent_rows(
    existing: DataFrame | None,
    batch: DataFrame,
    keys: Iterable[str],
    order_by: Iterable[str | Column],
    nulls_distinct: bool = True,
    narrow: bool = True,
    narrow_by: DataFrame | None = None,
    unique: bool = False,
) -> DataFrame:
    """The batch rows an insert-if-absent would add, first in ``order_by`` per key.

    With ``nulls_distinct`` a row with a NULL in its key conflicts with nothing; otherwise NULLs
    compare as equal. The batch is read once, and once more for its keys if stored keys are
    narrowed to those (``met_keys``). ``narrow=False`` is for a batch that is costly to make and
    stored rows that are limited to its range already. ``narrow_by`` holds the batch's keys that may
    be stored, where these are known. ``unique`` says that no key repeats in the batch, whose rows then
    need not be brought together by it.
    """
    keys = list(keys)
    fields = {f.name: f for f in batch.schema}
    if unique:
        fresh = batch
    elif nulls_distinct and any(fields[k].nullable for k in keys):
        # A row with a NULL key is alone in its group, so one window serves all rows.
        alone = batch.withColumn("__alone", F.when(_any_null(keys), F.monotonically_increasing_id()))
        fresh = dedup(alone, [*keys, "__alone"], order_by).drop("__alone")
    else:
        fresh = dedup(batch, keys, order_by)
    if existing is None:
        return fresh
    if narrow:
        stored = met_keys(existing, batch if narrow_by is None else narrow_by, keys, not nulls_distinct)
    else:
        stored = existing.select(*[F.col(k).alias(f"__stored_{k}") for k in keys])
    return fresh.join(stored, _equal(keys, "", "__stored_", not nulls_distinct), "left_anti")


def insert_if_absent(
    existing: DataFrame,
    batch: DataFrame,
    keys: Iterable[str],
    order_by: Iterable[str | Column],
    nulls_distinct: bool = True,
) -> DataFrame:
    """Stored rows unchanged, plus the first batch row of every key not stored yet."""
    return existing.unionByName(absent_rows(existing, batch, keys, order_by, nulls_distinct))


def upsert(
    existing: DataFrame,
    batch: DataFrame,
    keys: Iterable[str],
    order_by: Iterable[str | Column],
    mode: str = "last",
) -> DataFrame:
    """Keyed write of a batch over stored rows.

    ``last``: the last batch row of a key replaces the stored one. ``first``: the stored row is
    kept, as an update that assigns a column to itself does. Only the batch is sorted; the stored
    rows take part in one anti join, and do not move at all when the batch is small.
    """
    keys = list(keys)
    if mode == "first":
        return insert_if_absent(existing, batch, keys, order_by)
    if mode != "last":
        raise ValueError(f"mode must be 'first' or 'last', not {mode!r}")
    written = dedup(batch, keys, order_by, keep="last")
    replaced = distinct_keys(batch, keys)
    pairs = [existing[k].eqNullSafe(replaced[f"__written_{k}"]) for k in keys]
    kept = existing.join(replaced, reduce(lambda a, b: a & b, pairs), "left_anti")
    return kept.unionByName(written)


def distinct_keys(batch: DataFrame, keys: list[str]) -> DataFrame:
    return batch.select(*[F.col(k).alias(f"__written_{k}") for k in keys]).distinct()
