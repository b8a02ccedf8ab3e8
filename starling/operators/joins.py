"""Joins: catalogue matching, star joins and the two incremental anti joins."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from ..functions import drop_fraction, lower
from .dedup import dedup
from .keyed import met_keys
from .skew import SALT, dealt

# What a play and a catalogue entry are compared on (fixed names of the data sets).
PLAY_KEYS = {"title": "song", "artist": "artist", "duration": "length"}
SONG_KEYS = {"title": "title", "artist": "artist_name", "duration": "duration"}


def _match_exprs(names: dict[str, str], keys: str, rounding: str) -> list[Column]:
    title, artist, duration = (F.col(names[k]) for k in ("title", "artist", "duration"))
    if keys == "exact":
        return [title, artist, duration]
    if keys == "lower":
        return [lower(title), lower(artist)]
    if keys == "rounded":
        return [title, artist, drop_fraction(duration, rounding)]
    raise ValueError(f"unknown match keys {keys!r}")


def match_plays(
    log: DataFrame,
    songs: DataFrame,
    how: str = "inner",
    keys: str = "exact",
    left_guard: Iterable[str] = (),
    first_match: bool = False,
    tie_break: Iterable[str | Column] = ("song_id",),
    payload: Iterable[str] = ("song_id", "artist_id"),
    rounding: str = "half_up",
    replicate_under: int | None = None,
    hot_share: float | None = None,
) -> DataFrame:
    """Attach catalogue ids to plays.

    ``keys`` compares title, artist and duration exactly (``exact``), title and artist without
    case (``lower``), or all three with the fraction of the duration dropped (``rounded``).
    ``left_guard`` columns must be non-null for a play to match at all; under ``how="left"`` such
    plays are kept with NULL ids. ``first_match`` leaves one entry per key on the catalogue side,
    so that plays never fan out. ``how`` may also be ``left_anti``: the plays without a match.

    A catalogue that measures up to ``replicate_under`` bytes is copied to the executors, and the log
    does not move. Where it is not, ``hot_share`` deals the keys that have that share of all plays,
    of all entries or of what they match among several tasks (``dealt``); ``how`` is then ``inner``
    or a left join.
    """
    payload = list(payload)
    left_keys = _match_exprs(PLAY_KEYS, keys, rounding)
    right_keys = _match_exprs(SONG_KEYS, keys, rounding)
    names = [f"__match_{i}" for i in range(len(left_keys))]

    # The computed keys are columns of their own, so a shuffle or sort evaluates them once.
    left = log.withColumns(dict(zip(names, left_keys)))
    right = songs.withColumns(dict(zip(names, right_keys)))
    right = right.where(reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names]))
    if first_match:
        right = dedup(right, names, tie_break)
    right = right.select(*[F.col(n).alias(f"{n}_r") for n in names], *payload)
    copied = right if replicate_under is None else replicate(right, replicate_under)
    compared = [*names]
    if hot_share is not None and copied is right:
        if how != "inner" and not how.startswith("left"):
            raise ValueError(f"hot keys are not dealt in a {how!r} join")
        others = [f"{n}_r" for n in names]
        left, copied = dealt(left, right, names, others, hot_share, at_most_one=first_match)
        copied = copied.withColumnRenamed(SALT, f"{SALT}_r")
        compared.append(SALT)
    right = copied

    condition = reduce(lambda a, b: a & b, [F.col(n) == F.col(f"{n}_r") for n in compared])
    for column in left_guard:
        condition = condition & left[column].isNotNull()
    joined = left.join(right, condition, how)
    if how in ("left_anti", "left_semi"):
        return joined.drop(*compared)
    return joined.drop(*compared, *[f"{n}_r" for n in compared])


def catalogue(songs: DataFrame, artists: DataFrame) -> DataFrame:
    """Songs with the name of their artist, from the two dimensions."""
    names = artists.select("artist_id", F.col("name").alias("artist_name"))
    return songs.join(names, "artist_id")


def row_bytes(df: DataFrame) -> Column:
    """Estimated size of one row held in memory: eight bytes a field plus the text itself."""
    text = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema
            if isinstance(f.dataType, StringType)]
    return reduce(lambda a, b: a + b, text, F.lit(16 + 8 * len(df.columns)))


def held_bytes(df: DataFrame) -> int:
    """Estimated size of ``df`` held in memory, from one pass over it."""
    return df.agg(F.sum(row_bytes(df).cast("bigint")).alias("size")).first()["size"] or 0


def replicate(df: DataFrame, max_bytes: int = 64 << 20, at_most: int | None = None) -> DataFrame:
    """Ask for a copy of ``df`` on every executor, provided its measured size allows it.

    One pass over ``df`` sums up its size. Above ``max_bytes`` it comes back without the hint and
    joins as any large table does: shuffled, with hot partitions split at run time. ``at_most`` is a
    size that ``df`` is known not to exceed: where that one fits, the pass is spared.
    """
    known = at_most is not None and at_most <= max_bytes
    return F.broadcast(df) if known or held_bytes(df) <= max_bytes else df


def star_join(
    fact: DataFrame,
    dim: DataFrame,
    key: str | list[str],
    how: str = "inner",
    replicate_under: int | None = None,
) -> DataFrame:
    """Fact with a dimension, on a shared key.

    Without ``replicate_under`` the choice between broadcast and shuffle is left to the optimizer,
    which goes by the size of ``dim``; with it the size is measured against that many bytes.
    """
    if replicate_under is not None:
        dim = replicate(dim, replicate_under)
    return fact.join(dim, key, how)


def only_new(
    batch: DataFrame, existing: DataFrame, keys: Iterable[str], narrow: bool = True
) -> DataFrame:
    """Batch rows whose key is not stored yet; a NULL in the key never counts as stored.

    Stored keys are narrowed to those that the batch holds: with a small batch no stored row moves.
    ``narrow=False`` spares reading the batch twice where it is costly to make; then stored keys are
    made distinct before the shuffle, so that one stored very often does not fill a partition.
    """
    keys = list(keys)
    if narrow:
        stored = met_keys(existing, batch, keys)
    else:
        stored = existing.select(*[F.col(k).alias(f"__stored_{k}") for k in keys]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__stored_{k}") for k in keys])
    return batch.join(stored, same, "left_anti")


def not_in(
    batch: DataFrame, existing: DataFrame, key: str, existing_key: str | None = None,
    null_aware: bool = True,
) -> DataFrame:
    """``key NOT IN (existing)``.

    Null-aware semantics: nothing qualifies once ``existing`` holds a NULL key, a NULL batch key
    never qualifies, and an empty ``existing`` lets everything through. These cases depend on two
    flags of ``existing``, which a scalar subquery computes; what remains is a plain anti join that
    shuffles at any size, where SQL's NOT IN would broadcast ``existing`` whole.
    """
    stored = existing.select(F.col(existing_key or key).alias("__stored"))
    known = stored.where(F.col("__stored").isNotNull()).distinct()
    if not null_aware:
        return batch.join(known, batch[key] == known["__stored"], "left_anti")
    flags = stored.agg(
        F.struct(
            (F.count(F.lit(1)) == 0).alias("empty"),
            (F.count_if(F.col("__stored").isNull()) > 0).alias("has_null"),
        ).alias("flags")
    ).scalar()
    candidates = batch.where(
        (F.col(key).isNotNull() | flags.getField("empty")) & ~flags.getField("has_null")
    )
    return candidates.join(known, candidates[key] == known["__stored"], "left_anti")
