"""Reports that follow a fact's loads: a load is counted once, and a report merges what was counted.

A report keeps its counts in a table beside the fact, one load for each load of the fact, which names
it by its tag. A new load of the fact adds its own counts; no other is read again. When the fact is
rewritten (a full load, a compaction), its new load is counted and the counts of the old ones no
longer take part. A report needs a name of its own: counts by other columns go to another table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegralType, LongType, StructField, StructType

from ..operators import largest, users_by
from ..sinks import append, load_upsert, read_load, read_loads, refresh
from ..sinks.loads import committed_loads, current_loads

FORMS = ("bitmap", "rows", "sketch")
Rows = Callable[[DataFrame], DataFrame]


def _tag(load: str) -> str:
    return load.split("-", 2)[2]


def _counted(spark: SparkSession, root: str, fact: str, name: str, count: Rows) -> dict[str, str]:
    """The load of ``name`` that counts it, by current load of ``fact``; those missing are counted."""
    current = current_loads(spark, root, fact)
    if any(load.split("-")[1] == "keyed" for load in current):
        raise ValueError(f"{fact} is upserted: its loads do not only add rows")
    known = {_tag(load): load for load in committed_loads(spark, root, name)}
    return {
        load: known.get(load) or append(count(read_load(spark, root, fact, load)), root, name, tag=load)
        for load in current
    }


def _since(spark: SparkSession, root: str, report: str, loads: list[str]) -> list[str] | None:
    """The fact's loads that came after those in a report; None if the report must be made anew."""
    made = committed_loads(spark, root, report)
    # A top-k says besides how many groups it keeps.
    last = _tag(made[-1]).split("+")[0] if made else None
    return loads[loads.index(last) + 1:] if last in loads else None


def user_counts(rows: DataFrame, by: Iterable[str], user: str, form: str) -> DataFrame:
    """What is kept of a load to count distinct users per group; it can be merged with others.

    ``bitmap`` has a bit per user, in one bitmap per group and 32,768 ids, for ids that are dense;
    ``rows`` a row per group and user, for ids of any kind; ``sketch`` one sketch per group, which
    gives an estimate. A group whose users are all NULL stays, with none.
    """
    by = list(by)
    if form == "bitmap":
        place = F.col(user).cast("bigint")
        return rows.groupBy(*by, F.bitmap_bucket_number(place).alias("__bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("__users"))
    if form == "rows":
        return rows.select(*by, F.col(user).alias("__users")).distinct()
    if form == "sketch":
        return rows.groupBy(*by).agg(F.hll_sketch_agg(user).alias("__users"))
    raise ValueError(f"form must be one of {FORMS}, not {form!r}")


def users_of(counts: DataFrame, by: Iterable[str], form: str, name: str = "users") -> DataFrame:
    """Distinct users per group out of :func:`user_counts`; ``by`` may be some of its columns."""
    by = list(by)
    if form == "bitmap":
        merged = counts.groupBy(*by, "__bucket").agg(F.bitmap_or_agg("__users").alias("__users"))
        return merged.groupBy(*by).agg(F.sum(F.bitmap_count("__users")).alias(name))
    if form == "rows":
        return users_by(counts, by, "__users", name=name)
    return counts.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("__users")).alias(name))


def default_form(rows: DataFrame, user: str) -> str:
    return "bitmap" if isinstance(rows.schema[user].dataType, IntegralType) else "rows"


def standing_users(
    spark: SparkSession, root: str, fact: str, name: str, by: Iterable[str], user: str = "user_id",
    rows: Rows | None = None, form: str | None = None, buckets: int = 8,
) -> DataFrame | None:
    """Distinct users per group of ``by``, kept in ``root/name_report`` and brought up to date.

    Only the new loads' rows are read. The groups they hold are merged from what is kept of all
    loads, and only these are written, in the report's ``buckets`` that hold them (:func:`load_upsert`).
    ``rows`` makes what is counted out of the fact's rows: a filter, columns of the time. Without
    ``form`` whole-number ids are counted by bitmaps, others by rows. None while the fact is empty.
    """
    by, rows = list(by), rows or (lambda df: df)
    loads = current_loads(spark, root, fact)
    if not loads:
        return None
    form = form or default_form(rows(read_load(spark, root, fact, loads[-1])), user)
    counted = _counted(spark, root, fact, name, lambda df: user_counts(rows(df), by, user, form))
    report = f"{name}_report"
    new = _since(spark, root, report, loads)
    everything = read_load(spark, root, name, *counted.values())
    if new is None:
        refresh(users_of(everything, by, form), root, report, tag=loads[-1])
    elif new:
        groups = read_load(spark, root, name, *[counted[load] for load in new]).select(
            *[F.col(c).alias(f"__new_{c}") for c in by]).distinct()
        same = [F.col(c).eqNullSafe(F.col(f"__new_{c}")) for c in by]
        touched = everything.join(groups, same, "left_semi")
        load_upsert(users_of(touched, by, form), root, report, by, by, tag=loads[-1], buckets=buckets)
    return read_loads(spark, root, report)


def standing_top(
    spark: SparkSession, root: str, fact: str, name: str, by: str, k: int = 5, spare: int = 50,
    sign: Column | None = None, rows: Rows | None = None,
) -> DataFrame | None:
    """The ``k`` groups with most rows, as ``top_k`` gives them, kept in ``root/name_top``.

    ``sign`` is what a row counts (1; -1 takes one back); groups whose rows add up to nothing are
    left out. Kept are the first ``k + spare`` groups with their counts and a bound that no other
    group's count exceeds. A new load's counts are added to both. While the last of the ``k`` stays
    above the bound no other group can be among them, and only the new load was read; otherwise the
    counts of all loads are added up again, from one row per load and group and not from the fact.
    """
    make = rows or (lambda df: df)
    loads = current_loads(spark, root, fact)
    if not loads:
        return None
    counted = _counted(spark, root, fact, name, lambda df: make(df).groupBy(by).agg(
        F.coalesce(F.sum(F.lit(1) if sign is None else sign), F.lit(0)).cast("bigint").alias("plays")))
    report = f"{name}_top"
    made = f"{loads[-1]}+{k + spare}"
    if (done := committed_loads(spark, root, report)) and _tag(done[-1]) == made:
        return largest(read_loads(spark, root, report).drop("__bound"), by, k)
    new = _since(spark, root, report, loads)
    kept = None if new is None else _added(spark, root, name, report, by, k, [counted[load] for load in new])
    if kept is None:
        totals = read_load(spark, root, name, *counted.values()).groupBy(by).agg(F.sum("plays").alias("plays"))
        # At most k + spare + 1 rows.
        first = largest(totals.where("plays > 0"), by, k + spare + 1).collect()
        bound = first[-1]["plays"] if len(first) > k + spare else 0
        kept = [(row[by], row["plays"], bound) for row in first[:k + spare]]
    field = read_load(spark, root, name, counted[loads[-1]]).schema[by]
    schema = StructType([
        StructField(by, field.dataType), StructField("plays", LongType()), StructField("__bound", LongType())])
    refresh(spark.createDataFrame(kept, schema), root, report, tag=made)
    return largest(read_loads(spark, root, report).drop("__bound"), by, k)


def _added(
    spark: SparkSession, root: str, name: str, report: str, by: str, k: int, new: list[str]
) -> list[tuple] | None:
    """The kept groups with the counts of new loads added; None where others may be among the k."""
    kept = read_loads(spark, root, report)
    before = kept.collect()
    if not before:
        return None
    bound = before[0]["__bound"]
    groups = kept.select(by, "plays")
    if new:
        change = read_load(spark, root, name, *new).groupBy(by).agg(F.sum("plays").alias("plays"))
        # k + spare rows: their number is a parameter.
        known = F.broadcast(kept.select(F.col(by).alias("__kept")))
        same = F.col(by).eqNullSafe(F.col("__kept"))
        bound += max(0, change.join(known, same, "left_anti").agg(F.max("plays")).first()[0] or 0)
        groups = groups.unionByName(change.join(known, same, "left_semi"))
    after = largest(
        groups.groupBy(by).agg(F.sum("plays").alias("plays")).where("plays > 0"), by, len(before)).collect()
    certain = after[k - 1]["plays"] > bound if len(after) >= k else bound <= 0
    return [(row[by], row["plays"], bound) for row in after] if certain else None
