"""Counts, distinct counts and top-k reports."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F


def plays_by(
    fact: DataFrame, cols: Iterable[str], ordered: bool = False, name: str = "plays"
) -> DataFrame:
    """Rows per group; counted per map task first, so a hot group costs one row per task."""
    cols = list(cols)
    counts = fact.groupBy(*cols).agg(F.count(F.lit(1)).alias(name))
    return counts.orderBy(*cols) if ordered else counts


def users_by(
    fact: DataFrame,
    cols: Iterable[str],
    user: str = "user_id",
    ordered: bool = False,
    name: str = "users",
    approximate: bool = False,
) -> DataFrame:
    """Distinct users per group.

    The exact form is planned as DISTINCT (group, user) followed by a count, so a hot group is
    spread over its users. ``approximate`` keeps one sketch per group instead.
    """
    cols = list(cols)
    count = F.approx_count_distinct(user) if approximate else F.count_distinct(F.col(user))
    counts = fact.groupBy(*cols).agg(count.alias(name))
    return counts.orderBy(*cols) if ordered else counts


def count_where(df: DataFrame, conditions: Column | Mapping[str, Column]) -> DataFrame:
    """Rows satisfying each condition, all of them counted in one pass."""
    named = conditions if isinstance(conditions, Mapping) else {"n": conditions}
    return df.agg(*[F.count_if(c).alias(name) for name, c in named.items()])


def profile(df: DataFrame) -> DataFrame:
    """Number of rows."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def file_counts(df: DataFrame) -> DataFrame:
    """Rows per source file of a scan."""
    return df.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def top_k(fact: DataFrame, by: str, k: int = 5, name: str = "plays") -> DataFrame:
    """The ``k`` groups with most rows; equal counts go by group value."""
    return largest(plays_by(fact, [by], name=name), by, k, name)


def largest(counts: DataFrame, by: str, k: int = 5, name: str = "plays") -> DataFrame:
    return counts.orderBy(F.col(name).desc(), F.col(by).asc_nulls_last()).limit(k)


def preview(df: DataFrame, n: int, order_by: Iterable[str | Column] | None = None) -> DataFrame:
    """``n`` rows, any of them unless an order is given."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)
