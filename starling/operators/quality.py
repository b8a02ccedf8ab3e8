"""Data-quality checks."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType


class CheckFailed(ValueError):
    """A check returned something other than what it expects."""


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def null_counts(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """NULLs per column, in one pass and one row."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


def duplicate_keys(df: DataFrame, keys: Iterable[str], nulls_distinct: bool = False) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    keys = list(keys)
    rows = df.dropna(subset=keys) if nulls_distinct else df
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def not_null(df: DataFrame, cols: Iterable[str]) -> tuple[DataFrame, DataFrame]:
    """Rows that have all of ``cols``, and the rejects."""
    missing = _any([F.col(c).isNull() for c in cols])
    return df.where(~missing), df.where(missing)


def conform(
    df: DataFrame, schema: StructType, broken: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows typed as ``schema``, and the raw rows with a value that does not parse.

    The rejects carry the names of the offending columns in ``rejected_columns``. Rows with a value
    in the column ``broken`` are rejected under its name, whatever else they hold.
    """
    bad = {
        f.name: F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()
        for f in schema
    }
    if broken is not None:
        bad[broken] = F.col(broken).isNotNull()
    is_bad = _any(list(bad.values()))
    typed = df.where(~is_bad).select(
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema]
    )
    names = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in bad.items()]))
    return typed, df.where(is_bad).withColumn("rejected_columns", names)


def max_length(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """Rows with a text longer than its limit."""
    return df.where(_any([F.length(c) > F.lit(n) for c, n in limits.items()]))


def row_rules(
    mandatory: Iterable[str], limits: Mapping[str, int], in_bytes: bool = False
) -> dict[str, Column]:
    """Conditions that hold for a violating row, by a name that says which: ``level IS NULL``,
    ``length(level) > 100``. Lengths are in characters, or in bytes of UTF-8."""
    size, name = (F.octet_length, "octet_length") if in_bytes else (F.length, "length")
    rules = {f"{c} IS NULL": F.col(c).isNull() for c in mandatory}
    long = {f"{name}({c}) > {n}": F.coalesce(size(c) > F.lit(n), F.lit(False)) for c, n in limits.items()}
    return {**rules, **long}


def watched(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    """The same rows, and the number of violations of each rule, which is there once the rows have
    been written: counted on the way, without another read."""
    found = Observation()
    counts = [F.count_if(rule).alias(name) for name, rule in rules.items()]
    return df.observe(found, F.count(F.lit(1)).alias("rows"), *counts), found


def violations(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that keep all rules; and those that do not, with the rules' names in ``violations``."""
    broken = F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules.items()]))
    bad = _any(list(rules.values()))
    return df.where(~bad), df.where(bad).withColumn("violations", F.array_join(broken, ", "))


def null_key_checks(tables: Mapping[str, str]) -> list[dict]:
    """One check per ``{table: key column}``: no row may lack its key."""
    return [
        {"query": f"SELECT count(1) FROM {table} WHERE {key} IS NULL", "expected_result": 0}
        for table, key in tables.items()
    ]


def run_checks(spark: SparkSession, checks: Iterable[Mapping], fail_fast: bool = True) -> DataFrame:
    """Run ``{query, expected_result}`` checks and report on them.

    A check compares the first cell of its result; a query without rows passes. With ``fail_fast``
    the first mismatch raises :class:`CheckFailed`, naming both values.
    """
    report = []
    for check in checks:
        row = spark.sql(check["query"]).first()
        expected = check["expected_result"]
        passed = row is None or row[0] == expected
        actual = None if row is None else str(row[0])
        if fail_fast and not passed:
            raise CheckFailed(f"{check['query']}: expected {expected}, got {actual}")
        report.append((check["query"], str(expected), actual, passed))
    return spark.createDataFrame(
        report, "query string, expected string, actual string, passed boolean"
    )
