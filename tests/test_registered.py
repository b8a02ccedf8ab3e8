"""Every registered query against its SQL on the smallest tables."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, compare
from starling.workloads import registered

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


def test_every_query_has_sql():
    assert all(sql for _, sql in registered().values())
    assert set(registered()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 5


@pytest.mark.parametrize("name", sorted(registered()))
def test_query(spark, con, name):
    verdict, _, _ = compare(spark, con, SF, name, entry.queries()[name], entry.oracle_sql()[name])
    assert verdict == "ok"


def test_the_core_stands_alone(tmp_path):
    """Without the operators for training text and their pipeline, all other queries are there."""
    root = Path(__file__).resolve().parents[1]
    without = shutil.ignore_patterns("llm", "__pycache__", ".git")
    shutil.copytree(root / "starling", tmp_path / "starling", ignore=without)
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        if (root / name).exists():
            shutil.copy(root / name, tmp_path / name)
    listed = subprocess.run(
        [sys.executable, "-c",
         "import __spark_entry__ as e; print(sorted(e.queries()), sorted(e.oracle_sql()))"],
        cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)}, capture_output=True,
        text=True, check=True,
    ).stdout
    assert listed == f"{sorted(registered())} {sorted(registered())}\n"
