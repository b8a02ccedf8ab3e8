"""The registered queries: columns and rows of each contract, and SQL where there is some."""

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, compare
from starling.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": {"doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint",
            "base_sha256": "string", "spans": "string"},
    "op2": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op3": {"doc_id": "bigint", "held_out": "boolean", "n_tokens": "bigint", "n_known": "bigint",
            "train_tokens": "bigint", "base_score": "double", "score": "double"},
    "op4": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
    "op5": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op6": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    "op7": {"doc_id": "bigint", "licenses": "string", "sentence_ids": "string", "n_sentences": "bigint"},
    "op8": {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint",
            "sequence_id": "bigint", "offset": "bigint"},
    "op9": {"doc_id": "bigint", "keep_id": "bigint", "group_size": "bigint", "kept": "boolean",
            "text_sha256": "string"},
    "op10": {"doc_id": "bigint", "n_words": "bigint", "word_chars": "bigint", "n_symbols": "bigint",
             "n_dup_lines": "bigint", "n_repeat_words": "bigint", "base_failed": "boolean", "kept": "boolean"},
    "op11": {"conv_id": "bigint", "gaps": "bigint", "blank": "bigint", "duplicate": "bigint",
             "truncated": "bigint", "illegal": "bigint", "cost": "bigint", "audit": "string",
             "repaired_sha256": "string"},
    "op12": {"vec_id": "bigint", "cluster": "int", "distance": "bigint", "cluster_inertia": "bigint",
             "inertia": "bigint", "centroid_sha256": "string"},
    "op13": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"},
}
# Where a result is not one row per document: its id, the table it comes from, and which rows of it.
KEYS = {"op11": ("conv_id", "conversations", "true"), "op12": ("vec_id", "embeddings", "true"),
        "op13": ("query_id", "embeddings", "vec_id % 20 = 0")}
MANY = ("op8", "op13")  # several rows for one id


def test_all_operators_and_the_pipeline_are_registered():
    assert {name.split("_")[0] for name in QUERIES} == set(COLUMNS)
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_contract(spark, name):
    found = QUERIES[name][0](spark, SF)
    types = {f.name: f.dataType.simpleString() for f in found.schema}
    wanted = COLUMNS[name.split("_")[0]]
    assert {c: types.get(c) for c in wanted} == wanted
    number = name.split("_")[0]
    key, table, rows = KEYS.get(number, ("doc_id", "documents", "true"))
    source = spark.read.parquet(f"{SF}/{table}.parquet").where(rows)
    ids = [r[0] for r in source.select(key if key in source.columns else "vec_id").collect()]
    got = [r[0] for r in found.select(key).collect()]
    assert sorted(set(got) if number in MANY else got) == sorted(set(ids) if number == "op11" else ids)


@pytest.mark.parametrize("name", sorted(n for n, (_, sql) in QUERIES.items() if sql))
def test_sql(spark, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    query, sql = QUERIES[name]
    assert compare(spark, con, SF, name, query, sql)[0] == "ok"
