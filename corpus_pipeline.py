"""From raw documents to packed training sequences: five stages, each written before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from starling.llm.common import documents, stored
from starling.llm.exact import keep_first
from starling.llm.jaccard import one_of_each
from starling.llm.mixing import mix
from starling.llm.packing import pack_documents
from starling.llm.quality import judge, learn_rules
from starling.llm.queries import tokenizer_path

# Statistics and choices are columns beside this one, so no column of a document can clash.
_ROW = "__document"


def _held(docs: DataFrame, *names: str) -> DataFrame:
    return docs.select(*names, F.struct("*").alias(_ROW))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base test nor a rule learned from the labels rejects."""
    rules = learn_rules(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judge(_held(docs, "doc_id", "text"), rules, _ROW).where("kept").select(f"{_ROW}.*")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of equal texts."""
    return keep_first(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group linked by five-word shingles at 0.8 or more."""
    return one_of_each(docs, k=5, part=80, whole=100)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, or up to three times."""
    mixed = mix(_held(docs, "doc_id", "source", "text"))
    copies = F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))
    return mixed.select(_ROW, copies).select(f"{_ROW}.*")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens.

    An executor that ran the other stages has used up its heap, so its Python workers remember fewer words.
    """
    return pack_documents(docs, tokenizer_path(), words=200_000)


STAGES = [
    ("quality_rules", quality),
    ("exact_dedup", exact),
    ("ngram_jaccard", near),
    ("mix_sources", mixture),
    ("best_fit_packing", pack),
]

# Learning, linking by similarity, sampling and packing go beyond SQL; tests/llm compares them with
# brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
