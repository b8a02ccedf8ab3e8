"""Search against plain inner products, and that MaxScore leaves work out."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from starling.llm import topk as module
from starling.llm.topk import Shard, max_score, top_k

SCHEMA = "vec_id long, embedding array<float>, label int"
EVERY = "vec_id % 20 = 0"


def brute(rows, k=20, step=20):
    kept = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for place, (query, q) in enumerate(kept):
        if query is None or query % step:
            continue
        scored = sorted(
            (-sum(a * b for a, b in zip(q, v)), i is None, i or 0)
            for at, (i, v) in enumerate(kept) if at != place)
        out += [(query, rank, None if null else i, -score)
                for rank, (score, null, i) in enumerate(scored[:k], 1)]
    return sorted(out, key=str)


def found(df, queries=EVERY, k=20):
    return sorted((tuple(r) for r in top_k(df, queries, k).collect()), key=str)


def test_corpus(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    assert found(df.repartition(3)) == brute([(r[0], r[1]) for r in df.collect()])


def test_ties_repeats_nulls_and_sizes(small_batches):
    draw = np.random.default_rng(2)
    rows = [(int(i) % 90, draw.integers(-1, 2, int(draw.integers(0, 5))).astype(float).tolist(), 0)
            for i in range(200)]
    rows += [(None, [1.0, 0.0, 1.0], 0)] * 3 + [(20, [1.0, 1.0], 0)] * 2 + [(40, [], 0), (60, [0.0, 0.0], 0)]
    df = small_batches.createDataFrame(rows, SCHEMA).repartition(4)
    assert found(df, k=5) == brute([r[:2] for r in rows], 5)
    assert found(df, k=500) == brute([r[:2] for r in rows], 500)


def test_negative_scores_and_few_candidates(spark):
    rows = [(i, [float(-i) if i else 1.0, 0.5], 0) for i in range(6)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert found(df) == brute([r[:2] for r in rows])
    alone = spark.createDataFrame([(20, [1.0], 0)], SCHEMA)
    assert found(alone) == []


def test_rows_that_take_no_part_and_clashing_columns(spark):
    good = [(i, [float(i % 3), i / 7], 0) for i in range(41)]
    bad = [(100, None, 0), (120, [1.0, None], 0), (140, [float("nan"), 1.0], 0), (160, [float("-inf")], 0),
           (180, [1e30], 0)]
    names = ["row", "vec", "rank", "score", "query", "number", "kind", "group", "stripe"]
    df = spark.createDataFrame(good + bad, SCHEMA).withColumns({n: F.lit("x") for n in names})
    assert found(df) == brute([r[:2] for r in good])
    assert top_k(df.limit(0), EVERY).columns == ["query_id", "rank", "vec_id", "score"]
    assert found(spark.createDataFrame(bad, SCHEMA)) == []


@pytest.mark.parametrize("size", [1, 7, 64])
def test_shards_and_blocks_of_any_size_are_merged(spark, monkeypatch, size):
    monkeypatch.setattr(module, "_SHARD", size)
    monkeypatch.setattr(module, "_BLOCK", 3)
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").where("vec_id < 130")
    assert found(df, k=4) == brute([(r[0], r[1]) for r in df.collect()], 4)


def shard_of(vectors):
    ids = np.arange(len(vectors))
    return Shard.unpack(Shard.build(ids, ids, ids >= 0, list(vectors.astype("i8"))).pack())


def test_max_score_is_exact_above_its_threshold():
    draw = np.random.default_rng(3)
    for sparse in (1.0, 0.2):
        vectors = np.floor(draw.normal(0, 8, (500, 24)) * (draw.random((500, 24)) < sparse))
        shard = shard_of(vectors)
        queries = vectors[:40].astype("i8")
        scores = queries @ vectors.astype("i8").T
        limits = [[f(row) for row in scores] for f in (
            lambda _: None, lambda _: -50, lambda _: 0, lambda r: int(np.sort(r)[-20]), lambda r: int(r.max()),
            lambda r: int(r.max()) + 1)]
        for least in limits:
            for row, limit, (places, got, _) in zip(scores, least, max_score(shard, queries, least)):
                wanted = np.flatnonzero(row >= (-1 << 60 if limit is None else limit))
                assert sorted(zip(places, got)) == sorted(zip(wanted, row[wanted]))


def test_scores_beyond_exact_floating_point():
    vectors = np.array([[3 << 27, 1, -1], [3 << 27, 1, 0], [-5, (1 << 28) + 1, 7]])
    scores = vectors @ vectors.T
    found = list(max_score(shard_of(vectors), vectors, [None] * 3))
    assert [f[1].tolist() for f in found] == scores.tolist()


def test_max_score_looks_at_fewer_values():
    draw = np.random.default_rng(4)
    vectors = np.floor(draw.normal(0, 8, (4000, 64)) * np.geomspace(4, 0.1, 64))
    shard = shard_of(vectors)
    queries = vectors[:1].astype("i8")
    least = int(np.sort(vectors.astype("i8") @ queries[0])[-20])
    looked = [next(max_score(shard, queries, [limit]))[2] for limit in (least, None)]
    assert looked[0] < 0.5 * looked[1]
