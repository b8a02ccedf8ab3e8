"""Clustering against a plain integer version, and the bounds against exact distances."""

import hashlib
import math

import numpy as np
import pytest

from starling.llm.clustering import cluster, nearest, span

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, count=16, rounds=3, dims=64):
    """Rows (id, components) to the result, with Python integers."""
    kept = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    hashed = lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(),
                        np.array(r[1], "<i4").tobytes())
    centroids = [v for _, v in sorted(kept, key=hashed)[:count]]

    def assign():
        ways = [[(sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids)] for _, v in kept]
        return [min(w) for w in ways]

    for _ in range(rounds):
        found = assign()
        for n in range(len(centroids)):
            own = [v for (_, v), (_, m) in zip(kept, found) if m == n]
            if own:
                centroids[n] = [sum(col) // len(own) for col in zip(*own)]
    found = assign()
    total = sum(d for d, _ in found)
    return sorted(
        (str(i), n, d, sum(e for e, m in found if m == n), total,
         hashlib.sha256(",".join(map(str, centroids[n])).encode()).hexdigest())
        for (i, _), (d, n) in zip(kept, found))


def found(df, **options):
    return sorted((str(r[0]), *r[1:]) for r in cluster(df, **options).collect())


def test_corpus(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    assert found(df.repartition(3)) == brute([(r[0], r[1]) for r in df.collect()])


@pytest.mark.parametrize("pivots", [1, 2, 8])
def test_ties_repeats_and_few_distinct_vectors(small_batches, pivots):
    draw = np.random.default_rng(5)
    rows = [(int(i) % 40, draw.integers(-2, 3, 3).astype(float).tolist(), 0) for i in range(120)]
    rows += [(None, [1.0, 1.0, 1.0], 0)] * 3
    df = small_batches.createDataFrame(rows, SCHEMA).repartition(4)
    assert found(df, count=5, dimensions=3, pivots=pivots) == brute([r[:2] for r in rows], 5, 3, 3)


def test_all_equal_large_and_fewer_than_centroids(spark):
    for rows in ([(i, [0.5, -0.5], 0) for i in range(30)],
                 [(1, [4e6, -4e6], 0), (2, [-4e6, 3.9e6], 0), (3, [0.0, 0.0], 0)],
                 [(1, [0.001, -0.001], 0)]):
        df = spark.createDataFrame(rows, SCHEMA)
        assert found(df, dimensions=2) == brute([r[:2] for r in rows], 16, 3, 2)


def test_rows_that_take_no_part_and_clashing_columns(spark):
    from pyspark.sql import functions as F

    good = [(i, [float(i % 3), i / 7], 0) for i in range(20)]
    bad = [(90, None, 0), (91, [], 0), (92, [1.0], 0), (93, [1.0, None], 0), (94, [1.0, float("nan")], 0),
           (95, [float("inf"), 1.0], 0), (96, [1.0, 2.0, 3.0], 0), (97, [1e30, 1.0], 0)]
    names = ["row", "vec", "apex", "cluster", "distance", "inertia"]
    df = spark.createDataFrame(good + bad, SCHEMA).withColumns({n: F.lit("x") for n in names})
    assert found(df, dimensions=2) == brute([r[:2] for r in good], 16, 3, 2)
    none = spark.createDataFrame(bad, SCHEMA)
    assert cluster(none, dimensions=2).count() == 0
    assert cluster(none.limit(0)).columns == cluster(df, dimensions=2).columns


def test_bounds_hold_and_spare_distances():
    """No nearest centroid is ever filtered, and most others are where clusters are apart."""
    draw = np.random.default_rng(1)
    centres = draw.normal(0, 60, (16, 64))
    vectors = np.floor(centres[draw.integers(0, 16, 3000)] + draw.normal(0, 8, (3000, 64))).astype("i8")
    centroids = np.floor(centres).astype("i8")
    simplex = span(centroids, 8)
    assert len(simplex.pivots) == 8
    apexes, slack = simplex.apexes(vectors)
    best, least, exact = nearest(vectors, apexes, slack, centroids, simplex)
    far = ((vectors[:, None, :] - centroids[None]) ** 2).sum(axis=2)
    assert (least == far.min(axis=1)).all() and (best == far.argmin(axis=1)).all()
    assert exact < 3000 * 6
    tops, _ = simplex.apexes(centroids)
    flat = ((apexes[:, None, :-1] - tops[None, :, :-1]) ** 2).sum(axis=2)
    assert (flat + (apexes[:, -1:] - tops[None, :, -1]) ** 2 <= far + 1e-6 * (far + 1)).all()
    assert (flat + (apexes[:, -1:] + tops[None, :, -1]) ** 2 >= far - 1e-6 * (far + 1)).all()
