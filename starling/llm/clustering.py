"""Clusters around centroids, with an n-simplex projection in front of every exact distance.

A few pivots span a simplex. The distances of a vector to them, measured once and kept as the
coordinates of an apex over that simplex, bound its distance to any other vector from below (apex to
apex) and from above (apex to the other apex mirrored in the base). A centroid whose lower bound is
above the least upper bound cannot be the nearest; the others are compared exactly, in integers.

Every round reads the kept vectors and returns one fixed-size sum per task, added up in a tree; no
vector is shuffled. What is broadcast, pivots and centroids, is fixed by the parameters.

Defined results: vectors that :func:`~starling.llm.vectors.whole_vectors` leaves out have no row;
rows with one id are vectors of their own; with fewer vectors than centroids each vector is one; no
vectors give no rows; among equal hashes the lesser vector starts first. A NULL id hashes as empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import batch_of, single_thread, stored, tree_sum
from .vectors import matrix_of, whole_vectors

# Bounds are floating-point: they are widened by this share of the squared distances they come from,
# far above what rounding can add at the flattest simplex allowed (_FLAT).
_SLACK = 1e-6
_FLAT = 1e-2


@dataclass(frozen=True)
class Simplex:
    """Pivots, the first at the origin, and the inverse of the triangle that places the others."""

    pivots: np.ndarray
    inverse: np.ndarray
    lengths: np.ndarray

    def apexes(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Apex coordinates of each vector, its altitude last, and the slack of its bounds."""
        points = vectors.astype("f8")
        far = ((points[:, None, :] - self.pivots[None, :, :]) ** 2).sum(axis=2)
        right = (far[:, :1] - far[:, 1:] + self.lengths) / 2
        base = right @ self.inverse.T
        altitude = np.sqrt(np.maximum(far[:, 0] - (base ** 2).sum(axis=1), 0))
        return np.column_stack([base, altitude]), _SLACK * (far.max(axis=1) + 1)


def span(vectors: np.ndarray, count: int) -> Simplex:
    """Up to ``count`` of ``vectors`` as pivots, each as far as can be from the span of those before.

    Fewer where the rest lies almost in that span, as a flat simplex bounds nothing and rounds badly.
    """
    points = vectors.astype("f8")
    moved = points - points[0]
    chosen, axes, rest = [0], [], moved.copy()
    scale = np.sqrt((moved ** 2).sum(axis=1).max())
    while len(chosen) < count:
        altitude = np.sqrt((rest ** 2).sum(axis=1))
        farthest = int(altitude.argmax())
        if altitude[farthest] <= _FLAT * scale or scale == 0:
            break
        axis = rest[farthest] / altitude[farthest]
        axes.append(axis)
        rest = rest - np.outer(rest @ axis, axis)
        chosen.append(farthest)
    triangle = moved[chosen[1:]] @ np.array(axes).reshape(len(axes), points.shape[1]).T
    inverse = np.linalg.inv(triangle) if axes else np.zeros((0, 0))
    return Simplex(points[chosen], inverse, (triangle ** 2).sum(axis=1))


def nearest(
    vectors: np.ndarray, apexes: np.ndarray, slack: np.ndarray, centroids: np.ndarray,
    simplex: Simplex,
) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and squared distance of the nearest centroid of each vector, the smaller number among
    equals; and how many exact distances that took."""
    tops, loose = simplex.apexes(centroids)
    base = ((apexes[:, None, :-1] - tops[None, :, :-1]) ** 2).sum(axis=2)
    below = base + (apexes[:, -1:] - tops[None, :, -1]) ** 2
    above = base + (apexes[:, -1:] + tops[None, :, -1]) ** 2
    margin = slack[:, None] + loose[None, :]
    open_ = below - margin <= (above + margin).min(axis=1)[:, None]
    best = np.full(len(vectors), -1, dtype="i8")
    least = np.full(len(vectors), np.iinfo("i8").max, dtype="i8")
    for number, centroid in enumerate(centroids):
        rows = np.flatnonzero(open_[:, number])
        distance = ((vectors[rows].astype("i8") - centroid) ** 2).sum(axis=1)
        nearer = (distance < least[rows]) | (best[rows] < 0)
        best[rows[nearer]] = number
        least[rows[nearer]] = distance[nearer]
    return best, least, int(open_.sum())


_CACHED = pa.schema([("vec_id", pa.int64()), ("vec", pa.binary()), ("apex", pa.binary())])


def _projected(vectors: DataFrame, simplex: Simplex, dimensions: int) -> DataFrame:
    """The vectors with their apex and the slack of its bounds, kept for all rounds."""
    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        single_thread()
        for batch in batches:
            ids, packed = batch.columns
            apexes, slack = simplex.apexes(matrix_of(packed, dimensions))
            rows = np.column_stack([apexes, slack]).astype("<f8")
            yield batch_of(_CACHED, {"vec_id": ids, "vec": packed, "apex": [r.tobytes() for r in rows]})

    rows = vectors.select("vec_id", "vec").mapInArrow(project, "vec_id bigint, vec binary, apex binary")
    return stored(rows, "apexes")


def _assigned(dimensions: int, centroids: np.ndarray, simplex: Simplex) -> Callable:
    width = len(simplex.pivots) + 1

    def assign(batch: pa.RecordBatch):
        vectors = matrix_of(batch.column("vec"), dimensions)
        rows = np.frombuffer(b"".join(batch.column("apex").to_pylist()), dtype="<f8").reshape(-1, width)
        return vectors, *nearest(vectors, rows[:, :-1], rows[:, -1], centroids, simplex)

    return assign


def _moved(cached: DataFrame, centroids: np.ndarray, simplex: Simplex) -> np.ndarray:
    """The centroids after one round: the floor of the mean of each one's vectors."""
    count, dimensions = centroids.shape
    assign = _assigned(dimensions, centroids, simplex)
    schema = pa.schema([("sums", pa.binary())])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        single_thread()
        total = np.zeros((count, dimensions + 1), dtype="<i8")
        for batch in batches:
            vectors, best, _, _ = assign(batch)
            np.add.at(total, best, np.column_stack([vectors, np.ones(len(best), dtype="i8")]))
        yield batch_of(schema, {"sums": [total.tobytes()]})

    sums = tree_sum(cached.mapInArrow(add_up, "sums binary"), "sums", "<i8", count * (dimensions + 1))
    sums = sums.reshape(count, dimensions + 1)
    held = np.maximum(sums[:, -1:], 1)
    return np.where(sums[:, -1:] > 0, sums[:, :-1] // held, centroids)


def cluster(
    embeddings: DataFrame, count: int = 16, rounds: int = 3, dimensions: int = 64, pivots: int = 8
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` for every vector of
    ``dimensions`` finite components in ``vec_id, embedding``.

    The centroids start as the vectors with the smallest sha256 of ``1:<vec_id>``, in that order;
    each round assigns all vectors and moves every centroid that has any. Sums that need more than
    64 bits come back as NULL.
    """
    vectors = whole_vectors(embeddings, dimensions)
    name = F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    first = vectors.orderBy(F.sha2(name, 256), "vec").limit(count).select("vec").collect()
    schema = "vec_id bigint, cluster int, distance bigint"
    result = f"{schema}, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    if not first:
        return embeddings.sparkSession.createDataFrame([], result)
    centroids = matrix_of(pa.array([bytes(r["vec"]) for r in first]), dimensions).astype("i8")
    simplex = span(centroids, pivots)
    cached = _projected(vectors, simplex, dimensions)
    for _ in range(rounds):
        centroids = _moved(cached, centroids, simplex)

    assign = _assigned(dimensions, centroids, simplex)
    out = pa.schema([("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64())])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        single_thread()
        for batch in batches:
            _, best, least, _ = assign(batch)
            yield batch_of(out, {"vec_id": batch.column("vec_id"), "cluster": best, "distance": least})

    placed = stored(cached.mapInArrow(number, schema), "clusters")
    wide = F.sum(F.col("distance").cast("decimal(38,0)"))
    # One row per centroid.
    sums = {r["cluster"]: int(r["s"]) for r in placed.groupBy("cluster").agg(wide.alias("s")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    fits = lambda n: n if n < 1 << 63 else None
    facts = embeddings.sparkSession.createDataFrame(
        [(c, fits(s), fits(sum(sums.values())), digests[c]) for c, s in sums.items()],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return placed.join(F.broadcast(facts), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
