"""Exact top-k by inner product: MaxScore over postings, shard by shard.

Every component is a term, with the vectors that have it as its posting list. Candidates lie in
shards of a bounded number of vectors, each written once with its postings and the largest and
smallest value of every term. For a query a term's bound in a shard is the most it can add there.
The terms with the least bounds whose sum stays below the query's k-th score are not essential: a
vector found only in those cannot reach the k-th score. The postings of the others are added up,
then the rest of the terms is looked up, largest bound first, for the vectors that still can compete.

Shards and blocks of queries meet in cells of a grid, both of bounded size; within a cell the k-th
score is carried from shard to shard, and the best of all cells are merged per query. A grid cell
holds one block and reads its shards one after the other; nothing is collected.

Defined results: vectors that :func:`~starling.llm.vectors.whole_vectors` leaves out take no part;
vectors may have different sizes, a component that one lacks counts as 0; a row with an id held by
other rows is a query of its own and these others are candidates; a NULL id is no query and comes
after all others of the same score; fewer candidates than ``k`` give fewer rows; none give none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import batch_of, single_thread, stored
from .vectors import whole_vectors

_SHARD = 8192
_SHARDS_PER_CELL = 4
_BLOCK = 256
_TASKS = 20_000


# A term that this share of a shard's vectors has is a full row of numbers there, others are lists.
_FULL = 0.25
# Terms looked up at a time for the vectors that still can compete.
_STEP = 8
# Sums of whole numbers below this are exact in 64-bit floating point.
_EXACT = 1 << 53


class Shard:
    """Postings of some vectors. A term that most vectors have is kept as its values for all of them;
    one that few have as their places and values. With the largest and smallest value of each."""

    def __init__(self, rows, ids, known, terms, full, starts, places, values, high, low):
        self.rows, self.ids, self.known = rows, ids, known
        self.terms, self.full = terms, full.reshape(len(terms), len(rows))
        self.starts, self.places, self.values = starts, places, values
        self.high, self.low = high, low
        self.line = np.full(len(high), -1)
        self.line[terms] = np.arange(len(terms))

    @classmethod
    def build(cls, rows: np.ndarray, ids: np.ndarray, known: np.ndarray, vectors: list[np.ndarray]):
        sizes = np.array([len(v) for v in vectors])
        width = int(sizes.max(initial=0))
        place = np.repeat(np.arange(len(vectors)), sizes)
        term = np.concatenate([np.arange(n) for n in sizes])
        value = np.concatenate(vectors).astype("i8")
        has = value != 0
        place, term, value = place[has], term[has], value[has]
        high, low = np.zeros(width, "i8"), np.zeros(width, "i8")
        np.maximum.at(high, term, value)
        np.minimum.at(low, term, value)
        terms = np.flatnonzero(np.bincount(term, minlength=width) > _FULL * len(vectors))
        full = np.zeros((len(terms), len(vectors)), "i8")
        line = np.full(width, -1)
        line[terms] = np.arange(len(terms))
        dense = line[term] >= 0
        full[line[term[dense]], place[dense]] = value[dense]
        place, term, value = place[~dense], term[~dense], value[~dense]
        order = np.argsort(term, kind="stable")
        starts = np.searchsorted(term[order], np.arange(width + 1))
        return cls(rows, ids, known, terms, full, starts, place[order], value[order], high, low)

    _TYPES = ("<i8", "<i8", "?", "<i8", "<i4", "<i8", "<i4", "<i4", "<i8", "<i8")

    def pack(self) -> list[bytes]:
        fields = (self.rows, self.ids, self.known, self.terms, self.full, self.starts, self.places,
                  self.values, self.high, self.low)
        return [np.asarray(f).astype(t).tobytes() for f, t in zip(fields, self._TYPES)]

    @classmethod
    def unpack(cls, fields: list[bytes]):
        return cls(*(np.frombuffer(f, dtype=t) for f, t in zip(fields, cls._TYPES)))

    def traverse(self, weights: np.ndarray) -> np.ndarray:
        """Scores of all vectors, a row per query, from its terms with a weight: full terms of all
        queries at once, lists one by one. Exact, in integers where floating point is not."""
        largest = np.maximum(self.high, -self.low)[: weights.shape[1]]
        kind = "f8" if (np.abs(weights) @ largest).max(initial=0) < _EXACT else "i8"
        scores = weights[:, self.terms].astype(kind) @ self.full.astype(kind)
        for query, term in zip(*np.nonzero(weights)):
            if self.line[term] < 0:
                a, b = self.starts[term], self.starts[term + 1]
                scores[query, self.places[a:b]] += weights[query, term] * self.values[a:b].astype(kind)
        return scores

    def probe(self, places: np.ndarray, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """What some terms add for some vectors."""
        lines = self.line[terms]
        found = weights[lines >= 0] @ self.full[np.ix_(lines[lines >= 0], places)].astype("i8")
        for term, weight in zip(terms[lines < 0], weights[lines < 0]):
            a, b = self.starts[term], self.starts[term + 1]
            if a < b:
                at = np.minimum(np.searchsorted(self.places[a:b], places), b - a - 1)
                hit = self.places[a:b][at] == places
                found = found + np.where(hit, weight * self.values[a:b][at].astype("i8"), 0)
        return found


def max_score(
    shard: Shard, queries: np.ndarray, least: list[int | None]
) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """For each row of ``queries``, places and scores of all vectors of a shard that score its
    ``least`` or more, every vector if that is None; and how many values were looked at."""
    queries = queries[:, : len(shard.high)]
    width = queries.shape[1]
    # The most that each term can add in this shard; terms in order of that.
    bounds = np.where(queries > 0, queries * shard.high[:width], queries * shard.low[:width])
    order = np.argsort(-bounds, axis=1, kind="stable")
    sorted_ = np.take_along_axis(bounds, order, axis=1)
    none = np.zeros((len(queries), 1), "i8")
    # What the terms from each one on can add at most.
    rest = np.hstack([np.cumsum(sorted_[:, ::-1], axis=1)[:, ::-1], none])
    essential = [
        width if limit is None or limit <= 0 else int(np.argmax(left < limit))
        for limit, left in zip(least, rest)
    ]
    rank = np.argsort(order, axis=1, kind="stable")
    traversed = shard.traverse(np.where(rank < np.array(essential).reshape(-1, 1), queries, 0))
    for query, limit, terms, left, at, scores in zip(queries, least, order, rest, essential, traversed):
        looked = at * len(scores)
        if limit is None:
            places = np.arange(len(scores))
        else:
            # One that is in no essential list has 0 here, and the rest cannot lift it to the limit.
            places = np.flatnonzero(scores + left[at] >= limit)
        found = scores[places].astype("i8")
        while at < width and len(places):
            some = terms[at : at + _STEP]
            found = found + shard.probe(places, some, query[some])
            looked += len(places) * len(some)
            at += len(some)
            if limit is not None:
                competes = found + left[at] >= limit
                places, found = places[competes], found[competes]
        yield places, found, looked


class _Best:
    """The best of a query so far: scores, and ids with NULLs last among equal scores."""

    def __init__(self, k: int):
        self.k, none = k, np.zeros(0, "i8")
        self.scores, self.ids, self.known = none, none, np.zeros(0, bool)

    @property
    def least(self) -> int | None:
        return int(self.scores[-1]) if len(self.scores) == self.k else None

    def take(self, scores: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        scores = np.concatenate([self.scores, scores])
        ids = np.concatenate([self.ids, ids])
        known = np.concatenate([self.known, known])
        if len(scores) > 4 * self.k:
            enough = scores >= np.partition(scores, -self.k)[-self.k]
            scores, ids, known = scores[enough], ids[enough], known[enough]
        order = np.lexsort([ids, ~known, -scores])[: self.k]
        self.scores, self.ids, self.known = scores[order], ids[order], known[order]


_SHARD_FIELDS = ("rows", "ids", "known", "terms", "full", "starts", "places", "values", "high", "low")
_SHARD_SCHEMA = pa.schema([("number", pa.int64())] + [(f, pa.binary()) for f in _SHARD_FIELDS])
_BLOCK_SCHEMA = pa.schema([
    ("number", pa.int64()), ("queries", pa.list_(pa.int64())), ("query_ids", pa.list_(pa.int64())),
    ("vectors", pa.list_(pa.binary())),
])
_FOUND = pa.schema([
    ("query", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()),
])


def _dealt(vectors: DataFrame, size: int, rows: int, pack, schema: pa.Schema) -> DataFrame:
    """Rows dealt evenly to tasks and packed, ``size`` at a time."""
    tasks = min(_TASKS, max(1, -(-rows // size)))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        single_thread()
        number, held = TaskContext.get().partitionId(), []

        def out():
            return batch_of(schema, {"number": [number], **pack(held)})

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                held.append(row)
                if len(held) == size:
                    yield out()
                    number, held = number + tasks, []
        if held:
            yield out()

    types = {"number": "bigint", "queries": "array<bigint>", "query_ids": "array<bigint>",
             "vectors": "array<binary>"}
    columns = ", ".join(f"`{f.name}` {types.get(f.name, 'binary')}" for f in schema)
    dealt = vectors.select("row", "vec_id", "vec").repartition(tasks, F.xxhash64("row"))
    return stored(dealt.mapInArrow(packed, columns), "packed")


def _shard(rows: list[tuple]) -> dict:
    shard = Shard.build(
        np.array([r[0] for r in rows], "i8"), np.array([r[1] or 0 for r in rows], "i8"),
        np.array([r[1] is not None for r in rows], bool), [np.frombuffer(r[2], "<i4") for r in rows])
    return {name: [field] for name, field in zip(_SHARD_FIELDS, shard.pack())}


def _block(rows: list[tuple]) -> dict:
    columns = zip(("queries", "query_ids", "vectors"), zip(*rows))
    return {name: [list(values)] for name, values in columns}


def _searched(k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of a cell come blocks first, then shards; cells follow each other."""
        single_thread()
        cell, blocks = None, []

        def out(found: list) -> pa.RecordBatch:
            columns = {name: [] for name in _FOUND.names}
            for query, query_id, _, best in found:
                n = len(best.scores)
                columns["query"] += [query] * n
                columns["query_id"] += [query_id] * n
                columns["vec_id"] += [i if there else None for i, there in
                                      zip(best.ids.tolist(), best.known.tolist())]
                columns["score"] += best.scores.tolist()
            return batch_of(_FOUND, columns)

        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                if (row["group"], row["stripe"]) != cell:
                    if blocks:
                        yield out(blocks)
                    cell, blocks = (row["group"], row["stripe"]), []
                if row["queries"] is not None:
                    blocks += [
                        (query, query_id, np.frombuffer(vector, "<i4").astype("i8"), _Best(k))
                        for query, query_id, vector in zip(row["queries"], row["query_ids"], row["vectors"])]
                    continue
                shard = Shard.unpack([row[name] for name in _SHARD_FIELDS])
                width = max(len(vector) for _, _, vector, _ in blocks)
                queries = np.zeros((len(blocks), width), "i8")
                for line, (_, _, vector, _) in zip(queries, blocks):
                    line[: len(vector)] = vector
                hits = max_score(shard, queries, [best.least for *_, best in blocks])
                for (query, _, _, best), (places, scores, _) in zip(blocks, hits):
                    other = shard.rows[places] != query
                    places = places[other]
                    best.take(scores[other], shard.ids[places], shard.known[places])
        if blocks:
            yield out(blocks)

    return search


def top_k(embeddings: DataFrame, queries: Column | str, k: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every row of ``vec_id, embedding`` that ``queries``
    holds for, the ``k`` other rows with the largest inner products of whole-number components;
    equal scores go by the smaller id."""
    spark = embeddings.sparkSession
    queries = F.expr(queries) if isinstance(queries, str) else queries
    vectors = whole_vectors(embeddings)
    asked = vectors.where(F.col("vec_id").isNotNull() & queries)
    sizes = vectors.agg(F.count(F.lit(1)).alias("all"),
                        F.count_if(F.col("vec_id").isNotNull() & queries).alias("asked")).first()
    if not sizes["asked"]:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    shards = _dealt(vectors, _SHARD, sizes["all"], _shard, _SHARD_SCHEMA)
    blocks = _dealt(asked, _BLOCK, sizes["asked"], _block, _BLOCK_SCHEMA)
    groups = -(-sizes["all"] // (_SHARD * _SHARDS_PER_CELL))
    stripes = -(-sizes["asked"] // _BLOCK)
    # A stated set of queries against all rows, block by block.
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    in_cells = blocks.select((F.col("number") % stripes).cast("int").alias("stripe"), every(groups).alias("group"),
                             F.lit(0).alias("kind"), "queries", "query_ids", "vectors")
    read = shards.select((F.col("number") % groups).cast("int").alias("group"), every(stripes).alias("stripe"),
                         F.lit(1).alias("kind"), *_SHARD_FIELDS)
    cells = in_cells.unionByName(read, allowMissingColumns=True)
    tasks = min(_TASKS, groups * stripes)
    found = stored(
        cells.repartition(tasks, "group", "stripe").sortWithinPartitions("group", "stripe", "kind")
        .mapInArrow(_searched(k), "query bigint, query_id bigint, vec_id bigint, score bigint"),
        "found",
    )
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
