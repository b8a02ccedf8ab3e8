"""N-gram Jaccard join by grouped prefixes."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.joins import held_bytes, replicate
from .common import alone, batch_of, byte_words, stored, texts_of, tree_sum
from .components import components

# Hash buckets of the frequency sketch: its size is fixed, whatever the corpus.
_BUCKET_BITS = 20
# Rows without an id get numbers from here on, above all ids.
_NO_ID = 1 << 62
_WORDS_HELD = 1 << 17
# What is copied to every executor, at most.
_COPIED_BYTES = 64 << 20
# A bucket's share of all sets that are compared; a task holds two buckets.
_CELL_BYTES = 16 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(29)

# The parity of a set's shingles by hash bucket, 64 buckets a column.
_PARITY = ("parity0", "parity1", "parity2", "parity3")
_GROUPED = pa.schema([
    ("row", pa.int64()), ("doc", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()),
    ("group_key", pa.binary()), ("prefix", pa.list_(pa.int64())), ("odd", pa.binary()),
    *[(c, pa.int64()) for c in _PARITY],
])
_GROUPED_SQL = (
    "row long, doc long, doc_id long, n long, digest binary, group_key binary, prefix array<long>, odd binary, "
    + ", ".join(f"{c} long" for c in _PARITY)
)
_SETS = pa.schema([("doc", pa.int64()), ("digest", pa.binary()), ("grams", pa.binary())])
_SETS_SQL = "doc long, digest binary, grams binary"
_PAIRS = pa.schema([("a", pa.int64()), ("a_digest", pa.binary()), ("b", pa.int64()), ("b_digest", pa.binary())])
_PAIRS_SQL = "a long, a_digest binary, b long, b_digest binary"


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        found = xxhash.xxh3_64_intdigest(word)
        if len(self) >= _WORDS_HELD:
            self.clear()
        self[word] = found
        return found


_hashes = _WordHashes()


def grams(text: str | None, k: int) -> np.ndarray:
    """The sorted 64-bit hashes of a text's distinct ``k``-word shingles.

    Words are cut at blanks, A-Z lowered. A text of fewer words has one shingle, all of it; a text
    without words has none.
    """
    words = byte_words(text)
    if not words:
        return np.zeros(0, dtype=np.uint64)
    hashes = np.fromiter(map(_hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    width = min(k, len(words))
    windows = len(words) - width + 1
    mixed = np.full(windows, width, dtype=np.uint64)
    for j in range(width):
        mixed = (mixed ^ hashes[j:j + windows]) * _MIX
        mixed ^= mixed >> _SHIFT
    mixed *= _MIX
    return np.unique(mixed ^ (mixed >> np.uint64(32)))


def parity(found: np.ndarray) -> np.ndarray:
    """Whether a bucket holds an odd number of a set's shingles, as 64-bit numbers of ``_PARITY``.

    Two sets' parities differ in at most as many buckets as there are shingles that only one has.
    """
    buckets = 64 * len(_PARITY)
    odd = np.bincount(((found >> _SHIFT) % np.uint64(buckets)).astype(np.int64), minlength=buckets) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def odd_buckets(found: np.ndarray) -> bytes:
    """``parity`` in as many buckets as tell sets of this size apart, a power of two: bits, eight a byte."""
    buckets = max(256, 1 << (2 * len(found) - 1).bit_length()) if len(found) else 256
    odd = np.zeros(buckets, dtype=np.uint8)
    at, times = np.unique(((found >> _SHIFT) % np.uint64(buckets)).astype(np.int64), return_counts=True)
    odd[at] = times & 1
    return np.packbits(odd, bitorder="little").tobytes()


def _apart_by(one: bytes, two: bytes) -> int:
    """In how many buckets two results of ``odd_buckets`` differ; the larger is folded to the smaller."""
    x, y = (np.frombuffer(b, np.uint8) for b in sorted((one, two), key=len))
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


@dataclass(frozen=True)
class Threshold:
    """A Jaccard similarity of at least ``part / whole``, in whole numbers."""

    part: int
    whole: int

    def prefix(self, n: int) -> int:
        """How many of a set's rarest shingles must hold one that a linked set's prefix holds too."""
        return n + (-self.part * n) // self.whole + 1

    def sizes_fit(self, a: Column, b: Column) -> Column:
        return F.least(a, b) * self.whole >= F.greatest(a, b) * self.part

    def can_reach(self, a: Column, b: Column, bound: Column) -> Column:
        """Whether an intersection of at most ``bound`` can link sets of the sizes ``a`` and ``b``."""
        return bound * (self.part + self.whole) >= (a + b) * self.part

    def may_link(self, a: Column, b: Column, apart: Column) -> Column:
        """Whether sets of the sizes ``a`` and ``b`` can be linked if ``apart`` shingles or more are in one only."""
        return apart * (self.part + self.whole) <= (a + b) * (self.whole - self.part)

    def far(self, a: int, b: int, apart: int) -> bool:
        """Not ``may_link``, of whole numbers."""
        return apart * (self.part + self.whole) > (a + b) * (self.whole - self.part)

    def linked(self, common: int, a: int, b: int) -> bool:
        return common * self.whole >= self.part * (a + b - common)


def _apart(one: str, two: str) -> Column:
    """In how many buckets two parities differ, whose columns end on ``one`` and ``two``."""
    return reduce(lambda x, y: x + y, [F.bit_count(F.col(c + one).bitwiseXOR(F.col(c + two))) for c in _PARITY])


def _parity_of(side: str) -> list[Column]:
    return [F.col(c).alias(c + side) for c in _PARITY]


def _keyed(docs: DataFrame) -> DataFrame:
    doc_id = F.col("doc_id").cast("long")
    return docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.coalesce(doc_id, F.monotonically_increasing_id() + F.lit(_NO_ID)).alias("doc"),
        doc_id.alias("doc_id"),
        F.col("text").cast("string").alias("text"),
    )


def gram_frequencies(docs: DataFrame, k: int) -> np.ndarray:
    """How many documents' shingles fall into each bucket of hashes, over all documents."""
    buckets = 1 << _BUCKET_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for (texts,) in texts_of(batch):
                for text in texts:
                    np.add.at(total, (grams(text, k) >> np.uint64(64 - _BUCKET_BITS)).astype(np.int64), 1)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["counts"])

    vectors = docs.select(F.col("text").cast("string")).mapInArrow(run, "counts binary")
    return tree_sum(vectors, "counts", "i8", buckets)


def grouped_prefixes(keyed: DataFrame, frequencies: np.ndarray, k: int, threshold: Threshold) -> DataFrame:
    """Each document's set size, digests of its set and of (size, prefix), and its prefix.

    The prefix holds a set's rarest shingles, by the frequency of their bucket and then by hash:
    one order for all documents, from which two linked sets must share a shingle of their prefixes.
    """
    held = keyed.sparkSession.sparkContext.broadcast(
        np.minimum(frequencies, np.iinfo(np.int32).max).astype(np.int32)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = held.value
        for rows, docs, doc_ids, texts in (part for batch in batches for part in texts_of(batch)):
            out = {name: [] for name in _GROUPED.names}
            for row, doc, doc_id, text in zip(rows, docs, doc_ids, texts):
                found = grams(text, k)
                n = len(found)
                order = np.lexsort((found, rank[(found >> np.uint64(64 - _BUCKET_BITS)).astype(np.int64)]))
                prefix = found[order[: threshold.prefix(n) if n else 0]].view(np.int64)
                odd = odd_buckets(found)
                whole = blake2b(found.tobytes(), digest_size=16).digest()
                key = blake2b(prefix.tobytes() + n.to_bytes(8, "little"), digest_size=16).digest()
                for name, value in zip(_GROUPED.names, (row, doc, doc_id, n, whole, key, prefix, odd, *parity(found))):
                    out[name].append(value)
            yield batch_of(_GROUPED, out)

    return keyed.mapInArrow(run, _GROUPED_SQL)


def _sets_of(keyed: DataFrame, pairs: DataFrame, k: int, at_most: int) -> DataFrame:
    """The whole sets of the documents in ``pairs`` (``a`` and ``b``), made from their texts again."""
    ids = pairs.select(F.col("a").alias("doc")).union(pairs.select("b")).distinct()
    # Ids that may be too many to copy are measured and then joined.
    wanted = ids if at_most <= _COPIED_BYTES else stored(ids, "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for docs, texts in (part for batch in batches for part in texts_of(batch)):
            sets = [grams(t, k).tobytes() for t in texts]
            yield batch_of(_SETS, {
                "doc": docs, "digest": [blake2b(s, digest_size=16).digest() for s in sets], "grams": sets,
            })

    # The ids are copied to the executors up to 64 MB; above that, texts are shuffled.
    some = keyed.join(replicate(wanted, _COPIED_BYTES, at_most), "doc", "left_semi")
    return some.select("doc", "text").mapInArrow(run, _SETS_SQL)


def _close(pairs: DataFrame, rows: DataFrame, threshold: Threshold, at_most: int) -> DataFrame:
    """The rows of ``pairs`` (``a, a_digest, b, b_digest``) that the odd buckets of their sets do not rule out.

    These are a sixteenth of a set or less, so few pairs are left for which whole sets travel. ``pairs``
    hold ``at_most`` so many bytes, and so do the ids of both sides, or of some of the pairs; what is
    copied of them is measured by itself only where these may be too many.
    """
    ends = pairs.select(F.col("a").alias("doc"), F.col("a_digest").alias("digest")).union(
        pairs.select("b", "b_digest")).distinct()
    some = rows.select("doc", "digest", "n", "odd").join(
        replicate(ends, _COPIED_BYTES, 2 * at_most), ["doc", "digest"], "left_semi")
    # Rows of one class and one id have equal sets. Both sides take the same rows, so these move once.
    known = some.groupBy("doc", "digest").agg(F.first("n").alias("n"), F.first("odd").alias("odd"))

    def side(name: str) -> DataFrame:
        return known.toDF(name, f"{name}_digest", f"{name}_n", f"{name}_odd")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for a, a_digest, b, b_digest, *sets in (part for batch in batches for part in texts_of(batch)):
            keep = [not threshold.far(m, n, _apart_by(x, y)) for m, n, x, y in zip(*sets)]
            yield batch_of(_PAIRS, {"a": a, "a_digest": a_digest, "b": b, "b_digest": b_digest}).filter(
                pa.array(keep, pa.bool_()))

    both = pairs.join(side("b"), ["b", "b_digest"]).join(side("a"), ["a", "a_digest"])
    return stored(both.select(*_PAIRS.names, "a_n", "b_n", "a_odd", "b_odd").mapInArrow(run, _PAIRS_SQL), "close")


def verified(pairs: DataFrame, keyed: DataFrame, k: int, threshold: Threshold, at_most: int) -> DataFrame:
    """The pairs ``a, a_digest, b, b_digest`` whose whole sets are similar enough: ``a, b``.

    Sets are joined to the side that repeats first, so a set that many others are compared with is
    not what the second shuffle deals by; they are the same rows for both sides, and move once.
    ``at_most`` is as in ``_close``.
    """
    sets = stored(_sets_of(keyed, pairs, k, at_most), "sets")

    def side(name: str) -> DataFrame:
        return sets.toDF(name, f"{name}_digest", f"{name}_grams")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for first, second, *sets in (part for batch in batches for part in texts_of(batch)):
            keep = []
            for x, y in zip(*sets):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(threshold.linked(common, len(x), len(y)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(first, pa.int64()), pa.array(second, pa.int64())], names=["a", "b"]
            ).filter(pa.array(keep, pa.bool_()))

    both = pairs.join(side("b"), ["b", "b_digest"]).join(side("a"), ["a", "a_digest"])
    return both.select("a", "b", "a_grams", "b_grams").mapInArrow(run, "a long, b long")


def _verified_by_cell(
    pairs: DataFrame, keyed: DataFrame, k: int, threshold: Threshold, at_most: int
) -> DataFrame:
    """The rows of ``pairs`` (``a, a_digest, b, b_digest``) whose whole sets are similar enough.

    Classes fall into buckets and pairs into cells of two buckets. A set goes once to each cell that
    compares it, however many pairs it has there, and a task holds one cell's sets at a time.
    ``at_most`` is as in ``_close``.
    """
    sets = stored(_sets_of(keyed, pairs, k, at_most), "sets")
    held = sets.agg(F.sum(F.length("grams"))).first()[0] or 0
    spread = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(-(-held // _CELL_BYTES), 2 * math.isqrt(spread) + 2)
    bucket = lambda c: F.pmod(F.xxhash64(c), F.lit(buckets))
    dealt = pairs.withColumn("cell", bucket("a_digest") * buckets + bucket("b_digest"))
    wanted = dealt.select("cell", F.col("a_digest").alias("digest")).union(dealt.select("cell", "b_digest")).distinct()
    brought = wanted.join(sets.select("digest", "grams"), "digest").select(
        "cell", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("a"), F.col("digest").alias("a_digest"),
        F.lit(None).cast("long").alias("b"), F.lit(None).cast("binary").alias("b_digest"), "grams",
    )
    asked = dealt.select(
        "cell", F.lit(1).alias("kind"), "a", "a_digest", "b", "b_digest", F.lit(None).cast("binary").alias("grams")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sets = None, {}
        for columns in (part for batch in batches for part in texts_of(batch)):
            found = []
            for cell, kind, a, a_digest, b, b_digest, own in zip(*columns):
                if cell != now:
                    now, sets = cell, {}
                if kind == 0:
                    sets[a_digest] = np.frombuffer(own, np.uint64)
                    continue
                x, y = sets[a_digest], sets[b_digest]
                if threshold.linked(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y)):
                    found.append((a, a_digest, b, b_digest))
            if found:
                yield batch_of(_PAIRS, dict(zip(_PAIRS.names, zip(*found))))

    both = brought.unionByName(asked).repartition("cell").sortWithinPartitions("cell", "kind")
    return both.mapInArrow(run, _PAIRS_SQL)


def jaccard_components(docs: DataFrame, k: int = 5, part: int = 80, whole: int = 100) -> DataFrame:
    """Documents connected by links: shingle sets with a Jaccard similarity of ``part / whole`` or more.

    Returns ``doc_id, n_shingles, component_id`` (the smallest id reachable, NULL if none is known),
    a row for every row. Texts without words have no shingle and link with nothing; rows that share
    an id are one node of the graph; rows without an id are nodes of their own. Columns other than
    ``doc_id`` and ``text`` are not looked at; an empty table gives no rows.

    Documents with equal prefixes and sizes form a group, and equal sets within it a class, so any
    number of copies goes on as one. Groups meet in the lists of their prefix shingles, where sizes
    and places in the prefix rule pairs out. Not all pairs of a list need be verified: first each
    class meets the group of its lists that stands nearest to the front, as most near copies link
    to the least altered one; then only pairs from different components are left, and all of these
    that the filters let through are verified. The last filters are bounds on the shingles that only
    one of two sets has (``parity``, and ``odd_buckets`` for sets of any size), so a common passage does
    not make sets travel. Components are thus exactly those of all links.
    """
    threshold = Threshold(part, whole)
    keyed = _keyed(docs)
    rows, classes, lists = _grouped(docs, keyed, k, threshold)
    linked = _link_to_front(lists, classes, rows, keyed, k, threshold)
    rest = _link_across(lists, classes, linked, rows, keyed, k, threshold)
    nodes = _with_component(classes, linked.unionByName(rest)).select("doc", "copies", "digest", "label")
    return _of_rows(rows, nodes).select("doc_id", "n_shingles", "component_id")


@dataclass(frozen=True)
class Linked:
    """All links of a table: pairs of classes, and the class that each row belongs to.

    ``classes`` has a row for each distinct set: ``digest, doc`` (its smallest document), ``n``
    shingles and ``copies``. ``pairs`` has each two linked classes once, ``a, a_digest, b,
    b_digest`` as their documents and digests; a class is linked with itself, which no row says.
    ``rows`` has ``doc, doc_id, n, digest`` for every row; those without words are in no class.
    """

    rows: DataFrame
    classes: DataFrame
    pairs: DataFrame


def similarity_join(docs: DataFrame, k: int = 5, part: int = 80, whole: int = 100) -> Linked:
    """All pairs of shingle sets with a Jaccard similarity of ``part / whole`` or more.

    Every two groups that share a list and pass the filters of size and place are expanded to their
    classes, as are the classes of one group among themselves, and every such pair is verified unless
    the parities of its sets rule it out.
    """
    threshold = Threshold(part, whole)
    keyed = _keyed(docs)
    rows, classes, lists = _grouped(docs, keyed, k, threshold)
    one, two = (
        classes.select("group", F.col("doc").alias(c), F.col("digest").alias(f"{c}_digest"),
                       F.col("n").alias(f"{c}_n"), *_parity_of(f"_{c}"))
        for c in "ab"
    )
    near = threshold.may_link(F.col("a_n"), F.col("b_n"), _apart("_a", "_b"))
    across = (
        _group_pairs(lists, threshold).join(one.withColumnRenamed("group", "group1"), "group1")
        .join(two.withColumnRenamed("group", "group2"), "group2").where(near).select("a", "a_digest", "b", "b_digest")
    )
    inside = one.join(two, "group").where("a_digest < b_digest").where(near).select(*across.columns)
    pairs = stored(across.unionByName(inside), "pairs")
    size = held_bytes(pairs)
    close = _close(pairs, rows, threshold, size)
    return Linked(rows, classes, stored(_verified_by_cell(close, keyed, k, threshold, size), "links"))


def jaccard_links(docs: DataFrame, k: int = 5, part: int = 80, whole: int = 100) -> DataFrame:
    """``jaccard_components`` with ``n_links``: with how many other rows a row is linked.

    Components come from all links here. Rows with equal sets are linked; texts without words are
    linked with nothing.
    """
    linked = similarity_join(docs, k, part, whole)
    ends = linked.pairs.select(F.col("a_digest").alias("digest"), F.col("b_digest").alias("other")).union(
        linked.pairs.select("b_digest", "a_digest")
    )
    sizes = linked.classes.select(F.col("digest").alias("other"), "copies")
    partners = ends.join(sizes, "other").groupBy("digest").agg(F.sum("copies").alias("others"))
    nodes = _with_component(linked.classes, linked.pairs.select("a", "b")).join(partners, "digest", "left").select(
        "doc", "copies", "digest", "label", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    return _of_rows(linked.rows, nodes).select(
        "doc_id", "n_shingles", "component_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")
    )


def _grouped(
    docs: DataFrame, keyed: DataFrame, k: int, threshold: Threshold
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows' set digests, the classes of equal sets in their groups, and the prefix lists."""
    rows = stored(grouped_prefixes(keyed, gram_frequencies(docs, k), k, threshold), "prefixes")
    found = rows.where("n > 0")
    # A class keeps the smallest document; its group's number is the group's smallest document.
    classes = stored(
        found.groupBy("group_key", "n", "digest", *_PARITY).agg(
            F.min("doc").alias("doc"), F.min_by("row", "doc").alias("row"), F.count(F.lit(1)).alias("copies")),
        "classes",
    )
    groups = classes.groupBy("group_key").agg(
        F.min("doc").alias("group"), F.min_by("digest", "doc").alias("group_digest"),
        F.count(F.lit(1)).alias("classes"),
    )
    classes = stored(
        classes.join(groups, "group_key").select(
            "group", "group_digest", "classes", "n", "doc", "row", "digest", "copies", *_PARITY
        ),
        "classes",
    )
    # One row of each group brings the group's prefix.
    heads = classes.where("digest = group_digest").select("row", "group", "n")
    entries = found.select("row", "prefix").join(heads, "row").select(
        "group", "n", F.posexplode("prefix").alias("place", "token")
    )
    token = Window.partitionBy("token")
    lists = stored(
        entries.withColumn("members", F.count(F.lit(1)).over(token))
        .withColumn("front", F.min(F.struct("place", "group", "n")).over(token))
        .where("members > 1"),
        "lists",
    )
    return rows, classes, lists


def _with_component(classes: DataFrame, links: DataFrame) -> DataFrame:
    """The classes with ``label``, the smallest document that links lead to."""
    together = components(links)
    return classes.join(together, classes["doc"] == together["node"], "left").withColumn(
        "label", F.coalesce("component", "doc")
    )


def _of_rows(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """Every row with what ``nodes`` says of its class, by ``digest``; ``label`` becomes the component."""
    # A set's class is known by its digest; a hot class is one row here, and the salt splits its copies.
    # That of a class of one row is the row's own.
    salts = 32
    salt = F.pmod(F.xxhash64("doc"), F.lit(salts)).cast("int")
    all_salts = F.sequence(F.lit(0), F.lit(salts - 1))
    salted = nodes.withColumn("salt", F.explode(F.when(F.col("copies") == 1, F.array(salt)).otherwise(all_salts)))
    out = rows.select("doc", "doc_id", "n", "digest").withColumn("salt", salt).join(
        salted.drop("doc", "copies"), ["digest", "salt"], "left")
    component = F.when(F.col("n") > 0, F.col("label")).otherwise(F.col("doc"))
    return out.withColumn("component_id", F.when(component < _NO_ID, component)).withColumnRenamed("n", "n_shingles")


def _group_pairs(lists: DataFrame, threshold: Threshold) -> DataFrame:
    """The pairs ``group1, group2`` that share a list and pass the filters of size and place, each once."""
    band = F.floor(F.log("n") / math.log(threshold.whole / threshold.part)).cast("int")
    entries = lists.select("token", "group", "n", "place", band.alias("band"))
    left = entries.toDF("token", "g1", "n1", "place1", "band1").withColumn(
        "band2", F.explode(F.array("band1", F.col("band1") + 1))
    )
    right = entries.toDF("token", "g2", "n2", "place2", "band2")
    return (
        left.join(right, ["token", "band2"])
        .where((F.col("g1") < F.col("g2")) | ((F.col("band1") < F.col("band2")) & (F.col("g1") > F.col("g2"))))
        .where(threshold.sizes_fit(F.col("n1"), F.col("n2")))
        .where(threshold.can_reach(
            F.col("n1"), F.col("n2"), _bound(F.col("n1"), F.col("place1"), F.col("n2"), F.col("place2"))
        ))
        .select(F.least("g1", "g2").alias("group1"), F.greatest("g1", "g2").alias("group2"))
        .distinct()
    )


def _bound(n1: Column, place1: Column, n2: Column, place2: Column) -> Column:
    """The largest intersection of two sets whose first common shingle has these places."""
    return F.least(n1 - place1, n2 - place2)


def _link_to_front(
    lists: DataFrame, classes: DataFrame, rows: DataFrame, keyed: DataFrame, k: int, threshold: Threshold
) -> DataFrame:
    """Links of each class to its group's first class and to one group at the front of its lists."""
    front = F.col("front")
    bound = _bound(F.col("n"), F.col("place"), front["n"], front["place"])
    near = (
        lists.where(F.col("group") != front["group"])
        .where(threshold.sizes_fit(F.col("n"), front["n"]))
        .where(threshold.can_reach(F.col("n"), front["n"], bound))
        .groupBy("group").agg(F.min(F.struct((-bound).alias("least"), front["group"].alias("to"))).alias("best"))
        .select("group", F.col("best.to").alias("b"))
    )
    first = classes.where("digest = group_digest").select(
        F.col("group").alias("b"), F.col("group_digest").alias("b_digest"), F.col("n").alias("b_n"), *_parity_of("_b")
    )
    one = classes.select(
        "group", "group_digest", F.col("doc").alias("a"), F.col("digest").alias("a_digest"), F.col("n").alias("a_n"),
        *_parity_of("_a"),
    )
    close = threshold.may_link(F.col("a_n"), F.col("b_n"), _apart("_a", "_b"))
    outside = one.join(near.join(first, "b"), "group").where(close).select("a", "a_digest", "b", "b_digest")
    inside = one.where("a_digest <> group_digest").join(first.withColumn("group", F.col("b")), "group").where(
        close).select(*outside.columns)
    pairs = stored(outside.unionByName(inside), "pairs")
    size = held_bytes(pairs)
    close = _close(pairs, rows, threshold, size)
    return stored(verified(close, keyed, k, threshold, size), "links")


def _side(members: DataFrame, side: str, names: dict[str, str]) -> DataFrame:
    renamed = {"band": f"band{side}", "label": f"label{side}", "n": f"n{side}", "place": f"place{side}",
               "before": f"before{side}", "off": f"off{side}", **names, **{c: f"{c}_{side}" for c in _PARITY}}
    return members.select(*[F.col(c).alias(renamed.get(c, c)) for c in members.columns])


def _reaching(members: DataFrame, heads: DataFrame, threshold: Threshold) -> DataFrame:
    """Members of one component beside another component that they may reach in a list."""
    key = ["kind", "token"]
    # The list before, if it is the same for all members of a part.
    same = F.when((F.count("before") == F.count(F.lit(1))) & (F.min("before") == F.max("before")), F.min("before"))
    parts = members.groupBy(*key, "band", "label").agg(
        F.min("n").alias("least"), F.max("n").alias("most"), F.min("place").alias("place"), same.alias("before"),
        F.max("off").alias("off"),
    )
    left = parts.select(*[F.col(c).alias(c if c in key else f"{c}1") for c in parts.columns]).withColumn(
        "band2", F.explode(F.array("band1", F.col("band1") + 1))
    )
    right = parts.select(*[F.col(c).alias(c if c in key else f"{c}2") for c in parts.columns])
    reach = F.least(F.col("most1") - F.col("place1"), F.col("most2") - F.col("place2"))
    met = left.join(right, [*key, "band2"]).where(
        ((F.col("band1") < F.col("band2")) & (F.col("label1") != F.col("label2")))
        | ((F.col("band1") == F.col("band2")) & (F.col("label1") < F.col("label2")))
    ).where(threshold.can_reach(F.col("least1"), F.col("least2"), reach)).where(
        F.col("most1") * threshold.whole >= F.col("least2") * threshold.part
    ).where(F.coalesce(F.col("before1") != F.col("before2"), F.lit(True))).select(
        *key, "band1", "label1", "band2", "label2", F.col("least2").alias("other_least"),
        (F.col("most2") - F.col("place2")).alias("other_reach"), F.col("most2").alias("other_most"),
        F.col("before2").alias("other_before"), F.col("off2").alias("other_off"),
    )
    met = met.join(heads.drop("held").withColumnRenamed("label", "label2"), "label2")
    one = _side(members, "1", {"doc": "a", "digest": "a_digest"})
    # A member that reaches nothing of the other component goes before that one's members come in.
    return met.join(one, [*key, "band1", "label1"]).where(threshold.can_reach(
        F.col("n1"), F.col("other_least"), F.least(F.col("n1") - F.col("place1"), F.col("other_reach"))
    )).where(F.coalesce(F.col("before1") != F.col("other_before"), F.lit(True))).where(
        threshold.may_link(F.col("n1"), F.col("other_most"), _apart("_1", "_head") - F.col("other_off"))
    )


def _link_across(
    lists: DataFrame, classes: DataFrame, linked: DataFrame, rows: DataFrame, keyed: DataFrame, k: int,
    threshold: Threshold,
) -> DataFrame:
    """Links between classes of different components of ``linked`` that share a list or a group.

    Pairs are formed between components within a list, by bands of sizes of which only neighbours
    can be linked; a component's members come in where the components' extremes pass the filters. Where
    the lists before a list are the same for two groups, they meet in that one, nearer to the front;
    components of which this is true as a whole do not meet at all. A member is compared with the other
    component's head before that one's members come in: none of them is nearer to it than the head is,
    less what the members there are ``off`` the head.
    """
    labels = components(linked)
    labelled = classes.join(labels, classes["doc"] == labels["node"], "left").select(
        "group", "classes", "n", "doc", "digest", F.coalesce("component", "doc").alias("label"), *_PARITY
    )
    heads = stored(
        labelled.groupBy("label").agg(F.min(F.struct("digest", *_PARITY)).alias("head"), F.count(F.lit(1)).alias("held"))
        .select("label", "held", *[F.col(f"head.{c}").alias(f"{c}_head") for c in _PARITY]), "heads")
    several = replicate(heads.where("held > 1").drop("held"), _COPIED_BYTES)
    labelled = labelled.join(several, "label", "left").withColumn(
        "off", F.coalesce(_apart("", "_head"), F.lit(0))).select(*labelled.columns, "off")
    before = F.lag("token").over(Window.partitionBy("group").orderBy("place", "token"))
    shared = lists.select("token", "group", "place", before.alias("before")).join(labelled.drop("classes"), "group")
    own = labelled.where("classes > 1").select(
        F.col("group").alias("token"), "group", F.lit(0).alias("place"),
        F.lit(None).cast("long").alias("before"), "n", "doc", "digest", "label", *_PARITY, "off"
    )
    members = shared.withColumn("kind", F.lit(0)).unionByName(own.withColumn("kind", F.lit(1))).drop("group")
    key = ["kind", "token"]
    in_list = Window.partitionBy(*key)
    members = stored(
        members.withColumn("low", F.min("label").over(in_list)).withColumn("high", F.max("label").over(in_list))
        .where("low < high").drop("low", "high")
        .withColumn("band", F.floor(F.log("n") / math.log(threshold.whole / threshold.part)).cast("int")),
        "members",
    )
    two = _side(members, "2", {"doc": "b", "digest": "b_digest"})
    pairs = (
        _reaching(members, heads, threshold).join(two, [*key, "band2", "label2"])
        .where(threshold.sizes_fit(F.col("n1"), F.col("n2")))
        .where(F.coalesce(F.col("before1") != F.col("before2"), F.lit(True)))
        .where(threshold.may_link(F.col("n1"), F.col("n2"), _apart("_1", "_2")))
        .where(threshold.can_reach(
            F.col("n1"), F.col("n2"), _bound(F.col("n1"), F.col("place1"), F.col("n2"), F.col("place2"))
        ))
        .select("a", "a_digest", "b", "b_digest").distinct()
    )
    pairs = stored(pairs, "pairs")
    size = held_bytes(pairs)
    close = _close(pairs, rows, threshold, size)
    return stored(verified(close, keyed, k, threshold, size), "links")


def one_of_each(docs: DataFrame, k: int = 5, part: int = 80, whole: int = 100) -> DataFrame:
    """One row of ``docs`` for each component of similar texts: that of the smallest ``doc_id``.

    Rows count by themselves here, whatever their ids: near copies without ids or with one id leave
    one row, and a text that shares an id with another's near copy stays. A row is known by its place
    in ``docs``, which must give the same rows in the same order each time it is read.
    """
    row = "__row"
    columns = [F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString()]
    # True of every row. It makes each reading take the same columns, as a shuffle on the way to docs
    # would deal rows by the columns that are left to it, and number them otherwise each time.
    same = F.xxhash64(*columns).bitwiseOR(F.lit(1)) != 0
    numbered = docs.withColumn(row, F.monotonically_increasing_id()).where(same)

    def others() -> DataFrame:
        rows = numbered.select(F.col("doc_id").cast("long").alias("id"), F.col(row).alias("doc_id"), "text")
        found = jaccard_components(rows.select("doc_id", "text"), k, part, whole)
        near = stored(
            found.join(found.where("component_id < doc_id").select("component_id").distinct(), "component_id")
            .select("doc_id", "component_id"), "near")
        known = rows.select("doc_id", "id").join(replicate(near, _COPIED_BYTES), "doc_id")
        first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "doc_id")).alias("first")
        stays = known.groupBy("component_id").agg(first).select(F.col("first.doc_id").alias("doc_id"))
        return near.select("doc_id").join(stays, "doc_id", "left_anti").select(F.col("doc_id").alias(row))

    gone = alone(docs.sparkSession, "gone", others)
    return numbered.join(replicate(gone, _COPIED_BYTES), row, "left_anti").select(*docs.columns)
