"""Best-fit packing of token sequences with a bounded number of open bins."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import batch_of, stored, texts_of
from .tokens import WORDS, encoder

_PIECES = pa.schema([
    ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
    ("ids_crc32", pa.int64()),
])
_PACKED = pa.schema([*_PIECES, ("sequence_id", pa.int64()), ("offset", pa.int64())])
_PIECES_SQL = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PACKED_SQL = _PIECES_SQL + ", sequence_id long, offset long"
# A sequence's number holds its task above so many bits.
_TASK_BIT = 40


class OpenBins:
    """At most ``count`` open bins of ``capacity``, found by their free space in a bitset.

    Bit f is set while a bin with f free places is open. An item goes to the bin it fits best: the
    lowest set bit at or above its length. If it fits none and all bins are open, the fullest (the
    lowest set bit) closes and a new one opens. A bin that is full closes at once.
    """

    def __init__(self, capacity: int, count: int):
        self.capacity, self.count = capacity, count
        self.bits = 0
        self.open = 0
        self.made = 0
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _take(self, free: int) -> int:
        found = self.bins[free].pop()
        if not self.bins[free]:
            self.bits &= ~(1 << free)
        self.open -= 1
        return found

    def place(self, length: int) -> tuple[int, int]:
        """The bin's number and the place in it for an item of 1 to ``capacity``."""
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            if length < self.capacity and self.open >= self.count:
                self._take((self.bits & -self.bits).bit_length() - 1)
            number, free = self.made, self.capacity
            self.made += 1
        left = free - length
        if left:
            self.bins[left].append(number)
            self.bits |= 1 << left
            self.open += 1
        return number, self.capacity - free


def cut(total: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of ``total`` tokens; only the first may be shorter."""
    first = total % capacity or min(total, capacity)
    starts = [0, *range(first, total, capacity)]
    return [(s, first if not s else capacity) for s in starts]


def token_pieces(
    docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 0, words: int = WORDS
) -> DataFrame:
    """Each document's ids and ``end_id``, cut where longer than ``capacity``: a row per piece.

    ``doc_id, piece, start, length, ids_crc32``. NULL and empty texts are one piece, the end id.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, words).ids
        end = end_id.to_bytes(4, "little")
        for doc_ids, texts in (part for batch in batches for part in texts_of(batch, 128)):
            out = {name: [] for name in _PIECES.names}
            for doc_id, text in zip(doc_ids, texts):
                ids = encode(text) + end
                for n, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    crc = zlib.crc32(ids[4 * start:4 * (start + length)])
                    for name, value in zip(_PIECES.names, (doc_id, n, start, length, crc)):
                        out[name].append(value)
            yield batch_of(_PIECES, out)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, _PIECES_SQL)


def best_fit(pieces: DataFrame, capacity: int = 2048, open_bins: int = 512) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; every partition packs what it holds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = OpenBins(capacity, open_bins)
        task = TaskContext.get().partitionId() << _TASK_BIT
        for batch in batches:
            placed = [bins.place(n) for n in batch.column("length").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([task + n for n, _ in placed], pa.int64()),
                 pa.array([o for _, o in placed], pa.int64())],
                schema=_PACKED,
            )

    return pieces.mapInArrow(run, _PACKED_SQL)


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 2048,
    end_id: int = 0,
    open_bins: int = 512,
    pieces_per_task: int = 100_000,
    words: int = WORDS,
) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens.

    Returns ``token_pieces`` with ``sequence_id`` and ``offset``; each sequence is filled from 0
    without gaps. Repeated rows and NULL ids are packed like any others; columns other than
    ``doc_id`` and ``text`` are not looked at; an empty table gives no rows. Texts are encoded where
    they are read. Only the pieces' lengths move: about ``pieces_per_task`` of them, dealt evenly,
    to each packing task, so that its last open bins are few among those it fills. ``words`` bounds
    what a Python worker remembers of the encoding and changes no row.
    """
    pieces = stored(token_pieces(docs, tokenizer, capacity, end_id, words), "pieces")
    tasks = max(1, -(-pieces.count() // pieces_per_task))
    return best_fit(pieces.repartition(tasks), capacity, open_bins)
