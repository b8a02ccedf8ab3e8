"""Token files: independent zstandard frames, a document index, and a trailing seek table.

A file is a row of standard zstandard frames, each holding the ids of some consecutive documents as
little-endian unsigned 32-bit integers, then a skippable frame with the compressed document index,
then the seek table as a skippable frame, as the public seekable format lays it out:

    each frame: compressed size u32, plain size u32, lower half of XXH64 of the plain bytes u32
    footer: frames u32, descriptor u8 (0x80: with checksums), magic u32

Plain zstandard tools decompress such a file to all its ids. The index holds, for each document,
its id, whether the id is known, and its number of ids.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import scratch_path
from .common import batch_of, stored, texts_of
from .tokens import encoder

# Fixed values of the public seekable format.
SEEK_FRAME = 0x184D2A5E
SEEK_FOOTER = 0x8F92EAB1
CHECKSUMS = 0x80
# A skippable frame of our own for the document index.
INDEX_FRAME = 0x184D2A50

_INDEX = np.dtype([("doc_id", "<i8"), ("known", "u1"), ("ids", "<u8")])
_SEEK = np.dtype([("packed", "<u4"), ("plain", "<u4"), ("check", "<u4")])
_FOOTER = struct.Struct("<IBI")
_SKIP = struct.Struct("<II")

_MANIFEST = pa.schema([("part", pa.int32()), ("file", pa.string()), ("docs", pa.int64()), ("ids", pa.int64())])
_MANIFEST_SQL = "part int, file string, docs long, ids long"
_READ = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
_READ_SQL = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _check(plain: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF


class TokenWriter:
    """Writes one file. A frame closes once it holds ``frame_ids`` ids; no document is cut."""

    def __init__(self, sink, frame_ids: int = 1 << 16, level: int = 1):
        import zstandard

        self._sink, self._limit = sink, 4 * frame_ids
        self._zstd = zstandard.ZstdCompressor(level=level)
        self._waiting: list[bytes] = []
        self._held = 0
        self._frames: list[tuple[int, int, int]] = []
        self._index: list[tuple[int, bool, int]] = []
        self.ids = 0

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self._index.append((doc_id or 0, doc_id is not None, len(ids) // 4))
        self._waiting.append(ids)
        self._held += len(ids)
        self.ids += len(ids) // 4
        if self._held >= self._limit:
            self._close_frame()

    def _close_frame(self) -> None:
        if not self._held:
            return
        plain = b"".join(self._waiting)
        packed = self._zstd.compress(plain)
        self._sink.write(packed)
        self._frames.append((len(packed), len(plain), _check(plain)))
        self._waiting, self._held = [], 0

    def close(self) -> None:
        self._close_frame()
        index = np.array(self._index, dtype=_INDEX).tobytes()
        packed = self._zstd.compress(index)
        self._sink.write(_SKIP.pack(INDEX_FRAME, len(packed)) + packed)
        self._frames.append((_SKIP.size + len(packed), 0, _check(index)))
        table = np.array(self._frames, dtype=_SEEK).tobytes()
        self._sink.write(_SKIP.pack(SEEK_FRAME, len(table) + _FOOTER.size) + table)
        self._sink.write(_FOOTER.pack(len(self._frames), CHECKSUMS, SEEK_FOOTER))


class TokenReader:
    """Reads the documents of one file; only the frames that hold wanted ones are decompressed."""

    def __init__(self, source, size: int):
        import zstandard

        self._source, self._zstd = source, zstandard.ZstdDecompressor()
        count, flags, magic = _FOOTER.unpack(self._at(size - _FOOTER.size, _FOOTER.size))
        if magic != SEEK_FOOTER or flags != CHECKSUMS:
            raise ValueError("not a token file")
        begin = size - _FOOTER.size - count * _SEEK.itemsize
        table = np.frombuffer(self._at(begin, count * _SEEK.itemsize), dtype=_SEEK)
        ends = np.cumsum(table["packed"].astype("i8"))
        self._places = ends - table["packed"]
        self._frames = table[:-1]
        at, length = int(self._places[-1]), int(table["packed"][-1])
        index = self._zstd.decompress(self._at(at, length)[_SKIP.size:])
        if _check(index) != table["check"][-1]:
            raise ValueError("the document index fails its checksum")
        self.index = np.frombuffer(index, dtype=_INDEX)
        self.starts = np.concatenate([[0], np.cumsum(self.index["ids"].astype("i8"))])
        self._frame_starts = np.concatenate([[0], np.cumsum(self._frames["plain"].astype("i8"))]).tolist()
        self._bounds = (4 * self.starts).tolist()
        self._held: tuple[int, bytes] = (-1, b"")
        self.decompressed = 0

    def _at(self, place: int, length: int) -> bytes:
        self._source.seek(place)
        return self._source.read(length)

    def _frame(self, n: int) -> bytes:
        if self._held[0] != n:
            packed = self._at(int(self._places[n]), int(self._frames["packed"][n]))
            plain = self._zstd.decompress(packed, max_output_size=int(self._frames["plain"][n]))
            if len(plain) != self._frames["plain"][n] or _check(plain) != self._frames["check"][n]:
                raise ValueError(f"frame {n} fails its checksum")
            self._held, self.decompressed = (n, plain), self.decompressed + 1
        return self._held[1]

    def ids(self, n: int) -> bytes:
        """The ids of the file's n-th document."""
        begin, end = self._bounds[n], self._bounds[n + 1]
        if begin == end:
            return b""
        frame = bisect_right(self._frame_starts, begin) - 1
        inside = begin - self._frame_starts[frame]
        return self._frame(frame)[inside:inside + end - begin]


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = 2, frame_ids: int = 1 << 16
) -> DataFrame:
    """Encode all documents into files below ``folder``, ids ascending within and across files.

    Returns the manifest: ``part, file, docs, ids``. A file counts only if the manifest names it: a
    task that is run again writes a file of another name, so lost executors and doubled tasks leave
    at most files that nobody reads. NULL texts count as empty (the end id alone), NULL ids come
    first, rows with one id are ordered by a hash of their text, and equal rows by their place in
    the input, which also spreads them over files. An empty table gives an empty manifest. Columns
    other than ``doc_id`` and ``text`` are not looked at.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer).ids, end_id.to_bytes(4, "little")
        part = TaskContext.get().partitionId()
        system, path = fs.FileSystem.from_uri(folder)
        name = f"part-{part:06d}-{uuid.uuid4().hex}.ids.zst"
        writer = sink = None
        docs_written = 0
        for doc_ids, texts in (part for batch in batches for part in texts_of(batch, 128)):
            for doc_id, text in zip(doc_ids, texts):
                if writer is None:
                    system.create_dir(path, recursive=True)
                    sink = system.open_output_stream(f"{path}/{name}", compression=None)
                    writer = TokenWriter(sink, frame_ids)
                writer.add(doc_id, encode(text) + end)
                docs_written += 1
        if writer is not None:
            writer.close()
            sink.close()
            yield batch_of(_MANIFEST, {
                "part": [part], "file": [name], "docs": [docs_written], "ids": [writer.ids],
            })

    count = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["doc_id", "tie", "place"]
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.xxhash64("text").alias("tie"),
        F.monotonically_increasing_id().alias("place"),
    ).repartitionByRange(count, *order).sortWithinPartitions(*order)
    return stored(rows.select("doc_id", "text").mapInArrow(run, _MANIFEST_SQL), "manifest")


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """A row per document out of the files: ``doc_id, start, n_tokens, ids_crc32``.

    ``start`` counts the ids of all documents before it. Every frame is checked against its
    checksum. The running sum has one row per file; documents are read where their file is read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with system.open_input_file(f"{path}/{name}") as source:
                    yield from _rows(TokenReader(source, source.size()), before)

    before = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("file", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("before"))
    count = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(count).mapInArrow(run, _READ_SQL)


def _rows(reader: TokenReader, before: int, step: int = 10_000) -> Iterator[pa.RecordBatch]:
    for low in range(0, len(reader.index), step):
        index = reader.index[low:low + step]
        yield batch_of(_READ, {
            "doc_id": pa.array(index["doc_id"], mask=index["known"] == 0),
            "start": before + reader.starts[low:low + len(index)],
            "n_tokens": index["ids"].astype("i8"),
            "ids_crc32": [zlib.crc32(reader.ids(n)) for n in range(low, low + len(index))],
        })


def wanted_ids(source, size: int, doc_ids: Iterable[int]) -> dict[int, np.ndarray]:
    """The ids of some documents of one file, by id."""
    reader = TokenReader(source, size)
    wanted = set(doc_ids)
    return {
        int(r["doc_id"]): np.frombuffer(reader.ids(n), dtype="<u4")
        for n, r in enumerate(reader.index)
        if r["known"] and int(r["doc_id"]) in wanted
    }


def token_folder(spark: SparkSession) -> str:
    """A new folder on the shared file system, as a URI."""
    path = scratch_path(spark, "tokens")
    return path if "://" in path or path.startswith("file:") else f"file://{path}"
