"""Vectors as whole numbers: what clustering and search share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import batch_of, stored

# A squared length below this keeps squared distances and inner products in 64 bits.
LONGEST = 1 << 60
_SCALE = 64


def whole_vectors(embeddings: DataFrame, dimensions: int | None = None) -> DataFrame:
    """``row, vec_id, vec``: ``floor(64 * x)`` of each component ``x``, as packed 32-bit integers.

    Left out are vectors that are NULL, hold a NULL or a number that is not finite, have another
    number of components than ``dimensions`` (any by default), or whose squared length after scaling
    is 2^60 or more, for which sums of 64 bits would not do. ``row`` tells rows apart, whatever their
    ids. Written once to the shared folder.
    """
    schema = pa.schema([("row", pa.int64()), ("vec_id", pa.int64()), ("vec", pa.binary())])

    def scale(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, ids, lists = batch.columns
            good, packed = [], []
            for i, values in enumerate(_lists(lists)):
                if values is None or (dimensions is not None and len(values) != dimensions):
                    continue
                with np.errstate(invalid="ignore", over="ignore"):
                    whole = np.floor(values * _SCALE)
                    fits = np.isfinite(whole).all() and whole @ whole < LONGEST
                if fits:
                    good.append(i)
                    packed.append(whole.astype("<i4").tobytes())
            take = pa.array(good, pa.int64())
            yield batch_of(schema, {"row": rows.take(take), "vec_id": ids.take(take), "vec": packed})

    vectors = embeddings.select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("bigint"),
        F.col("embedding").cast("array<double>"),
    )
    return stored(vectors.mapInArrow(scale, "row bigint, vec_id bigint, vec binary"), "vectors")


def _lists(column: pa.ListArray) -> Iterator[np.ndarray | None]:
    """Each list as numbers, a NULL in it as NaN."""
    values = column.values.to_numpy(zero_copy_only=False).astype("f8", copy=False)
    offsets = column.offsets.to_numpy()
    there = column.is_valid().to_numpy(zero_copy_only=False)
    for i in range(len(column)):
        yield values[offsets[i]:offsets[i + 1]] if there[i] else None


def matrix_of(packed: pa.BinaryArray, dimensions: int) -> np.ndarray:
    """Packed vectors of one size as the rows of a matrix."""
    return np.frombuffer(b"".join(packed.to_pylist()), dtype="<i4").reshape(-1, dimensions)
