"""CSV with line ends in quoted fields, split among tasks.

Whether a line end is one of a record or of a field depends on all the text before it, which is why
such files are commonly read whole. Here each byte range is scanned twice. First it reports in which
state, inside a quoted field or outside, it ends for either state that it can start in: two flags a
line, found by columns, and folded in order. Composed along a file these fix where every range
starts. Then each range cuts its own lines into records. A record that goes on in the next range
comes out in parts, one per range, which are put together by place; only those move.

If no line ends inside a field, which the columns alone tell, the files go to the plain reader.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Fields up to the last comma, then a quoted field that does not end on the line. A field is quoted
# if it begins with a quote; behind the closing quote anything up to the comma belongs to it.
_FIELDS = r'(?:(?:"(?:[^"]|"")*+"[^,]*+|(?!")[^,]*+),)*+'
_OPENS = rf'\A{_FIELDS}"(?:[^"]|"")*+\z'
# Inside a field from the start: no quote that closes it, or one, and then another field that opens.
_STAYS = rf'\A(?:[^"]|"")*+(?:"[^,]*+,{_FIELDS}"(?:[^"]|"")*+)?\z'

_MORE = "__more"


def _lines(spark: SparkSession, path: str, pattern: str | None) -> DataFrame:
    """Lines with the byte range they begin in, and whether a field is open behind them if none was
    before (``opens``) or one was (``stays``)."""
    reader = spark.read.option("recursiveFileLookup", True).option("lineSep", "\n")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("value").rlike(_OPENS).alias("opens"), F.col("value").rlike(_STAYS).alias("stays"),
    )


def any_line_end_in_quotes(spark: SparkSession, path: str, pattern: str | None = None) -> bool:
    """Whether some line, read as the beginning of a record, ends inside a quoted field. The first
    line of a file that does so is the beginning of a record, so none does if none is found."""
    return not _lines(spark, path, pattern).where("opens").isEmpty()


_ENDS = pa.schema([
    ("file", pa.string()), ("start", pa.int64()), ("opened", pa.bool_()), ("stayed", pa.bool_()),
])


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """The byte ranges of a batch of lines, each with its lines."""
    file, start = batch.column("file"), batch.column("start")
    n = batch.num_rows
    if n == 0:
        return
    moved = pc.or_(pc.not_equal(file.slice(1), file.slice(0, n - 1)), pc.not_equal(start.slice(1), start.slice(0, n - 1)))
    cuts = [0, *(np.flatnonzero(_flags(moved)) + 1).tolist(), n]
    for first, end in zip(cuts, cuts[1:]):
        yield (file[first].as_py(), start[first].as_py()), batch.slice(first, end - first)


def _flags(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(bool)


def _states(lines: pa.RecordBatch, inside: bool) -> np.ndarray:
    """Whether a field is open behind each line, if one is or none is before the first.

    Lines that end the same either way say so themselves; the others keep the state or turn it.
    """
    opens, stays = _flags(lines.column("opens")), _flags(lines.column("stays"))
    turns = np.cumsum(opens & ~stays)
    last = np.maximum.accumulate(np.where(opens == stays, np.arange(len(opens)), -1))
    since = np.where(last >= 0, turns - turns[last], turns)
    return np.where(last >= 0, opens[last], inside) ^ (since % 2 == 1)


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each byte range the state at its end, for either state at its start."""
    at, ends = None, (False, True)
    out: dict[str, list] = {name: [] for name in _ENDS.names}

    def put() -> None:
        for name, value in zip(_ENDS.names, (*at, *ends)):
            out[name].append(value)

    for batch in batches:
        for here, lines in _runs(batch):
            if here != at:
                if at is not None:
                    put()
                at, ends = here, (False, True)
            states = tuple(bool(_states(lines, inside)[-1]) for inside in (False, True))
            ends = (states[ends[0]], states[ends[1]])
    if at is not None:
        put()
    yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in _ENDS], schema=_ENDS)


def _starts_inside(lines: DataFrame) -> DataFrame:
    """The byte ranges that start inside a quoted field. Along a file only ranges count that do not
    end the same whichever way they start: the state behind the last that does is known, and each one
    in between keeps the state or turns it."""
    ends = lines.select("file", "start", "opens", "stays").mapInArrow(
        _fold, "file string, start bigint, opened boolean, stayed boolean")
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    fixed = F.col("opened") == F.col("stayed")
    # The number of the last fixed range before, and the turns since.
    turns = (~fixed & F.col("opened")).cast("long")
    known = F.when(fixed, F.struct(F.sum(turns).over(
        Window.partitionBy("file").orderBy("start")).alias("turns"), F.col("opened").alias("state")))
    steps = ends.withColumns({"turns": turns, "known": known})
    last = F.last("known", ignorenulls=True).over(before)
    so_far = F.coalesce(F.sum("turns").over(before), F.lit(0))
    odd = (so_far - F.coalesce(last["turns"], F.lit(0))) % 2 == 1
    inside = F.coalesce(last["state"], F.lit(False)) != odd
    return steps.select("file", "start", inside.alias("inside")).where("inside")


_PARTS = pa.schema([
    ("file", pa.string()), ("start", pa.int64()), ("header", pa.bool_()), ("kind", pa.int8()),
    ("record", pa.string()),
])
# A whole record, or a part that begins one, goes on with it, or completes it.
_WHOLE, _BEGINS, _GOES_ON, _COMPLETES = range(4)


def _joined_lines(values: pa.Array, ends: np.ndarray) -> pa.Array:
    """The lines up to each of ``ends`` (exclusive), put together."""
    offsets = pa.array(np.concatenate([[0], ends]), pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(offsets, values), "\n")


def _cut(inside: set[tuple[str, int]], whole: bool):
    """Records of each byte range, from its lines in order: those that are ``whole``, or the parts."""

    def batch_of(at: tuple[str, int], header: int | None, kind: int, records: pa.Array) -> pa.RecordBatch:
        n = len(records)
        headers = np.zeros(n, bool)
        if header is not None:
            headers[header] = True
        return pa.RecordBatch.from_arrays([
            pa.repeat(pa.scalar(at[0], pa.string()), n), pa.repeat(pa.scalar(at[1], pa.int64()), n),
            pa.array(headers), pa.repeat(pa.scalar(kind, pa.int8()), n), records], schema=_PARTS)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, is_open = None, False
        # Lines of a record that is not complete; whether it begins in this range, and may be a header.
        held: list[str] = []
        begun, first = True, False

        def part(kind: int, record: str) -> Iterator[pa.RecordBatch]:
            if not whole:
                yield batch_of(at, 0 if first and begun else None, kind, pa.array([record], pa.string()))

        for batch in batches:
            for here, lines in _runs(batch):
                values = lines.column("value").cast(pa.string())
                new = here != at
                if new:
                    if held:
                        yield from part(_BEGINS if begun else _GOES_ON, "\n".join(held))
                    held, at, is_open = [], here, here in inside
                    begun, first = not is_open, here[1] == 0
                    if first and values[0].as_py().startswith("\ufeff"):
                        bare = pa.array([values[0].as_py().removeprefix("\ufeff")], pa.string())
                        values = pa.concat_arrays([bare, values.slice(1)])
                states = _states(lines, is_open)
                is_open = bool(states[-1])
                ends = np.flatnonzero(~states) + 1
                done = int(ends[-1]) if len(ends) else 0
                if done:
                    if held or not begun:
                        one = "\n".join([*held, *values.slice(0, int(ends[0])).to_pylist()])
                        if begun:
                            # It began in an earlier batch.
                            rest = _joined_lines(values.slice(int(ends[0])), ends[1:] - ends[0])
                            records = pa.concat_arrays([pa.array([one], pa.string()), rest])
                        else:
                            yield from part(_COMPLETES, one.removesuffix("\r"))
                            begun, first = True, False
                            records = _joined_lines(values.slice(int(ends[0])), ends[1:] - ends[0])
                        held = []
                    else:
                        records = _joined_lines(values, ends)
                    returned = pc.ends_with(records, "\r")
                    if pc.any(returned).as_py():
                        records = pc.if_else(returned, pc.utf8_slice_codeunits(records, 0, -1), records)
                    # Empty lines between records are none.
                    records = records.filter(pc.not_equal(records, ""))
                    if len(records):
                        if whole:
                            yield batch_of(at, 0 if first else None, _WHOLE, records)
                        first = False
                if done < lines.num_rows:
                    left = values.slice(done)
                    held.append(_joined_lines(left, np.array([len(left)]))[0].as_py())
        if held:
            yield from part(_BEGINS if begun else _GOES_ON, "\n".join(held))

    return cut


def _records(lines: DataFrame) -> DataFrame:
    """``file, header, record``: the text of each record, and whether it is its file's first."""
    # One short entry for each byte range that starts inside a field.
    inside = {(r["file"], r["start"]) for r in _starts_inside(lines).collect()}

    def cut(whole: bool) -> DataFrame:
        return lines.select("value", "file", "start", "opens", "stays").mapInArrow(
            _cut(inside, whole), "file string, start bigint, header boolean, kind tinyint, record string")

    return cut(True).select("file", "header", "record").unionByName(_joined(cut(False)))


def _joined(parts: DataFrame) -> DataFrame:
    """Records that lie in several byte ranges, or are left open by the end of their file."""
    begins = F.col("kind") == _BEGINS
    order = Window.partitionBy("file").orderBy("start", begins)
    numbered = parts.withColumn("number", F.sum(begins.cast("long")).over(order))
    pieces = F.array_sort(F.collect_list(F.struct("start", "record")))
    return numbered.groupBy("file", "number").agg(
        F.bool_or("header").alias("header"),
        F.array_join(F.transform(pieces, lambda p: p["record"]), "\n").alias("record"),
    ).select("file", "header", "record")


def read_split(
    spark: SparkSession, path: str, names: list[str], pattern: str | None = None, **options: str
) -> DataFrame:
    """The records as text columns ``names``, which every file's header must agree with."""
    # A column more, so that a header with more names than expected shows.
    schema = StructType([StructField(n, StringType()) for n in [*names, _MORE]])
    parsed = F.from_csv("record", schema.toDDL(), options)
    records = _records(_lines(spark, path, pattern)).select("file", "header", parsed.alias("row"))
    row = F.col("row")
    agrees = _all([row[n].eqNullSafe(F.lit(n)) for n in names] + [row[_MORE].isNull()])
    stop = F.raise_error(F.concat(F.lit("the header of "), "file", F.lit(" differs from the first one's")))
    keep = F.when(~F.col("header"), True).when(agrees, False).otherwise(stop.cast("boolean"))
    return records.where(keep).select(*[row[n].alias(n) for n in names])


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for condition in conditions[1:]:
        out = out & condition
    return out
