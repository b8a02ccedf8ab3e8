"""All-or-nothing loads into a Parquet table.

A table is a folder of loads, ``root/name/load=<number>-<kind>-<tag>/``. A load counts once an empty
marker ``root/name/_committed/<load>`` exists, which is created after the data is complete. Readers
take the last ``full`` load and the ``append`` loads after it. A failed load therefore leaves the
table as it was, and a table can be rewritten from its own rows. One writer per table at a time.

A ``keyed`` load stands for a whole table dealt into buckets by a hash of its key. It holds the
buckets that it changed; its file ``_buckets.json`` says in which load each of the others lies.

Loads of several tables are committed by one manifest, ``root/_manifests/<run>.json``, which names
them all and is put in place by a rename. It counts as the markers of its loads until these are
created and it is removed, so a run that ends at any point has changed all of its tables or none.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping
from functools import reduce
from hashlib import sha256

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..operators.dedup import dedup
from ..operators.keyed import absent_rows, upsert
from ..session import scratch_path, scratch_scope
from .files import writer
from .keyfilters import candidates, in_range, usable, write_filter

_BUCKET = "key_bucket"
_MANIFESTS = "_manifests"


def _fs(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def committed_loads(spark: SparkSession, root: str, name: str) -> list[str]:
    """Names of all committed loads, oldest first."""
    # Manifests first: one that goes in between has left its markers.
    named = {loads[name] for loads in _manifests(spark, root).values() if name in loads}
    return sorted(named | set(marks(spark, f"{root.rstrip('/')}/{name}/_committed")))


def _manifests(spark: SparkSession, root: str) -> dict[str, dict[str, str]]:
    """The manifests whose loads have no markers yet, by path: at most one per interrupted run."""
    folder = f"{root.rstrip('/')}/{_MANIFESTS}"
    found = {}
    for name in marks(spark, folder):
        if name.endswith(".json"):
            text = _text(spark, f"{folder}/{name}")
            if text is not None:
                found[f"{folder}/{name}"] = json.loads(text)
    return found


def _text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None where there is no such file (any more)."""
    fs, file = _fs(spark, path)
    if not fs.exists(file):
        return None
    stream = fs.open(file)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
    finally:
        stream.close()


def _put(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file so that it is there with all of its text or not at all."""
    folder, name = path.rsplit("/", 1)
    fs, pending = _fs(spark, f"{folder}/.{name}.{uuid.uuid4().hex}")
    stream = fs.create(pending, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    _, file = _fs(spark, path)
    if not fs.rename(pending, file):
        fs.delete(pending, False)
        if not fs.exists(file):
            raise OSError(f"{path} could not be put in place")


def commit_run(spark: SparkSession, root: str, loads: Mapping[str, str]) -> None:
    """Make one prepared load of each table count, all at the same moment."""
    text = json.dumps(dict(loads), sort_keys=True)
    name = sha256(text.encode()).hexdigest()[:32]
    _put(spark, f"{root.rstrip('/')}/{_MANIFESTS}/{name}.json", text)
    settle_runs(spark, root)


def settle_runs(spark: SparkSession, root: str) -> None:
    """Turn manifests into markers, those of interrupted runs as well. Nothing that a reader sees
    changes by it, and it may end at any point."""
    for path, loads in _manifests(spark, root).items():
        for table, load in loads.items():
            commit(spark, root, table, load)
        fs, file = _fs(spark, path)
        fs.delete(file, False)


def _kind(load: str) -> str:
    return load.split("-")[1]


def loaded_before(spark: SparkSession, root: str, name: str, tag: str) -> str | None:
    """The committed load with this tag, if there is one."""
    for load in committed_loads(spark, root, name):
        if load.split("-", 2)[2] == tag:
            return load
    return None


def current_loads(spark: SparkSession, root: str, name: str) -> list[str]:
    loads = committed_loads(spark, root, name)
    last_full = max((i for i, load in enumerate(loads) if _kind(load) != "append"), default=0)
    return loads[last_full:]


def _paths(spark: SparkSession, table: str, loads: Iterable[str]) -> list[str]:
    """The folders that hold the rows of some loads that follow each other."""
    paths = []
    for load in loads:
        if _kind(load) == "keyed":
            homes = _buckets(spark, table, load)["homes"]
            paths += [f"{table}/load={home}/{_BUCKET}={bucket}" for bucket, home in homes.items()]
        else:
            paths.append(f"{table}/load={load}")
    return paths


def _buckets(spark: SparkSession, table: str, load: str) -> dict:
    return json.loads(_text(spark, f"{table}/load={load}/_buckets.json"))


def read_loads(
    spark: SparkSession, root: str, name: str, schema: StructType | None = None,
    prepared: str | None = None,
) -> DataFrame | None:
    """The table's current rows, or None when nothing is committed.

    ``prepared`` names a load to be read as if it were committed.
    """
    loads = current_loads(spark, root, name)
    if prepared is not None and prepared not in loads:
        loads = [*loads, prepared] if _kind(prepared) == "append" else [prepared]
    if not loads:
        return None
    table = f"{root.rstrip('/')}/{name}"
    # A keyed load comes first if there is one. Its folders are a level deeper than those of others.
    keyed = [load for load in loads if _kind(load) == "keyed"]
    parts = [_paths(spark, table, some) for some in (keyed, loads[len(keyed):])]
    parts = [paths for paths in parts if paths]
    if not parts:
        return spark.createDataFrame([], schema or StructType.fromJson(
            _buckets(spark, table, loads[0])["schema"]))
    reader = spark.read.option("basePath", table)
    if schema is not None:
        reader = reader.schema(schema)
    return reduce(
        DataFrame.unionByName, [reader.parquet(*paths).drop("load", _BUCKET) for paths in parts])


def read_load(spark: SparkSession, root: str, name: str, *loads: str) -> DataFrame:
    """The rows of some loads; of a keyed one, those of the buckets that it changed."""
    table = f"{root.rstrip('/')}/{name}"
    rows = spark.read.option("basePath", table).parquet(*[f"{table}/load={load}" for load in loads])
    return rows.drop("load", _BUCKET)


def _next_load(spark: SparkSession, root: str, name: str, kind: str, tag: str | None, skip: int = 0) -> str:
    loads = committed_loads(spark, root, name)
    number = 1 + skip + (int(loads[-1].split("-")[0]) if loads else 0)
    return f"{number:010d}-{kind}-{tag or uuid.uuid4().hex}"


def prepare(
    df: DataFrame, root: str, name: str, kind: str = "append", tag: str | None = None, skip: int = 0,
    **layout,
) -> str:
    """Write a load without committing it: no reader sees it yet. Returns its name.

    ``kind`` is ``append`` or ``full``. A load with a ``tag`` that is committed is not written again.
    ``skip`` leaves out that many numbers, for a load that takes the place of another prepared one.
    """
    spark = df.sparkSession
    if tag is not None and (done := loaded_before(spark, root, name, tag)):
        return done
    load = _next_load(spark, root, name, kind, tag, skip)
    # An attempt that failed before its marker may have left files under a repeated tag.
    writer(df, **layout).mode("overwrite").parquet(f"{root.rstrip('/')}/{name}/load={load}")
    return load


def commit(spark: SparkSession, root: str, name: str, load: str) -> None:
    """Make a prepared load count."""
    mark(spark, f"{root.rstrip('/')}/{name}/_committed/{load}")


def mark(spark: SparkSession, path: str) -> None:
    """Create an empty file unless it exists."""
    fs, file = _fs(spark, path)
    if not fs.exists(file):
        fs.create(file, False).close()


def marks(spark: SparkSession, path: str) -> list[str]:
    """Names of the marks in a folder, in order."""
    fs, folder = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(folder)) if fs.exists(folder) else []


def _commit(
    df: DataFrame, root: str, name: str, kind: str, tag: str | None = None,
    check: Callable[[DataFrame], None] | None = None, **layout,
) -> str:
    load = prepare(df, root, name, kind, tag, **layout)
    if check is not None:
        check(read_load(df.sparkSession, root, name, load))
    commit(df.sparkSession, root, name, load)
    return load


def append(df: DataFrame, root: str, name: str, tag: str | None = None, **layout) -> str:
    """INSERT INTO: add rows. A load with a ``tag`` is done once, however often it is repeated."""
    return _commit(df, root, name, "append", tag, **layout)


def refresh(
    df: DataFrame, root: str, name: str, recreate: bool = True, tag: str | None = None, **layout
) -> str:
    """Truncate, then insert; with ``recreate=False`` insert only."""
    return _commit(df, root, name, "full" if recreate else "append", tag, **layout)


def atomic_load(
    df: DataFrame,
    root: str,
    name: str,
    recreate: bool = False,
    check: Callable[[DataFrame], None] | None = None,
    tag: str | None = None,
    **layout,
) -> str:
    """Load all or nothing; an error (also one raised by ``check`` on the new rows) goes on to the
    caller and leaves the table as it was. A load with a ``tag`` is done once."""
    return _commit(df, root, name, "full" if recreate else "append", tag, check, **layout)


def load_absent(
    batch: DataFrame,
    root: str,
    name: str,
    keys: Iterable[str],
    order_by: Iterable[str | Column],
    nulls_distinct: bool = True,
    tag: str | None = None,
    unique: bool = False,
    rows_of: Callable[[DataFrame], DataFrame] | None = None,
    **layout,
) -> str:
    """Insert-if-absent into a table. Stored rows are not rewritten; only keys are read of them.

    Each load gets a Bloom filter and the range of its keys (``keyfilters``). Of the stored loads only
    those are read whose range and filter let a key of the batch through, and of these only the keys
    that did; the anti join on them settles false positives. Loads without a filter are read as ever.
    The batch is read three times, so it should not be costly to make. ``unique`` says that its keys do
    not repeat. The batch may hold little more than keys: ``rows_of`` then makes the rows to be stored of
    those that are absent.
    """
    spark, keys = batch.sparkSession, list(keys)
    if tag is not None and (done := loaded_before(spark, root, name, tag)):
        return done
    table = f"{root.rstrip('/')}/{name}"
    with scratch_scope(spark):
        met, existing = _may_hold(batch, root, name, keys, nulls_distinct, unique)
        fresh = absent_rows(existing, batch, keys, order_by, nulls_distinct, narrow_by=met, unique=unique)
        load = prepare(rows_of(fresh) if rows_of else fresh, root, name, "append", tag, **layout)
    said = write_filter(read_load(spark, root, name, load), keys, nulls_distinct, f"{table}/load={load}")
    _put(spark, f"{table}/load={load}/_keys.json", json.dumps(said))
    commit(spark, root, name, load)
    return load


def filter_of(spark: SparkSession, root: str, name: str, load: str) -> dict | None:
    """What the filter of a load says of its keys; None for a load without one."""
    text = _text(spark, f"{root.rstrip('/')}/{name}/load={load}/_keys.json")
    return None if text is None else json.loads(text)


def _may_hold(
    batch: DataFrame, root: str, name: str, keys: list[str], nulls_distinct: bool, unique: bool
) -> tuple[DataFrame | None, DataFrame | None]:
    """The batch's keys that stored loads may hold, and the rows of the loads that may hold one.

    The keys are None where loads without a filter must be asked for all of them.
    """
    spark, table = batch.sparkSession, f"{root.rstrip('/')}/{name}"
    loads = current_loads(spark, root, name)
    blocks = {load: usable(_text(spark, f"{table}/load={load}/_keys.json"), batch, keys, nulls_distinct)
              for load in loads}
    if not loads or None in blocks.values():
        return None, read_loads(spark, root, name)
    folders = {load: f"{table}/load={load}" for load in loads}
    near = in_range(spark, batch, keys, nulls_distinct, folders)
    if not near:
        return None, None
    path = scratch_path(spark, "candidates")
    near_ones = {load: (folders[load], blocks[load]) for load in near}
    candidates(batch, keys, nulls_distinct, near_ones, unique).write.parquet(path)
    found = spark.read.parquet(path)
    # At most one row per load.
    hit = sorted(r[0] for r in found.select("__load").distinct().collect())
    return (found.select(*keys).distinct(), read_load(spark, root, name, *hit)) if hit else (None, None)


def load_upsert(
    batch: DataFrame,
    root: str,
    name: str,
    keys: Iterable[str],
    order_by: Iterable[str | Column],
    tag: str | None = None,
    buckets: int = 64,
    **layout,
) -> str:
    """Upsert into a table, last write wins. Only what the batch's keys can be in is rewritten.

    The table is dealt into ``buckets`` by a hash of the key (take so many that one is about the size
    of a file); the batch's buckets are read, merged and written, and the new load refers to the
    loads that hold the others. A table that is not dealt by these keys yet, or was added to since,
    is dealt anew, once. The number of a table that is dealt already stays.
    """
    spark, keys, order_by = batch.sparkSession, list(keys), list(order_by)
    if tag is not None and (done := loaded_before(spark, root, name, tag)):
        return done
    table = f"{root.rstrip('/')}/{name}"
    loads = current_loads(spark, root, name)
    dealt = _buckets(spark, table, loads[0]) if loads and _kind(loads[0]) == "keyed" else None
    existing = read_loads(spark, root, name)
    schema = batch.schema if existing is None else existing.schema
    # Equal keys hash alike only if they are of one type.
    batch = batch.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema])
    with scratch_scope(spark):
        if dealt is not None and len(loads) == 1 and dealt["keys"] == keys:
            path = scratch_path(spark, "upsert")
            last = dedup(batch, keys, order_by, keep="last")
            _in_buckets(last, keys, dealt["buckets"]).write.parquet(path)
            winners = spark.read.schema(StructType([*schema, StructField(_BUCKET, IntegerType())])).parquet(path)
            # At most one row per bucket.
            touched = sorted(r[0] for r in winners.select(_BUCKET).distinct().collect())
            homes = dealt["homes"]
            old = [f"{table}/load={homes[str(b)]}/{_BUCKET}={b}" for b in touched if str(b) in homes]
            stored = batch.limit(0)
            if old:
                reader = spark.read.option("basePath", table).schema(schema)
                stored = reader.parquet(*old).select(*schema.names)
            rows = upsert(stored, winners.select(*schema.names), keys, order_by)
        else:
            dealt = {"keys": keys, "buckets": buckets}
            homes = {}
            rows = upsert(batch.limit(0) if existing is None else existing, batch, keys, order_by)
        load = _next_load(spark, root, name, "keyed", tag)
        layout["partition_by"] = [_BUCKET, *layout.get("partition_by", [])]
        out = writer(_in_buckets(rows, keys, dealt["buckets"]), **layout)
        out.mode("overwrite").parquet(f"{table}/load={load}")
    written = [n.split("=")[1] for n in marks(spark, f"{table}/load={load}") if n.startswith(f"{_BUCKET}=")]
    homes = {**homes, **{bucket: load for bucket in written}}
    _put(spark, f"{table}/load={load}/_buckets.json", json.dumps(
        {"keys": keys, "buckets": dealt["buckets"], "homes": homes, "schema": schema.jsonValue()}))
    commit(spark, root, name, load)
    return load


def _in_buckets(rows: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    return rows.withColumn(_BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def vacuum_loads(spark: SparkSession, root: str, name: str) -> None:
    """Delete the loads, and the buckets of loads, that the table's current state does not refer to.

    Readers that started before the last load should have ended.
    """
    table = f"{root.rstrip('/')}/{name}"
    settle_runs(spark, root)
    current = current_loads(spark, root, name)
    used = _paths(spark, table, current)
    committed = committed_loads(spark, root, name)
    # A load that is being written has a higher number than every committed one.
    folders = [f.removeprefix("load=") for f in marks(spark, table) if f.startswith("load=")]
    for load in folders:
        if load in current or not committed or load.split("-")[0] > committed[-1].split("-")[0]:
            continue
        # The marker goes first: a load that is gone in part must not count.
        _delete(spark, f"{table}/_committed/{load}")
        parts = [f"{table}/load={load}/{part}" for part in marks(spark, f"{table}/load={load}")]
        kept = [part for part in parts if part in used]
        for part in parts if kept else [f"{table}/load={load}"]:
            if part not in kept:
                _delete(spark, part)


def _delete(spark: SparkSession, path: str) -> None:
    fs, file = _fs(spark, path)
    fs.delete(file, True)


def ensure_loads(spark: SparkSession, root: str, tables: Mapping[str, StructType]) -> None:
    """Create each table, empty, unless it has a committed load."""
    for name, schema in tables.items():
        if not committed_loads(spark, root, name):
            refresh(spark.createDataFrame([], schema), root, name)


def drop_loads(spark: SparkSession, root: str, name: str) -> None:
    """Remove a table with all its loads, if there is one."""
    settle_runs(spark, root)
    _delete(spark, f"{root.rstrip('/')}/{name}")


def rebuild_loads(spark: SparkSession, root: str, tables: Mapping[str, StructType]) -> None:
    """Remove every table and create it again, empty."""
    for name in tables:
        drop_loads(spark, root, name)
    ensure_loads(spark, root, tables)


def compact_loads(spark: SparkSession, root: str, name: str, **layout) -> None:
    """Write the table's current rows as one load, and delete the loads it replaces.

    A recurring run adds a load each time, and every reader lists them all. The new load counts
    before the old ones go, so a failure at any point leaves a whole table; readers that started
    earlier should have ended.
    """
    settle_runs(spark, root)
    rows = read_loads(spark, root, name)
    if rows is None:
        return
    before = committed_loads(spark, root, name)
    refresh(rows, root, name, **layout)
    for load in before:
        for path in (f"_committed/{load}", f"load={load}"):
            _delete(spark, f"{root.rstrip('/')}/{name}/{path}")
