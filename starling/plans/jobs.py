"""End-to-end jobs: stage, load, check."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import partial
from hashlib import sha256

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType

from .. import schemas
from ..functions import epoch_s
from ..operators import (
    CheckFailed, absent_rows, catalogue, for_date, not_null, null_key_checks, row_rules, run_checks,
    violations, watched,
)
from ..session import drop_path, scratch_path, scratch_scope
from ..sinks import append, commit_run, ensure_loads, prepare, read_load, read_loads, refresh
from ..sinks.loads import committed_loads, current_loads, loaded_before, mark, marks
from ..sources import read_table, register_all, stage_json
from ..sources.staging import BROKEN, as_text, located, recut, typed
from ..streaming import SENT, append_marked, each_new_batch, with_marks, without_marks
from .builders import build_artists, build_songplays, build_songs, build_time, build_users

EVENTS, ENTRIES = "staged_events", "staged_songs"
# Parsed rows that were not compared with what is staged yet.
_ARRIVED = "arrived_events"
TABLES = ["songplays", "users", "songs", "artists", "time"]


@dataclass(frozen=True)
class JobConfig:
    """Where a job reads and writes, and by which rules it builds.

    ``event_paths`` locates the event fields by JSON path, in column order. ``date`` restricts what
    is loaded to one day's events: what is added, and under ``lake``, which rewrites its tables, what
    they then hold. The dimensions that ``scheduled`` refreshes hold all days. A catalogue that measures up to ``replicate_under``
    bytes is copied to every executor, so that the log is matched where it lies; a larger one is
    shuffled together with the log.

    With ``resent="once"`` a recurring run takes an event file that is sent again, whole or in part and
    under whatever name, for the one it has (``append_marked``); by default every new file adds its rows.
    """

    events: str
    songs: str
    root: str
    variant: str = "lake"
    event_paths: tuple[str, ...] | None = None
    rounding: str = "half_up"
    date: str | None = None
    replicate_under: int = 128 << 20
    hot_share: float | None = 0.001
    violations: str = "keys"
    constraints: Mapping[str, tuple[Iterable[str], Mapping[str, int]]] | None = None
    resent: str = "kept"
    # Set by an incremental run: loads with a tag seen before are skipped.
    tag: str | None = None


def staged(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {name: without_marks(read_table(spark, root, name)) for name in (EVENTS, ENTRIES)}


def _together(spark: SparkSession, loads: list[Callable[[], object]]) -> None:
    """Run loads that do not depend on each other at the same time, so that the tail of one leaves
    no executor idle. All of them end before the first error is raised."""
    in_session = inheritable_thread_target(spark)
    with ThreadPoolExecutor(len(loads)) as pool:
        futures = [pool.submit(in_session(load)) for load in loads]
    for future in futures:
        future.result()


def stage_all(spark: SparkSession, cfg: JobConfig) -> dict[str, DataFrame]:
    """Parse both inputs once into typed Parquet; later steps read from that only the columns and
    row groups they need."""
    events = stage_json(spark, cfg.events, schemas.STAGED_EVENTS, cfg.event_paths)
    songs = stage_json(spark, cfg.songs, schemas.STAGED_SONGS)
    _together(spark, [partial(refresh, events, cfg.root, EVENTS),
                      partial(refresh, songs, cfg.root, ENTRIES)])
    return staged(spark, cfg.root)


class Loads:
    """The loads of one run: written one by one, readable within the run, committed together."""

    def __init__(self, spark: SparkSession, cfg: JobConfig):
        if cfg.violations not in ("keys", "stop", "divert"):
            raise ValueError(f"violations must be keys, stop or divert, not {cfg.violations!r}")
        self.spark, self.cfg = spark, cfg
        self._prepared: dict[str, str] = {}
        # Violations found while writing: (table, rule) and number of rows.
        self._found: dict[tuple[str, str], int] = {}

    def add(self, rows: DataFrame, name: str, recreate: bool = False, **layout) -> None:
        """Write a table's load. Its constraints are counted on the way; only if rows violate them
        and are to be diverted is what was written read again, to be split."""
        cfg, kind = self.cfg, "full" if recreate else "append"
        rules = {} if cfg.violations == "keys" else table_rules(cfg, name)
        if not rules or cfg.tag is not None and loaded_before(self.spark, cfg.root, name, cfg.tag):
            self._prepared[name] = prepare(rows, cfg.root, name, kind, cfg.tag, **layout)
            return
        rows, counts = watched(rows, rules)
        load = prepare(rows, cfg.root, name, kind, cfg.tag, **layout)
        found = {rule: n for rule, n in counts.get.items() if rule != "rows" and n}
        self._found.update({(name, rule): n for rule, n in found.items()})
        if found and cfg.violations == "divert":
            good, bad = violations(read_load(self.spark, cfg.root, name, load), rules)
            self.set_apart(bad, f"{name}_diverted")
            first, load = load, prepare(good, cfg.root, name, kind, cfg.tag, skip=1, **layout)
            drop_path(self.spark, f"{cfg.root.rstrip('/')}/{name}/load={first}")
        self._prepared[name] = load

    def set_apart(self, rows: DataFrame, name: str) -> None:
        """Rows kept beside a table instead of in it."""
        self._prepared[name] = prepare(rows, self.cfg.root, name, "append", self.cfg.tag)

    def stored(self, name: str) -> DataFrame | None:
        """What the table holds before this run."""
        return read_loads(self.spark, self.cfg.root, name)

    def table(self, name: str) -> DataFrame:
        """What the table holds with this run's load."""
        return read_loads(self.spark, self.cfg.root, name, prepared=self._prepared.get(name))

    def new(self, name: str) -> DataFrame:
        """This run's rows."""
        return read_load(self.spark, self.cfg.root, name, self._prepared[name])

    def gate(self, checks: Iterable[Mapping] | None, fail_fast: bool) -> DataFrame:
        """Run ``checks`` on the tables as they will be, and the variant's constraints on new rows."""
        for name in TABLES:
            self.table(name).createOrReplaceTempView(name)
        views = [name for name in TABLES if name in self._prepared]
        for name in views:
            self.new(name).createOrReplaceTempView(f"new_{name}")
        rules = constraint_checks(self.cfg.variant, views)
        stops = self.cfg.violations == "stop"
        counted = [(f"{name}: {rule}", "0", str(n), not stops) for (name, rule), n in sorted(self._found.items())]
        if counted and stops and fail_fast:
            query, expected, actual, _ = counted[0]
            raise CheckFailed(f"{query}: expected {expected}, got {actual}")
        report = run_checks(
            self.spark, [*(key_checks() if checks is None else checks), *rules], fail_fast)
        return report.union(self.spark.createDataFrame(counted, report.schema)) if counted else report

    def commit(self) -> None:
        """All tables of the run change at one moment, or none does."""
        commit_run(self.spark, self.cfg.root, self._prepared)


def load_all(
    spark: SparkSession, cfg: JobConfig, checks: Iterable[Mapping] | None = None,
    fail_fast: bool = True, batch: DataFrame | None = None,
) -> DataFrame:
    """Load the star schema from what is staged, or for incremental runs from ``batch`` of it.

    All tables are written, then checked, then committed: a failing check leaves every table as it
    was. The fact comes first and then the dimensions, side by side; where the fact is matched
    against the dimensions (``lake``, ``relational``) it comes last. Returns the report.
    """
    events, songs = staged(spark, cfg.root).values()
    rows = events if batch is None else batch
    if cfg.date is not None:
        rows = for_date(rows, cfg.date, "ts")
    loads = Loads(spark, cfg)
    with scratch_scope(spark):
        _LOADERS[cfg.variant](loads, rows, songs, cfg)
        report = loads.gate(checks, fail_fast)
    loads.commit()
    register_all(spark, cfg.root, TABLES)
    return report


def _fact(events, songs, cfg, **options) -> DataFrame:
    return build_songplays(
        events, songs, variant=cfg.variant, rounding=cfg.rounding,
        replicate_under=cfg.replicate_under, hot_share=cfg.hot_share, **options,
    )


def _next_id(spark: SparkSession, cfg: JobConfig) -> int:
    """One more than the last number given. Later loads hold higher numbers, so the newest load
    with any rows tells."""
    for load in reversed(current_loads(spark, cfg.root, "songplays")):
        rows = read_load(spark, cfg.root, "songplays", load)
        last = rows.agg(F.max("songplay_id").alias("last")).first()["last"]
        if last is not None:
            return last + 1
    return 1


def _stored_plays(spark: SparkSession, cfg: JobConfig, batch: DataFrame) -> DataFrame | None:
    """The stored plays a batch could meet again: those in the time it spans.

    The time is part of every play key, so others cannot match. The bounds reach the scan, which
    leaves out the loads and row groups of other times.
    """
    stored = read_loads(spark, cfg.root, "songplays")
    if stored is None:
        return None
    span = batch.agg(F.min("ts").alias("first"), F.max("ts").alias("last")).first()
    first, last = F.lit(span["first"]), F.lit(span["last"])
    if cfg.variant == "warehouse":
        first, last = epoch_s(first.cast("bigint")), epoch_s(last.cast("bigint"))
    return stored.where(F.col("start_time").between(first, last))


def _rejected(loads: Loads, rows: DataFrame, name: str) -> None:
    """Rows without their key, kept beside the table instead of in it."""
    if not rows.isEmpty():
        loads.set_apart(rows, f"{name}_rejects")


def _add_to_dimensions(loads: Loads, events: DataFrame, songs: DataFrame, cfg: JobConfig) -> None:
    """Add what is not stored. An event without a user is set apart before it can reach ``users``:
    by the null rules of NOT IN, one stored NULL would let no user in ever after."""
    known, unknown = not_null(events, ["userId"])

    def add(name, build, source):
        loads.add(build(source, loads.stored(name), variant=cfg.variant), name)

    _together(loads.spark, [
        partial(add, "users", build_users, known), partial(add, "songs", build_songs, songs),
        partial(add, "artists", build_artists, songs), partial(add, "time", build_time, events),
        lambda: _rejected(loads, build_users(unknown, variant=cfg.variant), "users"),
    ])


def _load_lake(loads, events, songs, cfg):
    by_month = {"partition_by": ["year", "month"]}
    full = partial(loads.add, recreate=True)
    _together(loads.spark, [
        partial(full, build_songs(songs), "songs", partition_by=["year"]),
        partial(full, build_artists(songs), "artists"),
        partial(full, build_users(events), "users"),
        partial(full, build_time(events), "time", **by_month),
    ])
    entries = catalogue(loads.table("songs"), loads.table("artists"))
    full(_fact(events, songs, cfg, entries=entries), "songplays", **by_month)


def _load_warehouse(loads, events, songs, cfg):
    stored = _stored_plays(loads.spark, cfg, events)
    loads.add(_fact(events, songs, cfg, existing=stored, next_id=_next_id(loads.spark, cfg)), "songplays")
    _add_to_dimensions(loads, events, songs, cfg)


def _load_scheduled(loads, events, songs, cfg):
    loads.add(_fact(events, songs, cfg), "songplays")
    rules = {"variant": "scheduled"}
    if cfg.tag is None:
        # Everything staged, whatever the day: these dimensions are refreshed.
        users = build_users(staged(loads.spark, cfg.root)[EVENTS], **rules)
        time = build_time(loads.table("songplays"), **rules)
    else:
        # The same rows as a refresh gives: stored tuples and the batch's new ones.
        rows = build_users(events, **rules)
        users = absent_rows(loads.stored("users"), rows, rows.columns, rows.columns, nulls_distinct=False)
        time = build_time(loads.new("songplays"), **rules)
    again = cfg.tag is None
    _together(loads.spark, [
        partial(loads.add, users, "users", again),
        partial(loads.add, build_songs(songs, rounding=cfg.rounding, **rules), "songs", True),
        partial(loads.add, build_artists(songs, rounding=cfg.rounding, **rules), "artists", True),
        partial(loads.add, time, "time", again),
    ])


def _load_relational(loads, events, songs, cfg):
    _add_to_dimensions(loads, events, songs, cfg)
    fact = _fact(
        events, songs, cfg, existing=_stored_plays(loads.spark, cfg, events),
        next_id=_next_id(loads.spark, cfg),
        entries=catalogue(loads.table("songs"), loads.table("artists")),
    )
    loads.add(fact, "songplays")


_LOADERS = {
    "lake": _load_lake,
    "warehouse": _load_warehouse,
    "scheduled": _load_scheduled,
    "relational": _load_relational,
}


def table_rules(cfg: JobConfig, table: str) -> dict[str, Column]:
    """What a row of a target table must not be, by name."""
    in_bytes = schemas.LENGTH_IN_BYTES[cfg.variant]
    if cfg.constraints is not None:
        return row_rules(*cfg.constraints.get(table, ((), {})), in_bytes=in_bytes)
    mandatory = schemas.MANDATORY[cfg.variant].get(table, [])
    return row_rules(mandatory, schemas.LENGTHS[cfg.variant].get(table, {}), in_bytes)


def key_checks() -> list[dict]:
    """No table may hold a row without its key."""
    return null_key_checks({table: schemas.KEYS[table][0] for table in TABLES})


def constraint_checks(variant: str, tables: Iterable[str]) -> list[dict]:
    """What the target tables of a variant enforce themselves, as checks of ``new_<table>``."""
    unique = schemas.UNIQUE.get(variant, {})
    return [
        {
            "query": f"SELECT count(1) FROM (SELECT 1 FROM new_{table} WHERE "
                     + " AND ".join(f"{k} IS NOT NULL" for k in unique[table])
                     + f" GROUP BY {', '.join(unique[table])} HAVING count(1) > 1)",
            "expected_result": 0,
        }
        for table in tables if table in unique
    ]


def run_job(
    spark: SparkSession, cfg: JobConfig, checks: Iterable[Mapping] | None = None,
    stage: bool = True, load: bool = True, fail_fast: bool = True,
) -> DataFrame:
    """Ensure the tables, stage, load fact and dimensions past the quality gate.

    ``stage`` / ``load`` switch off one half. ``checks`` refer to the tables by name and see them as
    they will be; a failing one stops the job with the tables as they were. The loaded tables are
    registered for SQL under their names. Returns the report of the checks.
    """
    ensure_loads(spark, cfg.root, schemas.targets(cfg.variant))
    if stage:
        stage_all(spark, cfg)
    if load:
        return load_all(spark, cfg, checks, fail_fast)
    register_all(spark, cfg.root, TABLES)
    return run_checks(spark, key_checks() if checks is None else checks, fail_fast)


def _taken(load: str) -> str:
    """Tag of the run that loads what is staged up to ``load``."""
    return "run." + sha256(load.encode()).hexdigest()[:16]


def _load_staged(spark, cfg, checks, fail_fast) -> DataFrame | None:
    """Load what is staged and not loaded yet, at once. A run that was interrupted goes first, over
    the same rows as before, so that its tables that are committed are not loaded again."""
    folder = f"{cfg.root.rstrip('/')}/_runs"
    report, done = None, ""
    known = marks(spark, folder)
    for mark_ in known:
        if mark_.endswith(".done"):
            done = mark_.removesuffix(".done")
    waiting = [load for load in committed_loads(spark, cfg.root, EVENTS) if load > done]
    begun = [m.removesuffix(".begun") for m in known if m.endswith(".begun")]
    ends = sorted({load for load in begun if load > done} | set(waiting[-1:]))
    for end in ends:
        batch = [load for load in waiting if done < load <= end]
        mark(spark, f"{folder}/{end}.begun")
        rows = without_marks(read_load(spark, cfg.root, EVENTS, *batch))
        report = load_all(spark, replace(cfg, tag=_taken(end)), checks, fail_fast, rows)
        mark(spark, f"{folder}/{end}.done")
        done = end
    return report


def _take_arrived(spark: SparkSession, cfg: JobConfig) -> None:
    """Stage those of the rows that have arrived which are new, all at once: stored keys are read once,
    whatever the number of batches. A run that ends half way finds its rows again, and what is staged
    already adds nothing."""
    table = f"{cfg.root.rstrip('/')}/{_ARRIVED}"
    there = set(marks(spark, table))
    waiting = [path for load in committed_loads(spark, cfg.root, _ARRIVED) if (path := f"load={load}") in there]
    if waiting:
        append_marked(spark, [f"{table}/{path}" for path in waiting], cfg.root, EVENTS)
    for path in waiting:
        drop_path(spark, f"{table}/{path}")


def run_new_files(
    spark: SparkSession, cfg: JobConfig, checkpoint: str, checks: Iterable[Mapping] | None = None,
    max_files: int | None = None, max_bytes: str | None = None, fail_fast: bool = True,
) -> DataFrame:
    """As :func:`run_job`, for a recurring run: parse and load only the event files that have
    arrived since the last one. The catalogue is staged afresh.

    ``max_files`` and ``max_bytes`` bound what is parsed at a time; whatever their values, a run
    adds all new rows to the star schema at once, so they do not change the result. An interrupted
    run is completed before new rows are loaded. ``lake`` rebuilds everything by its rules, so it
    has no incremental form.
    """
    if cfg.variant == "lake":
        raise ValueError("the lake rules rebuild all tables; use run_job")
    if cfg.resent not in ("kept", "once"):
        raise ValueError(f"resent must be kept or once, not {cfg.resent!r}")
    once = cfg.resent == "once"
    ensure_loads(spark, cfg.root, schemas.targets(cfg.variant))
    refresh(stage_json(spark, cfg.songs, schemas.STAGED_SONGS), cfg.root, ENTRIES)
    target, paths = schemas.STAGED_EVENTS, cfg.event_paths

    def parse(raw: DataFrame) -> DataFrame:
        return typed(raw if paths is None else located(raw, target, paths), target)

    def with_file(lines: DataFrame) -> DataFrame:
        return lines.withColumn(SENT, F.xxhash64(F.input_file_name()))

    def stage(rows: DataFrame, tag: str) -> None:
        append(rows, cfg.root, EVENTS, tag=tag)

    def stage_once(lines: DataFrame, tag: str) -> None:
        if loaded_before(spark, cfg.root, _ARRIVED, tag):
            return
        with scratch_scope(spark):
            path = scratch_path(spark, "lines")
            recut(lines, path, SENT)
            if paths is None:
                schema = as_text(target).add(SENT, LongType())
                raw = spark.read.schema(schema).option("columnNameOfCorruptRecord", BROKEN).json(path)
            else:
                raw = located(spark.read.schema(f"value string, {SENT} bigint").text(path), target, paths)
            append(with_marks(typed(raw, target, SENT), "ts"), cfg.root, _ARRIVED, tag=tag)

    as_lines = once or paths is not None
    each_new_batch(
        spark, cfg.events, None if as_lines else as_text(target), checkpoint, stage_once if once else stage,
        fmt="text" if as_lines else "json", transform=with_file if once else parse,
        max_files=max_files, max_bytes=max_bytes,
    )
    if once:
        _take_arrived(spark, cfg)
    report = _load_staged(spark, cfg, checks, fail_fast)
    if report is not None:
        return report
    register_all(spark, cfg.root, TABLES)
    return run_checks(spark, key_checks() if checks is None else checks, fail_fast)
