"""Writers and load modes. Every function here runs a job."""

from .catalog import drop_table, ensure_table, layout, rebuild_all, register
from .files import write_csv, write_table
from .loads import (
    append, atomic_load, commit, commit_run, compact_loads, drop_loads, ensure_loads, load_absent,
    load_upsert, prepare, read_load, read_loads, rebuild_loads, refresh, settle_runs, vacuum_loads,
)

__all__ = [
    "append", "atomic_load", "commit", "commit_run", "compact_loads", "drop_loads", "drop_table", "ensure_loads",
    "ensure_table", "layout", "load_absent", "load_upsert", "prepare", "read_load", "read_loads",
    "rebuild_all", "rebuild_loads", "refresh", "register", "settle_runs",
    "vacuum_loads", "write_csv", "write_table",
]
