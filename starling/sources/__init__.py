"""Readers."""

from .files import read_csv_dir, read_json
from .staging import raw_json, read_json_paths, stage_json, stage_json_checked
from .tables import read_existing, read_table, register_all

__all__ = [
    "raw_json", "read_csv_dir", "read_json_paths", "read_existing", "read_json", "read_table", "register_all",
    "stage_json", "stage_json_checked",
]
