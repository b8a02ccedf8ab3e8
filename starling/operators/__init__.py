"""Operators over DataFrames. All of them are lazy but for :func:`surrogate_key` (dense),
:func:`replicate`, :func:`dealt` and :func:`run_checks`, which say so."""

from .aggregate import (
    count_where, file_counts, largest, plays_by, preview, profile, top_k, users_by,
)
from .clean import (
    coerce, drop_blank, eq, for_date, lookup, not_null_rows, only_plays, parse_text, project,
    project_events, project_positions, rename,
)
from .dedup import dedup, distinct
from .joins import catalogue, match_plays, not_in, only_new, replicate, star_join
from .keyed import absent_rows, insert_if_absent, upsert
from .quality import (
    CheckFailed, conform, duplicate_keys, max_length, not_null, null_counts, null_key_checks,
    row_rules, run_checks, violations, watched,
)
from .resent import copies_of
from .skew import dealt
from .surrogate import surrogate_key

__all__ = [
    "CheckFailed", "absent_rows", "catalogue", "coerce", "conform", "copies_of", "count_where", "dealt", "dedup",
    "distinct", "drop_blank", "duplicate_keys", "eq", "file_counts", "for_date",
    "insert_if_absent", "largest", "lookup", "match_plays", "max_length", "not_in", "not_null",
    "not_null_rows", "null_counts", "null_key_checks", "only_new", "only_plays", "parse_text", "plays_by",
    "preview", "profile", "project", "project_events", "project_positions", "rename", "replicate",
    "row_rules", "run_checks", "star_join", "surrogate_key", "top_k", "upsert", "users_by", "violations",
    "watched",
]
