"""Keys computed from column values."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def concat(*cols: Column | str) -> Column:
    """Text concatenation; NULL when any part is NULL."""
    return F.concat(*map(_text, cols))


def md5_key(*cols: Column | str) -> Column:
    """md5 of the concatenated parts; NULL when any part is NULL."""
    return F.md5(concat(*cols))


def sha2_key(*cols: Column | str, null_safe: bool = False) -> Column:
    """sha2-256 of the parts joined by ``||``.

    The plain form skips NULL parts, so ``(a, NULL, b)`` and ``(a, b)`` share a key;
    ``null_safe`` gives NULL a spelling of its own.
    """
    parts = [F.coalesce(_text(c), F.lit("\\N")) if null_safe else _text(c) for c in cols]
    return F.sha2(F.concat_ws("||", *parts), 256)


def hash_key(*cols: Column | str) -> Column:
    """128-bit key that needs no ordering: md5 of the values under their names, NULLs told apart.

    Repeats by chance are out of reach of any table: about one in 10^18 at 10^10 rows.
    """
    named = [(F.col(c) if isinstance(c, str) else c).alias(f"k{i}") for i, c in enumerate(cols)]
    return F.md5(F.to_json(F.struct(*named)))
