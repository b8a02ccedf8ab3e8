"""Column functions; every one of them stays inside generated JVM code."""

from .keys import concat, hash_key, md5_key, sha2_key
from .text import as_text, coalesce, drop_fraction, lower, try_cast
from .time import epoch_ms, epoch_s, time_parts, to_epoch_ms, weekday

__all__ = [
    "as_text", "coalesce", "concat", "drop_fraction", "epoch_ms", "epoch_s", "hash_key", "lower",
    "md5_key", "sha2_key", "time_parts", "to_epoch_ms", "try_cast", "weekday",
]
