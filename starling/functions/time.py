"""Epoch conversion and calendar parts.

Timestamps are ``timestamp_ntz`` holding UTC wall time, reached by adding an interval to the epoch.
That keeps results the same under any ``spark.sql.session.timeZone``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_ms(c: Column | str) -> Column:
    """Epoch milliseconds as a timestamp, milliseconds kept."""
    return F.expr(_EPOCH) + F.expr("INTERVAL '0.001' SECOND") * _col(c)


def epoch_s(c: Column | str) -> Column:
    """Epoch milliseconds as a timestamp cut to the whole second (integer division)."""
    seconds = F.call_function("div", _col(c), F.lit(1000))
    return F.expr(_EPOCH) + F.expr("INTERVAL '1' SECOND") * seconds


def to_epoch_ms(c: Column | str) -> Column:
    """The inverse of :func:`epoch_ms`; anything finer than a millisecond is cut off."""
    # Whole seconds and milliseconds apart: a thousandfold interval would overflow after 2262.
    whole = F.date_trunc("second", _col(c)).cast("timestamp_ntz")
    seconds = (whole - F.expr(_EPOCH)).cast("interval second").cast("bigint")
    fraction = F.date_part(F.lit("SECOND"), _col(c)) * 1000
    return seconds * 1000 + (F.floor(fraction) % 1000).cast("bigint")


def weekday(ts: Column | str, base: str = "mon0") -> Column:
    """Day of week: ``mon0`` counts Monday as 0, ``sun0`` Sunday as 0, ``sun1`` Sunday as 1."""
    if base == "mon0":
        return F.weekday(ts)
    if base == "sun0":
        return F.dayofweek(ts) - 1
    if base == "sun1":
        return F.dayofweek(ts)
    raise ValueError(f"unknown weekday base {base!r}")


def time_parts(
    df: DataFrame, ts: Column | str = "start_time", base: str = "mon0", as_text: bool = False
) -> DataFrame:
    """Add hour, day, (ISO) week, month, year and weekday of ``ts``.

    ``as_text`` stores month and weekday as strings, as one of the target schemas does.
    """
    def text(c: Column) -> Column:
        return c.cast("string") if as_text else c

    return df.withColumns(
        {
            "hour": F.hour(ts),
            "day": F.dayofmonth(ts),
            "week": F.weekofyear(ts),
            "month": text(F.month(ts)),
            "year": F.year(ts),
            "weekday": text(weekday(ts, base)),
        }
    )
