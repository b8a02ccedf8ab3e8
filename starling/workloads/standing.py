"""Reports that follow a table delivery by delivery, against a count over all of it."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import epoch_ms
from ..plans import standing_top, standing_users
from ..session import scratch_path
from ..sinks import append, compact_loads
from .stand_ins import CLICKS, clicks, table

_BY = ["month", "hour"]


def _paid(fact):
    """Paid plays by the parts of their time."""
    start = epoch_ms("ts")
    return fact.where("page = 'NextSong'").select(
        F.month(start).alias("month"), F.hour(start).alias("hour"), F.col("userId").alias("user_id"))


def _delivered(spark, sf, name, form):
    """The clicks in four deliveries, one without a play, with a compaction after the second."""
    events, root = clicks(spark, sf), scratch_path(spark, name)
    parts = ["event_id % 3 = 0", "event_id % 3 = 1", "event_id % 3 = 2 AND page <> 'NextSong'",
             "event_id % 3 = 2 AND page = 'NextSong'"]
    for n, part in enumerate(parts):
        append(events.where(part), root, "fact")
        if n == 1:
            compact_loads(spark, root, "fact")
        report = standing_users(spark, root, "fact", "users", _BY, rows=_paid, form=form)
    return report


def paid_users_followed(spark, sf):
    return _delivered(spark, sf, "followed", None)


def paid_users_followed_rows(spark, sf):
    return _delivered(spark, sf, "followed-rows", "rows")


def paid_users_estimated(spark, sf):
    """Sketches: whether each group's estimate is within a tenth of the exact number."""
    exact = _delivered(spark, sf, "exact", "bitmap")
    near = _delivered(spark, sf, "estimate", "sketch").withColumnRenamed("users", "estimate")
    close = F.abs(F.col("estimate") - F.col("users")) * 10 <= F.col("users")
    return exact.join(near, _BY).select(*_BY, "users", close.alias("close"))


_USERS = f"""
  SELECT CAST(extract(month FROM t) AS INTEGER) AS month, CAST(extract(hour FROM t) AS INTEGER) AS hour,
         count(DISTINCT userId) AS users
  FROM (SELECT *, make_timestamp(ts * 1000) AS t FROM ({CLICKS}) WHERE page = 'NextSong') GROUP BY ALL
"""


def top_parts_followed(spark, sf):
    """Ten parts with most order lines, after deliveries and one that takes returned lines back."""
    lines, root = table(spark, sf, "lineitem"), scratch_path(spark, "top")
    parts = [lines.where(f"l_orderkey % 3 = {n}").withColumn("sign", F.lit(1)) for n in range(3)]
    parts.append(lines.where("l_returnflag = 'R'").withColumn("sign", F.lit(-1)))
    for part in parts:
        append(part.select("l_partkey", "sign"), root, "fact")
        top = standing_top(spark, root, "fact", "parts", "l_partkey", 10, sign=F.col("sign"))
    return top


QUERIES = {
    "paid_users_followed": (paid_users_followed, _USERS),
    "paid_users_followed_rows": (paid_users_followed_rows, _USERS),
    "paid_users_estimated": (paid_users_estimated, f"SELECT *, true AS close FROM ({_USERS})"),
    "top_parts_followed": (top_parts_followed, """
        SELECT l_partkey, count(*) - count(*) FILTER (l_returnflag = 'R') AS plays
        FROM lineitem GROUP BY l_partkey ORDER BY plays DESC, l_partkey LIMIT 10"""),
}
