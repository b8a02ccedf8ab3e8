"""Load modes, each run against a table that holds rows already."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import insert_if_absent, upsert
from ..session import scratch_path
from ..sinks import append, atomic_load, load_absent, load_upsert, read_loads, refresh
from ..sources import read_existing
from .stand_ins import CUTOFF, table

_KEYS = ["o_custkey", "o_orderpriority"]
_ORDER = ["o_orderdate", "o_orderkey"]


def _orders(spark, sf):
    return table(spark, sf, "orders")


def _before(df):
    return df.where(F.col("o_orderdate") < F.lit(CUTOFF).cast("timestamp_ntz"))


def _after(df):
    return df.where(F.col("o_orderdate") >= F.lit(CUTOFF).cast("timestamp_ntz"))


def _stored(spark, sf):
    """One order per key out of the earlier ones."""
    orders = _orders(spark, sf)
    return insert_if_absent(orders.limit(0), _before(orders), _KEYS, _ORDER)


def insert_absent(spark, sf):
    return insert_if_absent(_stored(spark, sf), _orders(spark, sf), _KEYS, _ORDER)


def _with_null_keys(df):
    return df.withColumn(
        "o_custkey", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey"))
    )


def insert_absent_null_keys(spark, sf):
    orders = _with_null_keys(_orders(spark, sf))
    stored = insert_if_absent(orders.limit(0), _before(orders), _KEYS, _ORDER)
    return insert_if_absent(stored, _after(orders), _KEYS, _ORDER)


def insert_absent_nulls_equal(spark, sf):
    orders = _with_null_keys(_orders(spark, sf))
    stored = insert_if_absent(orders.limit(0), _before(orders), _KEYS, _ORDER, nulls_distinct=False)
    return insert_if_absent(stored, _after(orders), _KEYS, _ORDER, nulls_distinct=False)


def upsert_last(spark, sf):
    return upsert(_stored(spark, sf), _after(_orders(spark, sf)), _KEYS, _ORDER)


def upsert_first(spark, sf):
    return upsert(_stored(spark, sf), _after(_orders(spark, sf)), _KEYS, _ORDER, mode="first")


def append_load(spark, sf):
    orders, root = _orders(spark, sf), scratch_path(spark, "append")
    append(_before(orders), root, "orders")
    append(_after(orders), root, "orders")
    return read_loads(spark, root, "orders")


def refresh_load(spark, sf):
    """Truncate and insert, the second time with rows read from the table itself."""
    orders, root = _orders(spark, sf), scratch_path(spark, "refresh")
    refresh(orders, root, "orders")
    refresh(_after(read_loads(spark, root, "orders")), root, "orders")
    return read_loads(spark, root, "orders")


class _Refused(RuntimeError):
    pass


def atomic_load_failed(spark, sf):
    """A load whose check fails leaves the table with the rows it had."""
    orders, root = _orders(spark, sf), scratch_path(spark, "atomic")

    def refuse(rows):
        raise _Refused

    atomic_load(_before(orders), root, "orders")
    try:
        atomic_load(_after(orders), root, "orders", check=refuse)
    except _Refused:
        pass
    return read_existing(spark, root, "orders", orders.schema)


def load_absent_table(spark, sf):
    """Insert-if-absent into a stored table; the second run adds nothing."""
    orders, root = _orders(spark, sf), scratch_path(spark, "absent")
    load_absent(_before(orders), root, "orders", _KEYS, _ORDER)
    load_absent(orders, root, "orders", _KEYS, _ORDER)
    load_absent(orders, root, "orders", _KEYS, _ORDER)
    return read_loads(spark, root, "orders")


def load_upsert_table(spark, sf):
    orders, root = _orders(spark, sf), scratch_path(spark, "upsert")
    load_upsert(_before(orders), root, "orders", _KEYS, _ORDER)
    load_upsert(_after(orders), root, "orders", _KEYS, _ORDER)
    return read_loads(spark, root, "orders")


def upsert_touched_buckets(spark, sf):
    """Two upserts into a table in buckets: its rows, and whether the second one wrote few of them."""
    orders, root = _orders(spark, sf), scratch_path(spark, "buckets")
    load_upsert(_before(orders), root, "orders", _KEYS, _ORDER)
    first = read_loads(spark, root, "orders").select(F.col("_metadata.file_path").alias("file")).distinct()
    load_upsert(_after(orders).where("o_custkey = 7"), root, "orders", _KEYS, _ORDER)
    rows = read_loads(spark, root, "orders").select("*", F.col("_metadata.file_path").alias("file"))
    # A customer's orders have five priorities at most, so five of the 64 buckets are written anew.
    kept = rows.join(first, "file", "left_semi").select("file").distinct().agg(
        (F.count(F.lit(1)) >= 59).alias("most_files_stay"))
    return rows.drop("file").join(F.broadcast(kept))


def _ranked(where, descending=False, source="orders"):
    order = "o_orderdate DESC, o_orderkey DESC" if descending else "o_orderdate, o_orderkey"
    return f"""
      SELECT * FROM {source} WHERE {where}
      QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY {order}) = 1
    """


_EARLY, _LATE = (f"o_orderdate {op} TIMESTAMP '{CUTOFF}'" for op in ("<", ">="))
_SAME_KEY = "s.o_custkey = b.o_custkey AND s.o_orderpriority = b.o_orderpriority"
_FIRST_WINS = f"""
  WITH s AS ({_ranked(_EARLY)}), b AS ({_ranked('true')})
  SELECT * FROM s UNION ALL SELECT * FROM b WHERE NOT EXISTS (SELECT 1 FROM s WHERE {_SAME_KEY})
"""
_LAST_WINS = f"""
  WITH b AS ({_ranked(_LATE, True)})
  SELECT * FROM b UNION ALL
  SELECT * FROM ({{stored}}) s WHERE NOT EXISTS (SELECT 1 FROM b WHERE {_SAME_KEY})
"""
_NULLED = """(SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS o_custkey,
  o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders)"""

_LAST_SEVEN = _LAST_WINS.replace(_LATE, f"{_LATE} AND o_custkey = 7").format(stored=_ranked(_EARLY, True))

QUERIES = {
    "insert_if_absent": (insert_absent, _FIRST_WINS),
    "insert_if_absent_nullkeys": (insert_absent_null_keys, f"""
        SELECT * FROM {_NULLED} WHERE o_custkey IS NULL UNION ALL
        {_ranked('o_custkey IS NOT NULL', source=_NULLED)}"""),
    "insert_if_absent_nulls_equal": (
        insert_absent_nulls_equal, _ranked("true", source=_NULLED)),
    "upsert_last": (upsert_last, _LAST_WINS.format(stored=_ranked(_EARLY))),
    "upsert_first": (upsert_first, _ranked("true")),
    "append_load": (append_load, "SELECT * FROM orders"),
    "refresh_load": (refresh_load, f"SELECT * FROM orders WHERE {_LATE}"),
    "atomic_load_failed": (atomic_load_failed, f"SELECT * FROM orders WHERE {_EARLY}"),
    "load_absent_table": (load_absent_table, _FIRST_WINS),
    "upsert_touched_buckets": (upsert_touched_buckets, f"SELECT *, true AS most_files_stay FROM ({_LAST_SEVEN})"),
    "load_upsert_table": (
        load_upsert_table, _LAST_WINS.format(stored=_ranked(_EARLY, True))),
}
