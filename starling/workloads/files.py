"""Sources, sinks, layouts, ingest and end-to-end jobs over files written from the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..schemas import STAGED_EVENTS
from ..session import scratch_path
from ..sinks import ensure_table, layout, read_loads, rebuild_all, register, write_csv, write_table
from ..sources import read_csv_dir, read_json, read_table, stage_json, stage_json_checked
from ..streaming import ingest_new_files
from .stand_ins import CLICKS, clicks, table


def _by_month(spark, sf):
    return table(spark, sf, "lineitem").withColumns(
        {"year": F.year("l_shipdate"), "month": F.month("l_shipdate")}
    )


def parquet_roundtrip(spark, sf):
    root = scratch_path(spark, "parquet")
    write_table(_by_month(spark, sf), root, "lines", ["year", "month"], sort=["l_shipdate"])
    return read_table(spark, root, "lines")


def parquet_files_per_partition(spark, sf):
    """At most two files in every directory, whatever the number of tasks."""
    root = scratch_path(spark, "dealt")
    write_table(_by_month(spark, sf), root, "lines", ["year"], files_per_partition=2)
    scan = read_table(spark, root, "lines")
    files = scan.select("year", F.col("_metadata.file_path").alias("file"), "l_orderkey")
    return files.groupBy("year").agg(
        F.count(F.lit(1)).alias("n_rows"),
        (F.count_distinct("file") <= 2).alias("few_files"),
    )


def parquet_one_file(spark, sf):
    root = scratch_path(spark, "single")
    write_table(table(spark, sf, "nation"), root, "nation", files_per_partition=1)
    scan = read_table(spark, root, "nation")
    return scan.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(F.col("_metadata.file_path")).alias("n_files"),
    )


def csv_roundtrip(spark, sf):
    """Quoted fields with commas and quotes in them, empty and missing text."""
    parts = table(spark, sf, "part").select(
        "p_partkey",
        F.concat(F.col("p_name"), F.lit(', "'), F.col("p_brand"), F.lit('"')).alias("label"),
        F.when(F.col("p_size") > 25, F.col("p_type")).alias("kind"),
        "p_retailprice",
    )
    path = write_csv(parts, scratch_path(spark, "csv"))
    return read_csv_dir(spark, path, parts.schema)


def _log(spark, sf):
    """Clicks in the raw field names: userId is text, and empty for errors."""
    return clicks(spark, sf).select(
        F.when(F.col("page") == "error", "").otherwise(F.col("userId").cast("string"))
        .alias("userId"),
        "page", "ts", "length", "song",
    )


_STAGED = ["userId", "page", "ts", "length", "song"]
_STAGED_SQL = f"""
  SELECT CASE WHEN page <> 'error' THEN CAST(userId AS INTEGER) END AS userId, page, ts, length,
         song FROM ({CLICKS})
"""


def json_scan(spark, sf):
    """A glob over nested directories, the schema inferred."""
    path = scratch_path(spark, "nested")
    _log(spark, sf).withColumn("day", F.date_format(F.timestamp_millis("ts"), "yyyy-MM-dd")).write \
        .partitionBy("day").json(path)
    return read_json(spark, path + "/*/*.json").select(*_STAGED)


def json_recursive(spark, sf):
    """A whole tree, of which only the files of one suffix are taken."""
    path = scratch_path(spark, "tree")
    _log(spark, sf).write.json(path + "/2024/01")
    _log(spark, sf).write.csv(path + "/2024/02")
    schema = _log(spark, sf).schema
    return read_json(spark, path, schema, recursive=True, pattern="*.json")


def json_stage(spark, sf):
    path = scratch_path(spark, "json")
    _log(spark, sf).write.json(path)
    return stage_json(spark, path, STAGED_EVENTS).select(*_STAGED)


def json_paths_stage(spark, sf):
    path = scratch_path(spark, "json")
    _log(spark, sf).select(
        F.struct("userId", "page").alias("who"), F.col("ts").alias("at"), "length", "song"
    ).write.json(path)
    target = STAGED_EVENTS
    located = {"userId": "$.who.userId", "page": "$.who.page", "ts": "$.at",
               "length": "$.length", "song": "$.song"}
    paths = [located.get(f.name, f"$.{f.name}") for f in target]
    return stage_json(spark, path, target, paths).select(*_STAGED)


def json_rejects(spark, sf):
    """Records with a value that does not parse, and which it was."""
    path = scratch_path(spark, "json")
    _log(spark, sf).withColumn(
        "length", F.when(F.col("page") == "view", "n/a").otherwise(F.col("length").cast("string"))
    ).write.json(path)
    typed, rejects = stage_json_checked(spark, path, STAGED_EVENTS)
    good = typed.groupBy("page").agg(F.count(F.lit(1)).alias("n_rows"))
    bad = rejects.groupBy(F.concat_ws(",", "rejected_columns").alias("rejected"), "page").agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    return good.select(F.lit("").alias("rejected"), "page", "n_rows").unionByName(bad)


def layout_bucketed(spark, sf):
    """A table distributed by order and sorted by line, read through SQL."""
    path = scratch_path(spark, "layout")
    name = "lines_" + path.rsplit("-", 1)[1]
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"
    )
    saved = layout(lines, name, ["l_orderkey"], ["l_linenumber"], 8, files_per_bucket=2,
                   location=path)
    register(saved, f"{name}_view")
    return spark.sql(f"SELECT * FROM {name}_view")


def tables_rebuilt(spark, sf):
    """Create, fill, create again (no effect), then rebuild one of two tables."""
    path = scratch_path(spark, "rebuilt")
    suffix = path.rsplit("-", 1)[1]
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    kept, emptied = f"kept_{suffix}", f"emptied_{suffix}"
    for name in (kept, emptied):
        ensure_table(spark, name, orders.schema, location=f"{path}/{name}")
        orders.write.insertInto(name)
        ensure_table(spark, name, orders.schema, location=f"{path}/{name}")
    rebuild_all(spark, {emptied: orders.schema}, path + "/again")
    counts = [
        spark.table(name).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(label).alias("name"),
                                                                        "n_rows")
        for label, name in (("kept", kept), ("emptied", emptied))
    ]
    return counts[0].unionByName(counts[1])


def incremental_ingest(spark, sf):
    """Files of two deliveries, the second of which repeats part of the first; three runs."""
    source, root = scratch_path(spark, "arrivals"), scratch_path(spark, "ingested")
    events = clicks(spark, sf)
    middle = F.col("ts") < F.lit(1_705_363_200_000)
    late = F.col("ts") >= F.lit(1_704_758_400_000)
    schema = events.schema

    def run():
        ingest_new_files(
            spark, source, schema, root, "clicks", f"{root}/_checkpoint", ["event_id"], ["ts"],
        )

    events.where(middle).write.json(source + "/first")
    run()
    events.where(late).write.json(source + "/second")
    run()
    run()
    return read_loads(spark, root, "clicks")


def csv_multiline(spark, sf):
    """Fields with line ends, blanks and quotes come back as they were written."""
    path = scratch_path(spark, "lines")
    parts = table(spark, sf, "part").select(
        "p_partkey", F.concat("p_name", F.lit("\n\"two\"\r\n, "), "p_brand").alias("label"),
    )
    write_csv(parts, path)
    return read_csv_dir(spark, path, parts.schema)


def csv_multiline_split(spark, sf):
    """Lines of orders in which every field that can hold line ends does, in files cut among tasks."""
    path = scratch_path(spark, "split")
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.concat(F.lit("\n"), "l_returnflag", F.lit("\n,\"\n"), "l_linestatus").alias("flags"),
        F.when(F.col("l_linenumber") > 1, F.repeat(F.lit("\"\n"), F.col("l_linenumber"))).alias("quotes"),
    )
    write_csv(lines, path)
    return read_csv_dir(spark, path, lines.schema)


def csv_reordered(spark, sf):
    """Files with the columns in another order than the schema, and one that it lacks."""
    path = scratch_path(spark, "reordered")
    parts = table(spark, sf, "part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    write_csv(parts.select("p_retailprice", "p_size", "p_name", "p_partkey"), path)
    return read_csv_dir(spark, path, parts.drop("p_size").schema)


def json_broken_lines(spark, sf):
    """Lines cut off in the middle are set apart with their text, by name and by path."""
    path = scratch_path(spark, "broken")
    whole = F.to_json(F.struct("userId", "page", "ts", "length", "song"))
    cut = F.when(F.col("page") == "click", F.left(whole, F.lit(20))).otherwise(whole)
    _log(spark, sf).where("page <> 'error'").select(cut.alias("value")).write.text(path)

    def staged(paths):
        good, bad = stage_json_checked(spark, path, STAGED_EVENTS, paths)
        return good.select(F.lit("").alias("broken"), *_STAGED).unionByName(
            bad.select(F.col("broken_line").alias("broken"), *_nothing()))

    return staged(None).unionByName(staged([f"$.{f.name}" for f in STAGED_EVENTS]))


def _nothing():
    return [F.lit(None).cast(STAGED_EVENTS[c].dataType).alias(c) for c in _STAGED]


_MONTHS = """CAST(extract(year FROM l_shipdate) AS INTEGER) AS year,
             CAST(extract(month FROM l_shipdate) AS INTEGER) AS month"""

QUERIES = {
    "parquet_roundtrip_partitioned": (
        parquet_roundtrip, f"SELECT *, {_MONTHS} FROM lineitem"),
    "parquet_files_per_partition": (parquet_files_per_partition, f"""
        SELECT year, count(*) AS n_rows, true AS few_files
        FROM (SELECT {_MONTHS} FROM lineitem) GROUP BY year"""),
    "parquet_one_file": (
        parquet_one_file, "SELECT count(*) AS n_rows, CAST(1 AS BIGINT) AS n_files FROM nation"),
    "csv_roundtrip": (csv_roundtrip, """
        SELECT p_partkey, p_name || ', "' || p_brand || '"' AS label,
               CASE WHEN p_size > 25 THEN p_type END AS kind, p_retailprice FROM part"""),
    "json_scan": (json_scan, f"""
        SELECT CASE WHEN page = 'error' THEN '' ELSE CAST(userId AS VARCHAR) END AS userId, page,
               ts, length, song FROM ({CLICKS})"""),
    "json_recursive": (json_recursive, f"""
        SELECT CASE WHEN page = 'error' THEN '' ELSE CAST(userId AS VARCHAR) END AS userId, page,
               ts, length, song FROM ({CLICKS})"""),
    "json_stage": (json_stage, _STAGED_SQL),
    "json_paths_stage": (json_paths_stage, _STAGED_SQL),
    "json_rejects": (json_rejects, f"""
        SELECT CASE page WHEN 'view' THEN 'length' WHEN 'error' THEN 'userId' ELSE '' END
                 AS rejected, page, count(*) AS n_rows
        FROM ({CLICKS}) GROUP BY ALL"""),
    "layout_bucketed": (
        layout_bucketed, "SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM lineitem"),
    "tables_rebuilt": (tables_rebuilt, """
        SELECT 'kept' AS name, count(*) AS n_rows FROM orders UNION ALL
        SELECT 'emptied', CAST(0 AS BIGINT)"""),
    "incremental_ingest": (incremental_ingest, CLICKS),
    "csv_multiline": (csv_multiline, """
        SELECT p_partkey, p_name || chr(10) || '"two"' || chr(13) || chr(10) || ', ' || p_brand AS label
        FROM part"""),
    "csv_multiline_split": (csv_multiline_split, """
        SELECT l_orderkey, l_linenumber, chr(10) || l_returnflag || chr(10) || ',"' || chr(10) || l_linestatus
                 AS flags,
               CASE WHEN l_linenumber > 1 THEN repeat('"' || chr(10), l_linenumber) END AS quotes
        FROM lineitem"""),
    "csv_reordered": (csv_reordered, "SELECT p_partkey, p_name, p_retailprice FROM part"),
    "json_broken_lines": (json_broken_lines, f"""
        WITH c AS (SELECT * FROM ({CLICKS}) WHERE page <> 'error'),
        r AS (
          SELECT '' AS broken, CAST(userId AS INTEGER) AS userId, page, ts, length, song
          FROM c WHERE page <> 'click'
          UNION ALL
          SELECT left('{{"userId":"' || userId || '","page":"click","ts":' || ts, 20), NULL, NULL, NULL,
                 NULL, NULL
          FROM c WHERE page = 'click')
        SELECT * FROM r UNION ALL SELECT * FROM r"""),
}
