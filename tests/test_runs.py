"""Runs that end half way, constraints of the target tables, and upserts that rewrite what they touch."""

import os

import pytest
from core_helpers import physical, rows

from starling import operators as O
from starling import plans as P
from starling.operators import CheckFailed
from starling.plans.jobs import TABLES
from starling.sinks import (
    append, commit_run, compact_loads, load_upsert, prepare, read_loads, settle_runs, vacuum_loads,
)
from starling.sinks import loads as L
from starling.sources import read_table

SCHEMA = "k int, v string, o int"
PLAY = ('{"artist":"Elena","song":"Setanta","length":269.58322,"page":"NextSong","userId":"%d","sessionId":%d,'
        '"itemInSession":0,"ts":%d,"level":%s,"firstName":"A","lastName":"B","gender":"F","location":"Here",'
        '"userAgent":"u"}\n')
SONG = ('{"song_id":"S1","title":"Setanta","artist_id":"A1","artist_name":"Elena","duration":269.58322,"year":2001,'
        '"artist_location":"There","artist_latitude":1.5,"artist_longitude":2.5,"num_songs":1}\n')


def frame(spark, *values):
    return spark.createDataFrame(list(values), SCHEMA)


def job(tmp_path, variant, levels, **options):
    for folder in ("events", "songs"):
        os.makedirs(tmp_path / folder, exist_ok=True)
    (tmp_path / "songs" / "s.json").write_text(SONG)
    (tmp_path / "events" / "e.json").write_text("".join(
        PLAY % (i + 1, i + 1, 1541105830796 + 1000 * i, level) for i, level in enumerate(levels)))
    return P.JobConfig(str(tmp_path / "events"), str(tmp_path / "songs"), str(tmp_path / "t"), variant, **options)


def sizes(spark, cfg):
    return [read_table(spark, cfg.root, name).count() for name in TABLES]


LEVELS = ['"free"', "null", '"%s"' % ("x" * 300), '"paid"']
# A limit that a variant does not have itself is given to it: files take anything.
RULES = {"songplays": (["level"], {"level": 256}), "users": (["level"], {"level": 256})}


@pytest.mark.parametrize("variant", P.VARIANTS)
def test_violations_stop_the_job(spark, tmp_path, variant):
    good = job(tmp_path, variant, LEVELS[:1], violations="stop", constraints=RULES)
    P.run_job(spark, good)
    before = {name: rows(read_table(spark, good.root, name)) for name in TABLES}
    for bad in (LEVELS[:2], [LEVELS[0], LEVELS[2]]):
        with pytest.raises(CheckFailed, match="level"):
            P.run_job(spark, job(tmp_path, variant, bad, violations="stop", constraints=RULES))
        assert before == {name: rows(read_table(spark, good.root, name)) for name in TABLES}


@pytest.mark.parametrize("variant", P.VARIANTS)
def test_violations_are_diverted(spark, tmp_path, variant):
    cfg = job(tmp_path, variant, LEVELS, violations="divert", constraints=RULES)
    report = {r["query"]: r["actual"] for r in P.run_job(spark, cfg).collect()}
    assert sizes(spark, cfg)[:2] == [2, 2]
    length = "octet_length" if variant in ("warehouse", "scheduled") else "length"
    for name in ("songplays", "users"):
        apart = read_table(spark, cfg.root, f"{name}_diverted")
        assert {r[0] for r in rows(apart, "violations")} == {f"{length}(level) > 256", "level IS NULL"}
        assert report[f"{name}: level IS NULL"] == "1"
        assert {r["level"] for r in read_table(spark, cfg.root, name).collect()} == {"free", "paid"}


def test_own_constraints_of_the_variants(spark, tmp_path):
    for variant, stops in (("lake", False), ("warehouse", True), ("scheduled", False), ("relational", True)):
        base = tmp_path / variant
        base.mkdir()
        cfg = job(base, variant, ["null"], violations="stop")
        if stops:
            with pytest.raises(CheckFailed, match="songplays: level IS NULL: expected 0, got 1"):
                P.run_job(spark, cfg)
        else:
            P.run_job(spark, cfg)
    with pytest.raises(CheckFailed, match="octet_length"):
        base = tmp_path / "long"
        base.mkdir()
        P.run_job(spark, job(base, "scheduled", LEVELS[2:3], violations="stop"))
    with pytest.raises(ValueError):
        P.run_job(spark, job(base, "scheduled", LEVELS[:1], violations="sometimes"))


def test_lengths_in_bytes_and_characters(spark):
    df = spark.createDataFrame([("é" * 3,), ("abcd",), (None,)], "t string")
    for in_bytes, long in ((True, 2), (False, 1)):
        rules = O.row_rules([], {"t": 3}, in_bytes)
        assert O.violations(df, rules)[1].count() == long


def test_violations_are_counted_in_the_pass_that_writes(spark, tmp_path):
    df = spark.range(1000).selectExpr("IF(id % 10 = 0, NULL, id) AS k", "REPEAT('x', CAST(id % 7 AS INT)) AS v")
    df.write.parquet(str(tmp_path / "in"))
    df = spark.read.parquet(str(tmp_path / "in"))
    seen, counts = O.watched(df, O.row_rules(["k"], {"v": 5}))
    assert physical(seen).count("FileScan") == 1 and "Exchange" not in physical(seen)
    append(seen, str(tmp_path), "t")
    assert counts.get == {"rows": 1000, "k IS NULL": 100, "length(v) > 5": 142}
    none, counts = O.watched(df.where("k < 0"), O.row_rules(["k"], {}))
    append(none, str(tmp_path), "t")
    assert counts.get == {"rows": 0, "k IS NULL": 0}


@pytest.mark.parametrize("variant", ["warehouse", "scheduled", "relational"])
def test_a_run_that_dies_before_its_commit_changes_nothing(spark, tmp_path, variant, monkeypatch):
    cfg = job(tmp_path, variant, LEVELS[:1])

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(L, "_put", dies)
        with pytest.raises(RuntimeError):
            P.run_job(spark, cfg)
    assert sizes(spark, cfg) == [0] * 5
    P.run_job(spark, cfg)
    assert sizes(spark, cfg) == [1] * 5


@pytest.mark.parametrize("tables", range(5))
def test_a_run_that_dies_between_two_tables_has_changed_all(spark, tmp_path, tables, monkeypatch):
    cfg = job(tmp_path, "scheduled", LEVELS[:1])
    marked, true_commit = [], L.commit

    def dies(spark_, root, name, load):
        if name in TABLES and cfg.root == root:
            if len(marked) == tables:
                raise RuntimeError("lost")
            marked.append(name)
        true_commit(spark_, root, name, load)

    from starling.sinks import ensure_loads
    from starling import schemas
    ensure_loads(spark, cfg.root, schemas.targets("scheduled"))
    with monkeypatch.context() as patch:
        patch.setattr(L, "commit", dies)
        with pytest.raises(RuntimeError):
            P.load_all(spark, cfg) if P.stage_all(spark, cfg) else None
    assert sizes(spark, cfg) == [1] * 5
    # The next run settles the last one's commit, and adds no row of it twice.
    settle_runs(spark, cfg.root)
    settle_runs(spark, cfg.root)
    assert L.marks(spark, f"{cfg.root}/_manifests") == []
    assert sizes(spark, cfg) == [1] * 5
    P.run_job(spark, cfg)
    assert sizes(spark, cfg) == [2, 1, 1, 1, 2]


def test_one_commit_for_several_tables(spark, tmp_path):
    root = str(tmp_path)
    loads = {name: prepare(frame(spark, (1, name, 0)), root, name) for name in ("a", "b")}
    assert read_loads(spark, root, "a") is None
    commit_run(spark, root, loads)
    commit_run(spark, root, loads)
    assert rows(read_loads(spark, root, "a")) == [(1, "a", 0)] and rows(read_loads(spark, root, "b")) == [(1, "b", 0)]


def _files(root):
    return {os.path.join(d, f) for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


def test_upsert_writes_only_the_buckets_it_touches(spark, tmp_path):
    root = str(tmp_path)
    every = spark.range(6400).selectExpr("CAST(id AS INT) AS k", "'old' AS v", "0 AS o")
    load_upsert(every, root, "t", ["k"], ["o"])
    first = _files(tmp_path)
    bucket = {r["k"]: r["b"] for r in L._in_buckets(every, ["k"], 64).selectExpr("k", "key_bucket AS b").collect()}
    three = sorted(set(bucket.values()))[:3]
    keys = [k for k in bucket if bucket[k] in three][:50]
    load_upsert(frame(spark, *[(k, "new", 1) for k in keys]), root, "t", ["k"], ["o"])
    new = _files(tmp_path) - first
    assert {f.split("key_bucket=")[1].split("/")[0] for f in new} == {str(b) for b in three if b in
                                                                     {bucket[k] for k in keys}}
    assert len(new) <= 3 and first <= _files(tmp_path)
    assert sum(map(os.path.getsize, new)) < 0.1 * sum(map(os.path.getsize, first))
    got = {r["k"]: r["v"] for r in read_loads(spark, root, "t").collect()}
    assert len(got) == 6400 and all((got[k] == "new") == (k in keys) for k in got)
    # A key that is new goes to its bucket, other columns and NULL keys are kept apart.
    load_upsert(frame(spark, (7000, "new", 1), (None, "a", 1), (None, "b", 2)), root, "t", ["k"], ["o"])
    load_upsert(frame(spark, (None, "c", 0)), root, "t", ["k"], ["o"])
    table = read_loads(spark, root, "t")
    assert table.count() == 6402 and rows(table.where("k IS NULL")) == [(None, "c", 0)]
    assert table.columns == ["k", "v", "o"]


def test_superseded_buckets_can_be_removed(spark, tmp_path):
    root = str(tmp_path)
    for v in ("a", "b", "c"):
        load_upsert(frame(spark, *[(k, v, 0) for k in range(0, 100 if v == "a" else 10)]), root, "t", ["k"], ["o"],
                    buckets=16)
    before, held = rows(read_loads(spark, root, "t")), _files(tmp_path)
    vacuum_loads(spark, root, "t")
    vacuum_loads(spark, root, "t")
    assert rows(read_loads(spark, root, "t")) == before and len(_files(tmp_path)) < len(held)
    load_upsert(frame(spark, (5, "d", 0)), root, "t", ["k"], ["o"])
    vacuum_loads(spark, root, "t")
    assert read_loads(spark, root, "t").where("v = 'd'").count() == 1 and read_loads(spark, root, "t").count() == 100
    compact_loads(spark, root, "t")
    assert read_loads(spark, root, "t").count() == 100


def test_upsert_into_other_tables(spark, tmp_path):
    """Into plain loads, after an append, by other keys, with an empty batch, and once per tag."""
    root = str(tmp_path)
    load_upsert(frame(spark, (0, "", 0)).limit(0), root, "empty", ["k"], ["o"])
    assert rows(read_loads(spark, root, "empty")) == []
    append(frame(spark, (1, "a", 0), (2, "b", 0)), root, "t")
    load_upsert(frame(spark, (1, "c", 0)), root, "t", ["k"], ["o"], buckets=4)
    append(frame(spark, (3, "d", 0)), root, "t")
    assert rows(read_loads(spark, root, "t")) == [(1, "c", 0), (2, "b", 0), (3, "d", 0)]
    load_upsert(frame(spark, (3, "e", 0)), root, "t", ["k"], ["o"])
    load_upsert(frame(spark, (0, "", 0)).limit(0), root, "t", ["k"], ["o"])
    for _ in range(2):
        load_upsert(frame(spark, (3, "f", 0), (3, "g", 1)).selectExpr("CAST(k AS BIGINT) AS k", "o", "v"), root, "t",
                    ["k"], ["o"], tag="once")
    assert rows(read_loads(spark, root, "t")) == [(1, "c", 0), (2, "b", 0), (3, "g", 1)]
    load_upsert(frame(spark, (9, "b", 5)), root, "t", ["v"], ["o"])
    assert rows(read_loads(spark, root, "t")) == [(1, "c", 0), (3, "g", 1), (9, "b", 5)]
