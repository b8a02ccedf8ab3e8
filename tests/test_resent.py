"""Event files that are sent again: what is compared, how often, and by how many tasks."""

import gzip
import os
from collections import Counter

import pytest
from core_helpers import rows

from starling import plans as P
from starling import schemas
from starling.operators.resent import EVENT, copies_of, told_apart
from starling.plans import jobs
from starling.sinks import append, read_loads
from starling.sinks.keyfilters import is_set
from starling.sources import read_table, staging
from starling.streaming import append_once, resent, without_marks

PLAY = ('{"artist":"Elena","song":"Setanta","length":269.58322,"page":"NextSong","userId":"%d","sessionId":%d,'
        '"itemInSession":0,"ts":%d,"level":"free","firstName":"A","lastName":"B","gender":"F","location":"Here",'
        '"userAgent":"u"}\n')
SONG = ('{"song_id":"S1","title":"Setanta","artist_id":"A1","artist_name":"Elena","duration":269.58322,"year":2001,'
        '"artist_location":"There","artist_latitude":1.5,"artist_longitude":2.5,"num_songs":1}\n')
EVENTS = "ts long, song string, length double, file string"


def play(n):
    return PLAY % (n, n, 1541105830796 + 1000 * n)


def job(tmp_path, **options):
    for folder in ("events", "songs"):
        os.makedirs(tmp_path / folder)
    (tmp_path / "songs" / "s.json").write_text(SONG)
    return P.JobConfig(str(tmp_path / "events"), str(tmp_path / "songs"), str(tmp_path / "t"), "scheduled",
                       resent="once", **options)


def send(tmp_path, name, *numbers):
    with gzip.open(tmp_path / "events" / f"{name}.json.gz", "wt") as out:
        out.write("".join(map(play, numbers)))


def run(spark, tmp_path, cfg, **limits):
    P.run_new_files(spark, cfg, str(tmp_path / "checkpoint"), **limits)
    return Counter(r[0] for r in read_table(spark, cfg.root, "songplays").select("session_id").collect())


@pytest.mark.parametrize("by_path", [False, True])
def test_a_run_of_many_batches_compares_its_rows_once(spark, tmp_path, by_path, monkeypatch):
    paths = tuple(f"$.{f.name}" for f in schemas.STAGED_EVENTS) if by_path else None
    cfg, calls, true_append = job(tmp_path, event_paths=paths), [], jobs.append_marked
    monkeypatch.setattr(jobs, "append_marked", lambda *a: calls.append(a[1]) or true_append(*a))
    send(tmp_path, "a", 1, 2, 3, 3)
    send(tmp_path, "b", 3, 3, 3, 4)
    send(tmp_path, "c", 1, 5)
    assert run(spark, tmp_path, cfg, max_files=1) == {1: 1, 2: 1, 3: 3, 4: 1, 5: 1}
    assert [len(paths) for paths in calls] == [3]
    send(tmp_path, "d", 3, 5, 6, 6)
    send(tmp_path, "e", 1, 2, 3, 3, 3, 3)
    assert run(spark, tmp_path, cfg, max_files=1) == {1: 1, 2: 1, 3: 4, 4: 1, 5: 1, 6: 2}
    assert [len(paths) for paths in calls] == [3, 2]
    # What has arrived is kept no longer than it waits.
    assert [f for f in os.listdir(tmp_path / "t" / "arrived_events") if f.startswith("load=")] == []


def test_a_run_that_dies_while_its_rows_are_staged_is_completed(spark, tmp_path, monkeypatch):
    cfg = job(tmp_path)

    def dies(*_):
        raise RuntimeError("lost")

    send(tmp_path, "a", 1, 2, 2)
    for step in ("append_marked", "_load_staged"):
        with monkeypatch.context() as patch:
            patch.setattr(jobs, step, dies)
            with pytest.raises(RuntimeError):
                P.run_new_files(spark, cfg, str(tmp_path / "checkpoint"))
    assert run(spark, tmp_path, cfg) == {1: 1, 2: 2}
    # Rows that were staged and not put away add nothing.
    send(tmp_path, "b", 2, 2, 3)
    with monkeypatch.context() as patch:
        patch.setattr(jobs, "drop_path", dies)
        with pytest.raises(RuntimeError):
            P.run_new_files(spark, cfg, str(tmp_path / "checkpoint"))
    assert run(spark, tmp_path, cfg) == {1: 1, 2: 2, 3: 1}


def test_lines_of_a_compressed_file_are_dealt(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(staging, "_RECUT_ROWS", 100)
    lines = [f'{{"n": {n}}}' for n in range(1000)]
    with gzip.open(tmp_path / "one.json.gz", "wt") as out:
        out.write("\n".join(lines))
    read = spark.read.text(str(tmp_path / "one.json.gz")).selectExpr("value", "-7L AS f")
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    staging.recut(read, str(tmp_path / "cut"), "f")
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
    files = os.listdir(tmp_path / "cut" / "f=-7")
    assert len([f for f in files if f.endswith(".snappy")]) == 10
    again = spark.read.schema("value string, f bigint").text(str(tmp_path / "cut"))
    assert rows(again) == sorted((line, -7) for line in lines)


def test_equal_rows_have_equal_digests_of_16_bytes(spark):
    values = [(1, "a", 0.0, "x"), (1, "a", -0.0, "y"), (1, None, 0.0, "x"), (None, "a", 0.0, "x"), (1, "a", None, "x")]
    marked = told_apart(spark.createDataFrame(values, EVENTS), "ts", ["ts", "song", "length"]).collect()
    digests = [bytes(r[EVENT]) for r in marked]
    assert digests[0] == digests[1] and len(set(digests)) == 4 and {len(d) for d in digests} == {16}


def test_copies_have_the_smallest_place(spark):
    some = spark.createDataFrame([(5, b"a", "x", 9), (5, b"a", "x", 7), (5, b"a", "y", 8), (6, b"b", "y", 3)],
                                 "__at long, __event binary, f string, p long")
    kept = []
    got = copies_of(some, "__at", "f", "p", lambda counts: kept.append(counts) or counts)
    assert rows(got.select("__at", "p", "__copy")) == [(5, 7, 0), (5, 7, 1), (6, 3, 0)]
    assert kept[0].count() == 2


@pytest.mark.parametrize("copied", [0, 64 << 20])
def test_rows_come_back_from_their_places(spark, tmp_path, copied, monkeypatch):
    monkeypatch.setattr(resent, "_COPIED", copied)
    root = str(tmp_path)
    data = spark.range(0, 80_000, 1, 2).selectExpr("id % 50000 AS ts", "'s' || id % 50000 AS song", "1.5D AS length",
                                                   "IF(id < 70000, 'x', 'y') AS file")
    append_once(data, root, "t", "ts", "file")
    got = without_marks(read_loads(spark, root, "t"))
    assert got.count() == 70_000 and got.distinct().count() == 50_000
    append_once(data.where("file = 'y'"), root, "t", "ts", "file")
    assert read_loads(spark, root, "t").count() == 70_000


def test_loads_with_other_digests_are_refused(spark, tmp_path):
    root = str(tmp_path)
    append(spark.createDataFrame([(1, "a", 0.5, 1, "ab" * 32, 0)],
                                 "ts long, song string, length double, __at long, __event string, __copy long"), root, "t")
    with pytest.raises(ValueError, match="not told apart"):
        append_once(spark.createDataFrame([(1, "a", 0.5, "x")], EVENTS), root, "t", "ts", "file")


def test_every_bit_of_a_bitmap(spark):
    bits = spark.range(0, 32768, 3).selectExpr("bitmap_construct_agg(CAST(id AS INT)) AS bits")
    asked = spark.range(32768).selectExpr("CAST(id AS INT) AS place").crossJoin(bits)
    found = [r[0] for r in asked.where(is_set(asked["bits"], asked["place"])).select("place").collect()]
    assert sorted(found) == list(range(0, 32768, 3))
