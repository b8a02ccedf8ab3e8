import json

import pytest
from core_helpers import rows

from starling import schemas
from starling.operators import file_counts
from starling.sinks import write_csv
from starling.sources import read_csv_dir, read_json, stage_json, stage_json_checked
from starling.streaming import ingest_new_files
from starling.sinks import read_loads

EVENT = {
    "artist": None, "auth": "Logged In", "firstName": "Nils", "gender": "M", "itemInSession": 0,
    "lastName": "Berg", "length": None, "level": "free", "location": "Lowmoor, ZZ",
    "method": "GET", "page": "Home", "registration": 1500000000123.0, "sessionId": 71, "song": None,
    "status": 200, "ts": 1600000000456, "userAgent": "\"Browser/1\"", "userId": "64",
}


def write(path, *records):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(json.dumps(r) + "\n" for r in records), encoding="utf8")


@pytest.fixture
def log(tmp_path):
    write(tmp_path / "2018/11/a.json", EVENT, {**EVENT, "userId": "", "itemInSession": 1})
    write(tmp_path / "2018/12/b.json", {**EVENT, "length": 246.5, "itemInSession": 2, "extra": 1})
    (tmp_path / "2018/12/notes.txt").write_text("not json")
    return str(tmp_path)


def test_glob_and_recursive_scan(spark, log):
    assert read_json(spark, log + "/*/*/*.json").count() == 3
    tree = read_json(spark, log, schemas.RAW_EVENTS, recursive=True, pattern="*.json")
    assert tree.count() == 3
    assert sorted(r["n_rows"] for r in file_counts(tree).collect()) == [1, 2]


def test_staging_is_typed_and_survives_empty_ids(spark, log):
    staged = stage_json(spark, log, schemas.STAGED_EVENTS, pattern="*.json")
    assert staged.schema.simpleString() == schemas.STAGED_EVENTS.simpleString()
    assert rows(staged, "itemInSession", "userId", "length", "ts") == [
        (0, 64, None, 1600000000456), (1, None, None, 1600000000456), (2, 64, 246.5, 1600000000456)]


def test_staging_by_json_paths(spark, log):
    paths = [f"$['{f.name}']" for f in schemas.STAGED_EVENTS]
    by_path = stage_json(spark, log, schemas.STAGED_EVENTS, paths, pattern="*.json")
    by_name = stage_json(spark, log, schemas.STAGED_EVENTS, pattern="*.json")
    assert rows(by_path, "itemInSession", "userId", "userAgent") == rows(
        by_name, "itemInSession", "userId", "userAgent")
    with pytest.raises(ValueError):
        stage_json(spark, log, schemas.STAGED_EVENTS, paths[:3])


def test_rejects_are_set_apart(spark, log):
    typed, rejects = stage_json_checked(spark, log, schemas.STAGED_EVENTS, pattern="*.json")
    assert typed.count() == 2
    assert [r["rejected_columns"] for r in rejects.collect()] == [["userId"]]


def test_csv_tree(spark, tmp_path):
    header = ("artist,auth,firstName,gender,itemInSession,lastName,length,level,location,method,page,"
              "registration,sessionId,song,status,ts,userId\n")
    first = ('Oak Choir,Logged In,Nils,M,0,Berg,301.25,free,"Lowmoor, ZZ",'
             'PUT,NextSong,1.5E+12,71,Night Train,200,1.6E+12,64\n')
    second = (',Logged Out,,,1,,,free,,GET,Home,,71,,200,1.6E+12,\n')
    third = ('"Say ""Hi""",Logged In,Ána,F,2,Ö,1.5,paid,"X, Y",PUT,NextSong,1.5E+12,584,Né,200,1.5E+12,7\n')
    (tmp_path / "d").mkdir()
    (tmp_path / "a.csv").write_text(header + first + second, encoding="utf8")
    (tmp_path / "d" / "b.csv").write_text(header + third, encoding="utf8")
    typed = read_csv_dir(spark, str(tmp_path), schemas.CSV_EVENTS)
    assert rows(typed, "itemInSession", "artist", "location", "userId") == [
        (0, "Oak Choir", "Lowmoor, ZZ", 64), (1, None, None, None),
        (2, 'Say "Hi"', "X, Y", 7)]
    text = read_csv_dir(spark, str(tmp_path))
    assert {f.dataType.simpleString() for f in text.schema} == {"string"}


def test_csv_sink_quotes_everything(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a, "b"'), (2, None)], "k int, v string")
    path = write_csv(df.coalesce(1), str(tmp_path / "out"))
    lines = [line for f in (tmp_path / "out").glob("part-*") for line in f.read_text().splitlines()]
    assert lines == ['"k","v"', '"1","a, ""b"""', '"2",""']
    assert rows(read_csv_dir(spark, path, df.schema)) == [(1, 'a, "b"'), (2, None)]


def test_csv_keeps_line_ends_and_goes_by_name(spark, tmp_path):
    df = spark.createDataFrame([(1, "a\nb"), (2, "c")], "k int, v string")
    assert rows(read_csv_dir(spark, write_csv(df, str(tmp_path / "out")), df.schema)) == [(1, "a\nb"), (2, "c")]
    (tmp_path / "turned").mkdir()
    (tmp_path / "turned" / "a.csv").write_text("v,k\nx,1\n")
    assert rows(read_csv_dir(spark, str(tmp_path / "turned"), df.schema)) == [(1, "x")]
    with pytest.raises(ValueError, match="no column w"):
        read_csv_dir(spark, str(tmp_path / "turned"), df.withColumnRenamed("v", "w").schema)
    (tmp_path / "turned" / "b.csv").write_text("k,v\n2,y\n")
    with pytest.raises(Exception):  # two headers: an error, never a false row
        read_csv_dir(spark, str(tmp_path / "turned"), df.schema).collect()


@pytest.mark.parametrize("by_path", [False, True])
def test_broken_lines_are_set_apart_or_stop_the_load(spark, tmp_path, by_path):
    whole = json.dumps({"userId": "1", "page": "p"})
    (tmp_path / "a.json").write_text(f"{whole}\n{whole[:12]}\n\n[1, 2\n")
    paths = [f"$.{f.name}" for f in schemas.STAGED_EVENTS] if by_path else None
    good, bad = stage_json_checked(spark, str(tmp_path), schemas.STAGED_EVENTS, paths)
    assert rows(good, "userId", "page") == [(1, "p")]
    assert rows(bad, "broken_line") == [("[1, 2",), (whole[:12],)]
    with pytest.raises(Exception, match="not a JSON record"):
        stage_json(spark, str(tmp_path), schemas.STAGED_EVENTS, paths).collect()


def test_paths_are_parsed_once_and_read_from_a_file(spark, tmp_path):
    from starling.sources import read_json_paths
    (tmp_path / "paths.json").write_text('{"jsonpaths": ["$.who.id", "$[\'at\']"]}')
    paths = read_json_paths(spark, str(tmp_path / "paths.json"))
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.json").write_text('{"who": {"id": 7, "x": 1}, "at": "9"}\n')
    target = spark.createDataFrame([], "id int, at bigint").schema
    staged = stage_json(spark, str(tmp_path / "d"), target, paths)
    assert rows(staged) == [(7, 9)]
    with pytest.raises(ValueError):
        stage_json(spark, str(tmp_path / "d"), target, ["$.a[0]", "at"])


def test_ingest_takes_every_file_once(spark, tmp_path):
    source, root = tmp_path / "in", str(tmp_path / "out")
    schema = "k int, v string"
    args = dict(schema=spark.createDataFrame([], schema).schema, root=root, name="t")

    def run(**more):
        ingest_new_files(spark, str(source), checkpoint=f"{root}/_cp", **args, **more)

    write(source / "a.json", {"k": 1, "v": "a"}, {"k": 1, "v": "b"}, {"k": None, "v": "n"})
    run(keys=["k"], order_by=["v"])
    assert rows(read_loads(spark, root, "t")) == [(None, "n"), (1, "a")]
    run(keys=["k"], order_by=["v"])
    write(source / "sub" / "b.json", {"k": 1, "v": "c"}, {"k": 2, "v": "d"})
    run(keys=["k"], order_by=["v"], max_files=1)
    assert rows(read_loads(spark, root, "t")) == [(None, "n"), (1, "a"), (2, "d")]


def test_ingest_without_keys_appends_and_transforms(spark, tmp_path):
    source, root = tmp_path / "in", str(tmp_path / "out")
    write(source / "a.json", {"k": 1}, {"k": 1})
    ingest_new_files(
        spark, str(source), spark.createDataFrame([], "k int").schema, root, "t",
        f"{root}/_cp", transform=lambda df: df.selectExpr("k + 1 AS k"))
    assert rows(read_loads(spark, root, "t")) == [(2,), (2,)]


def test_replayed_batch_is_not_loaded_again(spark, tmp_path):
    """What a restart after a crash between load and checkpoint does: the same batch once more."""
    import shutil
    source, root = tmp_path / "in", str(tmp_path / "out")
    write(source / "a.json", {"k": 1})
    args = (spark, str(source), spark.createDataFrame([], "k int").schema, root, "t", f"{root}/_cp")
    ingest_new_files(*args)
    shutil.rmtree(f"{root}/_cp/commits")
    ingest_new_files(*args)
    assert rows(read_loads(spark, root, "t")) == [(1,)]
