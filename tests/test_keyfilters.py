import random
from pathlib import Path

import pytest
from core_helpers import rows

from starling.sinks import append, compact_loads, load_absent, read_loads
from starling.sinks.keyfilters import candidates, write_filter
from starling.sinks.loads import committed_loads

SCHEMA = "k long, s string, v long"


def frame(spark, values):
    return spark.createDataFrame(list(values), SCHEMA)


def break_data(root, load):
    """Nothing of this load's rows can be read any more; its filter can."""
    for file in Path(root, "t", f"load={load}").glob("part-*"):
        file.write_bytes(b"no parquet")
        Path(file.parent, f".{file.name}.crc").unlink(missing_ok=True)


@pytest.mark.parametrize("same_range", [False, True])
def test_new_keys_read_no_stored_data_file(spark, tmp_path, same_range):
    """Neither where the ranges of keys differ, nor where only the filter tells keys apart."""
    root = str(tmp_path)
    load = load_absent(frame(spark, ((2 * n, "a", n) for n in range(2000))), root, "t", ["k", "s"], ["v"])
    break_data(root, load)
    new = [(2 * n + 1 if same_range else n + 9000, "a", n) for n in range(20)]
    second = load_absent(frame(spark, new), root, "t", ["k", "s"], ["v"])
    assert committed_loads(spark, root, "t") == [load, second]
    with pytest.raises(Exception):
        load_absent(frame(spark, [(4, "a", 0)]), root, "t", ["k", "s"], ["v"])


@pytest.mark.parametrize("nulls_distinct", [True, False])
def test_loads_equal_a_plain_insert_if_absent(spark, tmp_path, nulls_distinct):
    rnd = random.Random(7)
    root, stored = str(tmp_path), {}
    expected = []
    for batch in range(4):
        values = [(rnd.choice([None, rnd.randrange(60)]), rnd.choice([None, "a", "b"]), 1000 * batch + n) for n in range(80)]
        for k, s, v in values:
            distinct = nulls_distinct and None in (k, s)
            if distinct or (k, s) not in stored:
                stored[k, s] = v
                expected.append((k, s, v))
        load_absent(frame(spark, values), root, "t", ["k", "s"], ["v"], nulls_distinct)
        if batch == 2:
            compact_loads(spark, root, "t")
    assert rows(read_loads(spark, root, "t"), "v") == sorted((v,) for *_, v in expected)


def test_loads_without_a_filter_are_read(spark, tmp_path):
    root = str(tmp_path)
    append(frame(spark, [(1, "a", 0)]), root, "t")
    load_absent(frame(spark, [(1, "a", 1), (2, "a", 2)]), root, "t", ["k"], ["v"])
    # A filter of other keys, or of keys of another type, tells nothing.
    load_absent(frame(spark, [(2, "b", 3), (3, "a", 4)]), root, "t", ["s"], ["v"])
    narrow = frame(spark, [(3, "c", 5), (1, "d", 6)]).selectExpr("CAST(k AS INT) AS k", "s", "v")
    load_absent(narrow.selectExpr("k", "s", "v"), root, "t", ["s"], ["v"])
    assert rows(read_loads(spark, root, "t").select("v")) == [(0,), (2,), (3,), (5,), (6,)]


def test_filters_find_all_keys_and_few_others(spark, tmp_path):
    """Several blocks, an empty load, and a filter that is a part of what it stands for."""
    keys = spark.range(20_000).selectExpr("id * 7 AS k", "CONCAT('s', id % 3) AS s")
    said = write_filter(keys, ["k", "s"], True, str(tmp_path / "load=one"))
    none = write_filter(keys.limit(0), ["k", "s"], True, str(tmp_path / "load=none"))
    assert said["blocks"] == 16 and none["blocks"] == 1
    filters = {"one": (str(tmp_path / "load=one"), 16), "none": (str(tmp_path / "load=none"), 1)}
    assert candidates(keys, ["k", "s"], True, filters).where("__load = 'one'").count() == 20_000
    others = spark.range(20_000).selectExpr("id * 7 + 1 AS k", "CONCAT('s', id % 3) AS s")
    found = candidates(others, ["k", "s"], True, filters)
    assert found.count() < 100
    size = sum(f.stat().st_size for f in (tmp_path / "load=one" / "_keys").glob("part-*"))
    assert size < 20_000 * 8
