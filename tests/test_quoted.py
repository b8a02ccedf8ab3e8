"""Split CSV against the reader that takes files whole."""

import random

import pytest
from core_helpers import rows

from starling.sources import read_csv_dir
from starling.sources.quoted import any_line_end_in_quotes

PIECES = ["a", "é", '""', ",", "\n", "\r\n", " ", "x" * 30, "\n\n", ""]


def field(draw):
    """Quoted with anything in it, bare, or with quotes where they mean nothing."""
    kind = draw.random()
    if kind < 0.5:
        return '"' + "".join(draw.choice(PIECES) for _ in range(draw.randrange(8))) + '"'
    if kind < 0.9:
        return draw.choice(["", "plain", "1.5", "naïve 😀", " blank "])
    return draw.choice(['5" pipe', 'b"c"d', '"q"tail'])


def write(path, seed, records, end="\n", final=True):
    draw = random.Random(seed)
    lines = ["k,v,w"] + [",".join([str(i), field(draw), field(draw)]) for i in range(records)]
    path.write_bytes((end.join(lines) + (end if final else "")).encode())


def whole(spark, path):
    return (spark.read.option("header", True).option("recursiveFileLookup", True).option("multiLine", True)
            .option("quote", '"').option("escape", '"').csv(path))


@pytest.fixture
def small_ranges(spark):
    conf = {"spark.sql.files.maxPartitionBytes": "97", "spark.sql.files.openCostInBytes": "1",
            "spark.sql.files.minPartitionNum": "1"}
    for key, value in conf.items():
        spark.conf.set(key, value)
    yield spark
    for key in conf:
        spark.conf.unset(key)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("final", [True, False])
def test_random_quoted_text(small_ranges, tmp_path, end, final):
    for seed in range(3):
        write(tmp_path / f"{seed}.csv", seed, 60, end, final)
    found = read_csv_dir(small_ranges, str(tmp_path))
    assert found.rdd.getNumPartitions() > 20
    # Line ends in fields stay as they are; the other reader makes them those of its own.
    plain = lambda df: [tuple(v and v.replace("\r\n", "\n") for v in row) for row in rows(df)]
    assert sorted(plain(found), key=str) == sorted(plain(whole(small_ranges, str(tmp_path))), key=str)


def test_one_record_over_many_ranges(small_ranges, tmp_path):
    long = "\n".join(f"line {i}, \"\"q\"\"" for i in range(200))
    (tmp_path / "a.csv").write_text(f'k,v\n1,"{long}"\n2,"{long}"\n\n3,x\n4,"left open\nby the end')
    (tmp_path / "b.csv").write_text('k,v\n')
    (tmp_path / "c.csv").write_text('﻿k,v\n5,"a\nb"\n')
    found = {r["k"]: r["v"] for r in read_csv_dir(small_ranges, str(tmp_path)).collect()}
    text = long.replace('""', '"')
    assert found.keys() == {"1", "2", "3", "4", "5"} and found["1"] == found["2"] == text
    assert found["3"] == "x" and found["5"] == "a\nb" and "left open" in found["4"]


def test_header_with_a_line_end_and_wrong_headers(small_ranges, tmp_path):
    name = "v" * 80 + "\n" + "w" * 80
    (tmp_path / "a.csv").write_text(f'k,"{name}"\n1,"a\nb"\n')
    found = read_csv_dir(small_ranges, str(tmp_path))
    assert found.columns == ["k", name] and rows(found) == [("1", "a\nb")]
    for header in (f'"{name}",k', f'k,"{name}",more', "k"):
        (tmp_path / "b.csv").write_text(f"{header}\n2,x\n")
        with pytest.raises(Exception, match="header"):
            read_csv_dir(small_ranges, str(tmp_path)).collect()


def test_files_without_line_ends_in_quotes_take_the_plain_reader(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k,v\n1,"a, ""b"""\n2,5" pipe\n3,"x"y\n')
    assert not any_line_end_in_quotes(spark, str(tmp_path))
    found = read_csv_dir(spark, str(tmp_path))
    assert "mapInArrow" not in found._jdf.queryExecution().toString()
    assert rows(found) == [("1", 'a, "b"'), ("2", '5" pipe'), ("3", '"x"y')]
    (tmp_path / "b.csv").write_text('k,v\n1,"a\nb"\n')
    assert any_line_end_in_quotes(spark, str(tmp_path))


def test_one_file_is_read_by_many_tasks(spark, tmp_path):
    line = '{},"two\nlines, ""quoted"" {}"\n'
    (tmp_path / "big.csv").write_text("k,v\n" + "".join(line.format(i, "x" * 100) for i in range(20_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128k")
    try:
        found = read_csv_dir(spark, str(tmp_path))
        assert found.rdd.getNumPartitions() >= 16
        assert found.where("v = concat('two\nlines, \"quoted\" ', repeat('x', 100))").count() == 20_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
