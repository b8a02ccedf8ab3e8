"""Reports that follow a fact's loads, and files that are sent again."""

import json
import random
from collections import Counter
from pathlib import Path

import pytest
from core_helpers import rows

from pyspark.sql import functions as F
from starling import plans as P
from starling.operators import copies_of, top_k, users_by
from starling.plans import standing
from starling.sinks import append, compact_loads, load_upsert, read_loads, refresh
from starling.sinks.loads import committed_loads
from starling.streaming import append_once, without_marks

PLAYS = "month int, hour int, user_id long, level string"
FORMS = ["bitmap", "rows"]


def plays(spark, values, schema=PLAYS):
    return spark.createDataFrame(list(values), schema)


def break_data(root, name, load):
    """Nothing of this load's rows can be read any more."""
    for file in Path(root, name, f"load={load}").glob("part-*"):
        file.write_bytes(b"no parquet")
        Path(file.parent, f".{file.name}.crc").unlink(missing_ok=True)




def random_plays(rnd, n):
    return [(rnd.choice([1, 2, None]), rnd.randrange(3), rnd.choice([None, 0, -5, 32768, 32769, -32768,
            rnd.randrange(100_000), 2**62 + rnd.randrange(3)]), rnd.choice(["paid", "free"])) for _ in range(n)]


@pytest.mark.parametrize("form", FORMS)
def test_standing_users_equal_a_full_count_after_every_load(spark, tmp_path, form):
    rnd, root, by = random.Random(3), str(tmp_path), ["month", "hour"]
    paid = lambda df: df.where("level = 'paid'")
    for n in range(5):
        append(plays(spark, random_plays(rnd, 0 if n == 2 else 40)), root, "f")
        if n == 3:
            compact_loads(spark, root, "f")
        got = P.standing_users(spark, root, "f", "u", by, rows=paid, form=form)
        expected = users_by(paid(read_loads(spark, root, "f")), by)
        assert rows(got, *by, "users") == rows(expected, *by, "users")
    # Without a new load nothing is counted or written.
    before = committed_loads(spark, root, "u"), committed_loads(spark, root, "u_report")
    P.standing_users(spark, root, "f", "u", by, rows=paid, form=form)
    assert before == (committed_loads(spark, root, "u"), committed_loads(spark, root, "u_report"))
    refresh(plays(spark, [(7, 7, 7, "paid")]), root, "f")
    got = P.standing_users(spark, root, "f", "u", by, rows=paid, form=form)
    assert rows(got, *by, "users") == [(7, 7, 1)]


def test_standing_users_of_texts_and_of_coarser_groups(spark, tmp_path):
    root = str(tmp_path)
    values = [(1, 1, "a"), (1, 2, "a"), (1, 2, "b"), (2, 1, "a"), (2, 1, None)]
    append(plays(spark, values, "month int, hour int, user_id string"), root, "f")
    got = P.standing_users(spark, root, "f", "u", ["month", "hour"])
    assert rows(got, "month", "hour", "users") == [(1, 1, 1), (1, 2, 2), (2, 1, 1)]
    for form in standing.FORMS:
        data = plays(spark, [(1, 1, 5, ""), (1, 2, 5, ""), (1, 2, 6, ""), (2, 1, None, "")])
        counts = standing.user_counts(data, ["month", "hour"], "user_id", form)
        assert rows(standing.users_of(counts, ["month"], form), "month", "users") == [(1, 2), (2, 0)]


def test_sketches_are_close(spark):
    data = spark.range(60_000).select((F.col("id") % 2).alias("g"), (F.col("id") % 20_000).alias("u"))
    parts = [standing.user_counts(data, ["g"], "u", "sketch") for _ in range(2)]
    for row in standing.users_of(parts[0].union(parts[1]), ["g"], "sketch").collect():
        assert abs(row["users"] - 10_000) < 700


def test_a_new_load_reads_no_older_rows_and_writes_its_own_groups(spark, tmp_path):
    root, by = str(tmp_path), ["month", "hour"]
    values = [(m, h, 100 * m + h + i, "paid") for m in range(1, 9) for h in range(6) for i in range(2)]
    append(plays(spark, values), root, "f")
    P.standing_users(spark, root, "f", "u", by, buckets=32)
    append(plays(spark, [(1, 1, 1, "paid")]), root, "f")
    P.standing_users(spark, root, "f", "u", by, buckets=32)
    first, second = committed_loads(spark, root, "f")
    for load in (first, second):
        break_data(root, "f", load)
    append(plays(spark, [(3, 2, 9_000, "paid"), (3, 2, 302, "paid")]), root, "f")
    dealt = committed_loads(spark, root, "u_report")[-1]
    got = P.standing_users(spark, root, "f", "u", by, buckets=32)
    assert {tuple(r) for r in got.where("month = 3 AND hour = 2").collect()} == {(3, 2, 3)}
    assert got.count() == 48
    last = committed_loads(spark, root, "u_report")[-1]
    homes = json.loads(Path(root, "u_report", f"load={last}", "_buckets.json").read_text())["homes"]
    assert Counter(homes.values())[last] == 1 and set(homes.values()) == {dealt, last}


def test_upserted_facts_are_refused(spark, tmp_path):
    root = str(tmp_path)
    assert P.standing_users(spark, root, "f", "u", ["month"]) is None
    assert P.standing_top(spark, root, "f", "t", "month") is None
    load_upsert(plays(spark, [(1, 1, 1, "a")]), root, "f", ["month"], ["hour"])
    with pytest.raises(ValueError, match="upserted"):
        P.standing_users(spark, root, "f", "u", ["month"])
    with pytest.raises(ValueError, match="form"):
        standing.user_counts(plays(spark, []), ["month"], "user_id", "other")


COUNTED = "song string, sign int"


@pytest.mark.parametrize("seed", [1, 2])
def test_standing_top_equals_a_recount_after_every_load(spark, tmp_path, seed):
    rnd, root, held = random.Random(seed), str(tmp_path), []
    for n in range(7):
        new = [(rnd.choice([None, *"aaabbcdefghij"]), 1) for _ in range(0 if n == 3 else 25)]
        if n > 1:
            back = rnd.sample(held, 8)
            for song, _ in back:
                held.remove((song, 1))
            new += [(song, -1) for song, _ in back]
        held += [v for v in new if v[1] == 1]
        append(plays(spark, new, COUNTED), root, "f")
        k = 3 if n < 5 else 6
        got = P.standing_top(spark, root, "f", "t", "song", k, spare=2, sign=F.col("sign"))
        expected = top_k(plays(spark, held, COUNTED), "song", k)
        assert [tuple(r) for r in got.collect()] == [tuple(r) for r in expected.collect()]
    refresh(plays(spark, [("z", 1)], COUNTED), root, "f")
    got = P.standing_top(spark, root, "f", "t", "song", 3, sign=F.col("sign"))
    assert [tuple(r) for r in got.collect()] == [("z", 1)]


def test_standing_top_reads_only_the_new_load_while_it_is_certain(spark, tmp_path):
    root = str(tmp_path)
    songs = [(f"s{n:02d}", 1) for n in range(30) for _ in range(100 if n < 3 else 5)]
    append(plays(spark, songs, COUNTED), root, "f")
    P.standing_top(spark, root, "f", "t", "song", 3, spare=4)
    for name in ("f", "t"):
        break_data(root, name, committed_loads(spark, root, name)[0])
    append(plays(spark, [("s29", 1)] * 40 + [("s02", 1)] * 2, COUNTED), root, "f")
    got = P.standing_top(spark, root, "f", "t", "song", 3, spare=4)
    assert [tuple(r) for r in got.collect()] == [("s02", 102), ("s00", 100), ("s01", 100)]
    # 5 + 40 + 60 may exceed 100: all counts are needed, and those of the first load cannot be read.
    append(plays(spark, [("s29", 1)] * 60, COUNTED), root, "f")
    with pytest.raises(Exception):
        P.standing_top(spark, root, "f", "t", "song", 3, spare=4).collect()


EVENT = "ts long, song string, length double, file string"


def test_rows_stand_as_often_as_in_the_file_that_has_them_most_often(spark, tmp_path):
    rnd, root, expected = random.Random(5), str(tmp_path), Counter()
    for n in range(4):
        values = []
        for file in "xyz":
            some = [(rnd.choice([None, 1, 2, 10 * n]), rnd.choice([None, "a", ""]), rnd.choice([None, 0.5, float("nan")]))
                    for _ in range(0 if n == 2 else 30)]
            values += [(*v, file) for v in some]
            for v, times in Counter(map(repr, some)).items():
                expected[v] = max(expected[v], times)
        append_once(spark.createDataFrame(values, EVENT), root, "t", "ts", "file", tag=f"b{n}")
        append_once(spark.createDataFrame(values, EVENT), root, "t", "ts", "file", tag=f"b{n}")
        append_once(spark.createDataFrame(values, EVENT), root, "t", "ts", "file", tag=f"again{n}")
        got = without_marks(read_loads(spark, root, "t"))
        assert got.columns == ["ts", "song", "length"]
        assert Counter(repr(tuple(r)) for r in got.collect()) == expected


def test_one_row_repeated_very_often(spark):
    many = spark.range(5000).select(F.lit(1).alias("ts"), F.lit("f").alias("file"))
    got = copies_of(many, "ts", "file")
    assert got.select("__copy").distinct().count() == got.count() == 5000


def test_tables_filled_otherwise_are_refused(spark, tmp_path):
    root = str(tmp_path)
    data = spark.createDataFrame([(1, "a", 0.5, "x")], EVENT)
    append(data.drop("file"), root, "t")
    with pytest.raises(ValueError, match="not told apart"):
        append_once(data, root, "t", "ts", "file")
    append_once(data, root, "u", "ts", "file")
    compact_loads(spark, root, "u")
    append_once(data, root, "u", "ts", "file")
    assert read_loads(spark, root, "u").count() == 1


def test_old_loads_are_not_read_for_rows_of_another_time(spark, tmp_path):
    root = str(tmp_path)
    load = append_once(spark.createDataFrame([(n, "a", 0.5, "x") for n in range(50)], EVENT), root, "t", "ts", "file")
    break_data(root, "t", load)
    append_once(spark.createDataFrame([(n, "a", 0.5, "x") for n in range(100, 120)], EVENT), root, "t", "ts", "file")
    assert len(committed_loads(spark, root, "t")) == 2
