import datetime as dt
import hashlib

from hypothesis import given, settings, strategies as st
import pytest
from pyspark.sql import functions as F

from starling.functions import (
    concat, drop_fraction, epoch_ms, epoch_s, hash_key, md5_key, sha2_key, time_parts, to_epoch_ms,
    try_cast, weekday,
)


def test_millisecond_and_second_timestamps(spark):
    df = spark.createDataFrame([(1541105830796,), (0,), (None,)], "ts bigint")
    got = [tuple(r) for r in df.select(epoch_ms("ts"), epoch_s("ts")).collect()]
    assert got == [
        (dt.datetime(2018, 11, 1, 20, 57, 10, 796000), dt.datetime(2018, 11, 1, 20, 57, 10)),
        (dt.datetime(1970, 1, 1), dt.datetime(1970, 1, 1)),
        (None, None),
    ]


def test_two_plays_in_one_second_share_only_the_second(spark):
    df = spark.createDataFrame([(1541105830100,), (1541105830400,)], "ts bigint")
    counts = df.agg(F.count_distinct(epoch_ms("ts")), F.count_distinct(epoch_s("ts"))).first()
    assert tuple(counts) == (2, 1)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_timestamps_do_not_depend_on_the_session_zone(spark, zone):
    # 2018-11-04 05:30 UTC falls into the hour that New York repeats.
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(1541309400123,)], "ts bigint").select(
            epoch_ms("ts").alias("t"), to_epoch_ms(epoch_ms("ts")).alias("back"),
            F.hour(epoch_ms("ts")).alias("h"),
        )
        assert tuple(df.first()) == (dt.datetime(2018, 11, 4, 5, 30, 0, 123000), 1541309400123, 5)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_weekday_bases_on_a_sunday(spark):
    df = spark.sql("SELECT timestamp_ntz'2018-11-04 10:00:00' AS t")
    bases = [weekday("t", base) for base in ("mon0", "sun0", "sun1")]
    assert tuple(df.select(*bases).first()) == (6, 0, 1)
    with pytest.raises(ValueError):
        weekday("t", "sat0")


def test_time_parts(spark):
    df = spark.sql("SELECT timestamp_ntz'2018-11-04 10:30:00' AS start_time")
    number = time_parts(df, base="sun0").first()
    assert tuple(number)[1:] == (10, 4, 44, 11, 2018, 0)
    text = time_parts(df, base="sun0", as_text=True).first()
    assert (text["month"], text["weekday"], text["year"]) == ("11", "0", 2018)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(0, 4_000_000_000_000), min_size=1, max_size=20))
def test_epoch_round_trip(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "ts bigint")
    got = df.select(to_epoch_ms(epoch_ms("ts")).alias("v")).collect()
    assert [r["v"] for r in got] == values


def test_keys_and_null(spark):
    df = spark.sql("SELECT 7 AS a, CAST(NULL AS STRING) AS n, 'b' AS b")
    got = df.select(
        md5_key("a", "b"), md5_key("a", "n"), concat("a", "b"), concat("a", "n"),
        sha2_key("a", "n", "b"), sha2_key("a", "b"),
        sha2_key("a", "n", "b", null_safe=True), sha2_key("a", "b", null_safe=True),
        hash_key("a", "b").isNotNull(),
    ).first()
    assert got[0] == hashlib.md5(b"7b").hexdigest()
    assert got[1] is None and got[2] == "7b" and got[3] is None
    assert got[4] == got[5] == hashlib.sha256(b"7||b").hexdigest()
    assert got[6] != got[7]
    assert got[8]


def test_try_cast(spark):
    df = spark.createDataFrame([("",), ("abc",), ("12.5",), (None,)], "t string")
    assert [r[0] for r in df.select(try_cast("t", "double")).collect()] == [None, None, 12.5, None]


def test_drop_fraction(spark):
    df = spark.createDataFrame([(246.30812,), (246.90812,), (-1.7,), (None,)], "d double")
    got = df.select(drop_fraction("d"), drop_fraction("d", "truncate")).collect()
    assert [tuple(None if v is None else int(v) for v in r) for r in got] == [
        (246, 246), (247, 246), (-2, -1), (None, None)]
    with pytest.raises(ValueError):
        drop_fraction("d", "up")
