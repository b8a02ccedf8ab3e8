import datetime as dt

import pytest
from core_helpers import rows
from pyspark.sql import functions as F

from starling import plans as P
from starling import schemas
from starling.functions import epoch_ms
from starling.operators import conform, duplicate_keys, max_length, not_null, null_counts
from starling.plans.jobs import TABLES
from starling.sinks import drop_table
from starling.sources import read_table


def test_null_counts_and_split(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    assert tuple(null_counts(df, ["a", "b"]).first()) == (1, 2)
    good, rejects = not_null(df, ["a", "b"])
    assert rows(good) == [(3, "x")] and rejects.count() == 2


def test_duplicate_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "c"), (None, "c")], "k int, v string")
    assert rows(duplicate_keys(df, ["k", "v"])) == [(None, "c", 2), (1, "a", 2)]
    assert rows(duplicate_keys(df, ["k", "v"], nulls_distinct=True)) == [(1, "a", 2)]


def test_conform(spark):
    df = spark.createDataFrame([("1", "x"), ("", "1.5"), (None, None), ("7", "2.5")], "a string, b string")
    typed, rejects = conform(df, schemas._struct("a int, b double"))
    assert rows(typed) == [(None, None), (7, 2.5)]
    assert rows(rejects) == [("", "1.5", ["a"]), ("1", "x", ["b"])]


def test_max_length(spark):
    df = spark.createDataFrame([("F", "ab"), ("FM", "ab"), (None, "abcd")], "gender string, t string")
    assert rows(max_length(df, {"gender": 1, "t": 3})) == [(None, "abcd"), ("FM", "ab")]


@pytest.fixture(scope="module")
def star(spark):
    base = 1541105830796
    hour = 3_600_000
    plays = [(base, 1, "paid", "A1", "x"), (base + hour, 1, "paid", "A1", "x"),
             (base + hour + 5, 2, "paid", "A2", "y"), (base + 2 * hour, 3, "free", "A1", "x"),
             (base + 31 * 24 * hour, 1, "paid", None, "z")]
    fact = spark.createDataFrame(plays, "ts bigint, user_id int, level string, artist_id string, location string")
    fact = fact.withColumn("start_time", epoch_ms("ts"))
    events = fact.selectExpr("ts", "'NextSong' AS page")
    artists = spark.createDataFrame([("A1", "Elena"), ("A2", "Twins")], "artist_id string, name string")
    return fact, P.build_time(events), artists


def test_reports(star):
    fact, time, artists = star
    assert [tuple(r) for r in P.paid_plays_by_month(fact, time).collect()] == [(11, 3), (12, 1)]
    assert [tuple(r) for r in P.paid_users_by_month(fact, time).collect()] == [(11, 2), (12, 1)]
    assert rows(P.paid_users_by_hour(fact, time)) == [(20, 1), (21, 2)]
    assert [tuple(r) for r in P.top_locations(fact, 2).collect()] == [("x", 3), ("y", 1)]
    assert [tuple(r) for r in P.top_artists(fact, artists).collect()] == [("Elena", 3), ("Twins", 1)]


def test_reports_multiply_over_repeated_dimension_rows(star):
    """Counting per key before the join gives what joining first would give."""
    fact, time, artists = star
    twice = artists.unionByName(artists.where("artist_id = 'A1'"))
    joined = fact.join(twice, "artist_id").groupBy("name").count()
    assert rows(P.top_artists(fact, twice)) == rows(joined)
    assert [tuple(r) for r in P.paid_plays_by_month(fact, time.unionByName(time)).collect()] == [
        (11, 6), (12, 2)]


def test_play_detail_has_distinct_column_names(spark, star):
    fact, _, _ = star
    fact = fact.withColumn("song_id", F.lit("S1"))
    songs = spark.createDataFrame([("S1", "T", "A9", 2000, 1.5)], schemas.SONGS)
    detail = P.play_detail(fact, songs, 2, ["ts"])
    assert detail.count() == 2 and len(set(detail.columns)) == len(detail.columns)
    assert detail.first()["song_artist_id"] == "A9"
    assert P.resolved_plays(fact).count() == 4
    assert P.resolved_plays(fact, 3).count() == 3


@pytest.fixture(scope="module")
def csv_events(spark):
    values = [
        ("Oak Choir", "Nils", "M", 4, "Berg", "301.25", "free", "L", "7001", "Night Train (Long Cut)", "501"),
        ("Red Kites", "Mara", "F", 0, "Quist", "222.5", "free", "L", "7002", "Over the Weir", "502"),
        ("Tin Lanterns", "Mara", "F", 1, "Quist", "310.0", "free", "L", "7002", "Harbour 1", "502"),
        ("Tin Lanterns", "Mara", "F", 1, "Quist", "310.0", "free", "L", "7002", "Harbour 2", "502"),
        ("Glass Otters", "Ida", "F", 31, "Falk", "180.75", "paid", "L", "7003", "Two Rivers", "503"),
        (None, "Ida", "F", 32, "Falk", None, "paid", "L", "7003", None, "503"),
        ("", "Ida", "F", 33, "Falk", None, "paid", "L", "7003", "x", "503"),
    ]
    names = ("artist string, firstName string, gender string, itemInSession int, lastName string, "
             "length string, level string, location string, sessionId string, song string, userId string")
    return spark.createDataFrame(values, names)


def test_serving_tables_answer_their_questions(spark, csv_events, tmp_path):
    assert P.preprocess_events(csv_events).count() == 5
    sessions = P.build_song_session_history(csv_events)
    assert [tuple(r) for r in P.session_item(sessions, 7001, 4).collect()] == [
        ("Oak Choir", "Night Train (Long Cut)", 301.25)]
    users = P.build_user_artist_history(csv_events)
    history = P.user_session_history(users, 502, 7002)
    assert [tuple(r) for r in history.collect()] == [
        (0, "Red Kites", "Over the Weir", "Mara", "Quist"),
        (1, "Tin Lanterns", "Harbour 2", "Mara", "Quist")]
    songs = P.save_serving(P.build_user_song_history(csv_events), "user_song_history", "ush", 4,
                           location=str(tmp_path / "ush"))
    assert rows(P.song_listeners(songs, "Two Rivers")) == [(503, "Ida", "Falk")]
    drop_table(spark, "ush")


def _write_inputs(spark, tmp_path):
    events = spark.createDataFrame(
        [("Elena", "F", 0, "L1", 269.58322, "free", "Here", "NextSong", 10, "Setanta", 1541105830796, "1"),
         (None, "F", 1, "L1", None, "free", "Here", "Home", 10, None, 1541105930796, "1"),
         ("Nobody", "M", 0, "L2", 1.0, "paid", "There", "NextSong", 11, "Nothing", 1541205830796, "2")],
        "artist string, gender string, itemInSession int, lastName string, length double, level string, "
        "location string, page string, sessionId int, song string, ts bigint, userId string")
    songs = spark.createDataFrame(
        [("S1", "Setanta", "A1", "Elena", 269.58322, 0, "", None)],
        "song_id string, title string, artist_id string, artist_name string, duration double, year int, "
        "artist_location string, artist_latitude double")
    events.write.json(str(tmp_path / "events"))
    songs.write.json(str(tmp_path / "songs"))


@pytest.mark.parametrize("variant, expected", [
    ("lake", [1, 2, 1, 1, 2]), ("warehouse", [1, 3, 1, 1, 2]), ("scheduled", [2, 2, 1, 1, 2]),
    ("relational", [2, 2, 1, 1, 2]),
])
def test_whole_job(spark, tmp_path, variant, expected):
    _write_inputs(spark, tmp_path)
    cfg = P.JobConfig(str(tmp_path / "events"), str(tmp_path / "songs"), str(tmp_path / "t"), variant)
    report = P.run_job(spark, cfg)
    assert [r["passed"] for r in report.collect()] == [True] * (10 if variant == "relational" else 5)

    def sizes():
        return [read_table(spark, cfg.root, name).count() for name in TABLES]

    assert sizes() == expected
    schema = {f.name for f in read_table(spark, cfg.root, "songplays").schema}
    assert {f.name for f in schemas.SONGPLAYS} <= schema
    P.run_job(spark, cfg, stage=False)
    again = {"lake": expected, "warehouse": expected, "scheduled": [4, 2, 1, 1, 4],
             "relational": [3, 2, 1, 1, 2]}[variant]
    assert sizes() == again


@pytest.mark.parametrize("variant", ["lake", "warehouse", "scheduled", "relational"])
def test_job_for_one_day(spark, tmp_path, variant):
    _write_inputs(spark, tmp_path)
    cfg = P.JobConfig(str(tmp_path / "events"), str(tmp_path / "songs"), str(tmp_path / "t"),
                      variant, date="2018-11-01")
    P.run_job(spark, cfg)
    fact = read_table(spark, cfg.root, "songplays")
    expected = {
        "relational": 1541105830796, "lake": dt.datetime(2018, 11, 1, 20, 57, 10, 796_000),
    }.get(variant, dt.datetime(2018, 11, 1, 20, 57, 10))
    assert rows(fact, "start_time") == [(expected,)]


@pytest.mark.parametrize(
    "variant, by_path", [("warehouse", False), ("scheduled", True), ("relational", False)])
def test_recurring_run_takes_new_files_only(spark, tmp_path, variant, by_path):
    _write_inputs(spark, tmp_path)
    paths = tuple(f"$.{f.name}" for f in schemas.STAGED_EVENTS) if by_path else None
    cfg = P.JobConfig(str(tmp_path / "events"), str(tmp_path / "songs"), str(tmp_path / "t"),
                      variant, paths)
    checkpoint = str(tmp_path / "checkpoint")

    def sizes():
        P.run_new_files(spark, cfg, checkpoint, max_files=1)
        return [read_table(spark, cfg.root, name).count() for name in TABLES]

    first = sizes()
    assert first == ([1, 3, 1, 1, 2] if variant == "warehouse" else [2, 2, 1, 1, 2])
    assert sizes() == first
    (tmp_path / "events" / "more.json").write_text(
        '{"artist":"Elena","song":"Setanta","length":269.58322,"page":"NextSong","userId":"3",'
        '"sessionId":12,"itemInSession":0,"ts":1541305830796,"level":"free"}\n')
    assert sizes() == [n + (k in (0, 1, 4)) for k, n in enumerate(first)]


def test_recurring_run_resumes_a_batch_that_failed_half_way(spark, tmp_path, monkeypatch):
    from starling.plans import jobs
    _write_inputs(spark, tmp_path)
    cfg = P.JobConfig(str(tmp_path / "events"), str(tmp_path / "songs"), str(tmp_path / "t"),
                      "scheduled")

    def broken(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(jobs, "build_users", broken)
        with pytest.raises(Exception, match="lost"):
            P.run_new_files(spark, cfg, str(tmp_path / "checkpoint"))
    assert [read_table(spark, cfg.root, name).count() for name in TABLES] == [0] * 5
    P.run_new_files(spark, cfg, str(tmp_path / "checkpoint"))
    assert [read_table(spark, cfg.root, name).count() for name in TABLES] == [2, 2, 1, 1, 2]


def test_only_the_stored_plays_of_the_time_in_question_are_read(spark, tmp_path):
    from starling.plans import jobs
    from starling.sinks import append
    cfg = P.JobConfig("e", "s", str(tmp_path), "relational")
    for day in range(3):
        plays = [(day * 10 + i, day * 86_400_000 + i) for i in range(5)]
        append(spark.createDataFrame(plays, "songplay_id bigint, start_time bigint"), cfg.root, "songplays")
    batch = spark.createDataFrame([(86_400_001,), (86_400_003,)], "ts bigint")
    stored = jobs._stored_plays(spark, cfg, batch)
    assert rows(stored, "start_time") == [(86_400_001,), (86_400_002,), (86_400_003,)]
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(start_time,86400001)" in plan
    assert jobs._next_id(spark, cfg) == 25
    assert jobs._stored_plays(spark, cfg, batch.limit(0)).count() == 0


def test_lake_has_no_recurring_form(spark, tmp_path):
    with pytest.raises(ValueError):
        P.run_new_files(spark, P.JobConfig("e", "s", str(tmp_path)), str(tmp_path / "c"))


def test_failing_check_leaves_the_tables_as_they_were(spark, tmp_path):
    from starling.operators import CheckFailed
    _write_inputs(spark, tmp_path)
    cfg = P.JobConfig(str(tmp_path / "events"), str(tmp_path / "songs"), str(tmp_path / "t"), "scheduled")
    few = [{"query": "SELECT count(1) < 3 FROM songplays", "expected_result": True}]
    P.run_job(spark, cfg, few)
    before = {name: rows(read_table(spark, cfg.root, name)) for name in TABLES}
    with pytest.raises(CheckFailed):
        P.run_job(spark, cfg, few)
    assert before == {name: rows(read_table(spark, cfg.root, name)) for name in TABLES}


def test_logged_out_event_does_not_stop_users(spark, tmp_path):
    """An event without a user goes to the rejects, and later users still come in."""
    events = tmp_path / "events"
    events.mkdir()
    (tmp_path / "songs").mkdir()
    (tmp_path / "songs" / "s.json").write_text("")
    cfg = P.JobConfig(str(events), str(tmp_path / "songs"), str(tmp_path / "t"), "warehouse")

    def deliver(name, *users):
        (events / f"{name}.json").write_text("".join(
            '{"page":"NextSong","userId":"%s","sessionId":1,"ts":1541105830796}\n' % u for u in users))
        P.run_new_files(spark, cfg, str(tmp_path / "checkpoint"))
        return rows(read_table(spark, cfg.root, "users"), "user_id")

    assert deliver("a", "1", "") == [(1,)]
    assert deliver("b", "2", "") == [(1,), (2,)]
    assert read_table(spark, cfg.root, "users_rejects").count() == 2


@pytest.mark.parametrize("max_files", [None, 1])
def test_batch_size_does_not_change_users(spark, tmp_path, max_files):
    events = tmp_path / "events"
    events.mkdir()
    (tmp_path / "songs").mkdir()
    (tmp_path / "songs" / "s.json").write_text("")
    for i in range(3):
        (events / f"{i}.json").write_text('{"page":"NextSong","userId":"1","sessionId":%d,"ts":%d}\n' % (i, i))
    cfg = P.JobConfig(str(events), str(tmp_path / "songs"), str(tmp_path / "t"), "warehouse")
    P.run_new_files(spark, cfg, str(tmp_path / "checkpoint"), max_files=max_files)
    assert read_table(spark, cfg.root, "users").count() == 3
