"""Dimensions, the fact, the lake job, the scheduled load and the stream on the event fixture."""

from __future__ import annotations

import json
import pathlib
from datetime import date, datetime

import pytest
from conftest import DECEMBER, NOVEMBER, event, plan_of, song, values, write_lines
from pyspark.sql import Window
from pyspark.sql import functions as F

from starloom import schemas
from starloom.operators import merge, quality
from starloom.plans import dimensions, facts, lake, play_queries, reports, warehouse
from starloom.sinks import tables
from starloom.sources import files
from starloom.streaming import ingest


@pytest.fixture
def events(spark, raw):
    return files.read_json(spark, f"{raw}/log_data", schemas.PLAY_EVENTS, mode="PERMISSIVE")


@pytest.fixture
def catalogue(spark, raw):
    return files.read_json(spark, f"{raw}/song_data", schemas.SONG_CATALOGUE)


@pytest.fixture
def database(spark, tmp_path):
    name = f"star_{abs(hash(str(tmp_path))) % 10**9}"
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def test_users(events):
    assert values(dimensions.users(events), "user_id", "level") == [("1", "paid"), ("2", "free")]
    first = dimensions.users(events, keep="first")
    assert values(first, "user_id", "level") == [("1", "free"), ("2", "paid")]
    every = dimensions.users(events, keep="all")
    assert len(values(every)) == 4
    assert first.columns == schemas.USERS.names


def test_plays_need_a_user_and_a_time(spark):
    rows = [event("1", 5), event("", 6), event(None, 7), event("1", None), event("1", 8, page="Home")]
    lines = spark.createDataFrame([(json.dumps(row),) for row in rows], "value string")
    parsed = lines.select(F.from_json("value", schemas.PLAY_EVENTS).alias("r")).select("r.*")
    assert values(dimensions.plays(parsed), "userId", "ts") == [("1", 5)]


def test_first_seen_is_last_over_a_descending_frame(events):
    """The aggregate equals the windows it stands for."""
    plays = dimensions.plays(events)
    numbered = Window.partitionBy("userId").orderBy("ts")
    descending = (
        Window.partitionBy("userId")
        .orderBy(F.desc("ts"))
        .rangeBetween(Window.unboundedPreceding, Window.currentRow)
    )
    windowed = (
        plays.withColumn("n", F.row_number().over(numbered))
        .withColumn("level", F.last("level").over(descending))
        .where("n = 1")
    )
    first = dimensions.users(events, keep="first")
    assert values(first, "user_id", "level") == values(windowed, "userId", "level")


def test_songs_and_artists(catalogue):
    assert values(dimensions.songs(catalogue), "song_id", "title", "year") == [
        ("SO1", "Blue", 1999),
        ("SO2", "Green", 2003),
        ("SO3", "Blue", 0),
        ("SO4", "Blue", 1999),
    ]
    assert values(dimensions.artists(catalogue)) == [
        ("AR1", "Ann", "Lyon", 45.5, 2.5),
        ("AR2", "Bob", "", None, None),
    ]


def test_time(events):
    rows = dimensions.time(events).orderBy("start_time").collect()
    assert len(rows) == 5
    sunday, eve = rows[0], rows[-1]
    assert sunday.start_time == datetime(2018, 11, 25, 12, 0, 0, 123000)
    assert (sunday.hour, sunday.day, sunday.week, sunday.weekday) == (12, 25, 47, 6)
    assert (eve.hour, eve.day, eve.week, eve.weekday, eve.year, eve.month) == (
        23,
        31,
        1,
        0,
        2018,
        12,
    )
    assert dimensions.time(events, only_plays=False).count() == 8


@pytest.mark.parametrize(
    "match, how, expected",
    [
        ("title_artist_length", "left", [None, None, "SO1", "SO1", "SO2"]),
        ("title_artist_length", "inner", ["SO1", "SO1", "SO2"]),
        ("title_artist", "inner", ["SO1", "SO1", "SO1", "SO2"]),
        ("title", "inner", ["SO1", "SO1", "SO1", "SO1", "SO2"]),
    ],
)
@pytest.mark.parametrize("shuffled", [False, True])
def test_songplays(events, catalogue, match, how, expected, shuffled):
    plays = facts.songplays(events, catalogue, match, how, shuffled)
    assert plays.columns == schemas.SONGPLAYS.names
    assert plays.schema.simpleString() == schemas.SONGPLAYS.simpleString()
    rows = plays.collect()
    assert sorted(r.song_id or "" for r in rows) == sorted(e or "" for e in expected)
    assert len({r.songplay_id for r in rows}) == len(rows)


def test_songplay_key_repeats(events, catalogue):
    once = values(facts.songplays(events, catalogue), "songplay_id")
    again = values(facts.songplays(events.orderBy(F.desc("ts")), catalogue), "songplay_id")
    assert once == again


def test_lake(spark, raw, tmp_path):
    out = str(tmp_path / "lake")
    for _ in range(2):
        lake.run(spark, raw, out)
    songs = spark.read.parquet(f"{out}/songs_table")
    assert sorted(songs.columns) == sorted(schemas.SONGS.names)
    assert (tmp_path / "lake/songs_table/year=1999/artist_id=AR1").is_dir()
    assert (tmp_path / "lake/songplays_table/year=2018/month=12").is_dir()
    star = {name: spark.read.parquet(f"{out}/{name}_table") for name in ("users", "artists")}
    star |= {"songs": songs, "songplays": spark.read.parquet(f"{out}/songplays_table")}
    assert star["songplays"].count() == 5
    assert spark.read.parquet(f"{out}/time_table").count() == 5
    assert values(reports.who_heard_what(star)) == [
        ("Blue", "Ann", "First1 Last1"),
        ("Blue", "Ann", "First1 Last1"),
        ("Green", "Ann", "First1 Last1"),
    ]
    assert values(reports.most_prolific_years(star)) == [(1, "2003"), (2, "1999")]
    assert [tuple(r) for r in reports.longest_songs(star, 2).collect()] == [
        ("Ann", "Blue", 250.0),
        ("Bob", "Blue", 210.5),
    ]
    lake.run(spark, raw, out, partitions={"songs_table": ("year",)})
    assert spark.read.parquet(f"{out}/songs_table").count() == 4


def star_tables(spark, database):
    return {
        spec.name: values(tables.current(spark, f"{database}.{spec.name}"))
        for spec in schemas.STAR_TABLES
    }


def test_scheduled_load_is_repeatable(spark, raw, database):
    paths = (f"{raw}/log_data", f"{raw}/song_data", database)
    outcomes = warehouse.run(spark, *paths)
    assert len(outcomes) == 5 and all(o.success for o in outcomes)
    once = star_tables(spark, database)
    assert [len(once[n]) for n in ("users", "songs", "artists", "time", "songplays")] == [
        2,
        4,
        2,
        5,
        5,
    ]
    warehouse.run(spark, *paths)
    assert star_tables(spark, database) == once


def test_scheduled_load_keeps_rejected_lines(spark, raw, database):
    paths = (f"{raw}/log_data", f"{raw}/song_data", database)
    warehouse.run(spark, *paths)
    once = star_tables(spark, database)
    warehouse.run(spark, *paths, keep_rejects=True)
    assert star_tables(spark, database) == once
    rejected = spark.table(f"{database}.staging_events_rejects").collect()
    assert [r.line for r in rejected] == ['{"artist": "Ann", "page": ']
    assert spark.table(f"{database}.staging_events").count() == 9


def test_scheduled_load_by_month(spark, raw, database):
    """Two runs of a month each give what one run over both gives."""
    paths = (f"{raw}/log_data", f"{raw}/song_data", database)
    warehouse.run(spark, *paths, run_date=date(2018, 11, 1))
    users = f"{database}.users"
    assert values(spark.table(users), "user_id", "level") == [("1", "paid"), ("2", "free")]
    assert spark.table(f"{database}.songplays").count() == 4
    warehouse.run(spark, *paths, run_date=date(2018, 12, 1))
    by_month = star_tables(spark, database)
    spark.sql(f"DROP DATABASE {database} CASCADE")
    warehouse.run(spark, *paths)
    assert star_tables(spark, database) == by_month


def test_reprocessing_matches_plays_anew(spark, raw, database):
    """A song that comes later is found by plays loaded before, if they are reprocessed."""
    paths = (f"{raw}/log_data", f"{raw}/song_data", database)
    warehouse.run(spark, *paths)
    table = f"{database}.songplays"
    before = star_tables(spark, database)
    record = song("SO0", "Blue", "AR2", "Zed", 200.1234, 2020)
    write_lines(pathlib.Path(raw) / "song_data/Z/Z/Z/late.json", [json.dumps(record)])
    warehouse.run(spark, *paths)
    assert values(spark.table(table)) == before["songplays"]
    warehouse.run(spark, *paths, reprocess=True)
    after = star_tables(spark, database)
    assert len(after["songplays"]) == 5
    matched = tables.current(spark, table).where("user_id = '2'")
    assert values(matched, "song_id") == sorted([("SO0",), (None,)], key=repr)
    warehouse.run(spark, *paths, reprocess=True)
    assert star_tables(spark, database) == after


def test_scheduled_load_stops_on_failed_check(spark, raw, database, tmp_path):
    empty = tmp_path / "empty"
    write_lines(empty / "a.json", [json.dumps(NOVEMBER[5])])
    with pytest.raises(quality.QualityError, match="users has rows: 0 should be > 0"):
        warehouse.run(spark, str(empty), f"{raw}/song_data", database)


def test_constraints_find_violations(spark, raw, database):
    warehouse.run(spark, f"{raw}/log_data", f"{raw}/song_data", database)
    star = {spec.name: spark.table(f"{database}.{spec.name}") for spec in schemas.STAR_TABLES}
    star["users"] = star["users"].where("user_id = '1'")
    star["songs"] = star["songs"].union(star["songs"].where("song_id = 'SO1'"))
    found = warehouse.star_constraints(star).where("violations > 0")
    assert values(found) == [("songplays.user_id in users", 2), ("songs key unique", 1)]


def test_stream_takes_only_new_files(spark, raw, database, catalogue, tmp_path):
    """Two drops through the stream equal one batch run, also when a drop comes twice."""
    tables.create_tables(spark, schemas.STAR_TABLES, database)
    table = f"{database}.songplays"
    drops = tmp_path / "drops"
    sizes = []

    def merge(batch):
        sizes.append(batch.count())
        warehouse.append_songplays(batch, table)

    def take():
        query = ingest.stream_songplays(
            spark,
            str(drops),
            schemas.PLAY_EVENTS,
            lambda batch: facts.songplays(batch, catalogue),
            merge,
            name=f"plays_{database}",
        )
        query.awaitTermination()

    write_lines(drops / "2018/11/a.json", [json.dumps(e) for e in NOVEMBER])
    take()
    write_lines(drops / "2018/12/b.json", [json.dumps(e) for e in DECEMBER])
    take()
    take()
    assert sizes == [4, 1]
    events = files.read_json(spark, f"{raw}/log_data", schemas.PLAY_EVENTS, mode="PERMISSIVE")
    once = values(facts.songplays(events, catalogue))
    assert values(tables.current(spark, table)) == once
    # the same plays in another file, and one more in a month that has some
    late = event("2", DECEMBER[0]["ts"] - 5, "Blue", "Bob", 210.5, sessionId=9)
    write_lines(drops / "2018/12/c.json", [json.dumps(e) for e in [*NOVEMBER, late]])
    take()
    assert tables.current(spark, table).count() == 6
    assert values(spark.table(table).where("song_id = 'SO3'"), "user_id") == [("2",)]


def test_jobs_from_the_command_line(spark, raw, database, tmp_path):
    from starloom.__main__ import parse, run

    out = str(tmp_path / "out")
    run(spark, parse(["lake", raw, out, "--match", "title"]))
    assert spark.read.parquet(f"{out}/songplays_table").where("song_id = 'SO1'").count() == 4
    raw_paths = [f"{raw}/log_data", f"{raw}/song_data"]
    month = ["--run-date", "2018-11-25", "--database", database, "--keep-rejects"]
    run(spark, parse(["load", *raw_paths, *month]))
    assert tables.current(spark, f"{database}.songplays").count() == 4
    # The checkpoint goes to the shared folder; the stream adds what the load has not seen.
    for _ in range(2):
        run(spark, parse(["stream", raw_paths[0], "--database", database]))
        assert tables.current(spark, f"{database}.songplays").count() == 5
        assert spark.table(f"{database}.songplays_rejects").count() == 1


def test_loads_send_no_growing_table_through_the_driver(spark, raw, database, events, catalogue):
    """However small the tables are now: each of a load's many joins would broadcast one more."""
    tables.create_tables(spark, schemas.STAR_TABLES, database)
    star = {spec.name: spark.table(f"{database}.{spec.name}") for spec in schemas.STAR_TABLES}
    batch = facts.songplays(events, catalogue)
    of_tables = play_queries.play_events(
        {
            "events": spark.createDataFrame([], schemas.GIVEN_TABLES["events"]),
            "part": spark.createDataFrame([], schemas.GIVEN_TABLES["part"]),
        }
    )
    plans = [
        batch,
        of_tables,
        facts.catalogue_of(star["songs"], star["artists"]),
        merge.unseen(star["songplays"], batch, ["songplay_id"]),
        merge.without_keys(star["songplays"], batch, ["songplay_id"]),
        warehouse.star_constraints(star),
    ]
    for rows in plans:
        rows.collect()
        assert "Join" in plan_of(rows) and "Broadcast" not in plan_of(rows)
