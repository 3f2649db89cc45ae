from __future__ import annotations

import gzip
import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from starloom.session import build_session  # noqa: E402

SUNDAY = 1543147200123  # 2018-11-25 12:00:00.123
MONDAY = 1543233600000  # 2018-11-26 12:00:00
NEW_YEARS_EVE = 1546300799999  # 2018-12-31 23:59:59.999


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[4]",
        settings={
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.warehouse.dir": str(folder / "warehouse"),
            "spark.checkpoint.dir": str(folder / "shared"),
            "spark.driver.memory": "4g",
            "spark.sql.maxMetadataStringLength": "10000",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def settings(spark):
    """Sets session settings for one test."""
    before = {}

    def change(**values):
        for key, value in values.items():
            key = key.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def event(user, ts, song=None, artist=None, length=None, level="free", **more):
    return {
        "artist": artist,
        "auth": "Logged In" if user else "Logged Out",
        "firstName": f"First{user}" if user else None,
        "gender": "F" if user else None,
        "itemInSession": 0,
        "lastName": f"Last{user}" if user else None,
        "length": length,
        "level": level,
        "location": "Springfield",
        "method": "PUT",
        "page": "NextSong",
        "registration": 1540000000000.0,
        "sessionId": 1,
        "song": song,
        "status": 200,
        "ts": ts,
        "userAgent": "agent",
        "userId": user,
        **more,
    }


def song(song_id, title, artist_id, name, duration, year, location="", latitude=None):
    return {
        "num_songs": 1,
        "song_id": song_id,
        "title": title,
        "artist_id": artist_id,
        "artist_name": name,
        "artist_location": location,
        "artist_latitude": latitude,
        "artist_longitude": None if latitude is None else 2.5,
        "duration": duration,
        "year": year,
    }


WRONG_ARTIST = event("2", MONDAY, "Blue", "Zed", 200.1234, "paid", sessionId=2)

NOVEMBER = [
    event("1", SUNDAY, "Blue", "Ann", 200.1234, "free"),
    # the same session and second, a length that differs past the third decimal
    event("1", SUNDAY + 500, "Blue", "Ann", 200.12341, "paid", itemInSession=1),
    WRONG_ARTIST,
    WRONG_ARTIST,
    event("2", MONDAY + 60000, "Blue", "Ann", 199.0, "free", sessionId=2, itemInSession=1),
    event("", MONDAY + 1000, page="Home"),
    event("", MONDAY + 2000, "Green", "Ann", 180.0),
    event("3", MONDAY + 3000, page="Home", sessionId=3),
]
DECEMBER = [event("1", NEW_YEARS_EVE, "Green", "Ann", 180.0, "paid", sessionId=4)]

SONGS = [
    song("SO1", "Blue", "AR1", "Ann", 200.1234, 1999, "Paris", 48.5),
    song("SO1", "Blue", "AR1", "Ann", 200.1234, 1999, "Paris", 48.5),
    song("SO2", "Green", "AR1", "Ann", 180.0, 2003, "Lyon", 45.5),
    song("SO3", "Blue", "AR2", "Bob", 210.5, 0),
    song("SO4", "Blue", "AR1", "Ann", 250.0, 1999, "Paris", 48.5),
]


def write_lines(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    opened = gzip.open(path, "wt") if path.suffix == ".gz" else open(path, "w")
    with opened as file:
        file.write("\n".join(lines))
    return str(path)


@pytest.fixture
def raw(tmp_path):
    """A folder with `log_data/yyyy/MM` and `song_data/A/B/C`, one bad line included."""
    base = tmp_path / "raw"
    november = [json.dumps(e) for e in NOVEMBER] + ['{"artist": "Ann", "page": ']
    write_lines(base / "log_data/2018/11/2018-11-25-events.json", november)
    december = [json.dumps(e) for e in DECEMBER]
    write_lines(base / "log_data/2018/12/2018-12-31-events.json", december)
    for n, record in enumerate(SONGS):
        write_lines(base / f"song_data/A/B/{'ABC'[n % 3]}/TR{n}.json", [json.dumps(record)])
    return str(base)


def values(frame, *columns):
    """The rows as a sorted list of tuples."""
    chosen = frame.select(*columns) if columns else frame
    return sorted((tuple(row) for row in chosen.collect()), key=repr)


def plan_of(frame):
    """The physical plan as text, as `explain` prints it."""
    return frame._jdf.queryExecution().executedPlan().toString()
