"""User, song, artist and time dimensions from play events and the song catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions import calendar
from starloom.operators import rows

# The page of a play event, and source column to dimension column.
PLAY_PAGE = "NextSong"

USER_COLUMNS = {
    "userId": "user_id",
    "firstName": "first_name",
    "lastName": "last_name",
    "gender": "gender",
    "level": "level",
}

SONG_COLUMNS = {
    "song_id": "song_id",
    "title": "title",
    "artist_id": "artist_id",
    "duration": "duration",
    "year": "year",
}

ARTIST_COLUMNS = {
    "artist_id": "artist_id",
    "artist_name": "name",
    "artist_location": "location",
    "artist_latitude": "latitude",
    "artist_longitude": "longitude",
}

# What decides between several events of a user, and several records of a song or artist.
USER_ORDER = ["ts", "sessionId", "itemInSession"]
SONG_ORDER = ["artist_id", "title", "duration", "year"]
ARTIST_ORDER = ["year", "song_id", "name", "location"]


def plays(events: DataFrame) -> DataFrame:
    """Play events of known users at a known time."""
    return rows.with_keys(rows.where_value(events, "page", PLAY_PAGE), "userId", "ts")


def user_rows(events: DataFrame) -> DataFrame:
    """User attributes at each play, with the columns that put the plays in order."""
    return rows.renamed(plays(events), {**USER_COLUMNS, **{name: name for name in USER_ORDER}})


def users(events: DataFrame, keep: str = "latest") -> DataFrame:
    """Users, by what `keep` says: their "latest" attributes, the "first" ones, or "all" of them."""
    of_plays = user_rows(events)
    columns = list(USER_COLUMNS.values())
    if keep == "all":
        return of_plays.select(*columns).distinct()
    pick = {"latest": rows.latest_per_key, "first": rows.earliest_per_key}[keep]
    return pick(of_plays, ["user_id"], USER_ORDER).select(*columns)


def song_rows(catalogue: DataFrame) -> DataFrame:
    return rows.renamed(rows.with_keys(catalogue, "song_id"), SONG_COLUMNS)


def songs(catalogue: DataFrame) -> DataFrame:
    return rows.earliest_per_key(song_rows(catalogue), ["song_id"], SONG_ORDER)


def artist_rows(catalogue: DataFrame) -> DataFrame:
    known = rows.with_keys(catalogue, "artist_id")
    return rows.renamed(known, {**ARTIST_COLUMNS, "year": "year", "song_id": "song_id"})


def artists(catalogue: DataFrame) -> DataFrame:
    """Artists, as their most recent song describes them."""
    latest = rows.latest_per_key(artist_rows(catalogue), ["artist_id"], ARTIST_ORDER)
    return latest.select(*ARTIST_COLUMNS.values())


def time(events: DataFrame, only_plays: bool = True) -> DataFrame:
    """Distinct event times with their parts; of plays, or of all events."""
    chosen = plays(events) if only_plays else events.where(F.col("ts").isNotNull())
    moments = chosen.select("ts").distinct()
    stamped = moments.select(calendar.ms_to_timestamp(F.col("ts")).alias("start_time"))
    return with_time_parts(stamped)


def time_of_facts(songplays: DataFrame) -> DataFrame:
    """The time dimension from the fact's own start times."""
    return with_time_parts(songplays.select("start_time").distinct())


def with_time_parts(moments: DataFrame) -> DataFrame:
    return moments.select("start_time", *calendar.time_parts(F.col("start_time"))).select(
        "start_time", "hour", "day", "week", "weekday", "year", "month"
    )
