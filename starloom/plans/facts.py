"""The songplay fact: plays with the song and artist they match, and a key that repeats."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions import calendar, keys
from starloom.operators import joins, rows
from starloom.plans.dimensions import plays

# Event column to catalogue column, for each way to match a play to a song.
MATCHES = {
    "title": {"song": "title"},
    "title_artist": {"song": "title", "artist": "artist_name"},
    "title_artist_length": {
        "song": "title",
        "artist": "artist_name",
        "length": "duration",
    },
}

LENGTH_DECIMALS = 3

# What makes a play: two plays of a session in the same second differ in time or position.
PLAY_KEY = ["sessionId", "userId", "ts", "itemInSession"]


def catalogue_of(songs: DataFrame, artists: DataFrame) -> DataFrame:
    """The lookup side from the stored dimensions: each song with the name of its artist. Both grow,
    so neither goes through the driver."""
    named = artists.select("artist_id", F.col("name").alias("artist_name"))
    return songs.join(named.hint("merge"), "artist_id").select(
        "song_id", "artist_id", "title", "artist_name", "duration"
    )


def songplays(
    events: DataFrame,
    catalogue: DataFrame,
    match: str = "title_artist_length",
    how: str = "left",
    shuffled: bool = True,
) -> DataFrame:
    """One row per play.

    `match` names the columns that have to agree, `how` is "left" to keep plays without a
    song or "inner" to drop them. Of several matching songs the one with the lowest id is
    taken. Lengths agree if they are equal to three decimals. The key is a hash of session,
    user, time and position in the session, so a repeated event is one play. The catalogue grows and
    a stream joins it in every batch, so the join is shuffled unless `shuffled` is false.
    """
    round_to = {"length": LENGTH_DECIMALS} if "length" in MATCHES[match] else {}
    attributes = ["song", "artist", "length", "level", "location", "userAgent"]
    played = plays(events).select(*PLAY_KEY, *attributes)
    once = rows.earliest_per_key(played, PLAY_KEY, attributes)
    matched = joins.match_catalogue(
        once,
        catalogue,
        on=MATCHES[match],
        take=["song_id", "artist_id"],
        how=how,
        round_to=round_to,
        one_match="song_id",
        shuffled=shuffled,
    )
    start_time = calendar.ms_to_timestamp(F.col("ts"))
    return matched.select(
        keys.hash_key(*PLAY_KEY).alias("songplay_id"),
        start_time.alias("start_time"),
        F.col("userId").alias("user_id"),
        "level",
        "song_id",
        "artist_id",
        F.col("sessionId").alias("session_id"),
        "location",
        F.col("userAgent").alias("user_agent"),
        F.year(start_time).alias("year"),
        F.month(start_time).alias("month"),
    )
