"""The data-lake job: rebuilds all star tables as parquet folders from the raw files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starloom.plans import dimensions, facts
from starloom.schemas import PLAY_EVENTS, SONG_CATALOGUE
from starloom.sinks.files import write_parquet
from starloom.sources.files import read_json_checked

# Folder of each source and result, and the columns its folders are split by.
EVENT_FOLDER = "log_data"
SONG_FOLDER = "song_data"
STAGING_FOLDER = "_staging/plays"
REJECTS_FOLDER = "_rejects"
SORT_KEYS = {"songs_table": ("artist_id",), "songplays_table": ("start_time",)}
PARTITIONS = {
    "users_table": (),
    "songs_table": ("year", "artist_id"),
    "artists_table": (),
    "time_table": ("year", "month"),
    "songplays_table": ("year", "month"),
}


def star_frames(events: DataFrame, catalogue: DataFrame, **options) -> dict[str, DataFrame]:
    """Every star table as a frame; `options` go to the fact."""
    return {
        "users_table": dimensions.users(events),
        "songs_table": dimensions.songs(catalogue),
        "artists_table": dimensions.artists(catalogue),
        "time_table": dimensions.time(events),
        "songplays_table": facts.songplays(events, catalogue, **options),
    }


def run(
    spark: SparkSession,
    input_folder: str,
    output_folder: str,
    partitions: dict[str, tuple[str, ...]] | None = None,
    **options,
) -> None:
    """Reads `log_data` and `song_data` under the input folder, writes the five tables,
    and lines that do not fit their schema to `_rejects`.

    A folder per artist makes as many folders as there are artists. For a large catalogue
    pass `partitions={"songs_table": ("year",)}`: the files are sorted by artist anyway.
    """
    layout = {**PARTITIONS, **(partitions or {})}
    # Three tables come from the plays. They are kept as parquet, so the text is parsed once
    # and each table reads only its columns; a lost executor loses none of it.
    staged = f"{output_folder}/{STAGING_FOLDER}"
    events, bad_events = read_json_checked(spark, f"{input_folder}/{EVENT_FOLDER}", PLAY_EVENTS)
    write_parquet(dimensions.plays(events), staged)
    plays = spark.read.schema(PLAY_EVENTS).parquet(staged)
    # Read once, used by three tables; lost blocks are read from the files again.
    catalogue, bad_songs = read_json_checked(spark, f"{input_folder}/{SONG_FOLDER}", SONG_CATALOGUE)
    write_parquet(bad_events.unionByName(bad_songs), f"{output_folder}/{REJECTS_FOLDER}")
    catalogue = catalogue.cache()
    try:
        for name, rows in star_frames(plays, catalogue, **options).items():
            sort_by = [c for c in SORT_KEYS.get(name, ()) if c not in layout[name]]
            write_parquet(rows, f"{output_folder}/{name}", layout[name], sort_by)
    finally:
        catalogue.unpersist()
