"""The scheduled load: stage, merge the dimensions, merge the fact, check, all in catalog tables.

Running it again on the same files changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom import schemas
from starloom.functions import calendar
from starloom.operators import merge, quality
from starloom.plans import dimensions, facts
from starloom.sinks import tables
from starloom.sources.files import by_name, read_json, read_json_checked, run_date_path


def stage(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    table: str,
    run_date: date | None = None,
    keep_rejects: bool = True,
) -> None:
    """Clears a staging table and loads the files of the run's month, or all of them.

    Lines that do not fit the schema go to `<table>_rejects` with their file, which takes a second
    pass over the files. Without `keep_rejects` such a line stops the load.
    """
    folder = run_date_path(path, run_date)
    if keep_rejects:
        rows, rejected = read_json_checked(spark, folder, schema)
        tables.create_table_as(rejected, f"{table}_rejects")
    else:
        rows = read_json(spark, folder, schema)
    tables.load_table(by_name(rows, schema), table)


def merge_users(spark: SparkSession, events: DataFrame, table: str) -> None:
    tables.merge_into_parts(dimensions.user_rows(events), table, ["user_id"], dimensions.USER_ORDER)


def merge_artists(spark: SparkSession, catalogue: DataFrame, table: str) -> None:
    batch = dimensions.artist_rows(catalogue)
    tables.merge_into_parts(batch, table, ["artist_id"], dimensions.ARTIST_ORDER)


def merge_songs(spark: SparkSession, catalogue: DataFrame, table: str) -> None:
    batch = dimensions.song_rows(catalogue)
    stored = tables.current(spark, table)
    added = merge.new_rows(stored, batch, ["song_id"], dimensions.SONG_ORDER)
    tables.append_rows(added, table)


def months_of(rows: DataFrame) -> list[int]:
    """The months that rows fall in, as yyyyMM: a short list, one entry per calendar month."""
    months = rows.select((F.col("year") * 100 + F.col("month")).alias("yyyymm")).distinct()
    return [row.yyyymm for row in months.collect()]


def in_months(rows: DataFrame, months: list[int]) -> DataFrame:
    """Rows of those months, by plain conditions on the partition columns for each year, which a
    metastore can prune by: no other folder is read."""
    by_year: dict[int, list[int]] = {}
    for yyyymm in months:
        by_year.setdefault(yyyymm // 100, []).append(yyyymm % 100)
    wanted = [(F.col("year") == y) & F.col("month").isin(ms) for y, ms in sorted(by_year.items())]
    return rows.where(reduce(lambda a, b: a | b, wanted, F.lit(False)))


def merge_time(spark: SparkSession, events: DataFrame, table: str) -> None:
    played = calendar.ms_to_timestamp(F.col("ts"))
    parts = [F.year(played).alias("year"), F.month(played).alias("month")]
    months = months_of(dimensions.plays(events).select(*parts))
    stored = in_months(tables.current(spark, table), months)
    added = merge.unseen(stored, dimensions.time(events), ["start_time"])
    tables.append_partitions(added, table, ["year", "month"], ["start_time"])


@contextmanager
def written_batch(batch: DataFrame, table: str) -> Iterator[tuple[DataFrame, list[int]]]:
    """The batch written out, and its months."""
    with tables.written_out(batch, table) as written:
        yield written, months_of(written)


def append_songplays(batch: DataFrame, table: str) -> list[int]:
    """Adds the plays that the table does not have; a play's key is the same on every run.

    Reads the keys of the batch's months and writes the new rows, nothing else. Gives the
    months.
    """
    with written_batch(batch, table) as (written, months):
        if months:
            stored = in_months(tables.current(batch.sparkSession, table), months)
            added = merge.unseen(stored, written, ["songplay_id"])
            tables.append_partitions(added, table, ["year", "month"], ["start_time"])
    return months


def replace_songplays(batch: DataFrame, table: str) -> list[int]:
    """Deletes the plays that come again, then adds the batch: what a play matched may change.

    The batch's months are rewritten; other months are neither read nor written. Gives the
    months.
    """
    with written_batch(batch, table) as (written, months):
        if months:
            stored = in_months(tables.current(batch.sparkSession, table), months)
            kept = merge.without_keys(stored, written, ["songplay_id"])
            merged = kept.unionByName(written)
            tables.replace_partitions(merged, table, ["year", "month"], ["start_time"])
    return months


# The shipped checks, by table.
def star_rules(name=lambda table: table) -> list[quality.Rule]:
    return [
        quality.has_rows(name("users")),
        quality.has_rows(name("songs")),
        quality.has_rows(name("artists")),
        quality.has_rows(name("time")),
        quality.never_null(name("songs"), "song_id"),
    ]


def star_constraints(t: dict[str, DataFrame]) -> DataFrame:
    """Keys that repeat, required values that are missing, and references to nothing."""
    repeated = [
        (f"{spec.name} key unique", quality.repeated_keys(t[spec.name], *spec.keys))
        for spec in schemas.STAR_TABLES
    ]
    required = [
        (f"songplays.{column} not null", quality.missing_values(t["songplays"], column))
        for column in ("songplay_id", "start_time", "user_id")
    ]
    references = [
        ("start_time", "time", "start_time"),
        ("user_id", "users", "user_id"),
        ("song_id", "songs", "song_id"),
        ("artist_id", "artists", "artist_id"),
    ]
    known = [
        (
            f"songplays.{column} in {table}",
            quality.orphans(t["songplays"], column, t[table], key),
        )
        for column, table, key in references
    ]
    return quality.constraints(repeated + required + known)


def run(
    spark: SparkSession,
    events_path: str,
    songs_path: str,
    database: str = "star",
    run_date: date | None = None,
    match: str = "title_artist_length",
    reprocess: bool = False,
    keep_rejects: bool = True,
) -> list:
    """One run of the load. Returns the results of the checks; raises if one fails.

    Plays that the fact has are left as they are; with `reprocess` they are matched anew.
    """

    def name(table: str) -> str:
        return tables.qualified(table, database)

    tables.create_tables(spark, schemas.STAGING_TABLES + schemas.STAR_TABLES, database)
    songs, plays = schemas.SONG_CATALOGUE, schemas.PLAY_EVENTS
    stage(spark, events_path, plays, name("staging_events"), run_date, keep_rejects)
    stage(spark, songs_path, songs, name("staging_songs"), keep_rejects=keep_rejects)
    events, catalogue = spark.table(name("staging_events")), spark.table(name("staging_songs"))

    # The dimensions do not depend on each other, so their jobs run side by side. They come
    # before the fact, whose song lookup and foreign keys refer to them.
    with ThreadPoolExecutor(4) as pool:
        merges = [
            pool.submit(merge_users, spark, events, name("users")),
            pool.submit(merge_artists, spark, catalogue, name("artists")),
            pool.submit(merge_songs, spark, catalogue, name("songs")),
            pool.submit(merge_time, spark, events, name("time")),
        ]
        for done in merges:
            done.result()

    lookup = facts.catalogue_of(spark.table(name("songs")), spark.table(name("artists")))
    batch = facts.songplays(events, lookup, match)
    months = (replace_songplays if reprocess else append_songplays)(batch, name("songplays"))

    outcomes = quality.require(quality.run_rules(spark, star_rules(name)))
    # A play's key holds its time, so a repeated one falls in the same month: checking the
    # months of this run is enough, however long the history is.
    star = {spec.name: tables.current(spark, name(spec.name)) for spec in schemas.STAR_TABLES}
    star |= {table: in_months(star[table], months) for table in ("time", "songplays")}
    broken = star_constraints(star).where("violations > 0").collect()
    if broken:
        raise quality.QualityError("; ".join(f"{b.test_name}: {b.violations}" for b in broken))
    return outcomes
