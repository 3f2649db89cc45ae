"""Runs a job: python -m starloom lake|load|stream ..."""

from __future__ import annotations

import argparse
from datetime import date

from starloom import schemas
from starloom.plans import facts, lake, warehouse
from starloom.session import build_session
from starloom.sinks import tables
from starloom.streaming import ingest


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="starloom")
    parser.add_argument("--master", help="Spark master; as submitted if left out")
    jobs = parser.add_subparsers(dest="job", required=True)

    rebuild = jobs.add_parser("lake", help="rebuild all tables as parquet folders")
    rebuild.add_argument("input", help="folder that holds log_data and song_data")
    rebuild.add_argument("output")

    load = jobs.add_parser("load", help="merge into catalog tables, then check them")
    load.add_argument("events")
    load.add_argument("songs")
    load.add_argument("--run-date", type=date.fromisoformat, help="read only this day's month")
    load.add_argument("--reprocess", action="store_true", help="match stored plays anew")
    load.add_argument(
        "--keep-rejects", action=argparse.BooleanOptionalAction, default=True, help="store lines that do not parse"
    )

    stream = jobs.add_parser("stream", help="merge the plays of files that are new, then stop")
    stream.add_argument("events")
    stream.add_argument("--checkpoint", help="in the cluster's shared folder if left out")

    for job in (rebuild, load, stream):
        job.add_argument("--match", choices=facts.MATCHES, default="title_artist_length")
    for job in (load, stream):
        job.add_argument("--database", default="star")
    return parser.parse_args(arguments)


def run(spark, chosen: argparse.Namespace) -> None:
    if chosen.job == "lake":
        lake.run(spark, chosen.input, chosen.output, match=chosen.match)
    elif chosen.job == "load":
        warehouse.run(
            spark,
            chosen.events,
            chosen.songs,
            chosen.database,
            chosen.run_date,
            chosen.match,
            chosen.reprocess,
            chosen.keep_rejects,
        )
    else:
        tables.create_tables(spark, schemas.STAR_TABLES, chosen.database)
        songs, artists, songplays = (
            tables.qualified(name, chosen.database) for name in ("songs", "artists", "songplays")
        )

        def to_plays(batch):
            lookup = facts.catalogue_of(
                tables.current(spark, songs), tables.current(spark, artists)
            )
            return facts.songplays(batch, lookup, chosen.match)

        ingest.stream_songplays(
            spark,
            chosen.events,
            schemas.PLAY_EVENTS,
            to_plays,
            lambda plays: warehouse.append_songplays(plays, songplays),
            name=f"{chosen.database}_songplays",
            checkpoint=chosen.checkpoint,
            rejects=lambda lines: lines.write.mode("append").saveAsTable(f"{songplays}_rejects"),
        ).awaitTermination()


if __name__ == "__main__":
    options = parse()
    run(build_session(f"starloom {options.job}", options.master), options)
