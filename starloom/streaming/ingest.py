"""Incremental load: a stream that takes each new file once and merges its plays into the fact."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from starloom.session import shared_folder
from starloom.sources.files import CORRUPT, JSON_FILES


def stream_json(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    files_per_batch: int = 1000,
    mode: str = "FAILFAST",
    glob: str = JSON_FILES,
) -> DataFrame:
    """New line-JSON files under a folder, in batches of a bounded number of files.

    A line that does not fit the schema stops the stream, so that none is lost unseen.
    """
    return (
        spark.readStream.schema(schema)
        .option("mode", mode)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(path)
    )


def _checkpoint(rows: DataFrame, name: str, checkpoint: str | None) -> str:
    return checkpoint or f"{shared_folder(rows.sparkSession)}/streams/{name}"


def stage_stream(
    rows: DataFrame, name: str, output: str, checkpoint: str | None = None
) -> StreamingQuery:
    """Appends what is there now to a parquet folder, then stops; every file is taken once."""
    return (
        rows.writeStream.queryName(name)
        .format("parquet")
        .option("path", output)
        .option("checkpointLocation", _checkpoint(rows, name, checkpoint))
        .trigger(availableNow=True)
        .start()
    )


def merge_stream(
    rows: DataFrame,
    name: str,
    merge: Callable[[DataFrame], None],
    checkpoint: str | None = None,
) -> StreamingQuery:
    """Runs `merge` on each batch of what is there now, then stops.

    The checkpoint remembers which files are done, so the next start takes only new ones. A
    batch that was cut short runs again; `merge` has to give the same table then, as the
    merges by key do. Without `checkpoint` it goes to the cluster's shared folder.
    """
    return (
        rows.writeStream.queryName(name)
        .foreachBatch(lambda batch, _: merge(batch))
        .option("checkpointLocation", _checkpoint(rows, name, checkpoint))
        .trigger(availableNow=True)
        .start()
    )


LEDGER = "_ledger"
_LEDGER_SCHEMA = "stream string, batch bigint, n_rows bigint"


def _committed(spark: SparkSession, output: str) -> DataFrame:
    return spark.read.schema(_LEDGER_SCHEMA).parquet(f"{output}/{LEDGER}")


def _enter(spark: SparkSession, output: str, *entries: tuple[str, int, int]) -> None:
    entered = spark.createDataFrame(list(entries), _LEDGER_SCHEMA)
    entered.coalesce(1).write.mode("append").parquet(f"{output}/{LEDGER}")


def append_once(
    rows: DataFrame,
    name: str,
    output: str,
    checkpoint: str | None = None,
    change: Callable[[DataFrame], DataFrame] = lambda batch: batch,
) -> StreamingQuery:
    """Appends what is there now to a folder, each batch exactly once, then stops.

    A batch goes to a folder of its own and then, with its number of rows, into a ledger beside it. A batch
    that comes again after it was entered is passed over; one that was cut short before replaces its
    own folder. So stored rows are never read or compared, and `read_once` shows a batch as a whole or
    not at all. Numbers of batches belong to a checkpoint: a new one needs a new name.
    """

    def take(batch: DataFrame, number: int) -> None:
        known = _committed(batch.sparkSession, output)
        if not known.where((F.col("stream") == name) & (F.col("batch") == number)).isEmpty():
            return
        seen = Observation()
        watched = change(batch).observe(seen, F.count(F.lit(1)).alias("n"))
        watched.write.mode("overwrite").parquet(f"{output}/stream={name}/batch={number}")
        _enter(batch.sparkSession, output, (name, number, seen.get["n"]))

    _enter(rows.sparkSession, output)  # so that there is a ledger before the first batch
    return (
        rows.writeStream.queryName(name)
        .foreachBatch(take)
        .option("checkpointLocation", _checkpoint(rows, name, checkpoint))
        .trigger(availableNow=True)
        .start()
    )


def read_once(spark: SparkSession, output: str, schema: T.StructType) -> DataFrame:
    """The rows of all batches that the ledger has, with their `stream` and `batch`."""
    stored = T.StructType([*schema.fields, T.StructField("stream", T.StringType()), T.StructField("batch", T.LongType())])
    done = _committed(spark, output).select("stream", "batch").distinct()
    if done.isEmpty():
        return spark.createDataFrame([], stored)
    rows = spark.read.schema(stored).option("basePath", output).parquet(f"{output}/stream=*")
    return rows.join(done, ["stream", "batch"], "left_semi").select(*stored.names)


def stream_songplays(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    to_plays: Callable[[DataFrame], DataFrame],
    merge: Callable[[DataFrame], None],
    name: str = "songplays",
    checkpoint: str | None = None,
    files_per_batch: int = 1000,
    rejects: Callable[[DataFrame], None] | None = None,
) -> StreamingQuery:
    """New event files to plays to the fact table.

    Lines that do not fit the schema go to `rejects`, in a column `line`; without it the first
    such line stops the stream. A batch that runs again hands its rejects over again.
    """
    if rejects is None:
        events = stream_json(spark, path, schema, files_per_batch)
        return merge_stream(events, name, lambda batch: merge(to_plays(batch)), checkpoint)

    def take(batch: DataFrame) -> None:
        bad = F.col(CORRUPT).isNotNull()
        rejects(batch.where(bad).select(F.col(CORRUPT).alias("line")))
        merge(to_plays(batch.where(~bad).drop(CORRUPT)))

    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    events = stream_json(spark, path, with_corrupt, files_per_batch, mode="PERMISSIVE")
    return merge_stream(events, name, take, checkpoint)
