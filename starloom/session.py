"""Session settings and the shared folder that checkpoints go to."""

from __future__ import annotations

import math

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.ui.enabled": "false",
}

SHUFFLE_PARTITION_BYTES = 200 * 1024 * 1024


def shuffle_partitions(shuffle_bytes: int, cores: int) -> int:
    """Partitions that keep each shuffle task near 200 MB, at least one per core.

    AQE merges small partitions afterwards but never splits an ordinary one, so the
    starting number has to be large enough for the widest shuffle of the job.
    """
    return max(cores, math.ceil(shuffle_bytes / SHUFFLE_PARTITION_BYTES))


def build_session(
    app: str,
    master: str | None = None,
    shuffle_bytes: int | None = None,
    cores: int = 8,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    chosen = dict(SETTINGS)
    if shuffle_bytes is not None:
        chosen["spark.sql.shuffle.partitions"] = str(shuffle_partitions(shuffle_bytes, cores))
    chosen.update(settings or {})
    for key, value in chosen.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in `spark.checkpoint.dir`."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return folder.rstrip("/")
