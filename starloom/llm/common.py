"""Tables, intermediate tables in the shared folder, and Arrow batches in blocks of bytes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession

BLOCK_BYTES = 1 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that `spark.checkpoint.dir` names. Only a local session may go without one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="starloom-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def written(frame: DataFrame, label: str) -> DataFrame:
    """The same rows, written to the shared folder and read back: work done once, lineage cut."""
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def text_blocks(column: pa.Array, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Splits a text column into blocks of whole texts, each of about `block_bytes`.

    Yields the first and last row (half open), the UTF-8 bytes of the block, and the offsets of
    its texts in them. A null is an empty text.
    """
    column = pc.fill_null(column, "").cast(pa.large_string())
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + block_bytes, "right")) - 1
        last = min(max(last, first + 1), len(column))
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def few_rows(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, for work that holds several copies of a batch."""
    for batch in batches:
        for first in range(0, batch.num_rows, rows):
            yield batch.slice(first, rows)


def pack_texts(column: pa.Array) -> pa.Array:
    """Texts as zstd, which shuffle in a third of their bytes. A null is an empty text."""
    press = zstandard.ZstdCompressor(level=1)
    return pa.array([press.compress((x or "").encode()) for x in column.to_pylist()], pa.binary())


def unpack_texts(column: pa.Array) -> pa.Array:
    press = zstandard.ZstdDecompressor()
    return pa.array([press.decompress(x) for x in column.to_pylist()], pa.large_binary()).cast(pa.large_string())
