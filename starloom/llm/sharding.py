"""Sharding by extendible hashing.

The directory is indexed by the leading bits of a document's hash. A bucket that is over its byte
limit, and only such a bucket, is split on one more bit, until every shard fits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import written

SHARD_BYTES = 8 * 1024 * 1024
HASH_BITS = 60
#: Bits looked at in one round. The directory has entries of 6, 12, 18, ... bits.
ROUND_BITS = 6
COLUMNS = ("shard_id", "shard_depth", "shard_size")
#: Entries of the directory that are broadcast, some 32 MB; more are joined by a shuffle.
MOST_BROADCAST = 400_000


def hash_of(doc_id: Column) -> Column:
    """60 bits of the id's digest. A null id has the hash of an empty name."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, HASH_BITS // 4), 16, 10).cast("long")


def text_bytes() -> Column:
    return F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")


def directory(sizes: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Entries (level, cell, shard_id, shard_depth, shard_size) from rows (h long, bytes long).

    Sizes are added up per prefix, six bits a round; only what lies in a bucket still over the
    limit is looked at in the next round. A shard of fewer bits than its entries' level stands
    in several of them, as in any such directory. A shard is over the limit only if all 60 bits
    of its documents agree: rows of one id, or a single document that is too long.
    """
    entries, left, depth = None, sizes, 0
    while True:
        reach = depth + ROUND_BITS
        cells = left.groupBy(F.shiftright("h", HASH_BITS - reach).alias("cell")).agg(F.sum("bytes").alias("bytes"))
        cells = written(cells, "cells")
        levels = cells.withColumn("depth", F.explode(F.sequence(F.lit(depth), F.lit(reach)))).withColumn(
            "prefix", F.expr(f"shiftright(cell, {reach} - depth)")
        )
        sums = levels.groupBy("depth", "prefix").agg(F.sum("bytes").alias("size"))
        fits = F.col("size") <= shard_bytes
        if reach == HASH_BITS:
            fits = fits | (F.col("depth") == reach)
        first = F.min(F.when(fits, F.struct("depth", "prefix", "size"))).alias("shard")
        # of all buckets that a cell lies in, the one of fewest bits that fits
        shards = levels.join(sums, ["depth", "prefix"]).groupBy("cell").agg(first)
        found = shards.where("shard is not null").select(
            F.lit(reach).alias("level"),
            "cell",
            F.expr("lpad(bin(shard.prefix), shard.depth, '0')").alias("shard_id"),
            F.col("shard.depth").alias("shard_depth"),
            F.col("shard.size").alias("shard_size"),
        )
        entries = found if entries is None else entries.unionByName(found)
        large = cells.where(F.col("bytes") > shard_bytes).select("cell")
        if reach == HASH_BITS or large.isEmpty():
            return written(entries, "directory")
        left = left.withColumn("cell", F.shiftright("h", HASH_BITS - reach)).join(large, "cell", "left_semi").drop("cell")
        depth = reach


def _free_name(name: str, taken: list[str]) -> str:
    while name.lower() in (x.lower() for x in taken):
        name += "_"
    return name


def sharded(documents: DataFrame, shard_bytes: int = SHARD_BYTES, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """All columns of `documents`, and shard_id (bits), shard_depth (their number), shard_size.

    A document's bytes are those of its text in UTF-8; a null or empty text takes none. A null
    doc_id is hashed like an empty name. A document longer than the limit ends in a shard of its
    own that is over it, as do rows of one doc_id that don't fit together. If all fits one shard,
    its id is the empty text. An empty table gives an empty result. Columns of `documents` that
    are named like the new ones are replaced; all others may have any name.

    A small directory is sent to the rows, a level at a time, as a row is in an entry of one level
    only. A large one is looked up by the distinct hashes, and texts are joined to them once.
    """
    documents = documents.drop(*COLUMNS)
    entries = directory(documents.select(hash_of(F.col("doc_id")).alias("h"), text_bytes().alias("bytes")), shard_bytes)
    counted = {r[0]: r[1] for r in entries.groupBy("level").count().collect()}  # ten levels at most
    levels = sorted(counted) or [ROUND_BITS]
    h = _free_name("h", documents.columns)
    rows = documents.withColumn(h, hash_of(F.col("doc_id")))
    if sum(counted.values()) <= most_broadcast:
        shards = []
        for level in levels:
            cell, shard = (_free_name(f"{x}{level}", documents.columns) for x in ("cell", "shard"))
            some = entries.where(F.col("level") == level).select(F.col("cell").alias(cell), F.struct(*COLUMNS).alias(shard))
            rows = rows.join(F.broadcast(some), F.shiftright(h, HASH_BITS - level) == F.col(cell), "left")
            shards.append(F.col(shard))
        found = F.coalesce(*shards)
    else:
        shard = _free_name("shard", documents.columns)
        keys = rows.select(F.col(h).alias("h")).distinct().withColumn("level", F.explode(F.array(*(F.lit(n) for n in levels))))
        keys = keys.withColumn("cell", F.expr(f"shiftright(h, {HASH_BITS} - level)"))
        known = keys.join(entries, ["level", "cell"]).select(F.col("h").alias(h), F.struct(*COLUMNS).alias(shard))
        rows, found = rows.join(known, h), F.col(shard)
    return rows.select(*(F.col(f"`{c}`") for c in documents.columns), *(found[c].alias(c) for c in COLUMNS))


def write_shards(documents: DataFrame, path: str, shard_bytes: int = SHARD_BYTES) -> None:
    """Writes each shard as a folder of its own under `path`, one file a shard."""
    out = sharded(documents, shard_bytes)
    out.repartition("shard_id").write.partitionBy("shard_id").parquet(path)
