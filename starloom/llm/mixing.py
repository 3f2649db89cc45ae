"""Mixing sources to target weights by systematic sampling.

Within a source, every document is expected equally often; its expected copies are added up over
the documents in order of size, one random offset is added, and a document is emitted once for
each whole number that its stretch crosses. As neighbours in this order are of like size, the
words taken follow the target closely.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MOST_COPIES = 3
LANES = 4096
SEED = "mix"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def unit(*parts: Column) -> Column:
    """A number from 0 up to 1 that the parts determine."""
    digest = F.md5(F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("~")) for p in parts)))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def source_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_copies: int = MOST_COPIES) -> DataFrame:
    """Adds `target` to one row per source (source, source_size).

    Sources share the words of all by weight; weights are dealt in turn by code point of the
    name, null last. A target above `most_copies` times its source's size stops there, and the
    rest is shared again. All stops follow from one pass over the sources in order of size by
    weight: with the first k stopped, the next needs no stop if its share of what is left is
    below its own.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), (turn + 1).cast("int")).cast("long")
    weighed = sources.withColumn("weight", weight).withColumn("most", F.lit(most_copies) * F.col("source_size"))
    by_stop = Window.orderBy((F.col("most") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = by_stop.rowsBetween(Window.unboundedPreceding, -1)
    left_words = F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0))
    left_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    shares = weighed.withColumn("level", left_words / left_weight)
    free = shares.withColumn("free", F.col("level") * F.col("weight") <= F.col("most"))
    # the first that needs no stop sets the level for itself and all after it
    first_free = F.max("free").over(by_stop.rowsBetween(Window.unboundedPreceding, 0))
    set_level = F.first(F.when(F.col("free"), F.col("level")), ignorenulls=True).over(
        by_stop.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    target = F.when(first_free, set_level * F.col("weight")).otherwise(F.col("most").cast("double"))
    return free.withColumn("target", target).select("source", "source_size", "weight", "target")


def mixed(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_copies: int = MOST_COPIES, seed: str = SEED) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken for each row of `documents`.

    The running sum is a rank times the expected copies. The rank of a document in its source is
    added up from counts per size and per lane of a size (lanes are drawn from the doc_id), and
    the place in the lane, so that no task holds a whole source, however large.

    A null or empty text has size 0 and adds nothing to what is taken. Null is a source of its
    own. A source of no words has a target of 0 and expects no copies. Rows that are equal in all
    respects share the copies of their places in any order; a null doc_id is ranked first in its
    lane. Other columns are ignored; an empty table gives an empty result.
    """
    lane = F.floor(unit(F.lit("lane"), F.col("doc_id")) * LANES)
    sized = documents.select("doc_id", "source", word_count(F.col("text")).alias("size")).withColumn("lane", lane)
    cells = sized.groupBy("source", "size", "lane").agg(F.count("*").alias("docs"))
    sizes = cells.groupBy("source", "size").agg(F.sum("docs").alias("docs"))
    totals = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("docs")).alias("source_size"))
    targets = source_targets(totals, weights, most_copies)
    before = Window.orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    below = sizes.select(
        "source", "size", F.coalesce(F.sum("docs").over(before.partitionBy("source")), F.lit(0)).alias("below")
    )
    lanes = Window.partitionBy("source", "size").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    aside = cells.select("source", "size", "lane", F.coalesce(F.sum("docs").over(lanes), F.lit(0)).alias("aside"))
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    offsets = (
        aside.join(below.withColumnsRenamed({"source": "s", "size": "z"}), F.expr("source <=> s and size = z"))
        .join(targets.withColumnRenamed("source", "t"), F.expr("source <=> t"))
        .select(
            F.col("source").alias("o_source"), F.col("size").alias("o_size"), F.col("lane").alias("o_lane"),
            (F.col("below") + F.col("aside")).alias("offset"), "source_size", "target", expected.alias("expected"),
        )
    )
    place = F.row_number().over(Window.partitionBy("source", "size", "lane").orderBy("doc_id")) - 1
    ranked = sized.withColumn("place", place).join(offsets, F.expr("source <=> o_source and size = o_size and lane = o_lane"))
    rank = F.col("offset") + F.col("place")
    start = unit(F.lit(seed), F.col("source"))
    copies = F.floor(start + (rank + 1) * F.col("expected")) - F.floor(start + rank * F.col("expected"))
    # rounding may cross one boundary too many where a whole number of copies is expected
    copies = F.least(copies, F.lit(most_copies))
    return ranked.withColumn("copies", copies).select(
        "doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )


def emitted(documents: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of `documents` as often as it is taken, with all its columns.

    Rows that agree in doc_id, source and size share what is taken of them as evenly as can be.
    Columns named mix_... are for use within.
    """
    key = F.xxhash64("doc_id", "source", "size")
    plan = mixed(documents, **options).select(key.alias("mix_key"), "copies").groupBy("mix_key").agg(
        F.sum("copies").alias("mix_copies"), F.count("*").alias("mix_rows")
    )
    keyed = documents.withColumn("mix_key", F.xxhash64("doc_id", "source", word_count(F.col("text"))))
    joined = keyed.join(plan.where("mix_copies > 0"), "mix_key")
    row = F.row_number().over(Window.partitionBy("mix_key").orderBy(F.xxhash64("text")))
    mine = F.floor(row * F.col("mix_copies") / F.col("mix_rows")) - F.floor((row - 1) * F.col("mix_copies") / F.col("mix_rows"))
    times = joined.withColumn("mix_times", mine.cast("int")).where("mix_times > 0")
    return times.withColumn("mix_time", F.explode(F.sequence(F.lit(1), F.col("mix_times")))).select(*documents.columns)
