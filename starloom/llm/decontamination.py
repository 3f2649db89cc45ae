"""Benchmark decontamination by SimHash. DataFrame functions only.

Windows of a document as long as a benchmark item get 64-bit fingerprints of their five-word
shingles. Two fingerprints within `RADIUS` bits agree wholly in at least one of `RADIUS` + 1
blocks, so a join on blocks finds all of them. What is found is verified by the exact weighted
similarity of the shingles. Only windows are fingerprinted in which as many shingles as the
similarity asks for stand in some item of their length: all others are below it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SHINGLE_WORDS = 5
LIKE_PERCENT = 75
#: At a similarity of 0.75 fingerprints differ in 11 bits on average; over 24 in one case in 10^5.
RADIUS = 24
#: Shingles of benchmark items that are broadcast; a larger benchmark is joined by shuffles.
MOST_BROADCAST = 2_000_000
#: Counters of 16 bits hold so many shingles; longer windows are counted in 32 bits.
NARROW = 65_535


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def shingles(words_name: str, width: int) -> Column:
    return F.expr(
        f"case when size({words_name}) >= {width} then "
        f"transform(sequence(1, size({words_name}) - {width} + 1), i -> xxhash64(slice({words_name}, i, {width}))) "
        f"else cast(array() as array<bigint>) end"
    )


def fingerprint(values: str) -> Column:
    """SimHash: each bit is that of most shingles, repeated ones counted as often as they stand."""
    return F.expr(f"if(size({values}) <= {NARROW}, {_counted(values, 16)}, {_counted(values, 32)})")


def _counted(values: str, width: int) -> str:
    """A sum holds the counts of 64 / width bits of the hashes, in a field each."""
    per_sum, lowest = 64 // width, sum(1 << (width * k) for k in range(64 // width))
    sums = range(64 // per_sum)
    zero = ", ".join(f"'s{g}', 0L" for g in sums)
    add = ", ".join(f"'s{g}', s.s{g} + (shiftrightunsigned(h, {g}) & {lowest}L)" for g in sums)
    bits = " | ".join(
        f"if(2 * (shiftrightunsigned(s.s{g}, {width * f}) & {(1 << width) - 1}L) > s.n, shiftleft(1L, {g + width * f}), 0L)"
        for g in sums
        for f in range(per_sum)
    )
    return f"aggregate({values}, named_struct('n', 0L, {zero}), (s, h) -> named_struct('n', s.n + 1L, {add}), s -> {bits})"


def blocks(radius: int) -> list[int]:
    """Masks of radius + 1 blocks that share out all 64 bits."""
    edges = [64 * k // (radius + 1) for k in range(radius + 2)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _in_blocks(marked: DataFrame, mark: str, masks: list[int]) -> DataFrame:
    """A row for each block of each fingerprint, with the bits in it."""
    numbered = marked.withColumn("block", F.explode(F.array(*(F.lit(k) for k in range(len(masks))))))
    mask = F.element_at(F.array(*(F.lit(m).cast("long") for m in masks)), F.col("block") + 1)
    return numbered.withColumn("value", F.col(mark).bitwiseAND(mask))


def _told_apart(values: Column) -> Column:
    """The values, each with how often it has stood before, as one number."""
    ordered = F.array(F.sort_array(values))  # an element of an array, so that it is sorted once
    number = lambda some: F.transform(some, lambda x, at: F.xxhash64(x, at - F.array_position(some, x)))
    return F.get(F.transform(ordered, number), 0)


def shared_weight(a: Column, b: Column) -> Column:
    """Shingles in common, each as often as it stands in both."""
    once = (F.size(F.array_distinct(a)) == F.size(a)) | (F.size(F.array_distinct(b)) == F.size(b))
    return F.when(once, F.size(F.array_intersect(a, b))).otherwise(F.size(F.array_intersect(_told_apart(a), _told_apart(b))))


def leaks(documents: DataFrame, benchmark: DataFrame, like_percent: int = LIKE_PERCENT, radius: int = RADIUS) -> DataFrame:
    """(row_key, item_id, shared, total): the items found in each document, with their best window."""
    items = benchmark.select("item_id", words(F.col("text")).alias("words")).where("size(words) > 0")
    items = items.withColumn("n", F.size("words")).withColumn("width", F.least(F.lit(SHINGLE_WORDS), F.col("n")))
    widths = sorted(r[0] for r in items.select("width").distinct().collect())  # five at most
    masks = blocks(radius)
    found = None
    for width in widths:
        mine = items.where(F.col("width") == width).select("item_id", "n", shingles("words", width).alias("item"))
        # with `explode` a filter on the array's size would be pushed down to the text, to find its
        # words again for each shingle
        known = mine.select("n", F.explode_outer("item").alias("h")).where("h is not null").distinct()
        small = known.count() <= MOST_BROADCAST
        hint = F.broadcast if small else (lambda frame: frame)
        worded = documents.select(F.xxhash64("doc_id", "text").alias("row_key"), words(F.col("text")).alias("words"))
        placed = worded.select("row_key", F.size("words").alias("n_doc"), F.posexplode(shingles("words", width)).alias("at", "h"))
        hits = placed.join(hint(known), "h")
        # A window that stands in an item for so many of its places can be moved back until it ends
        # with one of them, or to the start: what it has in common with the item does not shrink.
        size = F.least("n", "n_doc") - width + 1
        least = F.expr(f"((least(n, n_doc) + n - 2 * {width - 1}) * {like_percent} + {99 + like_percent}) div {100 + like_percent}")
        placed_hits = hits.groupBy("row_key", "n", "n_doc").agg(F.sort_array(F.collect_set("at")).alias("places"))
        ends = placed_hits.select("row_key", "n", "places", size.alias("size"), least.cast("int").alias("least")).where("size(places) >= least")
        starts = F.expr(
            "transform(filter(sequence(least - 1, size(places) - 1), j -> places[j] - places[j - least + 1] < size), j -> greatest(places[j] - size + 1, 0))"
        )
        starts = ends.select("row_key", "n", F.explode(F.array_distinct(starts)).alias("start"))
        asked = starts.groupBy("row_key").agg(F.collect_list(F.struct("n", "start")).alias("asked"))
        texts = documents.select(F.xxhash64("doc_id", "text").alias("row_key"), "text")
        windows = (
            texts.join(asked, "row_key")
            .select("row_key", "asked", words(F.col("text")).alias("words"))
            .select("row_key", "asked", F.size("words").alias("n_doc"), shingles("words", width).alias("all"))
            # the shingles stand below the generator: once a document, not once a window
            .select("row_key", "n_doc", "all", F.explode("asked").alias("w"))
            .select("row_key", "w.n", F.expr(f"slice(all, w.start + 1, least(w.n, n_doc) - {width} + 1)").alias("window"))
            .withColumn("mark", fingerprint("window"))
        )
        windows = _in_blocks(windows, "mark", masks)
        index = _in_blocks(mine.withColumn("item_mark", fingerprint("item")), "item_mark", masks)
        differing = F.col("mark").bitwiseXOR(F.col("item_mark"))
        # of all blocks that agree, the first one finds the pair
        leading = reduce(
            lambda later, k: F.when(differing.bitwiseAND(F.lit(masks[k]).cast("long")) == 0, F.lit(k)).otherwise(later),
            reversed(range(len(masks))),
            F.lit(len(masks)),
        )
        near = windows.join(hint(index), ["n", "block", "value"]).where((F.bit_count(differing) <= radius) & (leading == F.col("block")))
        shared = near.withColumn("shared", shared_weight(F.col("window"), F.col("item"))).withColumn(
            "total", F.size("window") + F.size("item") - F.col("shared")
        )
        alike = shared.where(F.col("shared") * 100 >= F.col("total") * like_percent)
        best = alike.groupBy("row_key", "item_id").agg(
            F.max(F.struct((F.col("shared") / F.col("total")).alias("like"), "shared", "total")).alias("best")
        )
        best = best.select("row_key", "item_id", "best.shared", "best.total")
        found = best if found is None else found.unionByName(best)
    if found is None:
        nothing = documents.select(F.xxhash64("doc_id", "text").alias("row_key")).where("false")
        found = nothing.selectExpr("row_key", "cast(null as bigint) item_id", "0 shared", "1 total")
    return found


def decontaminated(documents: DataFrame, benchmark: DataFrame, like_percent: int = LIKE_PERCENT, radius: int = RADIUS) -> DataFrame:
    """doc_id, n_words, n_items, items, best_percent and kept for each row of `documents`.

    A document is not kept if a window as long as an item (or all of it, if it is shorter) has at
    least `like_percent` of its shingles in common with the item: shared ones by both together,
    repeats counted. `items` are the item_ids in order, `best_percent` the similarity of the best
    in whole percent, 0 if none. Case is ignored.

    A null or empty text has no words and is kept. A benchmark item without words finds nothing;
    one of fewer than five words is one shingle of its own length. Repeated items are all named;
    a null item_id is named -1. Equal rows get equal results, a null doc_id is passed
    on, other columns are ignored. An empty table of documents gives an empty result, an empty
    benchmark keeps all.
    """
    found = leaks(documents, benchmark, like_percent, radius)
    percent = F.floor(100 * F.col("shared") / F.col("total")).cast("int")
    by_row = found.groupBy("row_key").agg(
        F.sort_array(F.collect_set(F.coalesce(F.col("item_id").cast("long"), F.lit(-1)))).alias("items"), F.max(percent).alias("best_percent")
    )
    rows = documents.select("doc_id", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("n_words"), F.xxhash64("doc_id", "text").alias("row_key"))
    out = rows.join(by_row, "row_key", "left")
    return out.select(
        "doc_id",
        "n_words",
        F.when(F.col("items").isNull(), 0).otherwise(F.size("items")).cast("long").alias("n_items"),
        F.coalesce(F.array_join("items", ","), F.lit("")).alias("items"),
        F.coalesce("best_percent", F.lit(0)).alias("best_percent"),
        F.col("items").isNull().alias("kept"),
    )
