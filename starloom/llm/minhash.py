"""Near duplicates by min-max hashing.

Each permutation of the shingles gives two values of a signature, the smallest and the largest,
so that 64 permutations make 128 values. Bands of two permutations (four values) put texts into
buckets; two texts at the similarity sought meet in at least one of 32 bands but for five cases
in a million where the sets are large. The minimum and the maximum of a small set are seldom of the
same shingle, so that its bands agree less often than a large one's. Sets of at most seven shingles are
therefore looked up without one of their shingles too, which finds every link between a set and one
that has one shingle more. Every other link is confirmed on the full sets of both texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import few_rows, pack_texts, text_blocks, unpack_texts, written
from starloom.llm.graph import components
from starloom.llm.words import find_words, mix, seeded, window_hashes

SHINGLE_WORDS = 5
PERMUTATIONS = 64
BANDS = 32
LIKE_PERCENT = 75
#: Sets of so few shingles are also looked up without one of them.
FEW_SHINGLES = 7
MEMBERS = 128
BUCKET_BLOCK = 500
#: Keys that are broadcast, 32 MB; more are joined by a shuffle.
MOST_BROADCAST = 4_000_000

_SEEDS = seeded("permutations", 2 * PERMUTATIONS)
_XOR = (_SEEDS[:PERMUTATIONS] >> np.uint64(32)).astype(np.uint32)
_FACTOR = _SEEDS[PERMUTATIONS:].astype(np.uint32) | np.uint32(1)


def shingle_sets(texts: pa.Array, shingle_words: int = SHINGLE_WORDS) -> Iterator[np.ndarray]:
    """For each text the sorted hashes of its distinct shingles, A-Z lower-cased."""
    for _, _, data, offsets in text_blocks(texts):
        words = find_words(data, offsets, lower=True)
        hashes = words.hashes()
        starts = words.windows(shingle_words)
        shingles = window_hashes(hashes, starts, shingle_words)
        counts = np.maximum(words.counts - shingle_words + 1, 0)
        bounds = np.concatenate(([0], np.cumsum(counts)))
        short = (words.counts > 0) & (counts == 0)
        for k in range(len(counts)):
            if short[k]:
                first = words.firsts[k : k + 1]
                yield window_hashes(hashes[first[0] : first[0] + words.counts[k]], np.zeros(1, np.int64), int(words.counts[k]))
            else:
                row = np.sort(shingles[bounds[k] : bounds[k + 1]])
                yield row[np.concatenate(([True], row[1:] != row[:-1]))] if len(row) else row


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """128 values a set: minima under each permutation, then maxima. Sets must not be empty."""
    out = np.empty((len(sets), 2 * PERMUTATIONS), np.uint32)
    if not sets:
        return out
    values = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    bounds = np.concatenate(([0], np.cumsum([len(x) for x in sets[:-1]]))).astype(np.int64)
    for k in range(PERMUTATIONS):
        permuted = (values ^ _XOR[k]) * _FACTOR[k]
        out[:, k] = np.minimum.reduceat(permuted, bounds)
        out[:, PERMUTATIONS + k] = np.maximum.reduceat(permuted, bounds)
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One key for each text and band, from both values of the band's permutations."""
    low = signature[:, :PERMUTATIONS].astype(np.uint64)
    pairs = (low << np.uint64(32)) | signature[:, PERMUTATIONS:]
    rows = PERMUTATIONS // BANDS
    keys = np.tile(np.arange(BANDS, dtype=np.uint64), (len(signature), 1))
    for k in range(rows):
        keys = mix(keys ^ pairs[:, k::rows])
    return keys


def _describe(batches):
    names = ["doc_id", "n_shingles", "set_a", "set_b", "buckets", "less"]
    seed = np.uint64(0x9E3779B97F4A7C15)
    for batch in batches:
        ids, texts, done = batch.column(0), batch.column(1), 0
        pending: list[np.ndarray] = []

        def flush():
            counts = np.array([len(x) for x in pending], np.int64)
            sums = np.zeros((2, len(pending)), np.uint64)
            full = np.flatnonzero(counts)
            blobs, less = [None] * len(pending), [None] * len(pending)
            if len(full):
                sets = [pending[k] for k in full]
                joined, bounds = np.concatenate(sets), np.concatenate(([0], np.cumsum(counts[full])[:-1]))
                sums[0, full] = np.add.reduceat(mix(joined), bounds)
                sums[1, full] = np.add.reduceat(mix(joined ^ seed), bounds)
                for k, one, row in zip(full, sets, band_keys(signatures(sets))):
                    blobs[k] = row.tobytes()
                    if 1 < len(one) <= FEW_SHINGLES:
                        less[k] = np.stack((sums[0, k] - mix(one), sums[1, k] - mix(one ^ seed))).tobytes()
            return pa.RecordBatch.from_arrays(
                [ids.slice(done, len(pending)), pa.array(counts), pa.array(sums[0].view(np.int64)), pa.array(sums[1].view(np.int64)),
                 pa.array(blobs, pa.binary()), pa.array(less, pa.binary())],
                names,
            )

        size = 0
        for one in shingle_sets(texts):
            pending.append(one)
            size += len(one)
            if size > 200_000:
                yield flush()
                done, pending, size = done + len(pending), [], 0
        if pending:
            yield flush()


def described(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, two hashes of the whole set, its buckets, and of few shingles the hashes
    of the set without each of them. The last two are null for no words."""
    return documents.select("doc_id", "text").mapInArrow(
        _describe, "doc_id long, n_shingles long, set_a long, set_b long, buckets binary, less binary"
    )


def _to_buckets(batches):
    for batch in batches:
        if batch.num_rows:
            keys = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.int64)
            ids = np.repeat(np.asarray(batch.column(0)), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(ids)], ["bucket", "node"])


def _to_smaller_sets(batches):
    for batch in batches:
        for k, blob in enumerate(batch.column(2).to_pylist()):
            hashes = np.frombuffer(blob, np.int64).reshape(2, -1)
            count = hashes.shape[1]
            ids, sizes = (np.full(count, batch.column(c)[k].as_py(), np.int64) for c in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array(sizes - 1), pa.array(hashes[0]), pa.array(hashes[1])], ["b", "n_shingles", "set_a", "set_b"]
            )


def one_more(nodes: DataFrame, classes: DataFrame, like_percent: int = LIKE_PERCENT) -> DataFrame:
    """Links (a, b) where b has few shingles: those of a and one more."""
    few = nodes.where(F.col("less").isNotNull() & ((F.col("n_shingles") - 1) * 100 >= like_percent * F.col("n_shingles")))
    smaller = few.select("node", "n_shingles", "less").mapInArrow(
        _to_smaller_sets, "b long, n_shingles long, set_a long, set_b long"
    )
    return smaller.join(classes, ["set_a", "set_b", "n_shingles"]).select(F.col("node").alias("a"), "b")


def _if_few(keys: DataFrame) -> DataFrame:
    """The written rows, marked to be broadcast if they are counted and found to be few."""
    return F.broadcast(keys) if keys.count() <= MOST_BROADCAST else keys


def confirmed(pairs: DataFrame, documents: DataFrame, like_percent: int = LIKE_PERCENT) -> DataFrame:
    """Those of the pairs (a, b) whose full sets are alike enough.

    Each `a` meets its partners in groups of 128 or so, so that one with very many partners is
    spread over tasks; a group is read as a stream, `a` first.
    """
    sizes = pairs.groupBy("a").agg(F.ceil(F.count("*") / MEMBERS).alias("groups")).where("groups > 1")
    dealt = pairs.join(_if_few(written(sizes, "large_groups")), "a", "left").select(
        "a", "b", F.pmod(F.xxhash64("b"), F.coalesce("groups", F.lit(1))).alias("part")
    )
    wanted = dealt.select("a", "part", F.col("b").alias("doc_id")).unionByName(
        dealt.select("a", "part").distinct().withColumn("doc_id", F.col("a"))
    )
    texts = wanted.join(packed(_of_ids(documents, wanted)), "doc_id")
    stream = (
        texts.repartition("a", "part")
        .withColumn("partner", F.col("doc_id") != F.col("a"))
        .sortWithinPartitions("a", "part", "partner", "doc_id")
        .select("a", "part", "doc_id", "packed")
    )

    def compare(batches):
        group, hub = None, None
        for batch in few_rows(batches):
            heads, parts, ids = (np.asarray(batch.column(k)) for k in range(3))
            keep_a, keep_b = [], []
            for k, one in enumerate(shingle_sets(unpack_texts(batch.column(3)))):
                if group != (heads[k], parts[k]):
                    group, hub = (heads[k], parts[k]), None
                if ids[k] == heads[k]:
                    hub = one if hub is None else hub
                elif hub is not None and len(one) * 100 >= like_percent * len(hub) and len(hub) * 100 >= like_percent * len(one):
                    shared = int((hub[np.minimum(np.searchsorted(hub, one), len(hub) - 1)] == one).sum()) if len(hub) else 0
                    if shared and 100 * shared >= like_percent * (len(hub) + len(one) - shared):
                        keep_a.append(heads[k])
                        keep_b.append(ids[k])
            yield pa.RecordBatch.from_arrays([pa.array(keep_a, pa.int64()), pa.array(keep_b, pa.int64())], ["a", "b"])

    return stream.mapInArrow(compare, "a long, b long")


def _prefixes(number: np.ndarray, sizes: np.ndarray, like_percent: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """For each set its rarest shingles, numbered; and per number the sets that have it among theirs.

    Two sets that are alike enough share one of their prefixes: of n shingles they have at least
    `like_percent` in common, so one that is not among the n - common + 1 rarest cannot be the only one.
    """
    counts = np.bincount(number)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((number, counts[number], owner))
    place = np.arange(len(order)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    reach = sizes - -(-like_percent * sizes // 100) + 1
    taken = order[(place < reach[owner]) & (counts[number[order]] > 1)]
    number, owner = number[taken], owner[taken]
    mine = np.split(number, np.searchsorted(owner, np.arange(1, len(sizes))))
    by_number = np.argsort(number, kind="stable")
    return mine, owner[by_number], np.searchsorted(number[by_number], np.arange(len(counts) + 1))


def _links_of_block(batch: pa.Table, like_percent: int) -> tuple[list[int], list[int]]:
    """Links that join components of one block, each confirmed on full sets; no more than needed."""
    node, root, side = (np.asarray(batch.column(c)) for c in ("node", "root", "side"))
    sets = [np.frombuffer(x, np.uint64) for x in batch.column("shingles").to_pylist()]
    sizes = np.array([len(x) for x in sets])
    number = np.unique(np.concatenate(sets), return_inverse=True)[1]
    numbered = np.split(number, np.cumsum(sizes)[:-1])
    mine, owners, bounds = _prefixes(number, sizes, like_percent)
    root, right, in_this = root.copy(), (side & 2) > 0, np.zeros(len(bounds), bool)
    found: tuple[list[int], list[int]] = ([], [])
    for k in np.flatnonzero(side & 1):
        sharing = [owners[bounds[x] : bounds[x + 1]] for x in mine[k]]
        if not sharing:
            continue
        other = np.unique(np.concatenate(sharing))
        fits = right[other] & (root[other] != root[k]) & (100 * np.minimum(sizes[other], sizes[k]) >= like_percent * np.maximum(sizes[other], sizes[k]))
        other = other[fits]
        if not len(other):
            continue
        in_this[numbered[k]] = True
        hits = in_this[np.concatenate([numbered[j] for j in other])]
        shared = np.add.reduceat(hits, np.cumsum(sizes[other]) - sizes[other], dtype=np.int64)
        in_this[numbered[k]] = False
        for j in other[100 * shared >= like_percent * (sizes[other] + sizes[k] - shared)]:
            if root[j] != root[k]:
                found[0].append(int(min(node[j], node[k])))
                found[1].append(int(max(node[j], node[k])))
                root[root == root[j]] = root[k]
    return found


def across_components(members: DataFrame, sets: DataFrame, like_percent: int = LIKE_PERCENT) -> DataFrame:
    """Links (a, b) between texts of a bucket that are not connected yet.

    Takes (bucket, node, root) of buckets with more than one component, and the sets of their
    nodes. Buckets are compared in blocks of five hundred by five hundred texts, however large
    they are. In a block, pairs that share one of their rarest shingles are compared on full sets;
    no other pair can be alike enough. Only links leave a block.
    """
    sizes = members.groupBy("bucket").agg(F.ceil(F.count("*") / BUCKET_BLOCK).alias("blocks"))
    dealt = members.join(sizes, "bucket").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    placed = dealt.join(sets, "node").withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "bucket",
        F.least("block", "other").alias("first_block"),
        F.greatest("block", "other").alias("second_block"),
        F.expr("case when block = other then 3 when block < other then 1 else 2 end").alias("side"),
        "node",
        "root",
        "shingles",
    )

    def compare(block: pa.Table) -> pa.Table:
        a, b = _links_of_block(block, like_percent)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return placed.groupBy("bucket", "first_block", "second_block").applyInArrow(compare, "a long, b long").distinct()


def _of_ids(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of the wanted doc_ids. Few ids are broadcast, so that no other text is shuffled."""
    ids = written(wanted.select("doc_id").distinct(), "wanted")
    return documents.select("doc_id", "text").join(_if_few(ids), "doc_id", "left_semi")


def packed(documents: DataFrame) -> DataFrame:
    """(doc_id, packed): texts as zstd, which shuffles in a third of its bytes."""

    def pack(batches):
        for batch in few_rows(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pack_texts(batch.column(1))], ["doc_id", "packed"])

    return documents.select("doc_id", "text").where("doc_id is not null").mapInArrow(pack, "doc_id long, packed binary")


def _sets(batches):
    for batch in few_rows(batches):
        blobs = [x.tobytes() for x in shingle_sets(unpack_texts(batch.column(1)))]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(blobs, pa.binary())], ["node", "shingles"])


def near_duplicates(documents: DataFrame, like_percent: int = LIKE_PERCENT) -> DataFrame:
    """One row per row of `documents`: doc_id, n_shingles, component_id, kept.

    Texts with the same set form a class, whose smallest doc_id stands for it in all further
    steps. In each bucket every text is first paired with the one of the smallest doc_id only;
    pairs between others follow where these others are still of several components, once for
    buckets of the same texts. A pair within a component is never needed, as it would join nothing.

    A null or empty text, or one without words, has no shingles, is linked with nothing and is
    its own component. Rows that share a doc_id count as one document if their texts are equal;
    a row without doc_id is linked with nothing, has a null component and is kept. Other columns
    are ignored. An empty table gives an empty result.
    """
    rows = written(described(documents), "described")
    known = rows.where("n_shingles > 0 and doc_id is not null")
    classes = known.groupBy("set_a", "set_b", "n_shingles").agg(F.min("doc_id").alias("node"))
    classes = written(classes, "classes")
    nodes = known.join(
        classes.select("set_a", "set_b", "n_shingles", F.col("node").alias("doc_id")), ["set_a", "set_b", "n_shingles", "doc_id"], "left_semi"
    ).select(F.col("doc_id").alias("node"), "n_shingles", "buckets", "less")
    nodes = written(nodes, "nodes")
    buckets = nodes.select("node", "buckets").mapInArrow(_to_buckets, "bucket long, node long")
    hubs = buckets.groupBy("bucket").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a <> z")
    shared = written(buckets.join(hubs.select("bucket", "a"), "bucket"), "buckets")
    pairs = written(shared.where("a <> node").select("a", F.col("node").alias("b")).distinct(), "pairs")
    links = confirmed(pairs, documents, like_percent).unionByName(one_more(nodes, classes, like_percent))
    roots = components(written(links, "confirmed"))

    # pairs with a bucket's smallest have been compared; the others are left
    placed = shared.where("a <> node").join(roots, "node", "left").select("bucket", "node", F.coalesce("root", "node").alias("root"))
    placed = written(placed, "placed")
    texts = [F.sum(F.xxhash64(*x).cast("decimal(38,0)")).alias(name) for name, x in (("h", ["node"]), ("i", [F.lit(1), "node"]))]
    mixed = placed.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("n"), *texts)
    mixed = mixed.where("low <> high").groupBy("n", "h", "i").agg(F.min("bucket").alias("bucket"))
    members = written(placed.join(mixed.select("bucket"), "bucket", "left_semi").distinct(), "members")
    if not members.isEmpty():
        wanted = members.select(F.col("node").alias("doc_id"))
        sets = packed(_of_ids(documents, wanted)).mapInArrow(_sets, "node long, shingles binary")
        more = written(across_components(members, sets.dropDuplicates(["node"]), like_percent), "more")
        roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))

    found = classes.join(roots, "node", "left").select(
        "set_a", "set_b", F.col("n_shingles").alias("n"), F.coalesce("root", "node").alias("root")
    )
    same = (rows.set_a == found.set_a) & (rows.set_b == found.set_b) & (rows.n_shingles == found.n) & rows.doc_id.isNotNull()
    component = F.coalesce(found.root, rows.doc_id)
    return rows.join(found, same, "left").select(
        rows.doc_id, rows.n_shingles, component.alias("component_id"), F.coalesce(rows.doc_id == component, F.lit(True)).alias("kept")
    )
