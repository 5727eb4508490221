"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification.

Two fixed permutations make a whole signature: the first spreads a shingle over a ring, the second,
shifted by one place for each coordinate, gives its value there. So the values of a shingle for all
coordinates are one stretch of the second permutation.

1. Documents with equal shingle sets are one class, represented by its least id.
2. Signatures of representatives are cut into bands; representatives that share a band form a bucket.
   Two sets of similarity 0.8 share none of the 32 bands with a probability of 3e-6.
3. In each bucket all members are verified against one leader, a different one for each band. Links
   give components.
4. Buckets that still hold several components are split into blocks of bounded size, the members of the
   largest component apart from the rest. Blocks of the rest meet all blocks; those of the largest do
   not meet each other, as they have nothing left to link. In each pair of blocks members of different
   components are verified exactly, and only links leave the task. So no candidate pair that could join
   two components goes untested, and no list of all pairs is made.
5. The components of all links, by least id, are the groups.

Words are lower-cased from A to Z; shingles are known by 64-bit hashes (two of 100,000 collide with a
probability below 1e-9). A text of fewer words than a shingle is one shingle of all its words.

Defined results: NULL and empty texts, and texts without words, have no shingles and are linked with
nothing: their own id is their component. So are rows with a NULL id, whose component is NULL and which
are kept. Rows that share an id are one node. Texts are used whole; other columns are not read. An
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from foldcat.llm.components import components
from foldcat.llm.ordering import placed
from foldcat.llm.text import bound_batches, unused
from foldcat.operators.membership import chance_members, key_bitmap, with_chance
from foldcat.staging import cut

SHINGLE = 5
PERCENT = 80
BANDS, ROWS = 32, 5
RING = 1 << 20
# Ids whose sets are needed are sent to all executors up to so many; beyond, a sketch of them is.
BROADCAST_IDS = 2_000_000
# Blocks hold about so many members and shingles at most.
BLOCK_MEMBERS = 1_024
BLOCK_SHINGLES = 1_000_000

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_RINGS: list[np.ndarray] = []


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """The sorted different shingles of a text as 64-bit hashes."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []  # bytes: A to Z alone
    if not words:
        return np.zeros(0, np.uint64)
    size = min(size, len(words))
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    mixed = np.full(len(words) - size + 1, size, np.uint64)
    for i in range(size):
        mixed = (mixed ^ hashes[i : len(hashes) - size + 1 + i]) * _MULTIPLIER
        mixed ^= mixed >> np.uint64(32)
    return np.unique(mixed * _MULTIPLIER)


def _permutations() -> tuple[np.ndarray, np.ndarray]:
    """The first permutation of the ring, and the second with its start repeated at its end."""
    if not _RINGS:
        rng = np.random.default_rng(20_210_909)
        first, second = rng.permutation(RING).astype(np.uint32), rng.permutation(RING).astype(np.uint32)
        _RINGS.extend((first, np.concatenate([second, second[: BANDS * ROWS]])))
    return _RINGS[0], _RINGS[1]


def signature(shingles: np.ndarray) -> np.ndarray:
    """The least value of each coordinate; coordinate k reads the second permutation k places on."""
    first, second = _permutations()
    stretches = np.lib.stride_tricks.sliding_window_view(second, BANDS * ROWS)
    places = first[(shingles % np.uint64(RING)).astype(np.int64)]
    least = np.full(BANDS * ROWS, RING, np.uint32)
    for start in range(0, len(places), 1024):
        np.minimum(least, stretches[places[start : start + 1024]].min(0), out=least)
    return least


def band_keys(values: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band."""
    rows = values.reshape(BANDS, ROWS).astype(np.uint64)
    keys = np.arange(1, BANDS + 1, dtype=np.uint64) * _MULTIPLIER
    for i in range(ROWS):
        keys = (keys ^ rows[:, i]) * _MULTIPLIER
        keys ^= keys >> np.uint64(29)
    return keys.view(np.int64)


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    values = np.concatenate(parts).view(np.int64) if parts else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, n_shingles, digest, bands); digest and bands are NULL without shingles."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, bands = [], [], []
            for text in batch.column(1):
                found = shingle_set(text.as_py(), size)
                counts.append(len(found))
                digests.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                bands.append(band_keys(signature(found)).tolist() if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "digest", "bands"],
            )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(sketch, "doc_id long, n_shingles long, digest binary, bands array<long>")


def sets_of(docs: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """(node, shingles) of the documents in ``ids`` (node); the texts stay where they are read."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                found = [shingle_set(t.as_py(), size) for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), _lists(found)], names=["node", "shingles"])

    texts = docs.select(F.col("doc_id").cast("long").alias("node"), F.col("text").cast("string").alias("text"))
    if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        return texts.join(F.broadcast(ids), "node", "left_semi").mapInArrow(make, "node long, shingles array<long>")
    # A sketch of the ids goes to the texts; of the sets that are made, those of other ids go again.
    made = chance_members(texts, ids, ["node"]).mapInArrow(make, "node long, shingles array<long>")
    return made.join(ids, "node", "left_semi")


def _similar(a, b):
    """Whether 100 * |A and B| >= 80 * |A or B|, as a condition on array columns."""
    both = F.size(F.array_intersect(a, b))
    return 100 * both >= PERCENT * (F.size(a) + F.size(b) - both)


def _link_blocks(table: pa.Table) -> pa.Table:
    """Links between members of different components in one pair of blocks, a forest of them."""
    order = np.argsort(table["node"].to_numpy(), kind="stable")
    table = table.take(pa.array(order))
    nodes, labels = table["node"].to_numpy(), table["component"].to_numpy().copy()
    block, same = table["block"].to_numpy(), table["low"][0].as_py() == table["high"][0].as_py()
    bands = table["bands"].combine_chunks().flatten().to_numpy().reshape(len(nodes), BANDS)
    lists = table["shingles"].combine_chunks()
    offsets, values = lists.offsets.to_numpy(), lists.flatten().to_numpy()
    offsets = offsets - offsets[0]
    sizes = np.diff(offsets)
    band = int(np.argmax((bands == table["key"][0].as_py()).all(0)))
    kinds, counts = np.unique(labels, return_counts=True)
    large = labels == kinds[np.argmax(counts)]  # tested by the others, not among themselves
    places = np.arange(len(nodes))
    links = []
    for i in np.flatnonzero(~large):
        others = labels != labels[i]
        if not same:
            others &= block != block[i]
        # Of two members that are both tested, the one that comes first tests.
        others &= large | (places > i)
        others &= 100 * np.minimum(sizes, sizes[i]) >= PERCENT * np.maximum(sizes, sizes[i])
        at = np.flatnonzero(others)
        # A pair is tested in the first band that it shares.
        at = at[np.argmax(bands[at] == bands[i], axis=1) == band] if len(at) else at
        own = np.sort(values[offsets[i] : offsets[i + 1]])
        for j in at:
            if labels[j] == labels[i]:
                continue
            other = values[offsets[j] : offsets[j + 1]]
            found = np.searchsorted(own, other)
            both = int(np.count_nonzero(own[np.minimum(found, len(own) - 1)] == other))
            if 100 * both >= PERCENT * (len(own) + len(other) - both):
                links.append((nodes[i], nodes[j]))
                labels[labels == labels[j]] = labels[i]
    return pa.table({"a": pa.array([x[0] for x in links], pa.int64()), "b": pa.array([x[1] for x in links], pa.int64())})


def _blocks(members, shingles):
    """How many blocks so many members with so many shingles in all are dealt into."""
    return F.ceil(F.greatest(members / BLOCK_MEMBERS, shingles / BLOCK_SHINGLES)).cast("int")


def document_groups(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    bound_batches(docs.sparkSession)
    drawn = cut(sketches(docs, size))
    some = drawn.where("digest IS NOT NULL AND doc_id IS NOT NULL")
    classes = some.groupBy("digest").agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands"), F.first("n_shingles").alias("n"))
    nodes = cut(classes)

    banded = nodes.select("node", "n", F.explode("bands").alias("key"))
    leader = F.min(F.struct(F.xxhash64("node", "key").alias("order"), "node")).getField("node")
    buckets = cut(banded.groupBy("key").agg(F.count(F.lit(1)).alias("members"), leader.alias("leader"), F.sum("n").alias("n")).where("members > 1"))
    together = cut(banded.withColumnRenamed("n", "size").join(buckets, "key"))
    pairs = cut(together.where("node != leader").select("node", "leader").distinct())
    wanted = pairs.select("node").unionByName(pairs.select(F.col("leader").alias("node"))).distinct()
    sets = cut(sets_of(docs, wanted, size))
    led = sets.select(F.col("node").alias("leader"), F.col("shingles").alias("led"))
    starred = pairs.join(sets, "node").join(led, "leader").where(_similar(F.col("shingles"), F.col("led")))
    links = cut(starred.select(F.col("node").alias("a"), F.col("leader").alias("b")))
    reached = components(links)

    # Buckets of several components: the rest beside the largest component, in blocks, against all blocks.
    labelled = together.join(reached, "node", "left").withColumn("component", F.coalesce("component", "node"))
    shares = labelled.groupBy("key", "component").agg(F.count(F.lit(1)).alias("in_it"), F.sum("size").alias("size_in_it"))
    largest = F.max(F.struct("in_it", "size_in_it", "component")).alias("largest")
    mixed = shares.groupBy("key").agg(F.count(F.lit(1)).alias("parts"), largest).where("parts > 1").select("key", "largest")
    members = labelled.join(mixed, "key").withColumn("rest", F.col("component") != F.col("largest.component"))
    rest_blocks = _blocks(F.col("members") - F.col("largest.in_it"), F.col("n") - F.col("largest.size_in_it"))
    members = members.withColumn("rest_blocks", rest_blocks)
    members = members.withColumn("main_blocks", _blocks(F.col("largest.in_it"), F.col("largest.size_in_it")))
    in_rest = F.pmod(F.xxhash64("node"), F.col("rest_blocks")).cast("int")
    in_main = F.col("rest_blocks") + F.pmod(F.xxhash64("node"), F.col("main_blocks")).cast("int")
    members = members.withColumn("block", F.when(F.col("rest"), in_rest).otherwise(in_main))
    met = F.when(F.col("rest"), F.col("rest_blocks") + F.col("main_blocks")).otherwise(F.col("rest_blocks"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), met - 1)))
    members = members.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    placed = members.select("key", "low", "high", "block", "node", "component")
    carried = placed.join(sets, "node").join(nodes.select("node", "bands"), "node")
    carried = carried.select("key", "low", "high", "block", "node", "component", "bands", "shingles")
    more = cut(carried.groupBy("key", "low", "high").applyInArrow(_link_blocks, "a long, b long"))
    last = components(links.unionByName(more))

    shared = some.groupBy("digest").agg(F.min("doc_id").alias("node"))
    grouped = shared.join(last, "node", "left").select("digest", F.coalesce("component", "node").alias("component"))
    joined = drawn.select("doc_id", "n_shingles", "digest").join(grouped, "digest", "left")
    return joined.select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
        (F.col("doc_id").isNull() | (F.col("doc_id") == F.coalesce("component", "doc_id"))).alias("kept"),
    )


def _numbered(docs: DataFrame, node: str) -> DataFrame:
    """The documents with a number each, in the order of their ids; stored if ids are missing or repeated."""
    own = docs["doc_id"].cast("long")
    counts = docs.groupBy(own.alias("id")).agg(F.count(F.lit(1)).alias("n"))
    if counts.where("id IS NULL OR n > 1").isEmpty():
        return docs.withColumn(node, own)
    return placed(docs, [F.asc_nulls_last("doc_id")], "near-duplicates", node)


def drop_near_duplicates(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """One document of each group, that of the least id, with all columns.

    Every row counts as a document: of rows that share an id, or have none, one stays of each group, too;
    rows without an id stay only if no row of their group has one.
    """
    node = unused(docs, "_node")
    numbered = _numbered(docs, node)
    groups = document_groups(numbered.select(F.col(node).alias("doc_id"), "text"), size)
    gone = cut(groups.where("NOT kept").select(F.col("doc_id").alias(node)))
    if gone.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        return numbered.join(F.broadcast(gone), node, "left_anti").drop(node)
    # Only documents that a sketch of those that go does not clear are shuffled.
    chance = unused(numbered, "_chance")
    marked = with_chance(numbered, key_bitmap(gone, [node]), [node], into=chance)
    rest = marked.where(chance).join(gone, node, "left_anti")
    return marked.where(~F.col(chance)).drop(node, chance).unionByName(rest.drop(node, chance))
