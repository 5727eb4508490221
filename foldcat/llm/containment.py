"""Benchmark decontamination: which short test items are contained in long documents.

A document is contaminated by an item if it holds at least 80 % of the item's different five-word
shingles. An item of fewer words is one shingle of all its words; one without words is never found.
Words are runs of letters and digits, in lower case.

1. Only shingles that some item has can matter: document shingles are joined with the items' shingles
   as text, which changes no containment. What is left is small where there is no leak.
2. Items are partitioned by size into classes of powers of two. For each class the documents' left
   shingles fall into overlapping windows of twice the class's size, so that a short item in a long
   document is compared with something of its own size.
3. Windows and items get MinHash values; one equal value makes a candidate. A window with 80 % of an item
   has a similarity of 0.3 or so with it, and is found with a probability of over 0.999.
4. What a window cannot show is an item whose shingles stand far apart, or among many of other items. So
   every document that holds one of an item's keys, and is no candidate for it yet, becomes one. Of n
   shingles, 80 % of which a document must hold, any 20 % and one more include one that it holds: the keys
   are those that the fewest documents hold. No contained item is missed.
5. Candidates are verified by their exact shingle containment over the whole document.

Everything runs as DataFrame expressions. Small tables of items are broadcast, after their rows are
counted; beyond the bound the same joins are shuffled, the documents' shingles after a sketch of the items'
of fixed size has left out most. No text is shuffled, but that of documents which the last stage may drop.
A passage that a third of all documents holds is joined by (document, shingle) and never gathered.

Documents are told apart by a digest of id and text, so rows that share an id, NULL too, are judged by
their own text, and rows equal in both alike.

Defined results: NULL or empty texts hold nothing. Equal items are all reported. Other columns are not
read. An empty benchmark leaves all documents clean; an empty table gives no rows. A text is used whole.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from foldcat.llm.text import unused
from foldcat.operators.membership import chance_members, key_bitmap, with_chance
from foldcat.staging import cut

SHINGLE = 5
PERCENT = 80
HASHES = 32
# Tables of items and of flagged documents are sent to all executors up to this many rows.
BROADCAST_ROWS = 1_000_000


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def shingles_of(text: Column, sizes: list[int]) -> Column:
    """All word shingles of the given sizes, in text order for each size."""

    def of_size(words: Column, size: int) -> Column:
        def at(i: Column) -> Column:
            return F.concat_ws(" ", *[F.get(words, i + k) for k in range(size)])

        starts = F.sequence(F.lit(0), F.size(words) - size)
        return F.when(F.size(words) >= size, F.transform(starts, at)).otherwise(F.array().cast("array<string>"))

    # The words are made once and bound to a variable.
    return F.transform(F.array(words_of(text)), lambda w: F.concat(*[of_size(w, s) for s in sizes]))[0]


def document_key(docs: DataFrame) -> Column:
    """16 bytes that tell documents apart by id and text."""
    known = F.coalesce(docs["doc_id"].cast("string"), F.lit("null"))
    return F.unhex(F.md5(F.concat(known, F.lit(":"), F.coalesce(docs["text"].cast("string"), F.lit("")))))


def _maybe_broadcast(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def _minima(shingle: str) -> list[Column]:
    return [F.min(F.xxhash64(F.lit(i), F.col(shingle))).alias(f"m{i}") for i in range(HASHES)]


def _values() -> Column:
    return F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"m{i}").alias("value")) for i in range(HASHES)]))


def item_keys(once: DataFrame, item_shingles: DataFrame, item_sizes: DataFrame) -> DataFrame:
    """(item_id, shingle): of each item the shingles that the fewest documents hold, one more than may be missing."""
    held = once.groupBy("shingle").agg(F.count(F.lit(1)).alias("docs"))
    counted = item_shingles.join(_maybe_broadcast(held), "shingle", "left").join(item_sizes.select("item_id", "n_shingles"), "item_id")
    by_docs = Window.partitionBy("item_id").orderBy(F.coalesce("docs", F.lit(0)), "shingle")
    ranked = counted.withColumn("rank", F.row_number().over(by_docs))
    needed = F.ceil(F.col("n_shingles") * PERCENT / 100)
    return cut(ranked.where((F.col("rank") <= F.col("n_shingles") - needed + 1) & F.col("docs").isNotNull()).select("item_id", "shingle"))


def _known_shingles(held: DataFrame, item_shingles: DataFrame) -> DataFrame:
    """The shingles of documents that some item has. Where these are too many to send, a sketch of them is."""
    known = item_shingles.select("shingle").distinct()
    if known.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return held.join(F.broadcast(known), "shingle")
    return chance_members(held, known, ["shingle"]).join(known, "shingle")


def candidates(docs: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame] | None:
    """Candidates (key, item_id, windowed), items' shingles and sizes, and documents' shingles of items.

    ``windowed`` tells those that MinHash values of windows show from those by keys of items. None if no
    item has a word.
    """
    words = items.select("item_id", words_of(F.col("text").cast("string")).alias("words")).where(F.size("words") > 0)
    lengths = words.select(F.least(F.size("words"), F.lit(SHINGLE)).alias("k")).distinct()
    sizes = sorted(r.k for r in lengths.collect())  # at most SHINGLE numbers
    if not sizes:
        return None
    own = F.transform(F.array("words"), lambda w: F.concat_ws(" ", w))
    parts = F.when(F.size("words") >= SHINGLE, shingles_of(F.concat_ws(" ", "words"), [SHINGLE])).otherwise(F.transform(own, lambda s: s))
    item_shingles = cut(words.select("item_id", F.explode(parts).alias("shingle")).distinct())
    item_sizes = item_shingles.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_shingles"), *_minima("shingle"))
    item_sizes = cut(item_sizes.withColumn("class", F.ceil(F.log2("n_shingles")).cast("int")))
    classes = sorted(r["class"] for r in item_sizes.select("class").distinct().collect())  # one a power of two

    texts = docs.select(document_key(docs).alias("key"), docs["text"].cast("string").alias("text"))
    held = texts.select("key", F.posexplode(shingles_of(F.col("text"), sizes)).alias("at", "shingle"))
    left = cut(_known_shingles(held, item_shingles))

    # Windows of class c have 2^(c+1) places, one every 2^c.
    places = []
    least = F.lit(1)
    for c in classes:
        nth = F.floor(F.col("at") / F.lit(2**c)).cast("int")
        places += [F.struct(F.lit(c).alias("class"), (nth - back).alias("window")) for back in (0, 1)]
        smallest = 2 ** (c - 1) + 1 if c else 1
        least = F.when(F.col("class") == c, F.lit(math.ceil(smallest * PERCENT / 100))).otherwise(least)
    windows = left.select("key", "shingle", F.explode(F.array(*places)).alias("place")).select("key", "shingle", "place.*")
    signed = windows.groupBy("key", "class", "window").agg(F.count(F.lit(1)).alias("n"), *_minima("shingle"))
    signed = signed.where(F.col("n") >= least)  # fewer cannot be 80 % of the smallest item of the class
    values = signed.select("key", "class", _values().alias("v")).select("key", "class", "v.*").distinct()
    item_values = item_sizes.select("item_id", "class", _values().alias("v")).select("item_id", "class", "v.*")
    near = values.join(_maybe_broadcast(item_values), ["class", "i", "value"]).select("key", "item_id", F.lit(True).alias("windowed"))
    once = cut(left.select("key", "shingle").distinct())
    keys = item_keys(once, item_shingles, item_sizes)
    holding = once.join(_maybe_broadcast(keys), "shingle").select("key", "item_id", F.lit(False).alias("windowed"))
    found = near.union(holding).groupBy("key", "item_id").agg(F.max("windowed").alias("windowed"))
    return found, item_shingles, item_sizes.select("item_id", "n_shingles"), once


def contained_items(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(key, item_id, overlap, n_shingles, windowed) for every item that a document contains; see ``document_key``."""
    made = candidates(docs, items)
    if made is None:
        return docs.sparkSession.createDataFrame([], "key binary, item_id long, overlap long, n_shingles long, windowed boolean")
    found, item_shingles, item_sizes, once = made
    wanted = found.join(_maybe_broadcast(item_shingles), "item_id")
    met = wanted.join(once, ["key", "shingle"], "left_semi")
    counted = met.groupBy("key", "item_id").agg(F.count(F.lit(1)).alias("overlap"), F.first("windowed").alias("windowed"))
    sized = counted.join(_maybe_broadcast(item_sizes), "item_id")
    contained = sized.where(100 * F.col("overlap") >= PERCENT * F.col("n_shingles"))
    return contained.select("key", "item_id", "overlap", "n_shingles", "windowed")


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document: doc_id, contaminated, kept, n_items, item_ids (joined by commas)."""
    found = contained_items(docs, items).groupBy("key").agg(F.sort_array(F.collect_set("item_id")).alias("item_ids"))
    joined = docs.select("doc_id", document_key(docs).alias("key")).join(found, "key", "left")
    hit = F.col("item_ids").isNotNull()
    return joined.select(
        "doc_id",
        hit.alias("contaminated"),
        (~hit).alias("kept"),
        F.when(hit, F.size("item_ids")).otherwise(0).cast("long").alias("n_items"),
        F.when(hit, F.array_join("item_ids", ",")).otherwise("").alias("item_ids"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that contain no item, with all their columns."""
    flagged = cut(contained_items(docs, items).select("key").distinct())
    own = unused(docs, "document_key")
    keyed, flagged = docs.withColumn(own, document_key(docs)), flagged.withColumnRenamed("key", own)
    if flagged.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return keyed.join(F.broadcast(flagged), own, "left_anti").drop(own)
    # Only documents that a sketch of the flagged ones does not clear are shuffled.
    chance = unused(docs, "document_chance")
    marked = with_chance(keyed, key_bitmap(flagged, [own]), [own], into=chance)
    clear = marked.where(~F.col(chance))
    rest = marked.where(chance).join(flagged, own, "left_anti")
    return clear.drop(own, chance).unionByName(rest.drop(own, chance))
