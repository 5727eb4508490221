"""Document fingerprints by a threshold-scaled sketch: all shingle hashes below a fixed fraction.

A text's shingles are its runs of five consecutive words (fewer words: all of them as one), A-Z in lower
case. A shingle's hash is the first 16 hexadecimal digits of its md5; the fingerprint keeps the different
hashes below ``1 / FRACTION`` of their range, ascending. Whether a hash is kept depends on the hash alone,
so that

* fingerprints merge: that of a union is the union of fingerprints (``merged``), in any order;
* a text's part in another one (``containment``) is estimated without bias however unequal they are, as
  both keep the same share of what they have in common;
* a text as long as a book has a fingerprint in proportion, and loses no precision to its size.

A text with shingles, none of which is below, keeps its least one, so that only texts without words have
an empty fingerprint. In a merger, such a hash goes when another text brings one below.

Everything runs as DataFrame expressions. To pair each document with the next one, in descending order of
ids, only (id, digest) are sorted, by ranges. Texts are moved once, by digest, with their fingerprints,
and of the next text only that and as many characters as are used.

Defined results: a NULL or empty text has an empty fingerprint; two empty ones are alike (1), an empty one
and another are not (0). Rows of one id come by digest, NULL ids last. Rows equal in id and text are one
document here: all have the same next one, and the same result. A lone document is next to itself. Texts
are used whole. Other columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from foldcat.llm.ordering import ranked
from foldcat.staging import cut

SHINGLE = 5
# One of so many hashes is kept: a power of 16 or a multiple of one, see ``_below``.
FRACTION = 8
_DIGITS = 16
# Of the digest that tells documents apart.
_KEY_DIGITS = 32


def _below(fraction: int) -> Column:
    """The least hash that is not kept. Hashes have fixed width and so compare as text."""
    return F.lit(f"{16**_DIGITS // fraction:0{_DIGITS}x}")


def _words(text: Column) -> Column:
    lowered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_remove(F.split(lowered, r"[\x20\x09-\x0D]+"), "")


def shingle_hashes(text: Column, size: int = SHINGLE) -> Column:
    """The hashes of all shingles of a text, in text order."""

    def hashed(words: Column) -> Column:
        def at(i: Column) -> Column:
            return F.left(F.md5(F.concat_ws(" ", *[F.get(words, i + k) for k in range(size)])), F.lit(_DIGITS))

        last = F.greatest(F.size(words) - size, F.lit(0))
        return F.when(F.size(words) == 0, F.array().cast("array<string>")).otherwise(F.transform(F.sequence(F.lit(0), last), at))

    return F.transform(F.array(_words(F.coalesce(text, F.lit("")))), hashed)[0]


def sketch(hashes: Column, fraction: int = FRACTION) -> Column:
    """The sketch of all hashes of a text, or of several sketches' hashes together."""

    def least(every: Column) -> Column:
        kept = F.filter(every, lambda h: h < _below(fraction))
        bound = F.transform(F.array(kept), lambda k: F.when(F.size(k) > 0, k).otherwise(F.slice(F.array_sort(every), 1, 1)))[0]
        return F.array_sort(F.array_distinct(bound))

    return F.transform(F.array(hashes), least)[0]


def merged(a: Column, b: Column, fraction: int = FRACTION) -> Column:
    """The sketch of two texts together."""
    return sketch(F.concat(a, b), fraction)


def containment(own: Column, other: Column) -> Column:
    """The estimated share of a text's shingles that another text has."""
    share = F.size(F.array_intersect(own, other)) / F.size(own)
    return F.when(F.size(own) > 0, share).otherwise((F.size(other) == 0).cast("double"))


def jaccard(a: Column, b: Column) -> Column:
    """The estimated share of two texts' shingles that both have."""
    either = F.size(F.array_union(a, b))
    return F.when(either > 0, F.size(F.array_intersect(a, b)) / either).otherwise(F.lit(1.0))


def _packed(hashes: Column) -> Column:
    """Hashes as bytes, half as long as their digits."""
    return F.unhex(F.array_join(hashes, ""))


def _unpacked(packed: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.hex(packed)), F.lit(f".{{{_DIGITS}}}"), F.lit(0))


def _texts(docs: DataFrame, size: int, fraction: int) -> DataFrame:
    """(doc_id, key, text, packed): NULL texts are empty, the sketch is made where the text is read.

    The key is a digest of id and text that is never NULL, so that joins and groups by it share a shuffle.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    known = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    digest = F.unhex(F.left(F.sha2(F.concat(known, F.lit(":"), text), 256), F.lit(_KEY_DIGITS)))
    texts = docs.select("doc_id", F.coalesce(digest, F.lit(b"")).alias("key"), text.alias("text"))
    return texts.withColumn("packed", _packed(sketch(shingle_hashes(F.col("text"), size), fraction)))


def fingerprints(docs: DataFrame, size: int = SHINGLE, fraction: int = FRACTION) -> DataFrame:
    """One row per document: doc_id, hashes (its sketch)."""
    return _texts(docs, size, fraction).select("doc_id", _unpacked(F.col("packed")).alias("hashes"))


def next_documents(texts: DataFrame) -> DataFrame:
    """(doc_id, to, next, n_chars), by keys of documents: in descending order of ids, after the last the first."""
    ids = texts.select("doc_id", "key", F.length("text").cast("long").alias("n_chars")).distinct()
    order = cut(ranked(ids, [F.desc_nulls_last("doc_id"), F.asc("key")], "fingerprint-order"))
    total = order.count()
    after = order.select(F.col("key").alias("next"), F.col("rank").alias("next_rank"))
    pairs = order.join(after, F.col("rank") % max(total, 1) + 1 == F.col("next_rank"))
    return pairs.select("doc_id", F.col("key").alias("to"), "next", "n_chars")


def _joined(fingerprint: str) -> Column:
    return F.array_join(fingerprint, ",")


def compare_edited(docs: DataFrame, size: int = SHINGLE, fraction: int = FRACTION) -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and how alike they are.

    The edited text has the second half replaced by the beginning of the next document. ``near_edited`` and
    ``near_next`` are the document's estimated containment in its edited text and in the next document.
    """
    texts = _texts(docs, size, fraction)
    pairs = next_documents(texts)
    held = texts.drop("doc_id")  # both joins read the same columns, and so one shuffle
    half = F.floor(F.col("n_chars") / 2).cast("int")
    sent = held.join(pairs, held["key"] == pairs["next"]).select(
        "doc_id", "to", "n_chars", F.left("text", half).alias("lent"), F.col("packed").alias("next")
    )
    # Copies of the next document send the same.
    once = sent.groupBy("to").agg(*[F.first(c).alias(c) for c in ("doc_id", "n_chars", "lent", "next")])
    edited = F.concat(F.left("text", (F.col("n_chars") - half).cast("int")), "lent")
    both = held.join(once, held["key"] == once["to"]).select("doc_id", "n_chars", "packed", "next", edited.alias("edited"))
    made = both.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        _unpacked(F.col("packed")).alias("own"),
        sketch(shingle_hashes(F.col("edited"), size), fraction).alias("changed"),
        _unpacked(F.col("next")).alias("next"),
    )
    return made.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        _joined("own").alias("fingerprint"),
        _joined("changed").alias("edited_fingerprint"),
        containment(F.col("own"), F.col("changed")).alias("near_edited"),
        containment(F.col("own"), F.col("next")).alias("near_next"),
    )
