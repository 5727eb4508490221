"""Importance resampling: draw the documents whose words look like those of a target corpus.

Features are runs of 1 to ``longest`` consecutive words; each falls into one of ``buckets`` by crc32. A
bucket's gain says how much likelier the target is to use it than all documents are. A document's weight
is the floored mean gain of its features; its score adds Gumbel noise that follows from its id, so that
taking the highest scores draws documents without replacement in proportion to their likelihood ratio.

1. Words are found by bytes: a table of 256 bytes lower-cases A-Z and blanks all separators of the UTF-8
   text, ``split`` does the rest. Chained crc32 values extend a run by a word without building its text.
2. Each task counts its buckets in a ``Counter`` and gives one row per bucket; Spark adds these up. At
   most ``buckets`` counts a corpus reach the driver, where they become gains.
3. A second pass over the texts weighs each document; scores are Spark expressions. Only these narrow
   rows are kept (in a table of the shared folder) and ranked.
4. Ranks need no single task: counts of score cells, a bounded number, tell above which score the drawn
   ones lie; only those are sorted by ranges, and a range's first rank is the sum of the ranges before.

Texts are read in stretches of ``_STRETCH`` bytes, so a long one costs no more memory than its bytes.

Defined results: NULL or empty texts have no features, weight 0 and are never drawn. A NULL id counts as
empty text in the noise, and comes after other ids among equal scores. Rows that share an id are documents
of their own; fully equal ones get consecutive ranks in any order. Empty targets give gains too (all
counts 0); an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from foldcat.llm.ordering import ranked
from foldcat.llm.text import bound_batches, struct_udf
from foldcat.staging import stored

# 0-9, a-z and all bytes of other characters stay, A-Z are lowered, the rest parts words.
_KEEP = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
TABLE = bytes(b if b in _KEEP else b + 0x20 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))

LONGEST = 1
BUCKETS = 10_000
SEED = 2024
PERCENT = 10
LEAST_WORDS = 20
_STRETCH = 1 << 20
# Scores are counted in cells of this many values.
_CELL = 16


def _stretches(text: str) -> Iterator[list[bytes]]:
    """The words of a text, some at a time, cut only between words."""
    blanked = text.encode("utf-8", "surrogatepass").translate(TABLE)
    start = 0
    while start < len(blanked):
        end = blanked.find(b" ", start + _STRETCH)
        end = len(blanked) if end < 0 else end
        yield blanked[start:end].split()
        start = end


def count_features(text: str | None, longest: int = LONGEST) -> tuple[int, Counter[int]]:
    """The number of words, and how often each run's crc32 occurs.

    The crc32 of a run is that of the run without its last word, carried on over a space and that word.
    """
    n_words, counts, before = 0, Counter(), []
    for fresh in _stretches(text or ""):
        n_words += len(fresh)
        words = before + fresh
        runs = [crc32(word) for word in words]
        counts.update(runs[len(before) :])
        for size in range(2, longest + 1):
            # runs[i] covers size - 1 words from words[i]; those that end in an earlier stretch count there
            runs = [crc32(word, crc32(b" ", run)) for run, word in zip(runs, words[size - 1 :])]
            counts.update(runs[max(0, len(before) - size + 1) :])
        before = words[max(0, len(words) - longest + 1) :]
    return n_words, counts


def bucket_counts(texts: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> dict[int, int]:
    """How many features of all texts fall into each bucket; buckets without any are left out."""
    bound_batches(texts.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[int] = Counter()
        for batch in batches:
            for text in batch.column(0):
                for value, n in count_features(text.as_py(), longest)[1].items():
                    total[value % buckets] += n
        yield pa.RecordBatch.from_pydict(
            {"bucket": pa.array(total.keys(), pa.int32()), "n": pa.array(total.values(), pa.int64())}
        )

    counted = texts.select(F.col("text").cast("string")).mapInArrow(count, "bucket int, n long")
    return {r.bucket: r.n for r in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect()}


def gains(corpus: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> list[int]:
    """Of each bucket, a thousand times the log ratio of its smoothed shares, floored."""
    S, T = float(sum(corpus.values()) + buckets), float(sum(target.values()) + buckets)
    return [
        math.floor(1000 * math.log((target.get(b, 0) + 1) * S / ((corpus.get(b, 0) + 1) * T))) for b in range(buckets)
    ]


def _noise(seed: int) -> Column:
    """Gumbel noise in thousandths, from the first 32 bits of a digest of seed and id."""
    known = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    h = F.conv(F.left(F.sha2(F.concat(F.lit(f"{seed}:"), known), 256), F.lit(8)), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def weigh(
    docs: DataFrame, target: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS, seed: int = SEED
) -> DataFrame:
    """Rows (doc_id, n_words, n_features, weight, score), one per document."""
    gain = gains(bucket_counts(docs, longest, buckets), bucket_counts(target, longest, buckets), buckets)

    def of_text(text: str | None) -> tuple[int, int, int]:
        n_words, counts = count_features(text, longest)
        n_features = counts.total()
        weighed = sum(gain[value % buckets] * n for value, n in counts.items())
        return n_words, n_features, weighed // n_features if n_features else 0

    features = struct_udf(of_text, ["n_words", "n_features", "weight"], ["long", "long", "long"])
    weighed = docs.select("doc_id", features(F.col("text").cast("string")).alias("f")).select("doc_id", "f.*")
    return weighed.withColumn("score", F.col("weight") + _noise(seed))


def resample(
    docs: DataFrame,
    target: DataFrame,
    longest: int = LONGEST,
    buckets: int = BUCKETS,
    seed: int = SEED,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
) -> DataFrame:
    """One row per document: doc_id, n_features, weight, score, rank (NULL if not drawn).

    Of the documents with ``least_words`` words, ``percent`` of a hundred are drawn, rounded down.
    """
    scored = stored(weigh(docs, target, longest, buckets, seed), "importance")
    eligible = F.col("n_words") >= least_words
    cell = F.floor(F.col("score") / _CELL)
    # The cells are as many as scores are wide, about 10,000: logarithms of counts do not grow with rows.
    cells = scored.where(eligible).groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("n")).collect()
    drawn = sum(r.n for r in cells) * percent // 100
    lowest, taken = None, 0
    for r in sorted(cells, reverse=True):
        if taken >= drawn:
            break
        lowest, taken = r["cell"], taken + r.n
    columns = ["doc_id", "n_features", "weight", "score"]
    if lowest is None:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    near = eligible & (F.col("score") >= F.lit(lowest * _CELL))
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features")]
    tops = ranked(scored.where(near), order, "importance-ranked")
    kept = F.when(F.col("rank") <= drawn, F.col("rank"))
    rest = scored.where(~near).select(*columns, F.lit(None).cast("long").alias("rank"))
    return tops.select(*columns, kept.alias("rank")).unionByName(rest)
