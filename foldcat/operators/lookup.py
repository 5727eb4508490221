"""Joins on the content hash that hold up when one hash has a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldcat.schemas import CONTENT_KEY

# What says that the rows of a hash may be split; 1 says that they are proven to be few.
HASH_PARTS = 64
# A frame proven to have no more rows than this may be broadcast, or left unsplit in a shuffle.
BOUNDED_ROWS = 100_000
# A hash with more rows is split into parts of about so many.
ROWS_PER_PART = 100_000
# The most frequent hashes that are looked at. Any other has less than a thousandth of all rows.
_HOTTEST, _TRACKED = 1_000, 32_768

_PART, _PARTS = "_part", "_parts"


def hot_hashes(files: DataFrame, rows_per_part: int | None = None) -> list[tuple[str, int]]:
    """The hashes of more than ``rows_per_part`` rows, each with the number of parts to split it into.

    One pass with a sketch of frequent items, of bounded size in each task; no hash is shuffled.
    """
    most = ROWS_PER_PART if rows_per_part is None else rows_per_part
    sketch = F.expr(f"approx_top_k({CONTENT_KEY}, {_HOTTEST}, {_TRACKED})")
    found = files.select(sketch.alias("found")).first().found
    return [(r["item"], -(-r["count"] // most)) for r in found if r["item"] is not None and r["count"] > most]


def lookup(left: DataFrame, right: DataFrame, how: str, parts: int = HASH_PARTS) -> DataFrame:
    """``left.join(right, "hash", how)`` for how = inner, left, left_semi or left_anti.

    ``left`` may hold any number of rows per hash; ``right`` has few (usually one). With ``parts > 1``
    the hashes that have very many rows in ``left`` are found first. Their rows are split by name into
    parts in proportion to their number, and their rows of ``right`` are copied to these parts; rows of
    other hashes are neither split nor copied. So no task gets a whole hot hash, and only the list of
    hot hashes, which is bounded, is broadcast. As ``left`` is used twice, store it first if it is costly
    to compute.
    """
    hot = hot_hashes(left) if parts > 1 else []
    if not hot:
        return left.join(right, CONTENT_KEY, how)
    known = F.broadcast(left.sparkSession.createDataFrame(hot, f"{CONTENT_KEY} string, {_PARTS} int"))
    counts = F.coalesce(_PARTS, F.lit(1))
    part = F.pmod(F.xxhash64("name"), counts).cast("int")
    split = left.join(known, CONTENT_KEY, "left").withColumn(_PART, part).drop(_PARTS)
    every = F.explode(F.sequence(F.lit(0), counts - 1))
    copied = right.join(known, CONTENT_KEY, "left").withColumn(_PART, every).drop(_PARTS)
    return split.join(copied, [CONTENT_KEY, _PART], how).drop(_PART)


def parts_for(rows: int | None) -> int:
    """Whether to split, given a proven bound on the rows of the left side (None = unbounded)."""
    return 1 if rows is not None and rows <= BOUNDED_ROWS else HASH_PARTS
