"""One file per content, and back from one result to all files with that content."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldcat.functions.catalogue import stamp
from foldcat.operators.lookup import HASH_PARTS, lookup
from foldcat.schemas import CONTENT_KEY, EXTRACTED, LISTING


def one_per_hash(files: DataFrame) -> DataFrame:
    """One file per hash: benign before malicious, then the first by name.

    With this order one pass over both classes gives what a benign run followed by a malicious one
    would give.
    """
    columns = [name for name in LISTING.names if name != CONTENT_KEY]
    chosen = F.min(F.struct("malicious", "name", "size")).alias("_row")
    picked = files.groupBy(CONTENT_KEY).agg(chosen)
    return picked.select(CONTENT_KEY, *[f"_row.{name}" for name in columns]).select(*LISTING.names)


def fan_out(
    files: DataFrame, parsed: DataFrame, as_of: str | None = None, parts: int = HASH_PARTS
) -> DataFrame:
    """Every file with the result for its content; size and class are those of the parsed file."""
    metadata = parsed.drop("name", "created_at")
    spread = lookup(files.select("name", CONTENT_KEY), metadata, "left", parts)
    return spread.withColumn("created_at", stamp(as_of)).select(*EXTRACTED.names)
