"""How many different contents each prefix has had, kept over syncs without the listings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldcat.schemas import CONTENT_KEY

# Registers are 2 to this power, 16 KiB a sketch at most: the error is about 0.8 % (one sigma).
PRECISION = 14


def content_sketches(files: DataFrame, length: int = 1, precision: int = PRECISION) -> DataFrame:
    """(prefix, files, contents): of a listing, how many files a prefix has, and a sketch of their hashes."""
    return files.groupBy(F.substring("name", 1, length).alias("prefix")).agg(
        F.count(F.lit(1)).alias("files"), F.hll_sketch_agg(CONTENT_KEY, precision).alias("contents")
    )


def merged_sketches(sketches: DataFrame) -> DataFrame:
    """One row per prefix for any number of sketches of it; ``files`` is that of all listings together."""
    return sketches.groupBy("prefix").agg(F.sum("files").alias("files"), F.hll_union_agg("contents").alias("contents"))


def count_contents(sketches: DataFrame) -> DataFrame:
    """(prefix, files, contents): the estimated number of different contents that each prefix has had."""
    merged = merged_sketches(sketches)
    return merged.select("prefix", "files", F.hll_sketch_estimate("contents").alias("contents"))
