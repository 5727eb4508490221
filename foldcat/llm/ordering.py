"""Total orders over all rows without a task that sees them all: sort by ranges, then number."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, functions as F

from foldcat.llm.text import unused
from foldcat.staging import stored

# monotonically_increasing_id: the number of the partition above, the place of the row in it below.
_PLACE_BITS = 33


def placed(rows: DataFrame, order: list[Column], label: str, at: str = "at") -> DataFrame:
    """The rows with a long ``at`` that increases in the given order, from a table of the shared folder.

    Ranges are sorted on their own. Rows that are equal in all of ``order`` are told apart by where they
    stood, so that a range of them can be split too; their order is arbitrary. What stands together in a
    range has consecutive numbers.
    """
    spread = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tie = unused(rows, "_tie")
    by = [*order, F.asc(tie)]
    apart = rows.withColumn(tie, F.monotonically_increasing_id())
    ranges = apart.repartitionByRange(spread, *by).sortWithinPartitions(*by).drop(tie)
    return stored(ranges.withColumn(at, F.monotonically_increasing_id()), label)


def ranked(rows: DataFrame, order: list[Column], label: str) -> DataFrame:
    """The rows with ``rank`` = 1, 2, 3, ... in the given order.

    The first rank of a range is the number of rows in the ranges before; a count for each range reaches
    the driver.
    """
    place, part, before = (unused(rows, name) for name in ("_at", "_part", "_before"))
    at = placed(rows, order, label, place).withColumn(part, F.shiftrightunsigned(place, _PLACE_BITS))
    sizes = sorted(at.groupBy(part).agg(F.count(F.lit(1)).alias("n")).collect())
    firsts = accumulate((r.n for r in sizes), initial=0)
    starts = [(r[0], first) for r, first in zip(sizes, firsts)]
    ranges = rows.sparkSession.createDataFrame(starts, f"{part} long, {before} long")
    in_range = F.col(place).bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    joined = at.join(F.broadcast(ranges), part)
    return joined.withColumn("rank", F.col(before) + in_range + 1).drop(place, part, before)
