"""What is listed but not processed yet, and which part of it to take now."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foldcat.functions.catalogue import pick_key
from foldcat.operators.membership import BITS, anti_join
from foldcat.schemas import FILE_KEY
from foldcat.staging import stored

_KEY = "_pick"
_CELL = "_cell"
# Four hex digits of the pick key: at most 65,536 equally filled cells per class.
_CELL_DIGITS = 4
# Into how many parts what the map tasks send is merged before one task merges the parts.
_MERGES = 256
_MERGE = "_merge"


def of_class(files: DataFrame, malicious: bool) -> DataFrame:
    return files.filter(F.col("malicious") == F.lit(malicious))


def unprocessed(storage: DataFrame, extracted: DataFrame) -> DataFrame:
    """Listed files whose (name, hash) has no extracted row, whatever class that row has."""
    return storage.join(extracted.select(*FILE_KEY), FILE_KEY, "left_anti")


def unprocessed_prefiltered(storage: DataFrame, extracted: DataFrame, bits: int = BITS) -> DataFrame:
    """The same files. Those that a sketch of the results certainly lacks are not shuffled.

    For a listing most of which has no result yet; both tables are scanned twice.
    """
    return anti_join(storage, extracted, FILE_KEY, bits)


def first_files(files: DataFrame, num_files: int) -> DataFrame:
    """The first ``num_files`` in pick order, a total order, so the choice is repeatable."""
    return _first(files, num_files, [])


def first_files_per_class(files: DataFrame, num_files: int) -> DataFrame:
    """The first ``num_files`` of each class in pick order, in one pass over ``files``."""
    return _first(files, num_files, ["malicious"])


def unprocessed_batch(
    storage: DataFrame, extracted: DataFrame, malicious: bool, num_files: int
) -> DataFrame:
    """Up to ``num_files`` unprocessed files of one class."""
    return first_files(unprocessed(of_class(storage, malicious), extracted), num_files)


def balanced_batch(storage: DataFrame, extracted: DataFrame, num_files: int) -> DataFrame:
    """Half the budget for each class; an odd file and what a class leaves over are not used."""
    return first_files_per_class(unprocessed(storage, extracted), num_files // 2)


def _first(files: DataFrame, num_files: int, group: list[str]) -> DataFrame:
    """Up to the first ``num_files`` of each group; both ways give the same rows."""
    kept = files.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")
    if num_files > int(kept):  # beyond it Spark no longer drops rows before the shuffle
        return first_by_cells(files, num_files, group)
    return first_by_merging(files, num_files, group)


def first_by_merging(files: DataFrame, num_files: int, group: list[str]) -> DataFrame:
    """Every map task keeps its first files, 256 tasks merge these, and one per group merges the rest.

    A merging task gets ``num_files`` rows from each 256th map task, and the last at most 256 times
    ``num_files``, however many map tasks there are.
    """
    keyed = files.withColumn(_KEY, pick_key())
    keyed = keyed.withColumn(_MERGE, F.spark_partition_id() % F.lit(_MERGES))
    order = [_KEY, *FILE_KEY]
    within = Window.partitionBy(*group, _MERGE).orderBy(*order)
    merged = keyed.withColumn("_rank", F.row_number().over(within)).filter(F.col("_rank") <= num_files)
    if not group:
        return merged.orderBy(*order).limit(num_files).select(*files.columns)
    last = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return merged.withColumn("_rank", last).filter(F.col("_rank") <= num_files).select(*files.columns)


def first_by_cells(files: DataFrame, num_files: int, group: list[str]) -> DataFrame:
    """The same rows for a budget too large to rank in one task.

    Files are counted per cell of the pick key, the running count says how many files each cell may
    still give, and ranking happens inside cells only. The broadcast side has at most one row per
    cell and class. ``files`` are computed once and stored.
    """
    keyed = files.withColumn(_KEY, pick_key())
    keyed = stored(keyed.withColumn(_CELL, F.substring(_KEY, 1, _CELL_DIGITS)), "backlog")
    counts = keyed.groupBy(*group, _CELL).agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy(*group).orderBy(_CELL))
    room = counts.withColumn("_room", F.lit(num_files) - (upto - F.col("_n")))
    room = room.filter("_room > 0").select(*group, _CELL, "_room")
    within = Window.partitionBy(*group, _CELL).orderBy(_KEY, *FILE_KEY)
    ranked = keyed.join(F.broadcast(room), [*group, _CELL]).withColumn(
        "_rank", F.row_number().over(within)
    )
    return ranked.filter("_rank <= _room").select(*files.columns)
