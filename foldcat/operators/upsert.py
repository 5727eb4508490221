"""Keyed upsert of a listing into the catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldcat.schemas import FILE_KEY, STORAGE

_ORD = "_ord"


def fold_conflicts(incoming: DataFrame, order: str) -> DataFrame:
    """One row per file: size and class of its first row in ``order``, sync time of its last.

    Of rows in the same place the first has the smaller size, then is benign; the last has the later
    time.
    """
    folded = incoming.groupBy(*FILE_KEY).agg(
        F.min(F.struct(order, "size", "malicious")).alias("_first"),
        F.max(F.struct(order, "sync_time")).alias("_last"),
    )
    payload = ("_first.size", "_first.malicious", "_last.sync_time")
    return folded.select(*FILE_KEY, *payload).select(*STORAGE.names)


def upsert(target: DataFrame, incoming: DataFrame, order: str | None = None) -> DataFrame:
    """The catalogue after ``incoming`` was applied row by row in ``order``.

    New files are added; of a known file only the sync time changes; nothing is removed. The incoming
    rows are folded to one per file first and then meet the target, which has one row per file, in
    one join. A target bucketed by file identity is not shuffled for it.
    """
    position = F.lit(0) if order is None else F.col(order)
    rows = incoming.select(*STORAGE.names, position.cast("long").alias(_ORD))
    payload = [name for name in STORAGE.names if name not in FILE_KEY]
    new = fold_conflicts(rows, _ORD).select(*FILE_KEY, *[F.col(c).alias(f"_new_{c}") for c in payload])
    both = target.select(*STORAGE.names).join(new, FILE_KEY, "full_outer")
    return both.select(
        *FILE_KEY,
        F.coalesce("size", "_new_size").alias("size"),
        F.coalesce("malicious", "_new_malicious").alias("malicious"),
        F.coalesce("_new_sync_time", "sync_time").alias("sync_time"),
    ).select(*STORAGE.names)
