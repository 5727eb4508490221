"""Reuse of metadata that is already known for equal content."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldcat.functions.catalogue import stamp
from foldcat.operators.lookup import BOUNDED_ROWS, HASH_PARTS, lookup
from foldcat.schemas import CONTENT_KEY, EXTRACTED

_TWIN = "_twin"


def distinct_hashes(files: DataFrame) -> DataFrame:
    return files.select(CONTENT_KEY).distinct()


def matching_rows(
    batch: DataFrame, extracted: DataFrame, batch_rows: int | None = None
) -> DataFrame:
    """All extracted rows whose content occurs in the batch.

    ``batch_rows`` is a proven bound on the batch (its budget). Under it the batch's hashes are
    broadcast, so the extracted table is only filtered where it lies; otherwise hot hashes are split.
    """
    hashes = distinct_hashes(batch)
    if batch_rows is not None and batch_rows <= BOUNDED_ROWS:
        return extracted.join(F.broadcast(hashes), CONTENT_KEY, "left_semi")
    return lookup(extracted, hashes, "left_semi")


def representatives(extracted: DataFrame) -> DataFrame:
    """One extracted row per hash: the earliest, then the first by name.

    An aggregate, not a ranking: every map task sends at most one row per hash.
    """
    payload = [name for name in extracted.columns if name != CONTENT_KEY]
    chosen = F.min_by(F.struct(*payload), F.struct("created_at", "name")).alias("_row")
    return extracted.groupBy(CONTENT_KEY).agg(chosen).select(CONTENT_KEY, "_row.*")


def known_twins(batch: DataFrame, extracted: DataFrame, batch_rows: int | None = None) -> DataFrame:
    """One extracted row for each hash of the batch that has any.

    For a bounded batch the extracted table is filtered before it is aggregated. Otherwise it is
    aggregated first: its partial results and the batch's hashes then meet in one shuffle each, with
    one row per hash on both sides.
    """
    if batch_rows is not None and batch_rows <= BOUNDED_ROWS:
        return representatives(matching_rows(batch, extracted, batch_rows))
    return representatives(extracted).join(distinct_hashes(batch), CONTENT_KEY, "left_semi")


def carry_metadata(
    batch: DataFrame, known: DataFrame, as_of: str | None = None, parts: int = HASH_PARTS
) -> DataFrame:
    """Batch files with a known twin: their own name, everything else from the twin.

    Size, class and status are the twin's too, so a recorded error is carried and not tried again.
    """
    metadata = known.drop("name", "created_at")
    found = lookup(batch.select("name", CONTENT_KEY), metadata, "inner", parts)
    return found.withColumn("created_at", stamp(as_of)).select(*EXTRACTED.names)


def remaining_files(batch: DataFrame, known: DataFrame, parts: int = HASH_PARTS) -> DataFrame:
    """Batch files whose content nobody has processed."""
    return lookup(batch, known.select(CONTENT_KEY), "left_anti", parts)


def match_twins(batch: DataFrame, known: DataFrame, parts: int = HASH_PARTS) -> DataFrame:
    """Batch files beside what is known for their content, NULL if nothing is.

    One join for both kinds of files: store it, then split it by ``carried`` and ``unmatched``, which
    give the rows of ``carry_metadata`` and ``remaining_files``.
    """
    own = ("name", CONTENT_KEY, "created_at")
    metadata = F.struct(*[name for name in known.columns if name not in own])
    return lookup(batch, known.select(CONTENT_KEY, metadata.alias(_TWIN)), "left", parts)


def carried(matched: DataFrame, as_of: str | None = None) -> DataFrame:
    found = matched.filter(F.col(_TWIN).isNotNull()).select("name", CONTENT_KEY, f"{_TWIN}.*")
    return found.withColumn("created_at", stamp(as_of)).select(*EXTRACTED.names)


def unmatched(matched: DataFrame) -> DataFrame:
    return matched.filter(F.col(_TWIN).isNull()).drop(_TWIN)
