"""Extract metadata for files that have none yet, once per content."""

from __future__ import annotations

from pyspark.sql import DataFrame

from foldcat.operators.backlog import balanced_batch, unprocessed_batch
from foldcat.operators.content import fan_out, one_per_hash
from foldcat.operators.lookup import BOUNDED_ROWS, parts_for
from foldcat.operators.twins import carried, known_twins, match_twins, unmatched
from foldcat.schemas import EXTRACTED, enforce_schema
from foldcat.sources.objects import Extract
from foldcat.staging import stored


def dedup_extract(
    files: DataFrame, extract: Extract, as_of: str | None = None, rows: int | None = None
) -> DataFrame:
    """Extract one file per distinct content and give its result to every file with that content.

    ``rows`` is a proven bound on ``files``, None if there is none.
    """
    return fan_out(files, extract(one_per_hash(files), rows), as_of, parts_for(rows))


def incremental_extract(
    storage: DataFrame,
    extracted: DataFrame,
    extract: Extract,
    malicious: bool,
    num_files: int,
    as_of: str | None = None,
    retry_errors: bool = False,
) -> DataFrame:
    """Result rows for up to ``num_files`` unprocessed files of one class."""
    batch = unprocessed_batch(storage, extracted, malicious, num_files)
    return extract_batch(batch, extracted, extract, num_files, as_of, retry_errors)


def balanced_extract(
    storage: DataFrame,
    extracted: DataFrame,
    extract: Extract,
    num_files: int = 1000,
    as_of: str | None = None,
    retry_errors: bool = False,
) -> DataFrame:
    """Result rows for up to ``num_files // 2`` unprocessed files of each class."""
    batch = balanced_batch(storage, extracted, num_files)
    return extract_batch(batch, extracted, extract, 2 * (num_files // 2), as_of, retry_errors)


def extract_batch(
    batch: DataFrame,
    extracted: DataFrame,
    extract: Extract,
    rows: int,
    as_of: str | None = None,
    retry_errors: bool = False,
) -> DataFrame:
    """Result rows for a batch of at most ``rows`` files: carried from twins, or extracted.

    The batch, and the batch beside its twins, are computed once and kept: appending the result to
    ``extracted`` cannot change what later steps see, and each table is scanned once per use. The
    result is one frame, to be written in one append. It fails on a file that the extractor gave no
    result for. A recorded error is carried like any result; with ``retry_errors`` it is not, and files
    of that content are extracted (see ``plans.retry`` for rows that are recorded already).
    """
    if retry_errors:
        extracted = extracted.filter("status <> 'ERROR'")
    batch = stored(batch, "batch")
    if rows > BOUNDED_ROWS:
        rows = batch.count()  # a generous budget says little; the stored batch is quickly counted
    parts = parts_for(rows)
    matched = stored(match_twins(batch, known_twins(batch, extracted, rows), parts), "matched")
    parsed = dedup_extract(unmatched(matched), extract, as_of, rows)
    return enforce_schema(carried(matched, as_of).unionByName(parsed), EXTRACTED)
