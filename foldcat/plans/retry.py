"""Trying failed contents again, with a ledger of attempts between runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldcat.functions.catalogue import stamp
from foldcat.operators.content import one_per_hash
from foldcat.operators.lookup import lookup
from foldcat.schemas import CONTENT_KEY, EXTRACTED, LISTING, enforce_schema
from foldcat.sources.objects import Extract
from foldcat.staging import stored

# One row per content that failed and was tried again: how often in all, and when last.
LEDGER = T.StructType(
    [
        T.StructField("hash", T.StringType(), False),
        T.StructField("attempts", T.IntegerType(), False),
        T.StructField("last_tried", T.TimestampType(), False),
    ]
)

FIRST_WAIT = 3_600
MOST_ATTEMPTS = 6


def failed_contents(extracted: DataFrame, ledger: DataFrame) -> DataFrame:
    """One row per content whose files are recorded as errors: hash, attempts, last_tried.

    A content that the ledger does not know was tried once, when its first row was recorded.
    """
    errors = extracted.filter("status = 'ERROR'").groupBy(CONTENT_KEY).agg(F.min("created_at").alias("_recorded"))
    return errors.join(ledger, CONTENT_KEY, "left").select(
        CONTENT_KEY,
        F.coalesce("attempts", F.lit(1)).alias("attempts"),
        F.coalesce("last_tried", "_recorded").alias("last_tried"),
    )


def due_contents(
    extracted: DataFrame,
    ledger: DataFrame,
    as_of: str | None = None,
    first_wait: int = FIRST_WAIT,
    most_attempts: int = MOST_ATTEMPTS,
) -> DataFrame:
    """Failed contents whose wait is over: ``first_wait`` seconds, doubled after every attempt but the first."""
    wait = F.lit(first_wait) * F.pow(F.lit(2.0), F.col("attempts") - 1)
    over = F.col("last_tried").cast("long") + wait <= stamp(as_of).cast("long")
    return failed_contents(extracted, ledger).filter((F.col("attempts") < most_attempts) & over)


def retry_errors(
    extracted: DataFrame,
    ledger: DataFrame,
    extract: Extract,
    as_of: str | None = None,
    first_wait: int = FIRST_WAIT,
    most_attempts: int = MOST_ATTEMPTS,
) -> tuple[DataFrame, DataFrame]:
    """The result table and the ledger after one more attempt at every content that is due.

    Each such content is extracted once. If that succeeds, all its error rows become results, at the place
    of the errors, so a file still has one row; if not, they stay as they are. Contents that succeeded
    leave the ledger. Write both as new snapshots.
    """
    due = stored(due_contents(extracted, ledger, as_of, first_wait, most_attempts), "due")
    files = lookup(extracted.filter("status = 'ERROR'").select(*LISTING.names), due.select(CONTENT_KEY), "left_semi")
    tried = stored(extract(one_per_hash(files), None), "retried")
    metadata = [name for name in tried.columns if name not in LISTING.names]
    fresh = tried.filter("status <> 'ERROR'").select(CONTENT_KEY, F.struct(*metadata).alias("_fresh"))
    joined = lookup(extracted, fresh, "left")
    again = F.col("_fresh").isNotNull() & (F.col("status") == "ERROR")
    replaced = [F.when(again, F.col(f"_fresh.{c}")).otherwise(F.col(c)).alias(c) for c in metadata]
    created = F.when(again, stamp(as_of)).otherwise(F.col("created_at")).alias("created_at")
    kept = [c for c in EXTRACTED.names if c not in metadata and c != "created_at"]
    after = enforce_schema(joined.select(*kept, *replaced, created), EXTRACTED)
    failed = due.join(fresh.select(CONTENT_KEY), CONTENT_KEY, "left_anti")
    failed = failed.select(CONTENT_KEY, (F.col("attempts") + 1).cast("int").alias("attempts"), stamp(as_of).alias("last_tried"))
    untouched = ledger.join(due.select(CONTENT_KEY), CONTENT_KEY, "left_anti")
    return after, enforce_schema(untouched.unionByName(failed), LEDGER)
