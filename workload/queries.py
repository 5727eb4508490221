"""The Spark side of every registered query: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from foldcat.functions.catalogue import content_id
from foldcat.functions.pe import pe_metadata
from foldcat.operators import backlog, content, integrity, twins
from foldcat.operators.contents import content_sketches, count_contents
from foldcat.operators.upsert import fold_conflicts, upsert
from foldcat.plans import extract as plans
from foldcat.plans.retry import retry_errors
from foldcat.plans.sync import sync
from foldcat.schemas import EXTRACTED, FILE_KEY, STORAGE
from foldcat.sources import tables
from foldcat.sources.bodies import extract_from_slots, save_slots
from foldcat.sources.listing import label_listing, list_objects
from foldcat.sources.objects import (
    extract_from_contents,
    extract_from_store,
    extract_rows,
    put_contents,
    verify_contents,
)
from foldcat.sources.partitioned import read_parts, sync_parts, upsert_parts
from foldcat.staging import cut, fresh_path, stored
from foldcat.streaming.pages import fold_pages, stream_inventory, stream_store, sync_pages, sync_store
from workload import inputs

# The budget of a run, half of it for each class; one file is left over. It binds on all given tables.
NUM_FILES = 201
# A budget beyond any backlog here: everything that waits is taken.
ALL_FILES = 2**31 - 1
# Objects in a page of the stream of keys, pages in a micro-batch, bytes in a part of a composite ETag, slots
# of the table of bodies.
KEYS_A_PAGE = 2_500
PAGES_AT_ONCE = 64
PART = 2_048
SLOTS = 64


def listing_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.storage(spark, sf_dir)


def class_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backlog.of_class(inputs.storage(spark, sf_dir), True).select("hash")


def unprocessed_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backlog.unprocessed(inputs.storage(spark, sf_dir), inputs.extracted(spark, sf_dir))


def unprocessed_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backlog.unprocessed_batch(
        inputs.storage(spark, sf_dir), inputs.extracted(spark, sf_dir), False, 100
    )


def balanced_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backlog.balanced_batch(
        inputs.storage(spark, sf_dir), inputs.extracted(spark, sf_dir), NUM_FILES
    )


def large_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of each class, ranked without a single-task step as for budgets of any size."""
    waiting = backlog.unprocessed(inputs.storage(spark, sf_dir), inputs.extracted(spark, sf_dir))
    return backlog.first_by_cells(waiting, 75, ["malicious"])


def distinct_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return twins.distinct_hashes(inputs.storage(spark, sf_dir))


def one_per_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content.one_per_hash(inputs.storage(spark, sf_dir))


def matching_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return twins.matching_rows(unprocessed_anti(spark, sf_dir), inputs.extracted(spark, sf_dir))


def representatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return twins.representatives(inputs.extracted(spark, sf_dir))


def carry_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = twins.representatives(inputs.extracted(spark, sf_dir))
    return twins.carry_metadata(unprocessed_anti(spark, sf_dir), known, inputs.AS_OF)


def remaining_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return twins.remaining_files(unprocessed_anti(spark, sf_dir), inputs.extracted(spark, sf_dir))


def fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = inputs.storage(spark, sf_dir)
    parsed = inputs.with_expected_metadata(content.one_per_hash(files))
    return content.fan_out(files, parsed, inputs.AS_OF)


def count_by_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.count_by_prefix(inputs.storage(spark, sf_dir))


def incoming_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fold_conflicts(inputs.resync(spark, sf_dir), "ord")


def upsert_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return upsert(inputs.catalogue_before(spark, sf_dir), inputs.resync(spark, sf_dir), "ord")


def integrity_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.integrity_violations(inputs.damaged_storage(spark, sf_dir), STORAGE)


def content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = inputs.table(spark, sf_dir, "documents")
    return documents.select(inputs.object_name().alias("name"), content_id("text").alias("hash"))


def pe_metadata_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pe_metadata(inputs.binaries(spark, sf_dir))


def pe_metadata_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth body is missing: its file gives no row."""
    bodies = inputs.binaries(spark, sf_dir)
    missing = F.col("name").endswith("7")
    return extract_rows(bodies.withColumn("content", F.when(~missing, F.col("content"))))


def dedup_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole backlog, without looking for known twins."""
    extract = extract_from_contents(inputs.binaries(spark, sf_dir))
    return plans.dedup_extract(cut(unprocessed_anti(spark, sf_dir)), extract, inputs.AS_OF)


def incremental_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole backlog of one class."""
    return plans.incremental_extract(
        inputs.storage(spark, sf_dir),
        inputs.extracted(spark, sf_dir),
        extract_from_contents(inputs.binaries(spark, sf_dir)),
        True,
        ALL_FILES,
        inputs.AS_OF,
    )


def incremental_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run of one class with a budget that binds."""
    return plans.incremental_extract(
        inputs.storage(spark, sf_dir),
        inputs.extracted(spark, sf_dir),
        extract_from_contents(inputs.binaries(spark, sf_dir)),
        False,
        99,
        inputs.AS_OF,
    )


def store_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run whose bodies lie in a store: executors write them there and read their headers."""
    root = fresh_path(spark, "store")
    batch = balanced_batch(spark, sf_dir).select("name")
    bodies = inputs.binaries(spark, sf_dir).join(batch, "name", "left_semi")
    cut(put_contents(bodies, root))
    return plans.balanced_extract(
        inputs.storage(spark, sf_dir),
        inputs.extracted(spark, sf_dir),
        extract_from_store(root),
        NUM_FILES,
        inputs.AS_OF,
    )


def object_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as objects of one folder, listed by ranges of keys."""
    root = fresh_path(spark, "objects")
    texts = inputs.texts(spark, sf_dir).withColumn("name", F.translate("name", "/", "-"))
    cut(put_contents(texts, root))
    return list_objects(spark, root, ["0", "1"], with_etag=True)


def keyed_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as objects, listed as a stream of pages by key and folded into the earlier catalogue."""
    root, log = fresh_path(spark, "objects"), fresh_path(spark, "pages")
    cut(put_contents(inputs.texts(spark, sf_dir), root))
    pages = stream_store(spark, root, KEYS_A_PAGE, pages=PAGES_AT_ONCE)
    sync_store(pages, log, fresh_path(spark, "offsets"), inputs.RESYNCED_AT)
    return fold_pages(inputs.catalogue_before(spark, sf_dir), log)


def verified_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which objects still have their listed ETag, some of two parts, after every tenth one changed."""
    root = fresh_path(spark, "objects")
    texts = inputs.texts(spark, sf_dir)
    changed = F.concat("content", F.lit(b"!"))
    cut(put_contents(texts.withColumn("content", F.when(F.col("name").endswith("3"), changed).otherwise(F.col("content"))), root))
    listed = texts.select("name", inputs.etag_of_parts("content", PART).alias("hash"))
    return verify_contents(listed, root, part_sizes=[PART]).select("name", "verified")


def slot_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run with the default budget over bodies that are laid out by slots of their name."""
    path = fresh_path(spark, "bodies")
    save_slots(inputs.binaries(spark, sf_dir), path, SLOTS)
    return plans.balanced_extract(
        inputs.storage(spark, sf_dir),
        inputs.extracted(spark, sf_dir),
        extract_from_slots(spark, path, SLOTS),
        NUM_FILES,
        inputs.AS_OF,
    )


def unprocessed_prefiltered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The backlog, of which certain misses are not shuffled."""
    return backlog.unprocessed_prefiltered(inputs.storage(spark, sf_dir), inputs.extracted(spark, sf_dir))


def _retried(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return retry_errors(
        inputs.extracted(spark, sf_dir),
        inputs.retry_ledger(spark, sf_dir),
        extract_from_contents(inputs.mended_binaries(spark, sf_dir)),
        inputs.AS_OF,
    )


def retried_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result table after contents that had failed were tried again, some of them mended."""
    return _retried(spark, sf_dir)[0]


def retry_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the ledger of attempts says after that."""
    return _retried(spark, sf_dir)[1]


def balanced_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run with the default budget."""
    return plans.balanced_extract(
        inputs.storage(spark, sf_dir),
        inputs.extracted(spark, sf_dir),
        extract_from_contents(inputs.binaries(spark, sf_dir)),
        NUM_FILES,
        inputs.AS_OF,
    )


def append_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result table after the default run was appended to it, read back."""
    path = fresh_path(spark, "extracted")
    tables.append_table(inputs.extracted(spark, sf_dir), path, EXTRACTED)
    known = tables.read_table(spark, path, EXTRACTED)
    extract = extract_from_contents(inputs.binaries(spark, sf_dir))
    result = plans.balanced_extract(
        inputs.storage(spark, sf_dir), known, extract, NUM_FILES, inputs.AS_OF
    )
    tables.append_table(result, path, EXTRACTED)
    return tables.read_table(spark, path, EXTRACTED)


def sync_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = inputs.catalogue_before(spark, sf_dir)
    return sync(before, inputs.listing(spark, sf_dir), inputs.RESYNCED_AT)


def microbatch_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listing as a stream of pages, folded into the earlier catalogue."""
    log, inventory = fresh_path(spark, "pages"), fresh_path(spark, "inventory")
    listed = inputs.listing(spark, sf_dir)
    listed.repartition(4, "Key").write.parquet(inventory)
    pages = stream_inventory(spark, inventory, files_per_page=1)
    query = sync_pages(pages, log, fresh_path(spark, "offsets"), inputs.RESYNCED_AT)
    query.awaitTermination()
    return fold_pages(inputs.catalogue_before(spark, sf_dir), log)


def partitioned_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue in parts, synced in place: only the parts that a listing touches are rewritten."""
    path = fresh_path(spark, "catalogue")
    upsert_parts(spark, path, inputs.catalogue_before(spark, sf_dir), parts=SLOTS)
    sync_parts(spark, path, inputs.listing(spark, sf_dir), inputs.RESYNCED_AT, parts=SLOTS)
    return read_parts(spark, path)


def contents_by_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From sketches of two listings: files of both, and whether the number of contents is right to 2 %."""
    before = inputs.catalogue_before(spark, sf_dir)
    listings = [before, inputs.storage(spark, sf_dir)]
    sketches = [stored(content_sketches(files), "sketches") for files in listings]
    counted = count_contents(sketches[0].unionByName(sketches[1]))
    both = listings[0].select("name", "hash").unionByName(listings[1].select("name", "hash"))
    exact = both.groupBy(F.substring("name", 1, 1).alias("prefix")).agg(F.count_distinct("hash").alias("exact"))
    close = F.abs(F.col("contents") - F.col("exact")) <= 0.02 * F.col("exact")
    return counted.join(exact, "prefix").select("prefix", "files", "exact", close.alias("close"))


def relabelled_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only one prefix is listed: files of the other one are left out."""
    return label_listing(inputs.listing(spark, sf_dir), {"1": True}).select(*FILE_KEY, "malicious")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "listing_catalogue": listing_catalogue,
    "one_prefix_listing": relabelled_listing,
    "class_filter": class_filter,
    "unprocessed_anti": unprocessed_anti,
    "unprocessed_batch": unprocessed_batch,
    "balanced_batch": balanced_batch,
    "large_batch": large_batch,
    "distinct_hashes": distinct_hashes,
    "one_per_hash": one_per_hash,
    "matching_rows": matching_rows,
    "representatives": representatives,
    "carry_metadata": carry_metadata,
    "remaining_files": remaining_files,
    "fan_out": fan_out,
    "count_by_prefix": count_by_prefix,
    "incoming_conflicts": incoming_conflicts,
    "upsert_catalogue": upsert_catalogue,
    "integrity_violations": integrity_violations,
    "content_hash": content_hash,
    "pe_metadata": pe_metadata_columns,
    "pe_metadata_udf": pe_metadata_udf,
    "dedup_extract": dedup_extract,
    "incremental_extract": incremental_extract,
    "incremental_batch": incremental_batch,
    "balanced_extract": balanced_extract,
    "store_extract": store_extract,
    "append_results": append_results,
    "sync_catalogue": sync_catalogue,
    "microbatch_sync": microbatch_sync,
    "object_listing": object_listing,
    "keyed_sync": keyed_sync,
    "verified_bodies": verified_bodies,
    "slot_extract": slot_extract,
    "unprocessed_prefiltered": unprocessed_prefiltered,
    "retried_results": retried_results,
    "retry_ledger": retry_ledger,
    "partitioned_sync": partitioned_sync,
    "contents_by_prefix": contents_by_prefix,
}
