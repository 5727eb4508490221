"""Page-wise sync as an available-now stream."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from foldcat.functions.catalogue import stamp
from foldcat.operators.upsert import upsert
from foldcat.schemas import STORAGE
from foldcat.sources.inventory import stream_folder
from foldcat.sources.listing import hash_bodies, label_listing, list_objects
from foldcat.sources.listing_source import RAW_SCHEMA, stream_keys
from foldcat.sources.stores import Store
from foldcat.staging import fresh_path

PAGE_SIZE = 1000


def stream_objects(
    spark: SparkSession, root: str, page_size: int = PAGE_SIZE, prefix: str | Sequence[str] = ""
) -> DataFrame:
    """The objects under ``root`` as raw listing rows, at most ``page_size`` per micro-batch.

    The store is listed once, on the executors, into an inventory of files of a page each.
    """
    inventory = fresh_path(spark, "inventory")
    listing = list_objects(spark, root, prefix, with_etag=True)
    listing.write.option("maxRecordsPerFile", page_size).parquet(inventory)
    return stream_inventory(spark, inventory, files_per_page=1)


def stream_store(
    spark: SparkSession,
    root: str | Callable[[], Store],
    page_size: int = PAGE_SIZE,
    prefix: str | Sequence[str] = "",
    pages: int = 1,
) -> DataFrame:
    """The objects of a folder or store as raw listing rows, at most ``pages`` pages of ``page_size`` per micro-batch.

    Pages follow the order of keys, and the last key of a page is the stream's offset: a restarted query
    goes on behind it, and takes nothing again. A folder cannot be read in order, so it is listed once, when
    the stream is defined, into sorted files, and once more behind their last key; its bodies are hashed page
    by page. A store that ``root`` opens is asked for each page and gives the ETags itself. See ``sync_store``: such a stream plans when it is
    asked to, so a trigger that plans once, as available-now does, takes one micro-batch.
    """
    if callable(root):
        return stream_keys(spark, root, prefix, page_size, pages)
    return hash_bodies(stream_folder(spark, root, prefix, page_size, pages), root)


def stream_inventory(
    spark: SparkSession, path: str, files_per_page: int = PAGE_SIZE, format: str = "parquet"
) -> DataFrame:
    """New inventory files under ``path`` as raw listing rows."""
    return (
        spark.readStream.format(format)
        .schema(RAW_SCHEMA)
        .option("maxFilesPerTrigger", files_per_page)
        .load(path)
    )


def sync_pages(
    listing: DataFrame,
    log: str,
    checkpoint: str,
    sync_time: str | None = None,
    prefixes: dict[str, bool] | None = None,
) -> StreamingQuery:
    """Write what there is to ``log``, one folder per page and one sync time for all, and stop.

    A page that is replayed after a failure overwrites its own folder, so it counts once. Pages cost
    what they hold; the catalogue itself is not touched, see ``fold_pages``.
    """
    return _writer(listing, log, checkpoint, sync_time, prefixes).trigger(availableNow=True).start()


def sync_store(
    listing: DataFrame,
    log: str,
    checkpoint: str,
    sync_time: str | None = None,
    prefixes: dict[str, bool] | None = None,
) -> None:
    """``sync_pages`` for ``stream_store``: write page by page until there is none left."""
    query = _writer(listing, log, checkpoint, sync_time, prefixes).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def _writer(
    listing: DataFrame, log: str, checkpoint: str, sync_time: str | None, prefixes: dict[str, bool] | None
) -> DataStreamWriter:
    labelled = label_listing(listing, prefixes)
    run_time = sync_time or datetime.now(timezone.utc)

    def write_page(page: DataFrame, number: int) -> None:
        stamped = page.withColumn("sync_time", stamp(run_time))
        stamped.write.mode("overwrite").parquet(f"{log}/page={number}")

    return labelled.writeStream.foreachBatch(write_page).option("checkpointLocation", checkpoint)


def fold_pages(catalogue: DataFrame, log: str, after: int = -1) -> DataFrame:
    """The catalogue after the pages of ``log`` were upserted in page order.

    Pages up to ``after`` are part of the catalogue already; their folders are not read.
    """
    spark = catalogue.sparkSession
    schema = T.StructType([*STORAGE.fields, T.StructField("page", T.LongType(), False)])
    try:
        pages = spark.read.schema(schema).parquet(log)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return catalogue
    return upsert(catalogue, pages.filter(F.col("page") > after), order="page")


def last_page(spark: SparkSession, log: str) -> int:
    """The number of the last page in ``log``, -1 if there is none: what ``after`` is next time."""
    try:
        pages = spark.read.parquet(log)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
            raise
        return -1
    return pages.agg(F.coalesce(F.max("page"), F.lit(-1)).cast("bigint").alias("page")).first().page
