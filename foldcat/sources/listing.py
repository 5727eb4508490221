"""Listings of an object store: raw (Key, ETag, Size) rows, and the catalogue rows made of them."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from functools import partial, reduce
from operator import or_

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldcat.functions.catalogue import CLASS_BY_PREFIX, class_of, in_prefix, strip_quotes
from foldcat.operators.partition_map import map_rows
from foldcat.sources.listing_source import apart, read_keys
from foldcat.sources.stores import FolderStore, Store, is_folder
from foldcat.staging import cut

_LISTED = "Key string, Size bigint"
_STRETCH = 1 << 20
_HASHED_AT_ONCE = 16


def list_objects(
    spark: SparkSession,
    root: str | Callable[[], Store],
    prefix: str | Sequence[str] = "",
    with_etag: bool = False,
    tasks: int | None = None,
) -> DataFrame:
    """Objects under ``root`` whose key starts with a prefix; none is an empty frame.

    A local or mounted folder, or a store that ``root`` opens, is listed by ``tasks`` ranges of keys for
    each prefix, however its objects are spread over folders. An address is listed by one task per prefix
    and then one per folder found there. Every file is an object, also an empty one and one whose name
    starts with a dot or an underscore, and prefixes are taken literally. ETags are those of the listing;
    where it has none, ``with_etag`` reads the bodies.
    """
    if callable(root):
        return read_keys(spark, root, prefix, tasks)
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if is_folder(root):
        found = read_keys(spark, partial(FolderStore, root), prefix, tasks).select("Key", "Size")
    else:
        found = _list_folders(spark, root, apart(prefix), spread)
    if not with_etag:
        return found.select("Key", F.lit(None).cast("string").alias("ETag"), "Size")
    return hash_bodies(found.repartition(spread, "Key"), root)


def _list_folders(spark: SparkSession, root: str, prefixes: list[str], spread: int) -> DataFrame:
    starts = spark.createDataFrame([(p.rpartition("/")[0], p) for p in prefixes], "folder string, prefix string")
    shallow = cut(starts.repartition(max(1, len(prefixes)), "prefix").mapInArrow(_lister(root, False), _LISTED))
    folders = shallow.filter("Size IS NULL").select(F.col("Key").alias("folder"), F.lit("").alias("prefix"))
    deep = folders.repartition(spread, "folder").mapInArrow(_lister(root, True), _LISTED)
    return shallow.filter("Size IS NOT NULL").unionByName(deep).select("Key", "Size")


def hash_bodies(listed: DataFrame, root: str) -> DataFrame:
    """Raw listing rows with the MD5 of each body as its ETag."""
    etag = T.StructType([T.StructField("ETag", T.StringType(), True)])
    hashed = map_rows(listed.select("Key", "Size"), _hasher(root), etag, in_flight=_HASHED_AT_ONCE)
    return hashed.select("Key", "ETag", "Size")


def _lister(root: str, deep: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Files in the folders of a frame (folder, prefix), and the folders there, or what these hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        filesystem, base = open_store(root)
        for batch in batches:
            for start in batch.to_pylist():
                waiting = [start["folder"]]
                while waiting:
                    folder = f"{base}/{waiting.pop()}".rstrip("/")
                    selector = fs.FileSelector(folder, allow_not_found=True)
                    entries = [(e.path[len(base) + 1 :], e) for e in filesystem.get_file_info(selector)]
                    entries = [(k, e) for k, e in entries if (k if e.is_file else f"{k}/").startswith(start["prefix"]) or (not e.is_file and start["prefix"].startswith(f"{k}/"))]
                    if deep:
                        waiting += [k for k, e in entries if not e.is_file]
                        entries = [(k, e) for k, e in entries if e.is_file]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([k for k, _ in entries], pa.string()), pa.array([e.size if e.is_file else None for _, e in entries], pa.int64())],
                        names=["Key", "Size"],
                    )

    return run


def _hasher(root: str) -> Callable[[], Callable[[dict], dict]]:
    """MD5 of a body as object stores give it, read in stretches."""

    def open_hasher() -> Callable[[dict], dict]:
        filesystem, base = open_store(root)

        def etag(row: dict) -> dict:
            digest = hashlib.md5()
            with filesystem.open_input_stream(f"{base}/{row['Key']}") as body:
                while part := body.read(_STRETCH):
                    digest.update(part)
            return {"ETag": f'"{digest.hexdigest()}"'}

        return etag

    return open_hasher


def open_store(root: str) -> tuple:
    """The file system of a root folder or address, and the root's path in it."""
    from pyarrow import fs

    if "://" not in root and not root.startswith("file:"):
        root = f"file://{root}"
    return fs.FileSystem.from_uri(root.rstrip("/"))


def read_inventory(
    spark: SparkSession,
    path: str,
    format: str = "parquet",
    key: str = "Key",
    etag: str = "ETag",
    size: str = "Size",
    **options: str,
) -> DataFrame:
    """A listing that the store itself wrote to files: one row per object, read in parallel."""
    rows = spark.read.format(format).options(**options).load(path)
    return rows.select(
        F.col(key).alias("Key"), F.col(etag).alias("ETag"), F.col(size).cast("bigint").alias("Size")
    )


def label_listing(listing: DataFrame, prefixes: dict[str, bool] | None = None) -> DataFrame:
    """Catalogue columns of a raw listing; keys under other prefixes are left out."""
    labels = CLASS_BY_PREFIX if prefixes is None else prefixes
    listed = reduce(or_, [in_prefix("Key", prefix) for prefix in labels])
    return listing.filter(listed).select(
        F.col("Key").alias("name"),
        strip_quotes("ETag").alias("hash"),
        F.col("Size").cast("int").alias("size"),
        class_of("Key", labels).alias("malicious"),
    )
