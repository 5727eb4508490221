"""A folder's listing as sorted files, which a stream takes by key without running over the folder for each page."""

from __future__ import annotations

import json
import uuid
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence
from functools import cached_property, partial

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, InputPartition

from foldcat.sources.listing import open_store
from foldcat.sources.listing_source import RAW_SCHEMA, PageReader, apart, read_keys
from foldcat.sources.stores import FolderStore
from foldcat.staging import fresh_path


def save_inventory(spark: SparkSession, root: str, prefix: str | Sequence[str], page_size: int) -> str:
    """List a folder once, on the executors, into files of up to ``page_size`` keys in order; gives their path.

    Tasks list ranges of keys that do not meet, so each sorts its own and nothing is shuffled. Beside the
    files lies an index with a row for each.
    """
    path = fresh_path(spark, "inventory")
    listed = read_keys(spark, partial(FolderStore, root), prefix) if apart(prefix) else spark.createDataFrame([], RAW_SCHEMA)
    listed.sortWithinPartitions("Key").write.option("maxRecordsPerFile", page_size).parquet(f"{path}/keys")
    files = spark.read.schema(RAW_SCHEMA).parquet(f"{path}/keys").groupBy(F.col("_metadata.file_name").alias("file"))
    files.agg(F.max("Key").alias("last"), F.count("Key").alias("keys")).write.parquet(f"{path}/index")
    return path


def _table(root: str, file: str) -> pa.Table:
    import pyarrow.parquet as pq

    filesystem, base = open_store(root)
    with filesystem.open_input_file(f"{base}/{file}") as body:
        return pq.ParquetFile(body).read()


class FileRange(InputPartition):
    """The keys of a file with ``after`` < key <= ``upto``."""

    def __init__(self, file: str, after: str, upto: str):
        self.file, self.after, self.upto = file, after, upto


class InventoryReader(PageReader):
    """Pages of a folder from its inventory: each file that holds keys of a micro-batch is a task.

    Offsets are keys, so a restarted query goes on behind its last key also in a newer inventory, whose
    files are cut at other keys. Behind the last key of the inventory, pages are those that the folder has
    got since. The driver holds the index, a row for each file; it goes to no task.
    """

    def __init__(self, path: str, root: str, prefixes: list[str], page_size: int, pages: int):
        super().__init__(partial(FolderStore, root), prefixes, page_size, pages)
        self.path = path

    @cached_property
    def index(self) -> tuple[list[str], list[int], list[str]]:
        """The last key, number of keys and name of each file, in order of keys."""
        from pyarrow import fs

        filesystem, base = open_store(f"{self.path}/index")
        parts = [info.base_name for info in filesystem.get_file_info(fs.FileSelector(base)) if info.base_name.endswith(".parquet")]
        rows = sorted((r["last"], r["keys"], r["file"]) for part in parts for r in _table(f"{self.path}/index", part).to_pylist())
        return [r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows]

    def _keys(self, file: str) -> list[str]:
        return _table(f"{self.path}/keys", file)["Key"].to_pylist()

    def _ahead(self, after: str) -> str:
        """The last key of the next micro-batch of the inventory; ``after`` itself behind its end."""
        lasts, counts, files = self.index
        at, left = bisect_right(lasts, after), self.page_size * self.pages
        if at < len(files) and after != (lasts[at - 1] if at else ""):
            left += bisect_right(self._keys(files[at]), after)
        while at < len(files) and counts[at] <= left:
            after, left, at = lasts[at], left - counts[at], at + 1
        return self._keys(files[at])[left - 1] if at < len(files) and left else after

    def latestOffset(self) -> dict:
        after = self.initialOffset()["after"] if self.position is None else self.position
        ahead = self._ahead(after)
        if ahead == after:
            return super().latestOffset()
        self.position = ahead
        return {"after": ahead}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        lasts, _, files = self.index
        met = files[bisect_right(lasts, start["after"]) : bisect_left(lasts, end["after"]) + 1]
        listed = max(start["after"], lasts[-1] if lasts else "")
        later = super().partitions({"after": listed}, end) if end["after"] > listed else []
        self.position = max(self.position or "", end["after"])
        return [*(FileRange(file, start["after"], end["after"]) for file in met), *later]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        if not isinstance(partition, FileRange):
            return super().read(partition)
        table = _table(f"{self.path}/keys", partition.file)
        inside = pc.and_(pc.greater(table["Key"], partition.after), pc.less_equal(table["Key"], partition.upto))
        return iter(table.filter(inside).to_batches())


def stream_folder(spark: SparkSession, root: str, prefix: str | Sequence[str], page_size: int, pages: int) -> DataFrame:
    """``stream_keys`` of a folder, which is listed once, now."""

    class Inventory(DataSource):
        @classmethod
        def name(cls) -> str:
            return short_name

        def schema(self) -> str:
            return RAW_SCHEMA

        def streamReader(self, schema: object) -> InventoryReader:
            sizes = int(self.options["page_size"]), int(self.options["pages"])
            return InventoryReader(self.options["inventory"], root, json.loads(self.options["prefixes"]), *sizes)

    short_name = f"inventory_{uuid.uuid4().hex}"
    spark.dataSource.register(Inventory)
    reader = spark.readStream.format(short_name).option("inventory", save_inventory(spark, root, prefix, page_size))
    return reader.option("prefixes", json.dumps(apart(prefix))).option("page_size", page_size).option("pages", pages).load()
