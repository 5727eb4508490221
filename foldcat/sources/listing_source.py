"""Listings as a Spark data source: ranges of keys in batches, pages of keys in streams."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

import foldcat.operators.partition_map  # noqa: F401  workers get this package by value
from foldcat.sources.stores import PAGE, Listed, Store

RAW_SCHEMA = "Key string, ETag string, Size bigint"
_ARROW = pa.schema([("Key", pa.string()), ("ETag", pa.string()), ("Size", pa.int64())])


class KeyRange(InputPartition):
    """The keys of a prefix with ``after`` < key <= ``upto``, None for no end."""

    def __init__(self, prefix: str, after: str, upto: str | None):
        self.prefix, self.after, self.upto = prefix, after, upto


def apart(prefix: str | Sequence[str]) -> list[str]:
    """The prefixes without those that another one covers."""
    prefixes = [prefix] if isinstance(prefix, str) else sorted(set(prefix))
    return [p for p in prefixes if not any(p != q and p.startswith(q) for q in prefixes)]


def _batches(rows: Iterator[Listed]) -> Iterator[pa.RecordBatch]:
    waiting: list[Listed] = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(column, kind.type) for column, kind in zip(zip(*waiting), _ARROW)], schema=_ARROW)

    for row in rows:
        waiting.append(row)
        if len(waiting) >= PAGE:
            yield batch()
            waiting = []
    if waiting:
        yield batch()


class RangeReader(DataSourceReader):
    """Every range of keys is a task. Planning reads names only, and holds a bounded sample of them."""

    def __init__(self, open_store: Callable[[], Store], prefixes: list[str], tasks: int):
        self.open_store, self.prefixes, self.tasks = open_store, prefixes, tasks

    def partitions(self) -> Sequence[InputPartition]:
        store, found = self.open_store(), []
        for prefix in self.prefixes:
            ends = [*store.split_points(prefix, self.tasks), None]
            found += [KeyRange(prefix, after, upto) for after, upto in zip(["", *ends], ends)]
        return found

    def read(self, partition: KeyRange) -> Iterator[pa.RecordBatch]:
        return _batches(self.open_store().between(partition.prefix, partition.after, partition.upto))


class PageReader(DataSourceStreamReader):
    """Each micro-batch is the next ``pages`` pages of keys, a page a task; the offset is the last key of a page.

    A restarted query goes on behind the last key it had planned, without listing what came before.
    """

    def __init__(self, open_store: Callable[[], Store], prefixes: list[str], page_size: int, pages: int = 1):
        self.open_store, self.prefixes, self.page_size, self.pages = open_store, prefixes, page_size, pages
        self.position: str | None = None
        # Where the pages of the last planned micro-batch end.
        self.ends: list[str] = []

    def initialOffset(self) -> dict:
        return {"after": ""}

    def latestOffset(self) -> dict:
        after = self.initialOffset()["after"] if self.position is None else self.position
        store, self.ends = self.open_store(), []
        for _ in range(self.pages):
            before, left = after, self.page_size
            for prefix in self.prefixes:
                page = store.page(prefix, after, left) if left else []
                left -= len(page)
                after = page[-1].key if page else after
            if after == before:
                break
            self.ends.append(after)
        self.position = after
        return {"after": after}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        # After a restart, the last planned pages are planned again before the next ones are asked for.
        self.position = max(self.position or "", end["after"])
        ends = [*(key for key in self.ends if start["after"] < key < end["after"]), end["after"]]
        return [KeyRange(prefix, after, upto) for after, upto in zip([start["after"], *ends], ends) for prefix in self.prefixes]

    def read(self, partition: KeyRange) -> Iterator[pa.RecordBatch]:
        return _batches(self.open_store().between(partition.prefix, partition.after, partition.upto))

    def commit(self, end: dict) -> None:
        self.position = max(self.position or "", end["after"])


def _registered(spark: SparkSession, open_store: Callable[[], Store]) -> str:
    """A format of this session by which the store is read."""

    class ObjectListing(DataSource):
        @classmethod
        def name(cls) -> str:
            return short_name

        def schema(self) -> str:
            return RAW_SCHEMA

        def _prefixes(self) -> list[str]:
            return json.loads(self.options["prefixes"])

        def reader(self, schema: object) -> RangeReader:
            return RangeReader(open_store, self._prefixes(), int(self.options["tasks"]))

        def streamReader(self, schema: object) -> PageReader:
            return PageReader(open_store, self._prefixes(), int(self.options["page_size"]), int(self.options["pages"]))

    short_name = f"objects_{uuid.uuid4().hex}"
    spark.dataSource.register(ObjectListing)
    return short_name


def read_keys(
    spark: SparkSession, open_store: Callable[[], Store], prefix: str | Sequence[str] = "", tasks: int | None = None
) -> DataFrame:
    """Raw listing rows of a store, listed by ``tasks`` ranges of keys for each prefix."""
    tasks = tasks or 4 * spark.sparkContext.defaultParallelism
    reader = spark.read.format(_registered(spark, open_store))
    return reader.option("prefixes", json.dumps(apart(prefix))).option("tasks", tasks).load()


def stream_keys(
    spark: SparkSession, open_store: Callable[[], Store], prefix: str | Sequence[str] = "", page_size: int = PAGE, pages: int = 1
) -> DataFrame:
    """Raw listing rows of a store as a stream, at most ``pages`` of ``page_size`` in a micro-batch, in order of keys."""
    reader = spark.readStream.format(_registered(spark, open_store)).option("prefixes", json.dumps(apart(prefix)))
    return reader.option("page_size", page_size).option("pages", pages).load()
