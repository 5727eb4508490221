"""Object bodies, fetched by key on the executors."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldcat.functions.pe import pe_metadata
from foldcat.functions.pe_python import ExtractionError, extract_pe, in_blocks, reader_of
from foldcat.operators.lookup import BOUNDED_ROWS
from foldcat.operators.membership import chance_members
from foldcat.operators.partition_map import map_rows
from foldcat.schemas import LISTING, METADATA
from foldcat.sources.etags import PART_SIZES, body_matches
from foldcat.sources.listing import open_store

# (files, bound) -> the same files with metadata columns. Files come one per content with at least
# name, hash, size and malicious; the bound is a proven limit on their number, None if there is none.
Extract = Callable[[DataFrame, int | None], DataFrame]

# Fetches that one task has under way at a time.
_IN_FLIGHT = 16
# What is read of an object at once when only its headers are wanted.
_BLOCK = 64 * 1024
# What is read at once when the whole body is wanted.
_STRETCH = 1 << 20


def fetch_contents(
    files: DataFrame, root: str, rows: int | None = None, tasks: int | None = None
) -> DataFrame:
    """Add the whole body of each file as ``content``; a key that is not there fails the task."""

    def open_bodies() -> Callable[[dict], dict]:
        filesystem, base = open_store(root)

        def fetch(row: dict) -> dict:
            with filesystem.open_input_file(f"{base}/{row['name']}") as body:
                return {"content": body.read()}

        return fetch

    added = T.StructType([T.StructField("content", T.BinaryType(), True)])
    return map_rows(_spread(files, rows, tasks), open_bodies, added, in_flight=_IN_FLIGHT)


def put_contents(files: DataFrame, root: str, tasks: int | None = None) -> DataFrame:
    """Write each row's ``content`` as the object ``name`` under ``root``; gives the rows without it.

    Objects are written when the result is computed; a task that runs again writes the same bytes.
    """

    def open_sink() -> Callable[[dict], dict]:
        filesystem, base = open_store(root)

        def put(row: dict) -> dict:
            path = f"{base}/{row['name']}"
            filesystem.create_dir(path.rpartition("/")[0], recursive=True)
            with filesystem.open_output_stream(path) as body:
                body.write(row["content"])
            return {"written": len(row["content"])}

        return put

    added = T.StructType([T.StructField("written", T.LongType(), True)])
    return map_rows(_spread(files, None, tasks), open_sink, added, drop=("content",), in_flight=_IN_FLIGHT)


def _stretches(body) -> Iterator[bytes]:
    """From where the body stands to its end."""
    while stretch := body.read(_STRETCH):
        yield stretch


def verify_contents(
    files: DataFrame, root: str, rows: int | None = None, tasks: int | None = None, part_sizes: Sequence[int] = PART_SIZES
) -> DataFrame:
    """Add ``verified``: whether the object ``name`` still has the ETag ``hash``, plain or of parts.

    Bodies are streamed; a key that is not there fails the task.
    """

    def open_bodies() -> Callable[[dict], dict]:
        filesystem, base = open_store(root)

        def verify(row: dict) -> dict:
            with filesystem.open_input_file(f"{base}/{row['name']}") as body:
                return {"verified": body_matches(row["hash"], body.size(), _stretches(body), part_sizes)}

        return verify

    added = T.StructType([T.StructField("verified", T.BooleanType(), True)])
    return map_rows(_spread(files, rows, tasks), open_bodies, added, in_flight=_IN_FLIGHT)


def extract_from_store(
    root: str, tasks: int | None = None, verify_hash: bool = False, part_sizes: Sequence[int] = PART_SIZES
) -> Extract:
    """Extract by reading the header ranges of each object; bodies are not moved.

    A body that cannot be opened fails the task; one whose bytes cannot be read is an ERROR row. With
    ``verify_hash`` each body is read whole first, and one that is not the listed one any more is an ERROR
    row too, instead of metadata of new bytes under the old hash.
    """

    def open_bodies() -> Callable[[dict], dict]:
        filesystem, base = open_store(root)

        def extract(row: dict) -> dict:
            with filesystem.open_input_file(f"{base}/{row['name']}") as body:
                try:
                    if verify_hash and not body_matches(row["hash"], body.size(), _stretches(body), part_sizes):
                        raise ExtractionError("the body is not the listed one")
                    read = in_blocks(lambda at, width: body.read_at(width, at), _BLOCK)
                    return extract_pe(read, body.size())
                except OSError as error:
                    raise ExtractionError("the body cannot be read") from error

        return extract

    def run(files: DataFrame, rows: int | None = None) -> DataFrame:
        spread = _spread(files.select(*LISTING.names), rows, tasks)
        return map_rows(spread, open_bodies, METADATA, (ExtractionError,), in_flight=_IN_FLIGHT)

    return run


def extract_from_contents(contents: DataFrame) -> Extract:
    """Extract from a frame (name, content), never moving a body through a shuffle.

    A bounded number of files is broadcast. Otherwise a sketch of their names goes to the bodies, and the
    narrow result joins the files. Either way only the bodies of the files are parsed (and of a few others
    that the sketch takes for them), but all are scanned; see ``sources.bodies`` for a layout that is not.
    """

    def run(files: DataFrame, rows: int | None = None) -> DataFrame:
        bodies = contents.select("name", "content")
        if rows is not None and rows <= BOUNDED_ROWS:
            parsed = pe_metadata(bodies.join(F.broadcast(files), "name"))
        else:
            parsed = pe_metadata(chance_members(bodies, files, ["name"])).join(files, "name")
        return parsed.select(*LISTING.names, *METADATA.names)

    return run


def extract_from_bucketed(spark: SparkSession, table: str) -> Extract:
    """Extract from a table (name, content) that is bucketed by name, one plan for any number of files.

    Files are brought to their bodies and only those are parsed; bodies are neither moved nor sorted.
    A task holds the files of one bucket, which are fewer and smaller than the bodies it streams.
    """

    def run(files: DataFrame, rows: int | None = None) -> DataFrame:
        bodies = spark.table(table).select("name", "content")
        parsed = pe_metadata(bodies.join(files.hint("shuffle_hash"), "name"))
        return parsed.select(*LISTING.names, *METADATA.names)

    return run


def extract_rows(contents: DataFrame) -> DataFrame:
    """``pe_metadata`` through the partition map: for each row with a body, the Python extractor."""

    def open_extractor() -> Callable[[dict], dict | None]:
        def extract(row: dict) -> dict | None:
            body = row["content"]
            return None if body is None else extract_pe(reader_of(body), len(body))

        return extract

    return map_rows(contents, open_extractor, METADATA, (ExtractionError,), ("content",))


def _spread(files: DataFrame, rows: int | None, tasks: int | None) -> DataFrame:
    """Rows here are small but each stands for a fetch: keep them in many tasks."""
    spark = files.sparkSession
    if tasks is None:
        shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
        tasks = max(shuffle, 4 * spark.sparkContext.defaultParallelism)
        if rows is not None:
            tasks = max(1, min(tasks, -(-rows // _IN_FLIGHT)))
    return files.repartition(tasks, "name")
