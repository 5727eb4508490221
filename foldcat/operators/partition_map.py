"""A user function over the rows of a partition, with declared failures kept as data."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

import foldcat

# Functions of this package travel with the job, so workers need not have it installed.
cloudpickle.register_pickle_by_value(foldcat)

_MAX_ROWS = 1_000
_MAX_BYTES = 32 * 1024 * 1024


def map_rows(
    df: DataFrame,
    open_function: Callable[[], Callable[[dict], dict | None]],
    added: T.StructType,
    errors: tuple[type[Exception], ...] = (),
    drop: tuple[str, ...] = (),
    in_flight: int = 1,
) -> DataFrame:
    """Add the columns ``added`` with a function that maps a row to their values.

    ``open_function`` runs once per partition, for clients and settings. A row for which the function
    gives None is left out. An exception of a class in ``errors`` gives a row with status ERROR and
    NULL in the other added columns; any other one fails the task. Rows stream through: a partition is
    never held whole, and an output batch is closed when it gets large. ``in_flight`` > 1 calls the
    function for that many rows at a time in threads, for functions that wait for a store.
    """
    kept = [field for field in df.schema.fields if field.name not in drop]
    schema = T.StructType([*kept, *added.fields])
    kept_names, added_names = [field.name for field in kept], added.names
    failed = {name: "ERROR" if name == "status" else None for name in added_names}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow_schema = to_arrow_schema(schema)
        function = open_function()

        def added_to(row: dict) -> dict | None:
            try:
                values = function(row)
            except errors:
                values = failed
            if values is None:
                return None
            return {n: row[n] for n in kept_names} | {n: values.get(n) for n in added_names}

        rows: list[dict] = []
        held = 0
        for row in filter(None, _in_order(added_to, _rows(batches), in_flight)):
            rows.append(row)
            held += sum(len(v) for v in row.values() if isinstance(v, (bytes, str)))
            if len(rows) >= _MAX_ROWS or held >= _MAX_BYTES:
                yield pa.RecordBatch.from_pylist(rows, arrow_schema)
                rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, arrow_schema)

    return df.mapInArrow(run, schema)


def _in_order(function: Callable, rows: Iterator[dict], in_flight: int) -> Iterator[dict | None]:
    """Results in the order of the rows, with up to ``in_flight`` calls under way at any time."""
    if in_flight == 1:
        yield from map(function, rows)
        return
    with ThreadPoolExecutor(in_flight) as pool:
        waiting: deque[Future] = deque()
        for row in rows:
            if len(waiting) >= in_flight:
                yield waiting.popleft().result()
            waiting.append(pool.submit(function, row))
        while waiting:
            yield waiting.popleft().result()


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    """Rows as dicts, made for a bounded number of bytes at a time."""
    for batch in batches:
        step = max(1, _MAX_BYTES * batch.num_rows // max(1, batch.nbytes))
        for start in range(0, batch.num_rows, step):
            yield from batch.slice(start, step).to_pylist()
