"""What several text operators share: words, folds of rows, Arrow helpers."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Words are runs without these: space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"


# Rows that Spark hands to Python at once. Its default of 10,000 has no bound in bytes that suits texts.
BATCH_ROWS = 1_000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Let batches of this session's Python functions hold ``BATCH_ROWS`` rows at most."""
    if not 0 < int(spark.conf.get(_BATCH_SETTING)) <= BATCH_ROWS:
        spark.conf.set(_BATCH_SETTING, str(BATCH_ROWS))


def unused(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that the frame does not have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def quoted(name: str) -> str:
    """A column name as an expression, also one with a dot."""
    return f"`{name.replace('`', '``')}`"


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the decimal id, modulo the number of folds; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(folds)


def ascii_words(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8; bytes.split() parts at exactly the six characters above."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def struct_udf(per_row: Callable[[str | None], tuple], names: list[str], types: list[str]):
    """An Arrow column function that turns each text into one struct by ``per_row``.

    Rows of a batch are taken one by one, so that besides the batch only one row's work is held.
    """
    return texts_udf(lambda texts: map(per_row, texts), names, types)


def texts_udf(per_batch: Callable[[Iterable[str | None]], Iterable[tuple]], names: list[str], types: list[str]):
    """The same by a function that gets the texts of a batch and yields one struct for each, in order."""
    bound_batches(SparkSession.active())
    arrow = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}
    returns = ", ".join(f"{n} {t}" for n, t in zip(names, types, strict=True))
    kinds = [arrow[t] for t in types]

    def batch(texts):
        columns = [[] for _ in names]
        for row in per_batch(value.as_py() for value in texts):
            for column, got in zip(columns, row, strict=True):
                column.append(got)
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        return pa.StructArray.from_arrays(arrays, names=names)

    batch.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(batch, returns)
