"""Scalar column functions of the catalogue."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Which key prefix means which class (False = benign, True = malicious).
CLASS_BY_PREFIX = {"0": False, "1": True}


def in_prefix(name: Column | str, prefix: str) -> Column:
    return _col(name).startswith(prefix)


def class_of(name: Column | str, prefixes: dict[str, bool] | None = None) -> Column:
    """Class label from the key prefix; NULL for a key under no known prefix."""
    prefixes = CLASS_BY_PREFIX if prefixes is None else prefixes
    return F.coalesce(
        *[F.when(in_prefix(name, prefix), F.lit(label)) for prefix, label in prefixes.items()],
        F.lit(None).cast("boolean"),
    )


def strip_quotes(etag: Column | str) -> Column:
    """Drop every leading and trailing double quote; inner ones stay."""
    return F.btrim(_col(etag), F.lit('"'))


def content_id(content: Column | str) -> Column:
    """Content identity where the listing brings none."""
    return F.md5(_col(content))


def stamp(as_of: str | datetime | None) -> Column:
    """One timestamp per query: the clock's, or a given one for runs that must be repeatable."""
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")


def pick_key() -> Column:
    """Evenly spread sort key of a file identity, the basis of the batch order.

    ``(name, hash)`` is unique, so no value of it can hold many rows, however hot a hash is.
    """
    return F.md5(F.concat_ws("/", "hash", "name"))


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column
