"""Bring the catalogue up to date with a listing."""

from __future__ import annotations

from pyspark.sql import DataFrame

from foldcat.functions.catalogue import stamp
from foldcat.operators.upsert import upsert
from foldcat.sources.listing import label_listing


def sync(
    catalogue: DataFrame,
    listing: DataFrame,
    sync_time: str | None = None,
    prefixes: dict[str, bool] | None = None,
) -> DataFrame:
    """The catalogue after all objects of ``listing`` were upserted with one sync time."""
    incoming = label_listing(listing, prefixes).withColumn("sync_time", stamp(sync_time))
    return upsert(catalogue, incoming)
