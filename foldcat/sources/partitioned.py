"""The catalogue in parts by file identity, of which a sync rewrites those that its listing touches."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldcat.functions.catalogue import stamp
from foldcat.operators.upsert import upsert
from foldcat.schemas import FILE_KEY, STORAGE, enforce_schema
from foldcat.sources.listing import label_listing
from foldcat.staging import stored

# The number of parts is part of the layout. Choose it so that a part is a few files.
PARTS = 1_024
_PART = "part"
_LAYOUT = T.StructType([*STORAGE.fields, T.StructField(_PART, T.IntegerType(), False)])


def _part(parts: int) -> Column:
    return F.pmod(F.xxhash64(*FILE_KEY), F.lit(parts)).cast("int")


def read_parts(spark: SparkSession, path: str, touched: list[int] | None = None) -> DataFrame:
    """The catalogue, or some parts of it; a path not written yet is an empty one."""
    try:
        rows = spark.read.schema(_LAYOUT).parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], STORAGE)
    rows = rows if touched is None else rows.filter(F.col(_PART).isin(touched))
    return rows.select(*STORAGE.names)


def upsert_parts(spark: SparkSession, path: str, incoming: DataFrame, order: str | None = None, parts: int = PARTS) -> list[int]:
    """Upsert into the catalogue at ``path`` and give the parts that were rewritten; others are not read.

    The new rows of the touched parts are complete in the shared folder before any file of the catalogue
    is replaced. Spark then writes them beside the catalogue and swaps whole parts when all tasks are
    done; a run that fails before that, or is run again, leaves or gives the same catalogue. One writer at
    a time.
    """
    columns = [*STORAGE.names, *([order] if order else [])]
    rows = stored(incoming.select(*columns), "incoming")
    # At most ``parts`` numbers.
    touched = sorted(r[0] for r in rows.select(_part(parts)).distinct().collect())
    if not touched:
        return touched
    after = enforce_schema(upsert(read_parts(spark, path, touched), rows, order), STORAGE)
    staged = stored(after.withColumn(_PART, _part(parts)), "parts")
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    laid = staged.repartition(min(spread, len(touched)), _PART)
    laid.write.partitionBy(_PART).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    return touched


def sync_parts(
    spark: SparkSession,
    path: str,
    listing: DataFrame,
    sync_time: str | None = None,
    prefixes: dict[str, bool] | None = None,
    parts: int = PARTS,
) -> list[int]:
    """``plans.sync.sync`` of a catalogue in parts, in place."""
    incoming = label_listing(listing, prefixes).withColumn("sync_time", stamp(sync_time))
    return upsert_parts(spark, path, incoming, parts=parts)
