"""Bodies in a table laid out by slots of their name, of which a run scans those it needs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foldcat.functions.pe import pe_metadata
from foldcat.operators.lookup import BOUNDED_ROWS
from foldcat.operators.membership import chance_members
from foldcat.schemas import LISTING, METADATA
from foldcat.sources.objects import Extract

# A run of b files scans at most b of so many slots. Choose it so that a slot is a few files.
SLOTS = 4_096
_SLOT = "slot"
_SCHEMA = f"name string, content binary, {_SLOT} int"


def _slot(slots: int) -> Column:
    return F.pmod(F.xxhash64("name"), F.lit(slots)).cast("int")


def save_slots(bodies: DataFrame, path: str, slots: int = SLOTS, tasks: int | None = None) -> None:
    """Append bodies (name, content) to a table in which a name always falls into the same slot.

    A task writes whole slots, so that each append adds one file to a slot that it touches.
    """
    laid = bodies.select("name", "content", _slot(slots).alias(_SLOT))
    spread = tasks or int(bodies.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid.repartition(min(slots, spread), _SLOT).write.partitionBy(_SLOT).mode("append").parquet(path)


def extract_from_slots(spark: SparkSession, path: str, slots: int = SLOTS) -> Extract:
    """Extract from a table that ``save_slots`` wrote, never moving a body through a shuffle.

    A bounded number of files is broadcast; Spark makes of its slots a filter of the scan, so that other
    slots are not read. A larger number touches all slots in any case; there a sketch of the names tells
    which bodies to parse, and the narrow result joins the files.
    """

    def run(files: DataFrame, rows: int | None = None) -> DataFrame:
        bodies = spark.read.schema(_SCHEMA).parquet(path)
        if rows is not None and rows <= BOUNDED_ROWS:
            # Spark prunes partitions only by a side that some filter makes small.
            wanted = files.filter(F.length("name") > 0).withColumn(_SLOT, _slot(slots))
            parsed = pe_metadata(bodies.join(F.broadcast(wanted), [_SLOT, "name"]))
        else:
            parsed = pe_metadata(chance_members(bodies, files, ["name"])).join(files, "name")
        return parsed.select(*LISTING.names, *METADATA.names)

    return run
