"""Where intermediate results live, and how lineage is cut."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it in ``spark.checkpoint.dir``.

    Only a local session, where driver and executors are one machine, gets a fresh temporary folder
    when the setting is missing.
    """
    context = spark.sparkContext
    chosen = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not chosen:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="foldcat-"))
        chosen = context.getCheckpointDir()
    return chosen.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing has been written to yet."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Compute ``df`` now and keep it reliably, so that later steps see these very rows.

    A reliable checkpoint survives the loss of executors.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Compute ``df`` once into a Parquet table of the shared folder, and read it from there.

    It survives the loss of executors like a checkpoint; besides, readers take only the columns they
    use and the planner knows its size.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
