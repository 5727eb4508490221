"""Catalogue and result tables: Parquet, bucketed tables, JDBC."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import types as T

from foldcat.schemas import FILE_KEY, enforce_schema


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet table with a fixed schema; a path not written yet is an empty table."""
    try:
        return spark.read.schema(schema).parquet(path).select(*schema.names)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], schema)


def append_table(
    df: DataFrame, path: str, schema: T.StructType, partition_by: tuple[str, ...] = ()
) -> None:
    """Append by column name; a NULL where the schema forbids it fails the write."""
    _writer(df, schema, partition_by).mode("append").parquet(path)


def write_snapshot(
    df: DataFrame, path: str, schema: T.StructType, partition_by: tuple[str, ...] = ()
) -> None:
    """Write a whole table, such as the catalogue after an upsert, to a path that is not in use yet."""
    _writer(df, schema, partition_by).mode("errorifexists").parquet(path)


def _writer(df: DataFrame, schema: T.StructType, partition_by: tuple[str, ...]) -> DataFrameWriter:
    """With ``partition_by=("malicious",)`` a scan of one class does not touch the other's files."""
    writer = enforce_schema(df, schema).write
    return writer.partitionBy(*partition_by) if partition_by else writer


def save_bucketed(
    df: DataFrame,
    table: str,
    buckets: int,
    mode: str = "overwrite",
    schema: T.StructType | None = None,
    key: Sequence[str] = tuple(FILE_KEY),
) -> None:
    """Write a table bucketed by ``key``, file identity unless told otherwise, as ``schema`` if given.

    Two tables with the same number of buckets are compared by their key without any shuffle.
    """
    shaped = df if schema is None else enforce_schema(df, schema)
    shaped.write.bucketBy(buckets, *key).sortBy(*key).mode(mode).saveAsTable(table)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    key: str = "id",
    partitions: int = 16,
) -> DataFrame:
    """A whole database table, read in ``partitions`` ranges of its integer key."""
    if partitions == 1:
        return spark.read.jdbc(url, table, properties=properties)
    query = f"(SELECT min({key}) AS low, max({key}) AS high FROM {table}) bounds"
    bounds = spark.read.jdbc(url, query, properties=properties).first()
    if bounds[0] is None:
        return spark.read.jdbc(url, table, properties=properties)
    return spark.read.jdbc(
        url,
        table,
        column=key,
        lowerBound=bounds[0],
        upperBound=bounds[1] + 1,
        numPartitions=partitions,
        properties=properties,
    )


def append_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str],
    schema: T.StructType,
    connections: int = 16,
) -> None:
    """Append by column name over at most ``connections`` connections at a time."""
    limits = {"numPartitions": str(connections)}
    # A shuffle, as coalescing would run the work before it in so many tasks too.
    enforce_schema(df, schema).repartition(connections).write.jdbc(
        url, table, mode="append", properties={**properties, **limits}
    )
