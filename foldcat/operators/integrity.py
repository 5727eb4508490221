"""Integrity rules of a table, as a query that returns what violates them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foldcat.schemas import FILE_KEY, required_columns


def integrity_violations(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows (rule, name, hash, rows): NULLs in NOT NULL columns, and files listed more than once.

    A NULL in the key keeps a row out of the uniqueness rule, as in SQL.
    """
    required = required_columns(schema)
    nulls = df.agg(*[F.count_if(F.col(name).isNull()).alias(name) for name in required])
    counted = nulls.unpivot([], required, "column", "rows").filter("rows > 0")
    missing = counted.select(
        F.concat(F.lit("not_null:"), "column").alias("rule"),
        F.lit(None).cast("string").alias("name"),
        F.lit(None).cast("string").alias("hash"),
        "rows",
    )
    keyed = df.dropna(subset=FILE_KEY).groupBy(*FILE_KEY).agg(F.count(F.lit(1)).alias("rows"))
    repeated = keyed.filter("rows > 1").select(F.lit("unique:name,hash").alias("rule"), *FILE_KEY, "rows")
    return missing.unionByName(repeated)


def count_by_prefix(files: DataFrame, length: int = 1) -> DataFrame:
    """How many files are listed under each key prefix."""
    return files.groupBy(F.substring("name", 1, length).alias("prefix")).agg(
        F.count(F.lit(1)).alias("files")
    )
