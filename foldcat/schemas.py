"""Table schemas, and the step that brings a frame into one of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# File identity is (name, hash); content identity is hash alone, which several names may share.
FILE_KEY = ["name", "hash"]
CONTENT_KEY = "hash"

LISTING = T.StructType(
    [
        T.StructField("name", T.StringType(), False),
        T.StructField("hash", T.StringType(), False),
        T.StructField("size", T.IntegerType(), False),
        T.StructField("malicious", T.BooleanType(), False),
    ]
)

STORAGE = T.StructType([*LISTING.fields, T.StructField("sync_time", T.TimestampType(), False)])

METADATA = T.StructType(
    [
        T.StructField("architecture", T.StringType(), True),
        T.StructField("num_imports", T.IntegerType(), True),
        T.StructField("num_exports", T.IntegerType(), True),
        T.StructField("type", T.StringType(), True),
        T.StructField("status", T.StringType(), False),
    ]
)

EXTRACTED = T.StructType(
    [
        *LISTING.fields[:3],
        *METADATA.fields,
        LISTING["malicious"],
        T.StructField("created_at", T.TimestampType(), False),
    ]
)


def required_columns(schema: T.StructType) -> list[str]:
    return [field.name for field in schema.fields if not field.nullable]


def enforce_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the schema's columns by name, cast them, and fail the job on a NULL in a NOT NULL one."""

    def shaped(field: T.StructField) -> Column:
        value = F.col(field.name).cast(field.dataType)
        if not field.nullable:
            complaint = F.raise_error(F.lit(f"NULL in NOT NULL column {field.name}"))
            value = F.coalesce(value, complaint.cast(field.dataType))
        return value.alias(field.name)

    return df.select(*[shaped(field) for field in schema.fields])
