"""Small frames with explicit schemas."""

from __future__ import annotations

from datetime import datetime

from foldcat.schemas import EXTRACTED, LISTING, STORAGE

T1 = datetime(2024, 1, 1)
T2 = datetime(2024, 1, 2)
T3 = datetime(2024, 1, 3)


def storage(spark, *rows):
    return spark.createDataFrame([(*row, T1) for row in rows], STORAGE)


def listing(spark, *rows):
    return spark.createDataFrame(list(rows), LISTING)


def extracted(spark, *rows):
    """Rows (name, hash, size, architecture, imports, exports, type, status, malicious[, created])."""
    filled = [row if len(row) == 10 else (*row, T1) for row in rows]
    return spark.createDataFrame(filled, EXTRACTED)


def collected(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)
