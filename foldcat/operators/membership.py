"""A sketch of a set of keys of fixed size, by which certain misses need no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bits of a sketch. All executors get it: 16 MB, whatever the number of keys.
BITS = 1 << 27
# Spark's bitmap aggregates make pieces of so many bits.
_PIECE = 1 << 15
_NUMBER, _MAP = "_piece", "_bitmap"


def _unused(rows: DataFrame, name: str) -> str:
    taken = {c.lower() for c in rows.columns}
    while name in taken:
        name += "_"
    return name


def _place(columns: list[str], bits: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(bits))


def key_bitmap(keys: DataFrame, columns: list[str], bits: int = BITS) -> DataFrame:
    """At most ``bits / 32,768`` rows of 4 KiB: which places the keys' hashes fall on."""
    place = _place(columns, bits)
    pieces = keys.select(F.floor(place / _PIECE).alias(_NUMBER), (place % _PIECE).alias("_bit"))
    return pieces.groupBy(_NUMBER).agg(F.bitmap_construct_agg("_bit").alias(_MAP))


def merged_bitmaps(bitmaps: DataFrame) -> DataFrame:
    """One sketch of several, as of keys that came in over time."""
    return bitmaps.groupBy(_NUMBER).agg(F.bitmap_or_agg(_MAP).alias(_MAP))


def with_chance(rows: DataFrame, bitmap: DataFrame, columns: list[str], bits: int = BITS, into: str = "_chance") -> DataFrame:
    """The rows with a boolean: false if their key is certainly not in the set. No row moves.

    Of n keys, a share of about ``n / bits`` of the other rows is taken for members.
    """
    number, pieces = _unused(rows, _NUMBER), _unused(rows, _MAP)
    place = _place(columns, bits)
    at = (place % _PIECE).cast("int")
    byte = F.substring(F.col(pieces), F.floor(at / 8).cast("int") + 1, F.lit(1))
    bit = F.getbit(F.conv(F.hex(byte), 16, 10).cast("long"), at % 8) == 1
    keyed = rows.withColumn(number, F.floor(place / _PIECE))
    sent = F.broadcast(bitmap.select(F.col(_NUMBER).alias(number), F.col(_MAP).alias(pieces)))
    joined = keyed.join(sent, number, "left")
    return joined.withColumn(into, F.coalesce(bit, F.lit(False))).drop(number, pieces)


def chance_members(rows: DataFrame, keys: DataFrame, columns: list[str], bits: int = BITS) -> DataFrame:
    """The rows without those that certainly have no such key."""
    return with_chance(rows, key_bitmap(keys, columns, bits), columns, bits).filter("_chance").drop("_chance")


def anti_join(rows: DataFrame, keys: DataFrame, columns: list[str], bits: int = BITS) -> DataFrame:
    """``rows.join(keys, columns, "left_anti")``, where only possible members are shuffled.

    Rows are scanned twice and keys twice; worth it where most rows have no such key. Rows with a NULL in
    a key column are never members.
    """
    marked = with_chance(rows, key_bitmap(keys, columns, bits), columns, bits)
    possible = marked.filter("_chance").drop("_chance").join(keys.select(*columns), columns, "left_anti")
    return marked.filter("NOT _chance").drop("_chance").unionByName(possible.select(*rows.columns))
