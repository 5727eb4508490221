"""Catalogue, result and binary frames derived from the given ``documents`` and ``labels`` tables.

Each document is an object of the store. Its class is that of its feed: the feeds with two-digit
numbers are the malicious collection. Documents labelled with good quality count as processed before.
All steps on whole texts are projections at the scan, so no join or shuffle carries a text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foldcat.functions import pe
from foldcat.functions.catalogue import stamp
from foldcat.schemas import EXTRACTED, LISTING, STORAGE
from foldcat.sources.listing import label_listing

SYNCED_AT = "2023-12-01 00:00:00"
RESYNCED_AT = "2023-12-02 00:00:00"
SYNCED_LAST_AT = "2023-12-03 00:00:00"
EXTRACTED_AT = "2023-12-05 00:00:00"
AS_OF = "2023-12-06 00:00:00"

# The given tables; stating the schema spares a job that reads file footers.
SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def object_name() -> Column:
    folder = F.when(F.length("source") == 5, "1").otherwise("0")
    return F.concat_ws("/", folder, "source", F.col("doc_id").cast("string"))


def raw_listing(documents: DataFrame, *kept: str) -> DataFrame:
    """One (Key, ETag, Size) row per document, the ETag in quotes as object stores give it."""
    return documents.select(
        *kept,
        object_name().alias("Key"),
        F.concat(F.lit('"'), F.md5("text"), F.lit('"')).alias("ETag"),
        F.octet_length("text").cast("bigint").alias("Size"),
    )


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_listing(table(spark, sf_dir, "documents"))


def storage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue after one sync of all documents."""
    labelled = label_listing(listing(spark, sf_dir))
    return labelled.withColumn("sync_time", stamp(SYNCED_AT)).select(*STORAGE.names)


def _by_label(spark: SparkSession, sf_dir: str, condition: str) -> DataFrame:
    """Listing rows of the documents whose label meets the condition."""
    rows = raw_listing(table(spark, sf_dir, "documents"), "doc_id")
    chosen = table(spark, sf_dir, "labels").filter(condition).select("doc_id")
    return label_listing(rows.join(chosen, "doc_id", "left_semi"))


def extracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of an earlier run: the documents of good quality."""
    done = _by_label(spark, sf_dir, "quality = 1")
    return with_expected_metadata(done).withColumn("created_at", stamp(EXTRACTED_AT)).select(
        *EXTRACTED.names
    )


def _digit(position: int) -> Column:
    return F.conv(F.substring("hash", position, 1), 16, 10).cast("int")


def with_expected_metadata(files: DataFrame) -> DataFrame:
    """Metadata as a function of the content hash: what ``binary_of`` builds into a binary."""
    valid = _digit(1) < 15
    dll = _digit(3) % 2 == 0
    return files.select(
        *LISTING.names,
        F.when(valid, F.when(_digit(1) % 2 == 0, "x64").otherwise("x32")).alias("architecture"),
        F.when(valid, _digit(2)).alias("num_imports"),
        F.when(valid, F.when(dll, _digit(4)).otherwise(0)).alias("num_exports"),
        F.when(valid, F.when(dll, "dll").otherwise("exe")).alias("type"),
        F.when(valid, "EXTRACTED").otherwise("ERROR").alias("status"),
    )


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as an object body (name, content) that is its text."""
    return table(spark, sf_dir, "documents").select(object_name().alias("name"), F.col("text").cast("binary").alias("content"))


def etag_of_parts(content: str, part: int) -> Column:
    """The ETag of a body, composite if it was put in two parts, as bodies of more than one part are here."""
    halves = [F.md5(F.substring(content, 1, part)), F.md5(F.substring(content, part + 1, part))]
    composite = F.concat(F.md5(F.unhex(F.concat(*halves))), F.lit("-2"))
    size = F.octet_length(content)
    return F.when((size > part) & (size <= 2 * part), composite).otherwise(F.md5(content))


def retry_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attempts at some of the failed contents: as many as the second digit says, the last when results were made."""
    failed = extracted(spark, sf_dir).filter("status = 'ERROR'").select("hash").distinct()
    tried = failed.filter(_digit(2) > 0).select("hash", _digit(2).alias("attempts"))
    return tried.withColumn("last_tried", stamp(EXTRACTED_AT))


def mended_binaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bodies, where of the broken ones those with an even third digit are PE files now."""
    bodies = table(spark, sf_dir, "documents").select(object_name().alias("name"), F.md5("text").alias("hash"), "text")
    mended = F.when((_digit(1) == 15) & (_digit(3) % 2 == 0), F.concat(F.lit("0"), F.substring("hash", 2, 31)))
    return bodies.withColumn("hash", F.coalesce(mended, "hash")).select("name", "hash", binary_of("text").alias("content"))


def binaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as an object body (name, hash, content)."""
    named = table(spark, sf_dir, "documents").select(
        object_name().alias("name"), F.md5("text").alias("hash"), "text"
    )
    return named.select("name", "hash", binary_of("text").alias("content"))


def binary_of(text: str) -> Column:
    """A PE file shaped by the digits of ``hash`` with the text behind its sections.

    First digit f: the text alone, which is no PE. The layout is that of the published format: headers,
    one section at RVA 0x1000 and file offset 0x200, in it the export directory, its address and
    ordinal tables at +0x40 and +0x80, and the import descriptors at +0x100.
    """
    h1, h2, h3, h4 = (f"cast(conv(substring(hash, {i}, 1), 16, 10) AS int)" for i in range(1, 5))
    wide, dll = f"{h1} % 2 = 0", f"{h3} % 2 = 0"
    other = f"if({h1} % 4 = 1, {_le(0x014C, 2)}, {_le(0xAA64, 2)})"
    dos = f"'4D5A', {_zeros(58)}, {_le(64, 4)}"
    coff = f"""'{pe.NT_SIGNATURE.hex()}', if({wide}, {_le(pe.MACHINE_AMD64, 2)}, {other}), {_le(1, 2)},
        {_zeros(12)}, if({wide}, {_le(240, 2)}, {_le(224, 2)}), {_zeros(2)}"""
    import_size = f"lpad(hex(20 * ({h2} + 1)), 4, '0')"
    optional = f"""if({wide}, concat({_le(0x20B, 2)}, {_zeros(106)}), concat({_le(0x10B, 2)}, {_zeros(90)})),
        {_le(16, 4)},
        if({dll}, concat({_le(0x1000, 4)}, {_le(40, 4)}), {_zeros(8)}),
        if({h2} > 0, concat({_le(0x1100, 4)}, right({import_size}, 2), left({import_size}, 2), {_zeros(2)}),
           {_zeros(8)}),
        {_zeros(14 * pe.DIRECTORY_SIZE)}"""
    section = f"""'{b".rdata".ljust(8, bytes(1)).hex()}', {_le(0x400, 4)}, {_le(0x1000, 4)},
        {_le(0x400, 4)}, {_le(0x200, 4)}, {_zeros(16)}"""
    count = f"lpad(hex({h4}), 2, '0'), {_zeros(3)}"
    exports = f"""{_zeros(16)}, {_le(1, 4)}, {count}, {count}, {_le(0x1040, 4)}, {_zeros(4)}, {_le(0x1080, 4)}"""
    addresses = f"repeat({_le(0x1200, 4)}, {h4})"
    ordinals = f"left('{''.join(f'{i:02x}00' for i in range(16))}', 4 * {h4})"
    imports = f"repeat({_le(0x01010101, 4)}, 5 * {h2})"
    head = f"rpad(concat({dos}, {coff}, {optional}, {section}), {2 * 0x200}, '0')"
    parts = [(f"concat({exports})", 0x40), (addresses, 0x40), (ordinals, 0x80), (imports, 0x300)]
    body = ", ".join(f"rpad({part}, {2 * width}, '0')" for part, width in parts)
    return F.expr(
        f"""if({h1} = 15, cast({text} AS binary),
                concat(unhex(concat({head}, {body})), cast({text} AS binary)))"""
    )


def _le(value: int, width: int) -> str:
    return f"'{value.to_bytes(width, 'little').hex()}'"


def _zeros(width: int) -> str:
    return f"'{'00' * width}'"


def catalogue_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents with another size, and older versions of them under the same names."""
    known = _by_label(spark, sf_dir, "true").withColumn("size", F.col("size") + 1)
    older = known.withColumn("hash", F.md5("hash"))
    return known.unionByName(older).withColumn("sync_time", stamp(SYNCED_AT))


def resync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents listed, then the toxic ones listed again with another size, later."""
    first = label_listing(listing(spark, sf_dir)).select(
        *LISTING.names, stamp(RESYNCED_AT).alias("sync_time"), F.lit(1).alias("ord")
    )
    again = _by_label(spark, sf_dir, "toxic = 1").withColumn("size", F.col("size") + 7)
    return first.unionByName(
        again.select(*LISTING.names, stamp(SYNCED_LAST_AT).alias("sync_time"), F.lit(2).alias("ord"))
    )


def damaged_storage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue with toxic documents twice, and with documents of poor quality without a hash."""
    twice = _by_label(spark, sf_dir, "toxic = 1")
    unknown = _by_label(spark, sf_dir, "quality = 0").withColumn("hash", F.lit(None).cast("string"))
    extra = twice.unionByName(unknown).withColumn("sync_time", stamp(SYNCED_AT))
    return storage(spark, sf_dir).unionByName(extra)
