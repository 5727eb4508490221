"""Listings, bodies and tables on files made for the test, and whole runs over them."""

from __future__ import annotations

import hashlib
import os
import time

import pe_files
import pytest
from pyspark.sql import functions as F
from rows import T1, T3, collected, extracted, storage

from foldcat.functions.pe import pe_metadata
from foldcat.operators.backlog import of_class, unprocessed
from foldcat.operators.partition_map import _in_order, map_rows
from foldcat.plans.extract import balanced_extract, incremental_extract
from foldcat.plans.sync import sync
from foldcat.schemas import EXTRACTED, LISTING, METADATA, STORAGE
from foldcat.sources import tables
from foldcat.sources.listing import label_listing, list_objects, read_inventory
from foldcat.sources.objects import (
    extract_from_contents,
    extract_from_store,
    fetch_contents,
    put_contents,
)
from foldcat.streaming.pages import (
    fold_pages,
    last_page,
    stream_inventory,
    stream_objects,
    sync_pages,
)

OBJECTS = {
    "0/feed a/one.dll": pe_files.GOLDEN_DLL,
    "0/feed a/copy.dll": pe_files.GOLDEN_DLL,
    "0/two.exe": pe_files.GOLDEN_EXE,
    "1/bad": b"invalid",
    "1/three.dll": pe_files.GOLDEN_DLL,
    "2/other": b"not listed",
}


@pytest.fixture
def store(tmp_path):
    root = tmp_path / "store"
    for key, body in OBJECTS.items():
        path = root / key
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(body)
    return str(root)


def md5(body):
    return hashlib.md5(body).hexdigest()


def test_listing_of_a_store(spark, store):
    for root in (store, f"file://{store}/"):
        rows = label_listing(list_objects(spark, root, with_etag=True))
        assert collected(rows) == sorted(
            (key, md5(body), len(body), key[0] == "1") for key, body in OBJECTS.items() if key[0] in "01"
        )
    assert {r.Key for r in list_objects(spark, store, "1").collect()} == {"1/bad", "1/three.dll"}
    assert list_objects(spark, store, "7").count() == 0


def test_listing_without_etags_reads_no_bodies(spark, store):
    steps = lambda df: df._jdf.queryExecution().executedPlan().toString().count("MapInArrow")
    listing = list_objects(spark, store)
    assert steps(list_objects(spark, store, with_etag=True)) == steps(listing) + 1
    assert {(r.Key, r.ETag, r.Size) for r in listing.collect()} == {(k, None, len(b)) for k, b in OBJECTS.items()}


def test_listing_keeps_every_key(spark, tmp_path):
    keys = ["0/_b.exe", "0/.c.exe", "0/_d/e.exe", "0/empty.exe", "0/[x]{y}*", "0/[x]z", "0/a b/ü?.exe", "0/d/d/d/f", "0x", "1/g", "top"]
    for key in keys:
        path = tmp_path / "store" / key
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"" if "empty" in key else key.encode())
    root = str(tmp_path / "store")
    listed = lambda prefix: sorted(r.Key for r in list_objects(spark, root, prefix).collect())
    assert listed("") == sorted(keys)
    for prefix in ("0", "0/", "0/_", "0/[x]", "0/d/d", "0/_d/e", "0/a b/ü?", "1/g", "none/x"):
        assert listed(prefix) == sorted(k for k in keys if k.startswith(prefix)), prefix
    assert listed(["0/d", "0/", "1", "0/d/d"]) == sorted(k for k in keys if k.startswith(("0/", "1")))
    hashed = {r.Key: r.ETag for r in list_objects(spark, root, with_etag=True).collect()}
    assert hashed == {k: f'"{md5(b"" if "empty" in k else k.encode())}"' for k in keys}
    paged = sync_pages(stream_objects(spark, root, 3), str(tmp_path / "log"), str(tmp_path / "offsets"))
    assert paged.awaitTermination(120)
    folded = fold_pages(storage(spark), str(tmp_path / "log"))
    assert {r.name for r in folded.collect()} == {k for k in keys if k[0] in "01"}
    assert last_page(spark, str(tmp_path / "log")) >= 0 and last_page(spark, str(tmp_path / "no")) == -1


def test_bodies_are_put_and_listed(spark, tmp_path):
    rows = [(k, bytearray(b)) for k, b in OBJECTS.items()]
    root = str(tmp_path / "put")
    put = put_contents(spark.createDataFrame(rows, "name string, content binary"), root)
    assert put.columns == ["name", "written"]
    assert {r.name: r.written for r in put.collect()} == {k: len(b) for k, b in OBJECTS.items()}
    assert {r.Key: r.Size for r in list_objects(spark, root).collect()} == {k: len(b) for k, b in OBJECTS.items()}


def test_a_slow_row_does_not_hold_up_the_others():
    started = []

    def slow_first(row):
        started.append(row["i"])
        if row["i"] == 0:
            deadline = time.time() + 20
            while len(started) < 4 and time.time() < deadline:
                time.sleep(0.01)
        return row["i"] if row["i"] or len(started) >= 4 else None

    assert list(_in_order(slow_first, ({"i": i} for i in range(4)), 4)) == [0, 1, 2, 3]


def test_prefixes_reach_the_scan_of_an_inventory(spark, tmp_path):
    path = str(tmp_path / "inventory")
    spark.createDataFrame([("0/a", "x", 1)], "Key string, ETag string, Size bigint").write.parquet(path)
    plan = label_listing(read_inventory(spark, path))._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(Key,0)" in plan


def test_inventory_with_quoted_etags(spark, tmp_path):
    path = str(tmp_path / "inventory")
    rows = [("0/a", '"abc"', 5), ("1/b", "def", 6), ("x", "y", 1)]
    spark.createDataFrame(rows, "k string, e string, s int").write.json(path)
    listing = read_inventory(spark, path, "json", key="k", etag="e", size="s")
    assert collected(label_listing(listing)) == [("0/a", "abc", 5, False), ("1/b", "def", 6, True)]
    assert label_listing(listing).schema["size"].dataType == LISTING["size"].dataType


def test_bodies_are_fetched_by_key(spark, store):
    files = label_listing(list_objects(spark, store, with_etag=True))
    fetched = fetch_contents(files, store, tasks=2)
    assert {r.name: bytes(r.content) for r in fetched.collect()} == {
        key: body for key, body in OBJECTS.items() if key[0] in "01"
    }
    by_range = collected(extract_from_store(store, tasks=2)(files))
    assert by_range == collected(pe_metadata(fetched))
    assert {row[0]: row[-1] for row in by_range}["1/bad"] == "ERROR"


def test_missing_object_fails_the_task(spark, store):
    files = storage(spark, ("0/gone", "h", 1, False))
    with pytest.raises(Exception, match="0/gone"):
        extract_from_store(store)(files).collect()


def test_file_without_a_result_fails_the_run(spark):
    files = storage(spark, ("0/gone", "h", 1, False))
    nothing = spark.createDataFrame([], "name string, content binary")
    for budget in (10, 2**31 - 1):
        extract = extract_from_contents(nothing)
        run = incremental_extract(files, extracted(spark), extract, False, budget)
        with pytest.raises(Exception, match="NULL in NOT NULL column size"):
            run.collect()


def test_sync_then_runs_until_nothing_is_left(spark, store, tmp_path):
    path = str(tmp_path / "extracted")
    catalogue = sync(spark.createDataFrame([], STORAGE), list_objects(spark, store, with_etag=True))
    assert catalogue.count() == 5
    sizes = []
    for _ in range(4):
        known = tables.read_table(spark, path, EXTRACTED)
        result = balanced_extract(catalogue, known, extract_from_store(store, tasks=2), 2)
        tables.append_table(result, path, EXTRACTED)
        sizes.append(tables.read_table(spark, path, EXTRACTED).count())
    assert sizes == [2, 4, 5, 5]
    rows = {r.name: r for r in tables.read_table(spark, path, EXTRACTED).collect()}
    assert set(rows) == {key for key in OBJECTS if key[0] in "01"}
    assert rows["1/bad"].status == "ERROR" and rows["1/bad"].num_imports is None
    for name in ("0/feed a/one.dll", "0/feed a/copy.dll", "1/three.dll"):
        row = rows[name]
        assert (row.architecture, row.num_imports, row.num_exports, row.type) == ("x64", 7, 6, "dll")


def test_batch_does_not_move_when_the_result_is_appended(spark, store, tmp_path):
    path = str(tmp_path / "extracted")
    files = label_listing(list_objects(spark, store, with_etag=True)).withColumn("sync_time", F.lit(T1))
    run = balanced_extract(
        files, tables.read_table(spark, path, EXTRACTED), extract_from_store(store), 2, "2024-01-03"
    )
    before = collected(run)
    tables.append_table(run, path, EXTRACTED)
    assert collected(run) == before == collected(tables.read_table(spark, path, EXTRACTED))


def test_one_pass_equals_benign_run_then_malicious_run(spark, store):
    files = label_listing(list_objects(spark, store, with_etag=True)).withColumn("sync_time", F.lit(T1))
    extract = extract_from_store(store)
    none = extracted(spark)
    benign = incremental_extract(files, none, extract, False, 100, "2024-01-03")
    malicious = incremental_extract(files, benign, extract, True, 100, "2024-01-03")
    both = balanced_extract(files, none, extract, 200, "2024-01-03")
    assert collected(both) == collected(benign.unionByName(malicious))


def test_bounded_and_unbounded_runs_agree(spark, store, monkeypatch):
    files = label_listing(list_objects(spark, store, with_etag=True)).withColumn("sync_time", F.lit(T1))
    bodies = fetch_contents(files.select("name"), store).select("name", "content")
    known = extracted(spark, ("old", md5(OBJECTS["0/two.exe"]), 3, "x64", 9, 9, "dll", "EXTRACTED", False))

    def run(budget):
        extract = extract_from_contents(bodies)
        return collected(incremental_extract(files, known, extract, False, budget, "2024-01-03"))

    bounded = run(100)
    assert run(2**31 - 1) == bounded
    for module in ("plans.extract", "operators.lookup", "operators.twins", "sources.objects"):
        monkeypatch.setattr(f"foldcat.{module}.BOUNDED_ROWS", 0)
    assert run(2**31 - 1) == bounded
    carried = ("0/two.exe", md5(OBJECTS["0/two.exe"]), 3, "x64", 9, 9, "dll", "EXTRACTED", False, T3)
    assert carried in bounded


def test_partitioned_table_prunes_the_other_class(spark, tmp_path):
    path = str(tmp_path / "storage")
    rows = storage(spark, ("a", "h", 1, True), ("b", "i", 2, False))
    tables.write_snapshot(rows, path, STORAGE, ("malicious",))
    with pytest.raises(Exception, match="already exists"):
        tables.write_snapshot(rows, path, STORAGE)
    table = tables.read_table(spark, path, STORAGE)
    assert collected(table) == collected(rows)
    plan = of_class(table, True)._jdf.queryExecution().executedPlan().toString()
    assert "(malicious#" in plan[plan.index("PartitionFilters") : plan.index("PushedFilters")]


def test_bucketed_tables_are_compared_without_a_shuffle(spark):
    suffix = str(time.time_ns())
    rows = [(f"n{i}", f"h{i}", i, False) for i in range(50)]
    tables.save_bucketed(storage(spark, *rows), f"s{suffix}", 4)
    done = [(*row[:3], "x64", 1, 0, "exe", "EXTRACTED", False) for row in rows[:20]]
    tables.save_bucketed(extracted(spark, *done), f"e{suffix}", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = unprocessed(spark.table(f"s{suffix}"), spark.table(f"e{suffix}"))
        assert "Exchange" not in left._jdf.queryExecution().executedPlan().toString()
        assert left.count() == 30
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_class_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "storage")
    tables.append_table(storage(spark, ("a", "h", 1, True)), path, STORAGE)
    plan = of_class(tables.read_table(spark, path, STORAGE), True).select("hash")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(malicious,true)" in text
    assert "ReadSchema: struct<hash:string,malicious:boolean>" in text


def test_append_refuses_a_missing_required_value(spark, tmp_path):
    broken = extracted(spark, ("a", "h", 1, "x64", 1, 0, "exe", "EXTRACTED", False)).withColumn(
        "status", F.lit(None).cast("string")
    )
    with pytest.raises(Exception, match="NOT NULL column status"):
        tables.append_table(broken, str(tmp_path / "t"), EXTRACTED)


class FakeReader:
    """Stands in for ``spark.read``; no database is started for tests."""

    def __init__(self, bounds):
        self.bounds, self.calls = bounds, []

    @property
    def read(self):
        return self

    def jdbc(self, url, table, **options):
        self.calls.append((table, options))
        return self

    def first(self):
        return self.bounds


def test_jdbc_table_is_read_in_ranges_of_its_key():
    reader = FakeReader((5, 104))
    tables.read_jdbc(reader, "jdbc:x", "files", {"user": "u"}, partitions=8)
    assert "min(id)" in reader.calls[0][0]
    table, options = reader.calls[1]
    assert table == "files"
    assert (options["column"], options["lowerBound"], options["upperBound"]) == ("id", 5, 105)
    assert options["numPartitions"] == 8
    empty = FakeReader((None, None))
    tables.read_jdbc(empty, "jdbc:x", "files", {}, partitions=8)
    assert "column" not in empty.calls[1][1]


def test_stream_of_pages_equals_batch_sync(spark, tmp_path):
    inventory, log = str(tmp_path / "inventory"), str(tmp_path / "log")
    rows = [(f"{i % 3}/n{i}", f'"h{i}"', i) for i in range(30)]
    for part in range(5):
        page = spark.createDataFrame(rows[part * 6 : part * 6 + 6], "Key string, ETag string, Size bigint")
        page.coalesce(1).write.mode("append").parquet(inventory)
    catalogue = storage(spark, ("0/n0", "h0", 99, True), ("0/old", "h", 1, False))
    listing = stream_inventory(spark, inventory, files_per_page=2)
    for _ in range(2):  # the second execution finds nothing new
        query = sync_pages(listing, log, str(tmp_path / "offsets"), "2024-01-03")
        assert query.awaitTermination(60)
    assert len([d for d in os.listdir(log) if d.startswith("page=")]) == 3
    batch = sync(catalogue, spark.read.parquet(inventory), "2024-01-03")
    assert collected(fold_pages(catalogue, log)) == collected(batch)


def test_replayed_page_counts_once_and_first_page_wins(spark, tmp_path):
    log = str(tmp_path / "log")
    first = storage(spark, ("0/a", "h", 1, False))
    first.write.mode("overwrite").parquet(f"{log}/page=0")
    first.write.mode("overwrite").parquet(f"{log}/page=0")
    later = storage(spark, ("0/a", "h", 2, True)).withColumn("sync_time", F.lit(T3))
    later.write.parquet(f"{log}/page=1")
    assert collected(fold_pages(storage(spark), log)) == [("0/a", "h", 1, False, T3)]
    assert fold_pages(first, str(tmp_path / "none")).count() == 1
    resynced = first.withColumn("sync_time", F.lit(T3))
    assert collected(fold_pages(resynced, log, after=1)) == collected(resynced)
    rest = fold_pages(first, log, after=0)
    assert collected(rest) == [("0/a", "h", 1, False, T3)]
    plan = rest._jdf.queryExecution().executedPlan().toString()
    assert "(page#" in plan[plan.index("PartitionFilters") :]


def test_stream_of_objects(spark, store, tmp_path):
    log = str(tmp_path / "log")
    query = sync_pages(stream_objects(spark, store, 2), log, str(tmp_path / "offsets"))
    assert query.awaitTermination(60)
    folded = fold_pages(storage(spark), log)
    assert {r.name for r in folded.collect()} == {k for k in OBJECTS if k[0] in "01"}
    assert folded.select("sync_time").distinct().count() == 1


def test_partition_map_keeps_declared_failures_and_drops_none(spark):
    class Declared(Exception):
        pass

    def open_function():
        opened = []

        def run(row):
            opened.append(row)
            if row["size"] == 1:
                raise Declared("known")
            if row["size"] == 2:
                return None
            return {"architecture": "x64", "num_imports": len(opened), "status": "EXTRACTED"}

        return run

    files = storage(spark, *[(f"n{i}", "h", i, True) for i in range(6)]).coalesce(1)
    rows = map_rows(files, open_function, METADATA, (Declared,)).orderBy("name").collect()
    assert [r.name for r in rows] == ["n0", "n1", "n3", "n4", "n5"]
    assert rows[1].status == "ERROR" and rows[1].architecture is None
    assert rows[-1].num_imports == 6  # opened once for the partition
    with pytest.raises(Exception, match="known"):
        map_rows(files, open_function, METADATA).collect()
