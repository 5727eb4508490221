"""Listing by key: ranges in batches, pages in streams, stores of any layout."""

from __future__ import annotations

import bisect
import os
import random
import sys
from collections import Counter
from functools import partial

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from rows import collected, storage

from foldcat.plans.sync import sync
from foldcat.sources.inventory import InventoryReader, save_inventory
from foldcat.sources.listing import list_objects
from foldcat.sources.listing_source import PageReader, apart, read_keys
from foldcat.sources.stores import PAGE, FolderStore, Listed, Store
from foldcat.streaming.pages import fold_pages, stream_store, sync_store

# The store below is opened by workers, which do not have this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Fake(Store):
    """A store of sorted keys that counts its calls and gives a page at most."""

    def __init__(self, keys):
        self.keys, self.calls = sorted(keys), []

    def page(self, prefix, after, limit):
        self.calls.append((after, limit))
        assert limit <= PAGE
        start = max(bisect.bisect_right(self.keys, after), bisect.bisect_left(self.keys, prefix))
        page = self.keys[start : start + limit]
        return [Listed(k, f'"e{k}"', len(k)) for k in page if k.startswith(prefix)]


def ranges(store, prefix, n):
    ends = store.split_points(prefix, n)
    assert ends == sorted(set(ends)) and len(ends) < n
    return list(zip(["", *ends], [*ends, None]))


KEYS = {
    "numbers": [f"0/{i}" for i in range(60_000)],
    "padded": [f"0/{i:09d}.exe" for i in range(60_000)],
    "digests": [f"0/{random.Random(i).getrandbits(128):032x}" for i in range(60_000)],
    "clumped": [f"0/very/long/common/stem/{'a' * (i % 7)}{i:06d}" for i in range(50_000)] + [f"0/z{i}" for i in range(10_000)],
    "folders": [f"0/{i % 300}/{i}" for i in range(60_000)],
    "odd": [f"0/{chr(0x20 + i % 0x5000)}{i}" for i in range(60_000) if not 0xD800 <= 0x20 + i % 0x5000 < 0xE000],
}


@pytest.mark.parametrize("kind", sorted(KEYS))
def test_ranges_of_about_one_size_without_listing(kind):
    store = Fake(KEYS[kind] + ["00", "1/x"])
    found = ranges(store, "0/", 16)
    calls = len(store.calls)
    listed = [[e.key for e in store.between("0/", *r)] for r in found]
    assert sorted(sum(listed, [])) == sorted(KEYS[kind])
    assert calls <= 1_000 and len(found) >= 12
    assert max(map(len, listed)) <= 2.5 * len(KEYS[kind]) / 16


def test_small_stores_are_one_range():
    for keys in ([], ["a"], [f"{i}" for i in range(900)]):
        store = Fake(keys)
        assert ranges(store, "", 8) == [("", None)]
        assert [e.key for e in store.between("", "", None)] == sorted(keys)


def test_pages_of_a_folder_are_those_of_a_sorted_list(tmp_path):
    keys = ["a", "b/c", "b/d/e", "b.x", "b0", "c/.d", "c/_e", "ü/z", "b/d0"]
    for key in keys:
        (tmp_path / key).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / key).write_bytes(b"1")
    folder, fake = FolderStore(f"file://{tmp_path}/"), Fake(keys)
    for prefix in ("", "b", "b/", "b/d", "c/", "x"):
        for after in ["", *sorted(keys), "zz"]:
            for limit in (1, 3, 100):
                want = [e.key for e in fake.page(prefix, after, limit)]
                assert [e.key for e in folder.page(prefix, after, limit)] == want
            for upto in [None, *keys]:
                want = sorted(e.key for e in fake.between(prefix, after, upto))
                assert sorted(e.key for e in folder.between(prefix, after, upto)) == want


@pytest.fixture(scope="module")
def flat(tmp_path_factory):
    """100,000 objects in one folder."""
    root = tmp_path_factory.mktemp("flat")
    for i in range(100_000):
        os.close(os.open(f"{root}/{i % 2}-{i}", os.O_CREAT | os.O_WRONLY))
    return str(root)


def test_one_folder_is_listed_by_many_tasks(spark, flat):
    listing = list_objects(spark, flat, ["0", "1"], tasks=20)
    sizes = [r["count"] for r in listing.groupBy(F.spark_partition_id().alias("task")).count().collect()]
    assert sum(sizes) == 100_000 == listing.select("Key").distinct().count()
    assert len(sizes) == 40 and max(sizes) < 2 * 100_000 / 40


def test_a_client_of_a_store_lists_with_etags(spark):
    keys = [f"0/{i:05d}" for i in range(5_000)] + ["1/a", "2/b"]
    listing = list_objects(spark, partial(Fake, keys), ["0", "1", "0/1"], tasks=3)
    assert sorted(r.Key for r in listing.collect()) == sorted(keys[:-1])
    assert listing.filter("ETag != concat('\"e', Key, '\"') OR Size != length(Key)").count() == 0
    assert read_keys(spark, partial(Fake, []), "").count() == 0
    assert apart(["0/1", "0", "1", "0"]) == ["0", "1"]


def pages_of(spark, log):
    rows = spark.read.parquet(log).select("page", "name").collect()
    pages = {}
    for row in rows:
        pages.setdefault(row.page, []).append(row.name)
    return {page: sorted(names) for page, names in pages.items()}


def test_a_stream_stops_and_resumes_behind_the_last_key(spark, tmp_path):
    """Stopped after page 2, it goes on with page 3; objects before its last key are not listed again."""
    keys = [f"{i % 2}/{i:03d}" for i in range(70)]
    root, log, offsets = tmp_path / "store", str(tmp_path / "log"), str(tmp_path / "offsets")
    for key in keys:
        (root / key).parent.mkdir(parents=True, exist_ok=True)
        (root / key).write_bytes(key.encode())
    stream = lambda: stream_store(spark, str(root), 10)

    class Stop(Exception):
        pass

    def two_pages(batch, number):
        if number == 2:
            raise Stop
        batch.write.mode("overwrite").parquet(f"{log}-raw/page={number}")

    query = stream().writeStream.foreachBatch(two_pages).option("checkpointLocation", offsets).start()
    with pytest.raises(Exception, match="Stop"):
        query.awaitTermination(120)
    # What lies before the last key of page 2 may change: it is behind the offset.
    (root / "0/0000").write_bytes(b"late")
    sync_store(stream(), log, offsets)
    found, ordered = pages_of(spark, log), sorted(keys)
    assert found == {k: ordered[10 * k : 10 * k + 10] for k in range(2, 7)}
    sync_store(stream(), log, offsets)
    assert pages_of(spark, log) == found


def test_a_stream_of_keys_equals_a_batch_sync(spark, tmp_path):
    keys = [f"{i % 3}/n{i}" for i in range(2_345)]
    log = str(tmp_path / "log")
    catalogue = storage(spark, ("0/n0", "e0/n0", 99, True), ("0/old", "h", 1, False))
    pages = stream_store(spark, partial(Fake, keys), 400, ["0", "1", "2/n5"])
    sync_store(pages, log, str(tmp_path / "offsets"), "2024-01-03")
    batch = sync(catalogue, list_objects(spark, partial(Fake, keys)), "2024-01-03")
    assert collected(fold_pages(catalogue, log)) == collected(batch)
    assert len(os.listdir(log)) >= 4


def test_offsets_of_pages():
    reader = PageReader(partial(Fake, [f"{i % 3}/{i:02d}" for i in range(30)]), ["0", "2"], 8)
    ends = [reader.initialOffset(), *(reader.latestOffset() for _ in range(5))]
    assert [e["after"] for e in ends] == ["", "0/21", "2/17", "2/29", "2/29", "2/29"]
    counts = Counter()
    for start, end in zip(ends, ends[1:]):
        if start != end:
            for part in reader.partitions(start, end):
                for batch in reader.read(part):
                    counts.update(batch.column(0).to_pylist())
    assert sorted(counts) == [k for k in sorted(f"{i % 3}/{i:02d}" for i in range(30)) if k[0] != "1"]
    assert set(counts.values()) == {1}


def put(root, keys):
    for key in keys:
        (root / key).parent.mkdir(parents=True, exist_ok=True)
        (root / key).write_bytes(key.encode())


def test_a_folder_is_not_run_over_for_each_page(spark, tmp_path, monkeypatch):
    """However many pages there are, as many calls look at the folder."""
    put(tmp_path / "store", [f"{i % 2}/{i:03d}" for i in range(60)])
    counted = []
    for size in (5, 30):
        calls = tmp_path / f"calls{size}"
        names = FolderStore._names

        def counting(self, *args, _names=names, _calls=str(calls)):
            with open(_calls, "a") as log:
                log.write("x")
            return _names(self, *args)

        with monkeypatch.context() as patched:
            patched.setattr(FolderStore, "_names", counting)
            log = str(tmp_path / f"log{size}")
            sync_store(stream_store(spark, str(tmp_path / "store"), size), log, str(tmp_path / f"offsets{size}"))
        assert [len(p) for _, p in sorted(pages_of(spark, log).items())] == [size] * (60 // size)
        counted.append(len(calls.read_text()))
    assert counted[0] == counted[1]


def test_pages_at_once_and_objects_that_come_later(spark, tmp_path):
    keys = [f"{i % 2}/{i:03d}" for i in range(70)]
    root, log, offsets = tmp_path / "store", str(tmp_path / "log"), str(tmp_path / "offsets")
    put(root, keys)
    stream = stream_store(spark, str(root), 10, pages=3)
    late = ["1/9", "1/99", "2/a"]
    put(root, late)
    sync_store(stream, log, offsets)
    ordered = sorted(keys)
    assert pages_of(spark, log) == {0: ordered[:30], 1: ordered[30:60], 2: ordered[60:], 3: ["1/9", "1/99"]}  # 2/ has no class
    put(root, ["1/0", "1/999", "3/b"])
    sync_store(stream_store(spark, str(root), 10, ["0", "1", "3"], pages=3), log, offsets)
    # The offset was "2/a": what comes before it stays out, as in a store that is asked for pages.
    assert sorted(os.listdir(log)) == [f"page={k}" for k in range(5)]
    assert {k: len(names) for k, names in pages_of(spark, log).items()} == {0: 30, 1: 30, 2: 10, 3: 2}
    catalogue = storage(spark, ("0/old", "h", 1, False))
    for name, stream in {"missing": stream_store(spark, str(tmp_path / "missing"), 10), "none": stream_store(spark, str(root), 10, [])}.items():
        sync_store(stream, str(tmp_path / f"log-{name}"), str(tmp_path / f"offsets-{name}"))
        assert collected(fold_pages(catalogue, str(tmp_path / f"log-{name}"))) == collected(catalogue)


@pytest.mark.parametrize("size,pages", [(7, 1), (7, 4), (100, 2)])
def test_an_inventory_has_every_key_once_from_any_key_on(spark, tmp_path, size, pages):
    keys = sorted({f"{i % 3}/{chr(0x61 + i * 7 % 900)}{i}" for i in range(300)})
    put(tmp_path / "store", keys)
    path = save_inventory(spark, str(tmp_path / "store"), ["0", "2"], size)
    wanted = [k for k in keys if k[0] != "1"]
    for begin in ("", wanted[0], wanted[57], wanted[57] + "!", wanted[-1], "1/zz"):
        reader = InventoryReader(path, str(tmp_path / "store"), ["0", "2"], size, pages)
        position, left = begin, [k for k in wanted if k > begin]
        reader.position = begin
        while (end := reader.latestOffset()["after"]) != position:
            parts = reader.partitions({"after": position}, {"after": end})
            found = [k for part in parts for batch in reader.read(part) for k in batch["Key"].to_pylist()]
            assert found == left[: size * pages]
            position, left = end, left[size * pages :]
        assert not left


def test_pages_of_a_store_at_once():
    reader = PageReader(partial(Fake, [f"0/{i:02d}" for i in range(30)]), ["0"], 8, 3)
    assert [reader.latestOffset()["after"] for _ in range(3)] == ["0/23", "0/29", "0/29"]
    reader = PageReader(partial(Fake, [f"0/{i:02d}" for i in range(30)]), ["0"], 8, 3)
    parts = reader.partitions(reader.initialOffset(), reader.latestOffset())
    assert [(p.after, p.upto) for p in parts] == [("", "0/07"), ("0/07", "0/15"), ("0/15", "0/23")]
    # After a restart, what was planned is one range.
    again = PageReader(partial(Fake, [f"0/{i:02d}" for i in range(30)]), ["0"], 8, 3)
    assert len(again.partitions({"after": ""}, {"after": "0/23"})) == 1 and again.latestOffset() == {"after": "0/29"}
