"""Changed bodies, failed contents that are tried again, bodies by slots, and sketches of keys."""

from __future__ import annotations

import hashlib
import random

import pe_files
import pytest
from pyspark.sql import functions as F
from rows import collected, extracted, storage

from foldcat.functions.pe import pe_metadata
from foldcat.operators import backlog
from foldcat.operators.contents import content_sketches, count_contents, merged_sketches
from foldcat.operators.membership import anti_join, chance_members, key_bitmap, merged_bitmaps, with_chance
from foldcat.plans.extract import balanced_extract
from foldcat.plans.retry import LEDGER, due_contents, retry_errors
from foldcat.plans.sync import sync
from foldcat.schemas import FILE_KEY, LISTING
from foldcat.sources import etags
from foldcat.sources.bodies import extract_from_slots, save_slots
from foldcat.sources.objects import extract_from_contents, extract_from_store, verify_contents
from foldcat.sources.partitioned import read_parts, sync_parts, upsert_parts


def composite(body, part):
    parts = [body[i : i + part] for i in range(0, len(body), part)] or [b""]
    return f"{hashlib.md5(b''.join(hashlib.md5(p).digest() for p in parts)).hexdigest()}-{len(parts)}"


def in_stretches(body, rng):
    at = 0
    while at < len(body):
        step = rng.choice([1, 7, 100, 5_000])
        yield body[at : at + step]
        at += step


def test_composite_etags_of_unknown_part_size():
    rng = random.Random(1)
    for size in (0, 1, 99, 100, 101, 1_000, 12_345):
        body = rng.randbytes(size)
        plain = hashlib.md5(body).hexdigest()
        for etag in (plain, f'"{plain}"', composite(body, size + 1), *(composite(body, p) for p in (64, 100, 999))):
            assert etags.body_matches(etag, size, in_stretches(body, rng), (64, 100, 999)), (size, etag)
            for other in (body + b"x", body[:-1] + b"\x00\x01"):
                assert not etags.body_matches(etag, len(other), in_stretches(other, rng), (64, 100, 999))
    assert not etags.body_matches("no digest", 3, [b"abc"])
    # A part size that nobody is known to use cannot be told from another body.
    assert not etags.body_matches(composite(b"a" * 500, 77), 500, [b"a" * 500], (64, 100))


def test_part_sizes():
    mib = etags.MIB
    assert etags.part_sizes(20 * mib, 3) == [7 * mib, 8 * mib]
    assert etags.part_sizes(10 * mib, 2) == [5 * mib, 8 * mib]
    assert 5 * mib in etags.part_sizes(5 * mib * 9_999 + 1, 10_000)
    assert etags.part_sizes(30_000 * mib * 10, 10_000) == [30 * mib]
    assert etags.part_sizes(7, 1) == [7] and etags.part_sizes(0, 1) == [1]


def test_changed_bodies_are_errors_not_metadata_of_old_hashes(spark, tmp_path):
    body = pe_files.GOLDEN_DLL
    listed = {"0/same": body, "0/parts": body, "0/changed": body + b"old", "1/bad": b"invalid"}
    (tmp_path / "0").mkdir()
    (tmp_path / "1").mkdir()
    for name, listed_body in listed.items():
        (tmp_path / name).write_bytes(body if name == "0/changed" else listed_body)
    hashes = {n: composite(b, 64) if n == "0/parts" else hashlib.md5(b).hexdigest() for n, b in listed.items()}
    files = spark.createDataFrame([(n, hashes[n], len(b), n[0] == "1") for n, b in listed.items()], LISTING)
    status = lambda **options: {r.name: r.status for r in extract_from_store(str(tmp_path), **options)(files, None).collect()}
    assert status() == {"0/same": "EXTRACTED", "0/parts": "EXTRACTED", "0/changed": "EXTRACTED", "1/bad": "ERROR"}
    want = {"0/same": "EXTRACTED", "0/parts": "EXTRACTED", "0/changed": "ERROR", "1/bad": "ERROR"}
    assert status(verify_hash=True, part_sizes=[64]) == want
    verified = verify_contents(files, str(tmp_path), part_sizes=[64]).collect()
    assert {r.name for r in verified if not r.verified} == {"0/changed"}


def bodies(spark, rows):
    return spark.createDataFrame([(n, bytearray(b)) for n, b in rows.items()], "name string, content binary")


def ledger(spark, *rows):
    return spark.createDataFrame([], LEDGER).unionByName(
        spark.createDataFrame(list(rows), "hash string, attempts int, at string").selectExpr("hash", "attempts", "timestamp(at) AS last_tried")
    )


def test_a_content_that_failed_twice_ends_extracted_once(spark):
    """State is what two snapshots say; each run reads those of the run before."""
    failed = ("0/a", "h", 1, None, None, None, None, "ERROR", False)
    table = extracted(spark, failed, ("1/b", "h", 1, None, None, None, None, "ERROR", True), ("0/c", "k", 1, "x64", 1, 0, "exe", "EXTRACTED", False))
    bad, good = bodies(spark, {"0/a": b"bad", "1/b": b"bad", "0/c": b""}), bodies(spark, {"0/a": pe_files.GOLDEN_DLL, "1/b": b"not read", "0/c": b""})
    known = spark.createDataFrame([], LEDGER)
    seen = []
    # Recorded at midnight; tried again after an hour, after two more, after four more.
    for as_of, source in (
        ("2024-01-01 00:30:00", good),
        ("2024-01-01 01:00:00", bad),
        ("2024-01-01 02:59:00", good),
        ("2024-01-01 03:00:00", bad),
        ("2024-01-01 06:59:59", good),
        ("2024-01-01 07:00:00", good),
        ("2024-02-01 00:00:00", bad),
    ):
        table, known = retry_errors(table, known, extract_from_contents(source), as_of)
        table, known = (spark.createDataFrame(df.collect(), df.schema) for df in (table, known))
        seen.append(({r.name: r.status for r in table.collect()}, [r.attempts for r in known.collect()]))
    waiting, done = ({"0/a": s, "1/b": s, "0/c": "EXTRACTED"} for s in ("ERROR", "EXTRACTED"))
    assert seen == [(waiting, []), (waiting, [2]), (waiting, [2]), (waiting, [3]), (waiting, [3]), (done, []), (done, [])]
    rows = {r.name: r for r in table.collect()}
    assert len(rows) == table.count() == 3
    assert str(rows["0/a"].created_at) == str(rows["1/b"].created_at) == "2024-01-01 07:00:00"
    assert rows["0/a"].architecture == rows["1/b"].architecture == "x64" and rows["1/b"].malicious


def test_attempts_end_and_waits_double(spark):
    table = extracted(spark, *[(f"0/{h}", h, 1, None, None, None, None, "ERROR", False) for h in "abcd"])
    known = ledger(spark, ("a", 6, "2024-01-01 00:00:00"), ("b", 3, "2024-01-01 00:00:00"), ("c", 4, "2024-01-01 00:00:00"), ("gone", 2, "2024-01-01 00:00:00"))
    due = lambda as_of: sorted(r.hash for r in due_contents(table, known, as_of).collect())
    assert [due(f"2024-01-{t}") for t in ("01 03:59:59", "01 04:00:00", "01 08:00:00", "31 00:00:00")] == [["d"], ["b", "d"], ["b", "c", "d"], ["b", "c", "d"]]


def test_error_twins_are_carried_unless_retried(spark):
    files = storage(spark, ("0/new", "h", 1, False))
    table = extracted(spark, ("0/old", "h", 1, None, None, None, None, "ERROR", False))
    extract = extract_from_contents(bodies(spark, {"0/new": pe_files.GOLDEN_DLL}))
    run = lambda **options: [r.status for r in balanced_extract(files, table, extract, 10, **options).collect()]
    assert run() == ["ERROR"] and run(retry_errors=True) == ["EXTRACTED"]


@pytest.fixture
def slots(spark, tmp_path):
    rows = {f"0/{i}": pe_files.GOLDEN_DLL if i % 3 else b"bad" for i in range(200)}
    path = str(tmp_path / "slots")
    frame = bodies(spark, rows)
    save_slots(frame.limit(120), path, 16)
    save_slots(frame.subtract(frame.limit(120)), path, 16)
    return path, frame


def test_slots_that_a_batch_does_not_touch_are_not_read(spark, slots):
    path, frame = slots
    files = spark.createDataFrame([(f"0/{i}", "h", 1, False) for i in (3, 4, 5)], LISTING)
    extract = extract_from_slots(spark, path, 16)
    few, many = extract(files, 3), extract(files, None)
    want = pe_metadata(frame.join(files, "name")).select(*few.columns)
    assert collected(few) == collected(many) == collected(want)
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruningexpression" in plan.lower()
    assert "PartitionFilters: [isnotnull(slot" in plan


def test_large_batches_move_no_body(spark, slots):
    path, _ = slots
    files = spark.createDataFrame([(f"0/{i}", "h", 1, False) for i in range(150)], LISTING)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = extract_from_slots(spark, path, 16)(files, None)._jdf.queryExecution().executedPlan().toString()
        narrow = extract_from_contents(spark.read.parquet(path))(files, None)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for text in (plan, narrow):
        # The exchange of what was parsed stands above the projection that parses, and has no body.
        exchanges = [line for line in text.splitlines() if "Exchange hashpartitioning(name" in line]
        assert exchanges and "content" not in " ".join(exchanges)


def test_sketches_lose_no_member_and_few_others_stay(spark):
    keys = spark.range(0, 40_000, 2).selectExpr("concat('n', id) AS name", "'h' AS hash")
    rows = spark.range(40_000).selectExpr("concat('n', id) AS name", "'h' AS hash", "id")
    bits = 1 << 20
    marked = with_chance(rows, key_bitmap(keys, FILE_KEY, bits), FILE_KEY, bits)
    counts = {(r.odd, r._chance): r["count"] for r in marked.groupBy((F.col("id") % 2).alias("odd"), "_chance").count().collect()}
    assert counts[0, True] == 20_000 and (0, False) not in counts
    assert counts[1, True] < 20_000 * 1.3 * 20_000 / bits
    halves = [key_bitmap(keys.filter(f"pmod(hash(name), 2) = {k}"), FILE_KEY, bits) for k in (0, 1)]
    both = merged_bitmaps(halves[0].unionByName(halves[1]))
    assert collected(both) == collected(key_bitmap(keys, FILE_KEY, bits))
    assert both.count() <= bits // (1 << 15)
    assert chance_members(rows, keys.limit(0), FILE_KEY, bits).count() == 0


def test_sketches_leave_columns_of_any_name(spark):
    rows = spark.createDataFrame([("a", 1, 2, 3)], ["name", "_piece", "_Bitmap", "a.b"])
    keys = spark.createDataFrame([("a",)], "name string")
    got = chance_members(rows, keys, ["name"])
    assert got.columns == rows.columns and [tuple(r) for r in got.collect()] == [("a", 1, 2, 3)]


def test_anti_join_by_sketch_equals_the_plain_one(spark):
    keys = spark.createDataFrame([("a", "1"), ("b", None), (None, "2"), ("c", "3")], "name string, hash string")
    rows = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", None), (None, "2"), ("c", "3"), ("c", "3"), ("d", "4")], "name string, hash string")
    for bits in (1 << 15, 1 << 27):
        got, want = anti_join(rows, keys, FILE_KEY, bits), rows.join(keys, FILE_KEY, "left_anti")
        assert collected(got.select(*rows.columns)) == collected(want.select(*rows.columns))


def test_certain_misses_are_not_shuffled(spark):
    files = storage(spark, *[(f"n{i}", "h", 1, True) for i in range(2_000)])
    done = extracted(spark, *[(f"n{i}", "h", 1, "x64", 1, 0, "exe", "EXTRACTED", True) for i in range(20)])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = backlog.unprocessed_prefiltered(files, done)
        assert got.count() == 1_980
        assert collected(got) == collected(backlog.unprocessed(files, done))
        possible = with_chance(files, key_bitmap(done, FILE_KEY), FILE_KEY).filter("_chance")
        assert possible.count() < 25
        # One branch of the union has no exchange but the sketch's, which is sent to all.
        misses = got._jdf.queryExecution().executedPlan().toString().split("Union", 1)[1]
        first = misses[: misses.index("LeftAnti")]
        assert first.count("BroadcastExchange") >= 1 and "Exchange hashpartitioning(name" not in first
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def modified(path):
    return {d: max(f.stat().st_mtime_ns for f in d.iterdir()) for d in path.iterdir() if d.is_dir()}


def test_a_small_sync_rewrites_the_parts_it_touches(spark, tmp_path):
    path = tmp_path / "catalogue"
    before = storage(spark, *[(f"0/n{i}", f"h{i}", i, False) for i in range(300)])
    assert len(upsert_parts(spark, str(path), before, parts=32)) == 32
    times = modified(path)
    listing = spark.createDataFrame([("0/n7", '"h7"', 99), ("1/new", '"k"', 5), ("2/no", '"k"', 5)], "Key string, ETag string, Size bigint")
    touched = sync_parts(spark, str(path), listing, "2024-01-03", parts=32)
    assert len(touched) == 2
    changed = {d.name for d, t in modified(path).items() if times.get(d) != t}
    assert changed == {f"part={k}" for k in touched}
    want = sync(before, listing, "2024-01-03")
    assert collected(read_parts(spark, str(path))) == collected(want)
    # Run again, as after a failure, it gives the same catalogue; an empty listing touches nothing.
    times = modified(path)
    assert sync_parts(spark, str(path), listing.limit(0), "2024-01-04", parts=32) == []
    assert modified(path) == times
    assert sync_parts(spark, str(path), listing, "2024-01-03", parts=32) == touched
    assert collected(read_parts(spark, str(path))) == collected(want)
    assert read_parts(spark, str(tmp_path / "none")).count() == 0


def test_an_upsert_in_parts_reads_those_parts_only(spark, tmp_path):
    path = str(tmp_path / "catalogue")
    upsert_parts(spark, path, storage(spark, *[(f"0/n{i}", f"h{i}", i, False) for i in range(300)]), parts=32)
    plan = read_parts(spark, path, [3, 5])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [part" in plan and "(3,5)" in plan.replace(" ", "")


def test_contents_over_syncs_from_sketches(spark):
    """Three listings that overlap: distinct contents per prefix without the listings, within 2 %."""
    listings = [[(f"{i % 2}/n{i}", f"h{i % 7_000 if i % 3 else 0}", 1, False) for i in range(k * 5_000, k * 5_000 + 10_000)] for k in range(3)]
    sketches = [content_sketches(storage(spark, *rows)) for rows in listings]
    joined = sketches[0].unionByName(sketches[1]).unionByName(sketches[2])
    got = {r.prefix: r for r in count_contents(joined).collect()}
    for prefix in "01":
        rows = [r for rows in listings for r in rows if r[0][0] == prefix]
        exact = len({r[1] for r in rows})
        assert got[prefix].files == len(rows) and abs(got[prefix].contents - exact) <= 0.02 * exact
    # A state that was merged before gives the same.
    state = merged_sketches(sketches[0].unionByName(sketches[1])).unionByName(sketches[2])
    assert collected(count_contents(state)) == collected(count_contents(joined))
    assert count_contents(sketches[0].limit(0)).count() == 0
