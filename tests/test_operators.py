"""The operators on the small cases of the survey, and their edge cases."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from rows import T1, T2, T3, collected, extracted, listing, storage

from foldcat.functions.catalogue import class_of, strip_quotes
from foldcat.operators import backlog, content, integrity, twins
from foldcat.operators.upsert import fold_conflicts, upsert
from foldcat.plans.extract import dedup_extract
from foldcat.schemas import EXTRACTED, STORAGE, enforce_schema

KNOWN = ("name1", "hash1", 1, "x64", 1, 1, "dll", "EXTRACTED", True)
TWO_FILES = [("name1", "hash1", 1, True), ("name2", "hash2", 2, True)]


def test_processed_file_is_left_out(spark):
    files = storage(spark, *TWO_FILES)
    batch = backlog.unprocessed_batch(files, extracted(spark, KNOWN), True, 1)
    assert [(r.name, r.hash) for r in batch.collect()] == [("name2", "hash2")]


def test_everything_is_unprocessed_at_first(spark):
    batch = backlog.unprocessed_batch(storage(spark, *TWO_FILES), extracted(spark), True, 2)
    assert batch.count() == 2


def test_changed_content_is_a_new_file(spark):
    files = storage(spark, ("name1", "hash9", 1, True))
    assert backlog.unprocessed(files, extracted(spark, KNOWN)).count() == 1


def test_class_of_the_extracted_row_does_not_matter(spark):
    files = storage(spark, ("name1", "hash1", 1, False))
    assert backlog.unprocessed(files, extracted(spark, KNOWN)).count() == 0


def test_matching_rows_of_files_with_one_content(spark):
    files = storage(spark, ("name1", "hash1", 1, True), ("name2", "hash1", 1, True))
    known = extracted(spark, KNOWN, ("name2", "hash2", 2, "x64", 1, 1, "dll", "EXTRACTED", True))
    for bound in (None, 2):
        rows = twins.matching_rows(files, known, bound).collect()
        assert [(r.name, r.hash) for r in rows] == [("name1", "hash1")]


def test_metadata_is_carried_from_the_twin(spark):
    files = storage(spark, ("other", "hash1", 7, False), ("name2", "hash2", 2, True))
    for parts in (1, 64):
        rows = twins.carry_metadata(files, extracted(spark, KNOWN), "2024-01-03", parts).collect()
        assert [tuple(r) for r in rows] == [("other", *KNOWN[1:], T3)]


def test_recorded_error_is_carried(spark):
    error = ("name1", "hash1", 1, None, None, None, None, "ERROR", True)
    files = storage(spark, ("other", "hash1", 1, True))
    rows = twins.carry_metadata(files, extracted(spark, error)).collect()
    assert [(r.name, r.status, r.type) for r in rows] == [("other", "ERROR", None)]
    assert rows[0].created_at is not None


def test_remaining_files(spark):
    rows = twins.remaining_files(storage(spark, *TWO_FILES), extracted(spark, KNOWN)).collect()
    assert [(r.name, r.hash) for r in rows] == [("name2", "hash2")]


def test_one_representative_per_hash_is_the_earliest(spark):
    known = extracted(
        spark,
        ("b", "h", 1, "x64", 1, 1, "dll", "EXTRACTED", True, T1),
        ("a", "h", 2, "x64", 2, 1, "dll", "EXTRACTED", True, T1),
        ("0", "h", 3, "x64", 3, 1, "dll", "EXTRACTED", True, T2),
    )
    assert [(r.name, r.num_imports) for r in twins.representatives(known).collect()] == [("a", 2)]
    files = storage(spark, ("new", "h", 9, False))
    for bound in (None, 1):
        assert twins.known_twins(files, known, bound).count() == 1


def test_one_per_hash_prefers_benign(spark):
    files = listing(spark, ("a", "h", 1, True), ("z", "h", 2, False), ("y", "h", 3, False))
    assert collected(content.one_per_hash(files)) == [("y", "h", 3, False)]


def test_parse_once_and_fan_out(spark):
    files = storage(spark, *TWO_FILES, ("copy", "hash1", 5, True))
    seen = []

    def extract(rows, bound):
        seen.append(rows)
        return rows.select(
            "*",
            F.lit("x32").alias("architecture"),
            F.lit(0).alias("num_imports"),
            F.lit(0).alias("num_exports"),
            F.lit("dll").alias("type"),
            F.lit("EXTRACTED").alias("status"),
        )

    result = dedup_extract(files, extract, "2024-01-03")
    metadata = ("x32", 0, 0, "dll", "EXTRACTED", True, T3)
    assert seen[0].count() == 2
    assert collected(result) == [
        ("copy", "hash1", 5, *metadata),  # the parsed file of hash1 is the first by name: copy
        ("name1", "hash1", 5, *metadata),
        ("name2", "hash2", 2, *metadata),
    ]
    assert result.columns == EXTRACTED.names


def test_budget_is_split_and_odd_file_dropped(spark):
    rows = [(f"{i}", f"h{i}", i, i % 4 == 0) for i in range(40)]
    files = storage(spark, *rows)
    for budget, per_class in ((7, 3), (1, 0), (60, 30)):
        batch = backlog.balanced_batch(files, extracted(spark), budget)
        counts = {r.malicious: r["count"] for r in batch.groupBy("malicious").count().collect()}
        assert counts.get(False, 0) == min(per_class, 30)
        assert counts.get(True, 0) == min(per_class, 10)


@pytest.mark.parametrize("budget", [1, 5, 250, 600, 5000])
def test_large_budget_picks_the_same_files(spark, budget):
    rows = [(f"n{i}", "hot" if i % 3 == 0 else f"h{i % 50}", i, i % 7 == 0) for i in range(1500)]
    files = storage(spark, *rows)
    ranked = files.orderBy(backlog.pick_key(), "name", "hash").collect()
    expected = sorted(r.name for r in ranked[:budget])
    cells = backlog.first_by_cells(files, budget, [])
    assert sorted(r.name for r in cells.collect()) == expected
    assert sorted(r.name for r in backlog.first_files(files, budget).collect()) == expected
    per_class = [[r.name for r in ranked if r.malicious == flag][:budget] for flag in (False, True)]
    both = backlog.first_files_per_class(files, budget)
    cells = backlog.first_by_cells(files, budget, ["malicious"])
    assert sorted(r.name for r in both.collect()) == sorted(sum(per_class, []))
    assert sorted(r.name for r in cells.collect()) == sorted(sum(per_class, []))


def test_upsert_equals_row_by_row_application(spark):
    target = [("a", "1", 1, True, T1), ("b", "1", 2, False, T1)]
    incoming = [
        (1, "a", "1", 9, False, T2),
        (2, "a", "2", 5, True, T2),
        (3, "c", "1", 6, True, T3),
        (4, "c", "1", 7, False, T2),
        (5, "a", "1", 8, False, T3),
    ]
    state = {row[:2]: row[2:] for row in target}
    for _, name, hash_, size, malicious, sync_time in incoming:
        kept = state.get((name, hash_), (size, malicious, None))
        state[name, hash_] = (*kept[:2], sync_time)
    frame = spark.createDataFrame(incoming, "ord int, " + ", ".join(
        f"{f.name} {f.dataType.simpleString()}" for f in STORAGE.fields
    ))
    got = upsert(spark.createDataFrame(target, STORAGE), frame, "ord")
    assert collected(got) == sorted(((*k, *v) for k, v in state.items()), key=repr)
    assert got.columns == STORAGE.names
    folded = {tuple(r)[:2]: tuple(r)[2:] for r in fold_conflicts(frame, "ord").collect()}
    assert folded["c", "1"] == (6, True, T2)


def test_rows_in_one_place_fold_to_the_same_row_in_any_partitioning(spark):
    rows = [("a", "1", size, size == 3, time) for size in (9, 3, 3, 7) for time in (T2, T3)]
    for tasks in (1, 5):
        frame = spark.createDataFrame(rows, STORAGE).repartition(tasks)
        assert collected(upsert(storage(spark), frame)) == [("a", "1", 3, True, T3)]
        known = storage(spark, ("a", "1", 5, False))
        assert collected(upsert(known, frame)) == [("a", "1", 5, False, T3)]


def test_batch_split_by_twins_equals_the_two_joins(spark):
    files = storage(spark, *[(f"n{i}", "hot" if i % 3 == 0 else f"h{i % 9}", i, i % 2 == 0) for i in range(60)])
    known = extracted(
        spark,
        ("z", "hot", 1, "x64", 1, 0, "exe", "EXTRACTED", True),
        ("y", "h2", 2, None, None, None, None, "ERROR", False),
    )
    for parts in (1, 64):
        matched = twins.match_twins(files, known, parts)
        assert collected(twins.carried(matched, "2024-01-03")) == collected(twins.carry_metadata(files, known, "2024-01-03", parts))
        left = twins.unmatched(matched)
        assert collected(left) == collected(twins.remaining_files(files, known, parts))
        assert sorted(left.columns) == sorted(files.columns)


def test_upsert_twice_changes_nothing(spark):
    target = storage(spark, *TWO_FILES)
    incoming = storage(spark, ("name3", "hash3", 3, False), *TWO_FILES)
    once = upsert(target, incoming)
    assert collected(upsert(once, incoming)) == collected(once)


def test_integrity_violations(spark):
    nullable = spark.createDataFrame(
        [("a", "1", 1, True), ("a", "1", 2, True), ("b", None, None, True), ("b", None, 1, True)],
        "name string, hash string, size int, malicious boolean",
    ).withColumn("sync_time", F.lit(T1))
    assert collected(integrity.integrity_violations(nullable, STORAGE)) == [
        ("not_null:hash", None, None, 2),
        ("not_null:size", None, None, 1),
        ("unique:name,hash", "a", "1", 2),
    ]
    assert integrity.integrity_violations(storage(spark, *TWO_FILES), STORAGE).count() == 0


def test_enforce_schema_casts_orders_and_refuses_nulls(spark):
    loose = spark.sql("SELECT true AS malicious, 5L AS size, 'h' AS hash, 'n' AS name, now() AS sync_time")
    want = [(f.name, f.dataType.simpleString()) for f in STORAGE.fields]
    assert enforce_schema(loose, STORAGE).dtypes == want
    with pytest.raises(Exception, match="NULL in NOT NULL column hash"):
        enforce_schema(loose.withColumn("hash", F.lit(None)), STORAGE).collect()


def test_scalar_functions(spark):
    row = spark.sql("""SELECT '"ab"c""' AS etag, '1/x' AS bad, '0/x' AS good, '2/x' AS other""")
    got = row.select(
        strip_quotes("etag"), class_of("bad"), class_of("good"), class_of("other")
    ).first()
    assert tuple(got) == ('ab"c', True, False, None)
