"""One hash with a third of all rows: same results as the plain join, no oversized group."""

from __future__ import annotations

import pytest
from rows import collected, extracted, storage

from foldcat.operators import content, lookup as lookups, twins
from foldcat.operators.lookup import hot_hashes, lookup


def hot_rows(count):
    return [
        (f"n{i}", "hot" if i % 3 == 0 else f"h{i % 200}", i, i % 2 == 0) for i in range(count)
    ]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def small_parts(monkeypatch):
    """Split hashes of more than 100 rows."""
    monkeypatch.setattr(lookups, "ROWS_PER_PART", 100)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("known", [["hot", "h1", "h2", "absent"], ["h5"], []])
def test_split_lookup_equals_plain_join(spark, small_parts, how, known):
    left = storage(spark, *hot_rows(900))
    right = spark.createDataFrame([(h, f"m-{h}") for h in known], "hash string, note string")
    got = lookup(left, right, how)
    want = left.join(right, "hash", how)
    assert sorted(got.columns) == sorted(want.columns)
    assert collected(got.select(*sorted(got.columns))) == collected(want.select(*sorted(want.columns)))


def test_only_hot_hashes_are_split_in_proportion(spark, small_parts):
    """One hash with 90 % of the rows, one with 5 %; the rest are cold."""
    rows = [(f"n{i}", "hot" if i % 10 else "warm" if i % 20 else f"h{i % 400}", i, True) for i in range(4_000)]
    files = storage(spark, *rows)
    assert sorted(hot_hashes(files)) == [("hot", 36), ("warm", 2)]
    known = spark.createDataFrame([(h, 1) for h in ("hot", "warm", "h0", "h20", "absent")], "hash string, note int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = lookup(files, known, "left")
        plan = plan_of(got)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got.count() == 4_000 and got.filter("note = 1").count() == 3_800 + 20
    assert "hashpartitioning(hash" in plan and "_part" in plan and plan.count("BroadcastExchange") >= 1
    # Split by name, the parts are even, and cold hashes are whole.
    split = files.selectExpr("hash", "pmod(xxhash64(name), 36) AS part").filter("hash = 'hot'").groupBy("part").count().collect()
    assert len(split) == 36 and max(r["count"] for r in split) < 2 * 100
    cold = lookup(files.filter("hash LIKE 'h_%' AND hash != 'hot'"), known, "inner")
    assert "_part" not in plan_of(cold) and cold.count() == 20


def test_hot_hashes_of_odd_frames(spark, small_parts):
    assert hot_hashes(storage(spark)) == []
    missing = spark.createDataFrame([("n", None)] * 500 + [("n", "h")] * 101, "name string, hash string")
    assert hot_hashes(missing) == [("h", 2)]
    known = spark.createDataFrame([("h", 1), (None, 2)], "hash string, note int")
    assert lookup(missing, known, "left").filter("note IS NULL").count() == 500


def test_no_plan_pairs_rows_without_a_key_or_ranks_a_hash(spark):
    files = storage(spark, *hot_rows(300))
    known = extracted(spark, ("x", "hot", 1, "x64", 1, 1, "dll", "EXTRACTED", True))
    frames = {
        "one_per_hash": content.one_per_hash(files),
        "representatives": twins.representatives(known),
        "carry": twins.carry_metadata(files, known),
        "remaining": twins.remaining_files(files, known),
        "matching": twins.matching_rows(files, known),
        "known_twins": twins.known_twins(files, known),
        "fan_out": content.fan_out(files, known),
    }
    for name, frame in frames.items():
        plan = plan_of(frame)
        assert "NestedLoop" not in plan and "Cartesian" not in plan, name
        assert "Window" not in plan, name
    for name in ("one_per_hash", "representatives"):
        assert "partial_min" in plan_of(frames[name])


def test_fan_out_and_carry_of_a_hot_hash_keep_every_row(spark, small_parts):
    files = storage(spark, *hot_rows(3000))
    known = extracted(spark, ("x", "hot", 1, "x64", 1, 1, "dll", "EXTRACTED", True))
    carried = twins.carry_metadata(files, known)
    assert carried.count() == 1000
    assert twins.remaining_files(files, known).count() == 2000
    assert content.fan_out(files, known).count() == 3000
