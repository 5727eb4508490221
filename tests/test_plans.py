"""What the physical plans must look like for large inputs."""

from __future__ import annotations

import re

import pytest
from rows import extracted, listing, storage

from foldcat.functions.pe import pe_metadata
from foldcat.operators import backlog, twins
from foldcat.operators.integrity import integrity_violations
from foldcat.operators.upsert import upsert
from foldcat.plans.extract import balanced_extract
from foldcat.schemas import EXTRACTED, STORAGE
from foldcat.sources.objects import extract_from_bucketed, extract_from_contents
from foldcat.sources.tables import append_table, read_table, save_bucketed


@pytest.fixture
def stored(spark, tmp_path):
    append_table(storage(spark, ("a", "h", 1, True)), str(tmp_path / "s"), STORAGE)
    done = ("b", "h", 1, "x64", 1, 0, "exe", "EXTRACTED", True)
    append_table(extracted(spark, done), str(tmp_path / "e"), EXTRACTED)
    return (
        read_table(spark, str(tmp_path / "s"), STORAGE),
        read_table(spark, str(tmp_path / "e"), EXTRACTED),
    )


@pytest.fixture(autouse=True)
def no_small_sides(spark):
    """Plan as for tables that are too large to be broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_small_batch_scans_each_table_once_and_limits_before_the_shuffle(stored):
    plan = plan_of(backlog.balanced_batch(*stored, 1000))
    assert plan.count("FileScan") == 2
    exchanges = [at for at in range(len(plan)) if plan.startswith("Exchange hashpartitioning(malicious#", at)]
    assert len(exchanges) == 2 and "_merge#" in plan[exchanges[1] : exchanges[1] + 70]
    assert plan.rindex("500, Final") < exchanges[1] < plan.rindex("500, Partial")
    assert "LeftAnti" in plan and "Broadcast" not in plan and "SinglePartition" not in plan


def test_one_class_small_batch_is_a_top_k(stored):
    plan = plan_of(backlog.unprocessed_batch(*stored, True, 500))
    assert plan.index("TakeOrderedAndProject") < plan.index("Exchange hashpartitioning(_merge#")


def test_large_batch_computes_its_backlog_once(stored):
    plan = plan_of(backlog.balanced_batch(*stored, 10_000_000))
    assert "LeftAnti" not in plan and plan.count("FileScan") == 2
    assert "ReadSchema: struct<malicious:boolean,_cell:string>" in plan


def test_run_joins_batch_and_twins_once(spark, stored):
    bodies = spark.createDataFrame([("a", bytearray(b"x"))], "name string, content binary")
    plan = plan_of(balanced_extract(*stored, extract_from_contents(bodies), 1000))
    assert "LeftAnti" not in plan and plan.count("FileScan") == 3
    assert plan.count("Exchange hashpartitioning") <= 4


def test_bucketed_bodies_stay_where_they_are(spark):
    bodies = spark.createDataFrame([("a", bytearray(b"x"))], "name string, content binary")
    save_bucketed(bodies, "plan_bodies", 8, key=["name"])
    files = listing(spark, ("a", "h", 1, False))
    for rows in (10, None):
        plan = plan_of(extract_from_bucketed(spark, "plan_bodies")(files, rows))
        assert plan.count("Exchange") == 1 and "8), REPARTITION" not in plan
        assert "ShuffledHashJoin" in plan and "Sort " not in plan
    assert extract_from_bucketed(spark, "plan_bodies")(files).count() == 1
    spark.sql("DROP TABLE plan_bodies")


def test_large_batch_ranks_inside_cells_only(stored):
    plan = plan_of(backlog.balanced_batch(*stored, 10_000_000))
    ranking = [line for line in plan.splitlines() if "row_number()" in line]
    assert len(ranking) == 1
    assert re.search(r"windowspecdefinition\(malicious#\d+, _cell#\d+", ranking[0])
    assert "TakeOrdered" not in plan and "SinglePartition" not in plan
    assert "partial_count" in plan


def test_bounded_batch_filters_known_results_where_they_lie(stored):
    files, known = stored
    plan = plan_of(twins.matching_rows(files, known, 1000))
    assert "BroadcastHashJoin" in plan
    scan = plan.index("FileScan")
    assert "Exchange hashpartitioning" not in plan[: scan]


def test_unbounded_batch_meets_aggregated_results(stored):
    files, known = stored
    plan = plan_of(twins.known_twins(files, known))
    assert plan.count("FileScan") == 2
    assert plan.count("Exchange hashpartitioning(hash#") == 2
    assert "partial_min_by" in plan and "Broadcast" not in plan


def test_upsert_shuffles_each_side_once(stored):
    plan = plan_of(upsert(stored[0], stored[0]))
    assert plan.count("Exchange") == 2 and plan.count("Join") == 1
    assert "partial_min" in plan


def test_upsert_leaves_a_bucketed_catalogue_where_it_is(spark, stored):
    save_bucketed(stored[0], "plan_catalogue", 8, schema=STORAGE)
    plan = plan_of(upsert(spark.table("plan_catalogue"), stored[0]))
    target = [line for line in plan.splitlines() if "Bucketed: true" in line]
    assert len(target) == 1 and "Exchange" not in plan[: plan.index("Bucketed: true")]
    spark.sql("DROP TABLE plan_catalogue")


def test_integrity_check_combines_before_the_shuffle(stored):
    plan = plan_of(integrity_violations(stored[0], STORAGE))
    assert "partial_count" in plan and "Window" not in plan


def test_header_extraction_is_a_projection_of_the_scan(spark, tmp_path):
    path = str(tmp_path / "bodies")
    spark.createDataFrame([("a", bytearray(b"x"), 1)], "name string, content binary, other int").write.parquet(path)
    bodies = spark.read.parquet(path)
    plan = plan_of(pe_metadata(bodies.select("name", "content")))
    assert "Exchange" not in plan and "Python" not in plan
    assert "ReadSchema: struct<name:string,content:binary>" in plan
    assert len(plan) < 40_000

    files = listing(spark, ("a", "h", 1, False))
    bounded = plan_of(extract_from_contents(bodies)(files, 10))
    assert "Exchange hashpartitioning" not in bounded
    unbounded = plan_of(extract_from_contents(bodies)(files, None))
    assert unbounded.count("Exchange hashpartitioning(name#") == 2
    lines = unbounded.splitlines()
    shuffled = [below for line, below in zip(lines, lines[1:]) if "Exchange hashpartitioning" in line]
    parsed = next(line for line in shuffled if "architecture" in line)
    names = re.sub(r"CASE.*?END AS ", "", parsed)  # columns that are kept as they are
    assert "_body" not in names and "content" not in names
