"""Numbers of a total order that no task sees whole."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from foldcat.llm.ordering import placed, ranked


def rows_of(rng, n):
    return [(rng.choice([None, *range(30)]), rng.choice("abc"), k) for k in range(n)]


def test_ranks_are_those_of_a_sorted_list(spark):
    rng = random.Random(1)
    rows = rows_of(rng, 2_000)
    frame = spark.createDataFrame(rows, "a long, b string, at long").repartition(7)
    got = ranked(frame, [F.desc_nulls_last("a"), F.asc("b")], "test").collect()
    key = lambda r: (r[0] is None, -(r[0] or 0), r[1])
    assert [key(r) for r in sorted(got, key=lambda r: r["rank"])] == sorted(map(key, rows))
    assert sorted(r["rank"] for r in got) == list(range(1, 2_001))


def test_equal_rows_are_split(spark):
    """A third of all rows equal: no range holds them all."""
    rows = [(5, "x")] * 4_000 + [(k, "y") for k in range(8_000)]
    frame = spark.createDataFrame(rows, "a long, _tie string").repartition(5)
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    try:
        at = placed(frame, [F.asc("a")], "test")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert at.columns == ["a", "_tie", "at"]
    sizes = [r["count"] for r in at.groupBy(F.shiftrightunsigned("at", 33)).count().collect()]
    assert sum(sizes) == 12_000 and max(sizes) < 3 * 12_000 / 24
    ordered = [r.a for r in at.orderBy("at").collect()]
    assert ordered == sorted(r[0] for r in rows)


def test_no_rows(spark):
    assert ranked(spark.createDataFrame([], "a long"), [F.asc("a")], "test").collect() == []
