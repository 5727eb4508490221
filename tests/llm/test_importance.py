"""Importance resampling against plain counting, weighing and sorting."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from foldcat.llm import importance_resampling as resampling

DOCS = "doc_id long, text string"
ITEMS = "item_id long, text string"


def features(text, longest):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [" ".join(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]
    return words, runs


def bucket(run, buckets):
    return zlib.crc32(run.encode()) % buckets


def plain(docs, items, longest=1, buckets=10_000, seed=2024, percent=10, least=20):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(bucket(r, buckets) for r in features(text, longest)[1])
    for _, text in items:
        t.update(bucket(r, buckets) for r in features(text, longest)[1])
    total_s, total_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    rows = []
    for doc_id, text in docs:
        words, runs = features(text, longest)
        gains = [
            math.floor(1000 * math.log((t[b] + 1) * total_s / ((s[b] + 1) * total_t)))
            for b in (bucket(r, buckets) for r in runs)
        ]
        weight = math.floor(sum(gains) / len(gains)) if gains else 0
        known = "" if doc_id is None else doc_id
        h = int(hashlib.sha256(f"{seed}:{known}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc_id, len(runs), weight, score, len(words)))
    able = [r for r in rows if r[4] >= least]
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    drawn = {id(r): k for k, r in enumerate(able[: percent * len(able) // 100], 1)}
    return sorted((*r[:4], drawn.get(id(r))) for r in rows if r[0] is not None), len(drawn)


def run(spark, docs, items, **options):
    found = resampling.resample(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), **options)
    return [tuple(r) for r in found.collect()]


ODD = [
    (1, "Alpha beta, GAMMA delta! 12 3 alpha"),
    (2, None),
    (3, ""),
    (4, " \t \u0085 été-ÉTÉ naïve\x00zero\x7fdel"),
    (5, "alpha " * 30),
    (6, "one two three four five six seven eight nine ten " * 3),
    (7, "ÀÉ alpha_beta[gamma]`delta{ " * 10),
]
TARGET = [(0, "alpha beta alpha beta"), (1, None), (2, "seven eight nine")]


@pytest.mark.parametrize("longest", [1, 2, 3])
def test_odd_texts(spark, longest):
    got = run(spark, ODD, TARGET, longest=longest, buckets=97, percent=50)
    want, n = plain(ODD, TARGET, longest=longest, buckets=97, percent=50)
    assert sorted(got) == want and n == 1


def test_given_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("item_id", "text").collect()]
    got = run(spark, docs, items)
    want, n = plain(docs, items)
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert sorted(r[4] for r in got if r[4]) == list(range(1, n + 1)) and n > 10


def test_stretches_change_nothing(monkeypatch):
    text = " ".join(f"w{i % 37} é{i % 11}" for i in range(2_000))
    whole = [resampling.count_features(text, k) for k in (1, 2, 4)]
    monkeypatch.setattr(resampling, "_STRETCH", 5)
    assert [resampling.count_features(text, k) for k in (1, 2, 4)] == whole
    assert resampling.count_features("a b", 4) == resampling.count_features("a  b ", 4)


def test_ties_and_repeated_rows(spark):
    """Rows that are wholly equal get consecutive ranks; a third of all rows may be one."""
    docs = [(7, "alpha " * 25)] * 40 + [(k, "beta gamma " * 15) for k in range(100, 140)] + [(None, "delta " * 20)] * 40
    got = run(spark, docs, [(0, "alpha")], percent=50)
    ranks = sorted((r[4], r[3]) for r in got if r[4] is not None)
    assert [r for r, _ in ranks] == list(range(1, 61))
    assert [s for _, s in ranks] == sorted((r[3] for r in got), reverse=True)[:60]
    assert len(got) == 120 and sum(r[0] is None for r in got) == 40


def test_empty_tables_and_extra_columns(spark):
    assert run(spark, [], TARGET) == []
    assert {r[4] for r in run(spark, ODD[:4], [])} == {None}
    docs = spark.createDataFrame(ODD, DOCS).selectExpr("*", "1 AS score", "2 AS rank", "3 AS n_words", "4 AS `a.b`", "5 AS at")
    found = resampling.resample(docs, spark.createDataFrame(TARGET, ITEMS), percent=50, buckets=97)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, found.collect())) == plain(ODD, TARGET, buckets=97, percent=50)[0]
