"""The pipeline against plain versions of its stages, each on what its predecessor kept."""

from __future__ import annotations

import hashlib

import public_tokenizers
import test_containment
import test_lines
import test_near_duplicates
from tokenizers import Tokenizer

import corpus_pipeline
from foldcat.llm.pairwise_quality import THRESHOLD, score_documents

SF = "/root/testdata/sf0.01"


def test_run_equals_plain_stages(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = {r.doc_id for r in score_documents(documents, labels).where(f"score >= {THRESHOLD}").collect()}
    docs = [(r.doc_id, r.text) for r in documents.collect() if r.doc_id in good]
    assert 0 < len(docs) < documents.count()
    left = test_lines.plain(docs)
    docs = [(d, left[d]) for d, text in docs if left[d].strip() or not text.split()]
    groups = test_near_duplicates.plain(docs, 5)
    docs = [(d, t) for d, t in docs if groups[d][3]]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaks = test_containment.plain(docs, items)
    assert any(leaks.values())
    docs = {d: t for d, t in docs if not leaks[d]}
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(got) == set(docs)
    for d, text in docs.items():
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert got[d].n_tokens == len(ids)
        assert got[d].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, "/root/testdata/sf0.001")
        assert kept.schema.simpleString() == docs.schema.simpleString(), name
        assert kept.count() > 0
    assert stage(spark, docs.limit(0), "/root/testdata/sf0.001").count() == 0


def test_without_documents(spark, tmp_path):
    for table in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"/root/testdata/sf0.001/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
