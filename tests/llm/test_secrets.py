"""Secret scans against Python's regular expressions, and the derived trigram queries."""

from __future__ import annotations

import hashlib
import random
import re

from foldcat.llm import trigram_secrets
from foldcat.llm.trigram_secrets import BASE_RULES, MORE_RULES, RULES, candidates, find_secrets, trigram_query

# The base rules as they are stated, without the lengths inside.
STATED = [
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
]


def plain(text):
    text = text or ""
    base = [(m.start(), k, kind, m.end()) for k, (kind, p, g, least) in enumerate(STATED) for m in re.finditer(p, text, re.A) if len(m[g]) >= least]
    more = [(m.start(), 3 + k, r.kind, m.end()) for k, r in enumerate(MORE_RULES) for m in re.finditer(r.pattern, text)]
    show = lambda found: ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in sorted(found))
    counts = tuple(sum(f[2] == kind for f in base) for kind, *_ in STATED)
    return (*counts, hashlib.sha256(show(base).encode()).hexdigest(), show(base + more))


def check(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = find_secrets(docs).collect()
    assert len(got) == len(texts)
    for r in got:
        assert tuple(r)[1:] == plain(texts[r.doc_id]), texts[r.doc_id]


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = find_secrets(docs).collect()
    assert len(got) == len(texts)
    assert all(tuple(r)[1:] == plain(texts[r.doc_id]) for r in got)
    assert sum(r.n_hex for r in got) > 0


def test_random_texts(spark):
    rng = random.Random(5)
    bits = ["password", "PassWD", "token", "ToKen", "apikey", "API_KEY", "secret", "=", ":", " ", '"', "'", "abcdef", "0123456789abcdef" * 2, "AKIA", "ABCDEFGH12345678", "é", "😀", "\n", "ghp_" + "a1" * 18, "xoxb-1234567890", "eyJ" + "a" * 12 + ".eyJ" + "b" * 12 + ".c", "-----BEGIN RSA PRIVATE KEY-----", "sk_live_" + "9" * 16, "AIza" + "x" * 35, "ſecret=abcdefg", "toKen=abcdefg"]
    check(spark, [None, "", *("".join(rng.choices(bits, k=rng.randrange(14))) for _ in range(400))])


def test_very_many_matches_in_one_text(spark):
    for n in (1, 2, 3, 10, 99, 100, 101, 20_000):
        check(spark, [" ".join(f"é token={'a' * (4 + i % 5)} AKIA{i:020d}" for i in range(n))])


def test_odd_rows(spark):
    rows = [(None, "token=abcdefg"), (1, "token=abcdefg"), (1, "nothing"), (1, None), (2, "token = abcdefg " * 3000)]
    docs = spark.createDataFrame([(*r, "x", ["y"]) for r in rows], "doc_id long, text string, spans string, kinds array<string>")
    got = sorted((str(r.doc_id), r.n_assign) for r in find_secrets(docs).collect())
    assert got == [("1", 0), ("1", 0), ("1", 1), ("2", 3000), ("None", 1)]
    assert find_secrets(docs.limit(0)).count() == 0


def test_derived_queries():
    assert trigram_query(r"AKIA[A-Z0-9]{16,}") == {frozenset({"aki", "kia"})}
    assert trigram_query(r"[0-9a-f]{24,}") == {frozenset()}
    assert trigram_query(r"(abc|xyz)d?") == {frozenset({"abc"}), frozenset({"xyz"})}
    assert trigram_query(r"a[bc]d.*hello") == {frozenset({"abd", "hel", "ell", "llo"}), frozenset({"acd", "hel", "ell", "llo"})}
    assert trigram_query(r"(?:abcd)+") == {frozenset({"abc", "bcd"})}
    assert trigram_query(r"(?:abcd)*") == {frozenset()}
    assert all(frozenset() not in trigram_query(r.pattern) for r in RULES if r.kind != "hex")


def test_index_prunes(spark):
    docs = spark.createDataFrame([(1, "tok ken"), (2, "a token"), (3, "AKIa"), (4, None), (5, "")], "doc_id long, text string")
    assert {r.doc_id: r.kinds for r in candidates(docs, BASE_RULES[:2]).collect()} == {2: ["assign"], 3: ["access"]}


def test_beyond_the_bound_rows_are_equal_and_no_text_moves(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = sorted(map(tuple, find_secrets(docs).collect()))
    monkeypatch.setattr(trigram_secrets, "BROADCAST_ROWS", 0)
    got = find_secrets(docs)
    assert sorted(map(tuple, got.collect())) == want
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Join LeftOuter, (_piece" in plan and "(doc_id" not in plan.split("Join LeftOuter", 1)[1].splitlines()[0]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        physical = find_secrets(docs)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # One exchange puts the sketch together; the scan of the texts has none above it.
    assert "BroadcastHashJoin" in physical and "Exchange hashpartitioning(doc_id" not in physical
