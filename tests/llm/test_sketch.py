"""Scaled sketches against plain sets, and how good their estimates are."""

from __future__ import annotations

import hashlib
import random
import re

from pyspark.sql import functions as F

from foldcat.llm import scaled_sketch as scaled

DOCS = "doc_id long, text string"
BELOW = f"{16**16 // 8:016x}"


def shingles(text):
    words = [w for w in re.split(r"[ \t-\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), text)) if w]
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def sketch(text):
    hashes = sorted(hashlib.md5(s.encode()).hexdigest()[:16] for s in shingles(text))
    return [h for h in hashes if h < BELOW] or hashes[:1]


def near(a, b):
    return len(set(a) & set(b)) / len(a) if a else float(not b)


def plain(docs):
    """Rows equal in id and text are one; NULL ids come last."""
    texts = {(d, t or "") for d, t in docs}
    order = sorted(texts, key=lambda x: (x[0] is None, -(x[0] or 0), hashlib.sha256(f"{'null' if x[0] is None else x[0]}:{x[1]}".encode()).digest()[:16]))
    follows = {a: b[1] for a, b in zip(order, order[1:] + order[:1])}
    rows = []
    for d, t in docs:
        text = t or ""
        after, half = follows[d, text], len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        own, changed = sketch(text), sketch(edited)
        digest = hashlib.sha256(edited.encode()).hexdigest()
        rows.append((d, len(text), digest, ",".join(own), ",".join(changed), near(own, changed), near(own, sketch(after))))
    return sorted(rows, key=repr)


def check(spark, docs):
    got = [tuple(r) for r in scaled.compare_edited(spark.createDataFrame(docs, DOCS)).collect()]
    assert sorted(got, key=repr) == plain(docs)


WORDS = [f"w{i}" for i in range(300)] + ["Été", "naïve", "日本", "🙂"]


def text_of(rng, n):
    return rng.choice([" ", "\n", "  ", "\t"]).join(rng.choice(WORDS) for _ in range(n))


def test_made_documents(spark):
    rng = random.Random(3)
    docs = [(k * 7 % 101, text_of(rng, rng.choice([0, 1, 3, 5, 6, 40, 400]))) for k in range(101)]
    docs += [(1_000, None), (1_001, ""), (1_002, "\u0085  "), (1_003, docs[5][1]), (1_004, docs[5][1]), (-3, "UPPER upper")]
    check(spark, docs)


def test_repeated_and_missing_ids(spark):
    rng = random.Random(4)
    a, b, c = (text_of(rng, 30) for _ in range(3))
    check(spark, [(1, a)] * 30 + [(1, b), (2, c), (None, a), (None, a), (None, b), (None, None), (0, c)])


def test_lone_empty_and_extra_columns(spark):
    check(spark, [(5, "one two three four five six seven")])
    check(spark, [])
    frame = spark.createDataFrame([(1, "a b"), (2, "c d")], DOCS)
    odd = frame.selectExpr("*", "1 AS digest", "2 AS rank", "3 AS `a.b`", "4 AS n_chars", "5 AS at", "6 AS next")
    rows = [sorted(map(tuple, scaled.compare_edited(f).collect())) for f in (frame, odd)]
    assert rows[0] == rows[1]


def test_long_text(spark):
    rng = random.Random(6)
    check(spark, [(1, text_of(rng, 100_000)), (2, "short text"), (3, text_of(rng, 10))])


def test_mergers(spark):
    """The sketch of two texts' shingles is the merger of theirs, also if a least hash must go."""
    rng = random.Random(8)
    pairs = [(text_of(rng, rng.choice([0, 2, 6, 12, 90])), text_of(rng, rng.choice([0, 2, 6, 12, 90]))) for _ in range(120)]
    frame = spark.createDataFrame(pairs, "a string, b string")
    a, b = (scaled.shingle_hashes(F.col(c)) for c in "ab")
    merged = scaled.merged(scaled.sketch(a), scaled.sketch(b))
    got = frame.select("a", "b", merged.alias("m"), scaled.sketch(F.concat(a, b)).alias("together")).collect()
    for r in got:
        hashes = sorted({hashlib.md5(s.encode()).hexdigest()[:16] for s in shingles(r.a) | shingles(r.b)})
        assert r.m == r.together == ([h for h in hashes if h < BELOW] or hashes[:1])


def test_containment_of_very_unequal_documents(spark):
    """A passage of 400 words in documents of up to 80,000: error of the estimate, with its bias."""
    rng = random.Random(10)
    fresh = lambda n: " ".join(str(rng.getrandbits(40)) for _ in range(n))
    rows = []
    for k in range(60):
        passage, share = [str(rng.getrandbits(40)) for _ in range(400)], rng.random()
        cut = int(400 * share)
        whole = " ".join(passage[:cut]) + " " + fresh(rng.choice([100, 5_000, 80_000]))
        rows.append((" ".join(passage), whole))
    frame = spark.createDataFrame(rows, "a string, b string")
    a, b = (scaled.sketch(scaled.shingle_hashes(F.col(c))) for c in "ab")
    errors = []
    for r in frame.select("a", "b", scaled.containment(a, b).alias("estimate"), scaled.jaccard(a, b).alias("j")).collect():
        x, y = shingles(r.a), shingles(r.b)
        errors.append(r.estimate - len(x & y) / len(x))
        assert abs(r.j - len(x & y) / len(x | y)) < 0.2
    assert abs(sum(errors) / len(errors)) < 0.03 and max(map(abs, errors)) < 0.25
