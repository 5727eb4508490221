"""Encoding against the public tokenizers library, and the lexicon against a dictionary."""

from __future__ import annotations

import hashlib
import json
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from foldcat.llm import bpe
from foldcat.llm.bpe import Bpe, Coder, bpe_code, bpe_documents
from foldcat.llm.lexicon import Lexicon, compile_lexicon

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    None,
    "",
    "   \n\t ",
    "Hello  World's <|endoftext|>x ΣΑΣ İ 123 &&&\x00 é",
    "<|EndOfText|> a<|endoftext|><|startoftext|>b <|endoftext| >",
    "日本語😀 don't I'LL we've ½ ² Ⅷ",
    "a　b c\x85d\x1cd\x1f e f​g",
    "x" * 5000 + " " + "ab" * 300,
    "Ñandú ñ Œuvre ﬁ Å Å ẛ̣ ǅ ẞ",
    "Nicht aulich für sch erüver enau sch der.",
    "Nicht aulich für sch erüver enau sch der.",
]


def check(spark, texts, words):
    tokenizer = Tokenizer.from_file(PATH)
    docs = spark.createDataFrame([(i, t, "n") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens string")
    rows = docs.select("doc_id", "text", bpe_code(docs, "text", PATH, words).alias("c")).select("text", "c.*").collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = tokenizer.encode(row.text or "", add_special_tokens=False).ids
        assert row.ids == " ".join(map(str, ids)), row.text
        assert row.n_tokens == len(ids)
        assert row.decoded == tokenizer.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("words", [3, 1000])
def test_encodes_as_the_library(spark, words):
    check(spark, TEXTS, words)


def test_random_texts(spark):
    rng = random.Random(4)
    alphabet = "aabcdeeeillnorst  '\n.,09<|>éüñßĳСловоשלום漢字🙂́‍ "
    check(spark, ["".join(rng.choices(alphabet, k=rng.randrange(200))) for _ in range(300)], 50)


def test_documents_of_a_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    tokenizer = Tokenizer.from_file(PATH)
    got = {r.doc_id: r for r in bpe_documents(docs, PATH).collect()}
    for row in docs.collect():
        ids = tokenizer.encode(row.text, add_special_tokens=False).ids
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert got[row.doc_id].ids_sha256 == sha(" ".join(map(str, ids)))
        assert got[row.doc_id].decoded_sha256 == sha(tokenizer.decode(ids, skip_special_tokens=False))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe_documents(docs, PATH).count() == 0


def test_lexicon_shares_suffixes(tmp_path):
    rng = random.Random(1)
    words = {bytes(rng.choices(b"abc", k=rng.randrange(1, 9))) for _ in range(2000)}
    entries = {w: [rng.randrange(50_000) for _ in range(rng.randrange(1, 4))] for w in words}
    (tmp_path / "lexicon").write_bytes(compile_lexicon(entries))
    lexicon = Lexicon(str(tmp_path / "lexicon"))
    assert all(lexicon.get(w) == ids for w, ids in entries.items())
    assert all(lexicon.get(w) is None for w in (b"", b"abcabcabcab", b"d", b"\xff"))
    # Minimal: as many states as there are different sets of endings.
    endings = {frozenset(w[len(p) :] for w in words if w.startswith(p)) for w in words for p in (w[:i] for i in range(len(w) + 1))}
    assert lexicon.n_states == len(endings)


def test_empty_lexicon(tmp_path):
    (tmp_path / "lexicon").write_bytes(compile_lexicon({}))
    assert Lexicon(str(tmp_path / "lexicon")).get(b"a") is None


def test_many_words_are_looked_up_at_once(tmp_path):
    entries = {b"ab": [1], b"abc": [2, 3], b"bc": [4]}
    (tmp_path / "lexicon").write_bytes(compile_lexicon(entries))
    words = [b"bc", b"", b"abcd", b"b", b"abc", b"abc", b"\xff", b"ab"]
    assert Lexicon(str(tmp_path / "lexicon")).get_all(words) == [entries.get(w) for w in words]
    (tmp_path / "empty").write_bytes(compile_lexicon({b"": [7]}))
    assert Lexicon(str(tmp_path / "empty")).get_all([b"a", b""]) == [None, [7]]


def test_many_words_merge_as_one_by_one(monkeypatch):
    with open(PATH, encoding="utf-8") as file:
        coder = Bpe(json.load(file))
    tokenizer, rng = Tokenizer.from_file(PATH), random.Random(5)
    words = ["".join(rng.choices("aeinrstélñ漢", k=rng.randrange(1, 30))) for _ in range(500)] + ["a" * n for n in range(1, 90)]
    monkeypatch.setattr(bpe, "_SIDE_BY_SIDE", 64)
    got = coder.merge_all([w.encode() for w in words])
    assert got == [tokenizer.encode(w, add_special_tokens=False).ids for w in words]
    assert coder.merge_all([]) == []


def test_frequent_words_are_looked_up_once(tmp_path, monkeypatch):
    """Rare words that fill the memory of a task do not make it forget the frequent ones."""
    (tmp_path / "lexicon").write_bytes(compile_lexicon({}))
    coder, asked = Coder(PATH, str(tmp_path / "lexicon")), []
    find = coder.lexicon.get_all
    monkeypatch.setattr(coder.lexicon, "get_all", lambda words: asked.extend(words) or find(words))
    monkeypatch.setattr(bpe, "_REMEMBERED", 20)
    rare = ["".join(random.Random(i).choices("abcdefgh", k=12)) for i in range(100)]
    tokenizer = Tokenizer.from_file(PATH)
    for i in range(0, 100, 2):
        texts = [f"The cat, the dog. {rare[i]}", None, f"the dog, {rare[i + 1]} the cat. {'x' * 100}"]
        for text, (n, ids, _) in zip(texts, coder.code(texts), strict=True):
            want = tokenizer.encode(text or "", add_special_tokens=False).ids
            assert (n, ids) == (len(want), " ".join(map(str, want)))
        assert not any(len(c) > 64 for c in coder._seen)
    assert len(coder._seen) <= 40
    assert [asked.count(w) for w in (b"the", b"cat", b"dog", b",")] == [1, 1, 1, 1]


def test_texts_are_taken_together_up_to_a_size(monkeypatch):
    monkeypatch.setattr(bpe, "_TOGETHER", 4)
    assert list(bpe._together(["abc", "d", None, "e", "fghijk", "", "l"])) == [["abc", "d", None], ["e"], ["fghijk"], ["", "l"]]
    assert list(bpe._together([])) == []
