"""BPE encoding and decoding with word ends, the frequent words compiled into a transducer.

The most frequent words of the whole corpus are merged once, on the driver, and compiled with their
ids into a minimal acyclic transducer (``lexicon``). Spark hands its file to every executor, also to
one that replaces a lost one, and tasks map it into memory. Words it does not hold are merged exactly.

Defined results: a NULL or empty text has no tokens and decodes to the empty text. Rows are encoded
one by one, so repeated rows and ids give repeated results, and other columns do not matter. Texts of
any length are encoded whole. An empty table gives an empty result.
"""

from __future__ import annotations

import atexit
import hashlib
import heapq
import json
import os
import shutil
import tempfile
import unicodedata
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import regex
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, Window, functions as F

from foldcat.llm.lexicon import Lexicon, compile_lexicon
from foldcat.llm.text import texts_udf
from foldcat.staging import cut

# How many words the lexicon holds at most: the most frequent ones of the corpus.
LEXICON_WORDS = 262_144
# Above this many different words and chunks a task remembers only those of its last texts.
_REMEMBERED = 300_000
# Texts are taken together up to this many characters, or one by one if they are longer.
_TOGETHER = 1 << 20
# Words above this many symbols are merged with a heap.
_SHORT = 40
# That many words are merged side by side.
_SIDE_BY_SIDE = 2_048
# Words and chunks longer than this are not remembered, nor held by the lexicon.
_LONGEST = 64
_NEVER, _ID = 1 << 62, (1 << 32) - 1

# White space and the word pattern of the vocabulary's pre-tokenizer.
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^" + _SPACE + r"\p{L}\p{N}]+"
_NEEDED = {"NFC", "Replace", "Lowercase"}


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class Bpe:
    """The vocabulary of one file: splits text, merges words, names ids."""

    def __init__(self, spec: dict):
        model = spec["model"]
        kinds = {n["type"] for n in spec["normalizer"]["normalizers"]}
        if model["type"] != "BPE" or model["end_of_word_suffix"] != "</w>" or kinds != _NEEDED:
            raise ValueError("a BPE vocabulary with word ends, lower case and NFC is needed")
        self.vocab: dict[str, int] = model["vocab"]
        # By the left id: a pair's rank and the id it merges to, as one number; the least comes first.
        self.ranks: list[dict[int, int]] = [{} for _ in self.vocab]
        for rank, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            self.ranks[self.vocab[left]][self.vocab[right]] = rank << 32 | self.vocab[left + right]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        named = {i: p for p, i in self.vocab.items()} | {i: p for p, i in self.special.items()}
        self.pieces = [named.get(i, "") for i in range(max(named) + 1)]
        self.numerals = [str(i) for i in range(len(self.pieces))]
        shown = byte_characters()
        self._plain = [self.vocab[c] for c in shown]
        self._final = [self.vocab[c + "</w>"] for c in shown]
        # The same pairs in order, to look up many at once; the greatest id and one more tells left from right.
        pairs = sorted((left * (len(self.pieces) + 1) + right, to) for left, by_right in enumerate(self.ranks) for right, to in by_right.items())
        self._pairs, self._merged = np.array(pairs or [(-1, _NEVER)], np.int64).T.copy()
        self._words = regex.compile(_PATTERN)
        names = sorted(map(regex.escape, self.special), key=len, reverse=True)
        self._specials = regex.compile(f"({'|'.join(names)})") if names else None
        self._spaces = regex.compile(f"[{_SPACE}]+")

    def chunks(self, text: str) -> list[str]:
        """Parts of a text in lower case between white space; special tokens after one space.

        No word reaches across white space. Each character is lowered on its own: no final sigma.
        """
        if any(token in text for token in self.special):
            found: list[str] = []
            for part in self._specials.split(text):
                found += [f" {part}"] if part in self.special else self.chunks(part)
            return found
        lowered = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        if any(c in lowered for c in "\x1c\x1d\x1e\x1f"):  # white space to str.split() alone
            return [c for c in self._spaces.split(lowered) if c]
        return lowered.split()

    def words(self, chunk: str) -> list[str]:
        if chunk[0] == " " or chunk.isalpha():
            return [chunk]
        if chunk[-1] in ".," and chunk[:-1].isalpha():
            return [chunk[:-1], chunk[-1]]
        return self._words.findall(chunk)

    def merge_all(self, words: list[bytes]) -> list[list[int]]:
        """The ids of each word: the pair of the lowest rank merges first, the leftmost of equals."""
        found: list[list[int]] = [[] for _ in words]
        sizes = np.array([len(w) for w in words], np.int64)
        for number in np.flatnonzero(sizes > _SHORT).tolist():
            word = words[number]
            found[number] = self._merge_long([self._plain[b] for b in word[:-1]] + [self._final[word[-1]]])
        short = np.flatnonzero((sizes > 0) & (sizes <= _SHORT))
        short = short[np.argsort(sizes[short], kind="stable")]  # words of like size side by side
        for start in range(0, len(short), _SIDE_BY_SIDE):
            block = short[start : start + _SIDE_BY_SIDE]
            self._merge_block(b"".join([words[n] for n in block.tolist()]), sizes[block], block, found)
        return found

    def _merge_block(self, letters: bytes, sizes: np.ndarray, number: np.ndarray, found: list[list[int]]) -> None:
        """Merge one pair of every word at a time; a row of ``ids`` is a word, filled up with no symbol's id."""
        none = len(self.pieces)
        ids = np.full((len(sizes), int(sizes.max()) + 1), none, np.int64)
        ids[np.arange(ids.shape[1]) < sizes[:, None]] = np.array(self._plain, np.int64)[np.frombuffer(letters, np.uint8)]
        rows = np.arange(len(sizes))
        ids[rows, sizes - 1] = np.array(self._final, np.int64)[np.frombuffer(letters, np.uint8)[np.cumsum(sizes) - 1]]
        ranks = self._ranked(ids, np.roll(ids, -1, axis=1))  # nothing pairs with the last column
        while True:
            at = ranks.argmin(axis=1)
            best = ranks[rows, at]
            if not (more := best != _NEVER).all():
                for n, size, row in zip(number[~more].tolist(), sizes[~more].tolist(), ids[~more].tolist()):
                    found[n] = row[:size]
                if not more.any():
                    return
                ids, ranks, sizes, number, at, best = ids[more], ranks[more], sizes[more], number[more], at[more], best[more]
                rows = rows[: len(sizes)]
            shape, columns = (len(ids), ids.shape[1] - 1), np.arange(ids.shape[1])
            ids = ids[columns != at[:, None] + 1].reshape(shape)
            ranks = ranks[columns != at[:, None]].reshape(shape)
            merged = ids[rows, at] = best & _ID
            sizes = sizes - 1
            ranks[rows, at - 1] = self._ranked(ids[rows, at - 1], merged)
            ranks[rows, at] = self._ranked(merged, ids[rows, at + 1])

    def _ranked(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Of each pair the rank and the id it merges to, as one number."""
        sought = left * (len(self.pieces) + 1) + right
        place = np.minimum(np.searchsorted(self._pairs, sought), len(self._pairs) - 1)
        return np.where(self._pairs[place] == sought, self._merged[place], _NEVER)

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same for one word of any length, with a heap and a linked list."""
        n = len(ids)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(self.ranks[a][b], i, (a, b)) for i, (a, b) in enumerate(zip(ids, ids[1:])) if b in self.ranks[a]]
        heapq.heapify(heap)
        while heap:
            best, i, pair = heapq.heappop(heap)
            j = after[i]
            if ids[i] != pair[0] or j < 0 or ids[j] != pair[1]:
                continue
            ids[i], ids[j] = best & _ID, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right >= 0 and ids[right] in self.ranks[ids[left]]:
                    heapq.heappush(heap, (self.ranks[ids[left]][ids[right]], left, (ids[left], ids[right])))
        return [i for i in ids if i >= 0]


class Coder:
    """What a task holds: the vocabulary, the mapped lexicon, and the words and chunks it has seen."""

    def __init__(self, vocabulary: str, lexicon: str):
        with open(vocabulary, encoding="utf-8") as file:
            self.bpe = Bpe(json.load(file))
        self.lexicon = Lexicon(lexicon)
        # Of words and chunks alike, as a word is a chunk of one word: the ids and the pieces, joined by spaces.
        self._seen: dict[str, tuple[str, str]] = {}

    def _learn(self, chunks: set[str]) -> list[str]:
        """Remember chunks that were not seen before, and their words; those too long to be kept are returned."""
        seen, bpe, numerals, pieces = self._seen, self.bpe, self.bpe.numerals, self.bpe.pieces
        parted = {c: bpe.words(c) for c in chunks}
        words = list(set().union(*parted.values()).difference(seen))
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        known = self.lexicon.get_all(raw)
        missing = [i for i, ids in enumerate(known) if ids is None]
        for i, ids in zip(missing, bpe.merge_all([raw[i] for i in missing])):
            known[i] = [bpe.special[words[i][1:]]] if words[i][0] == " " else ids
        for word, ids in zip(words, known):
            seen[word] = " ".join([numerals[i] for i in ids]), " ".join([pieces[i] for i in ids])
        for chunk, parts in parted.items():
            if len(parts) > 1:
                seen[chunk] = _joined([seen[w] for w in parts])
        return [c for c in {*words, *parted} if len(c) > _LONGEST]

    def code(self, texts: list[str | None]) -> Iterator[tuple[int, str, str]]:
        """For each text: number of tokens, the ids joined by spaces, the decoded text."""
        seen = self._seen
        parted = [self.bpe.chunks(t) if t else [] for t in texts]
        found = set().union(*parted)
        long = self._learn(found.difference(seen))
        for chunks in parted:
            ids, decoded = _joined(list(map(seen.__getitem__, chunks)))
            yield ids.count(" ") + 1 if ids else 0, ids, decoded
        for chunk in long:
            del seen[chunk]
        if len(seen) > _REMEMBERED:
            found.difference_update(long)
            self._seen = {c: seen[c] for c in found} if len(found) < _REMEMBERED else {}


def _joined(parts: list[tuple[str, str]]) -> tuple[str, str]:
    return " ".join([p[0] for p in parts]), " ".join([p[1] for p in parts])


def _together(texts: Iterable[str | None]) -> Iterator[list[str | None]]:
    """Texts in lists of ``_TOGETHER`` characters or one text."""
    group, size = [], 0
    for text in texts:
        if group and size + len(text or "") > _TOGETHER:
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text or "")
    if group:
        yield group


_CODERS: dict[str, Coder] = {}


def _coder(vocabulary: str, lexicon: str) -> Coder:
    if lexicon not in _CODERS:
        _CODERS.clear()
        _CODERS[lexicon] = Coder(SparkFiles.get(vocabulary), SparkFiles.get(lexicon))
    return _CODERS[lexicon]


def frequent_words(texts: Column, docs: DataFrame, words: int) -> list[bytes]:
    """The most frequent words (runs of letters, in lower case) of a text column over all its rows.

    At most ``words``: those of at least the least frequency that no more words reach. What meets on
    the driver is that many words; frequencies are summed over one row for each frequency.
    """
    runs = docs.select(F.explode(F.split(F.lower(texts), r"[^\p{L}]+")).alias("word"))
    counted = cut(runs.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(f"n > 1 AND word != '' AND length(word) <= {_LONGEST}"))
    sizes = counted.groupBy("n").agg(F.count(F.lit(1)).alias("words"))
    reached = sizes.withColumn("total", F.sum("words").over(Window.orderBy(F.desc("n")))).where(F.col("total") <= words)
    least = reached.agg(F.min("n").alias("n")).first().n
    if least is None:  # no words, or too many of the highest frequency
        return []
    return sorted(r.word.encode("utf-8") for r in counted.where(F.col("n") >= least).select("word").collect())


def _hand_out(spark, files: dict[str, bytes]) -> None:
    """Let Spark bring files to every executor, now and later; names must be new."""
    folder = tempfile.mkdtemp(prefix="foldcat-")  # the driver's own; Spark serves the files from it
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    for name, content in files.items():
        with open(os.path.join(folder, name), "wb") as file:
            file.write(content)
        spark.sparkContext.addFile(os.path.join(folder, name))


def bpe_code(docs: DataFrame, text: str, vocabulary_path: str, words: int = LEXICON_WORDS, digest: bool = False) -> Column:
    """A column function's result for ``docs[text]``: struct n_tokens, ids, decoded.

    The vocabulary file's path is the driver's. Ids are joined by one space. With ``digest`` only the
    SHA-256 of ids and of the decoded text (ids_sha256, decoded_sha256) leave the task.
    """
    spark, tag = docs.sparkSession, uuid.uuid4().hex
    vocabulary, lexicon = f"vocabulary-{tag}.json", f"lexicon-{tag}.bin"
    with open(vocabulary_path, "rb") as file:
        raw = file.read()
    _hand_out(spark, {vocabulary: raw})
    bpe = Bpe(json.loads(raw))
    found = frequent_words(docs[text].cast("string"), docs, words)
    _hand_out(spark, {lexicon: compile_lexicon(dict(zip(found, bpe.merge_all(found))))})

    def code(texts: Iterable[str | None]) -> Iterator[tuple[int, str, str]]:
        for group in _together(texts):
            yield from _coder(vocabulary, lexicon).code(group)

    def digests(texts: Iterable[str | None]) -> Iterator[tuple[int, str, str]]:
        for n, *coded in code(texts):
            yield n, *(hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest() for s in coded)

    names = ["n_tokens", *(["ids_sha256", "decoded_sha256"] if digest else ["ids", "decoded"])]
    return texts_udf(digests if digest else code, names, ["long", "string", "string"])(docs[text].cast("string"))


def bpe_documents(docs: DataFrame, vocabulary_path: str, words: int = LEXICON_WORDS) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    coded = docs.select("doc_id", bpe_code(docs, "text", vocabulary_path, words, digest=True).alias("coded"))
    return coded.select("doc_id", "coded.*")
