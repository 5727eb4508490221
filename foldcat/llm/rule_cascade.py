"""Quality rules as a short-circuit cascade, ordered by how much they reject for what they cost.

Each rule is one test on a text. On a bounded sample every rule's time and its rejections are
measured, on texts that pass the base rules and with the counts made that every text gets, as the cascade
meets them; rules are then ordered by rejection per cost, and a document leaves at the first rule that
rejects it. The order decides what work is done, never which documents are kept: a document is kept
if it passes all rules.

Defined results: a NULL or empty text has zero words and fails the base rules. Lines without a word
are no duplicates. Of rows that share an id, one may be in the sample. Ties in the order go to the rule listed first. Repeated rows get equal results,
other columns are not read, an empty table gives no rows and the listed order.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

import numpy as np
from pyspark.sql import DataFrame, functions as F

from foldcat.llm.text import ascii_words, struct_udf

# The sample on which cost and selectivity are measured: the documents of the least xxhash64 of the id.
SAMPLE = 1_000
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
WINDOW = 5
SYMBOLS = "#*$%&|<>"


class Text:
    """A text and what rules share of it, each part made when first asked for."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def words(self) -> list[bytes]:
        return ascii_words(self.text)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum([self.text.count(c) for c in " \t\n\v\f\r"])

    @cached_property
    def n_symbols(self) -> int:
        return sum([self.text.count(c) for c in SYMBOLS])

    @cached_property
    def n_dup_lines(self) -> int:
        lines = [line for line in self.text.split("\n") if line.strip(" \t\n\v\f\r")]
        return len(lines) - len(set(lines))

    @cached_property
    def n_repeat_words(self) -> int:
        return repeated_words(self.words)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """How many words lie in a window of words that the text holds twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter([numbers.setdefault(w, len(numbers)) for w in words], np.int64, len(words))
    if len(numbers) == len(words):
        return 0
    # Windows get equal numbers if and only if they are equal: pairs are numbered anew at each step.
    key = ids[:n]
    for i in range(1, window):
        _, key = np.unique(key * len(numbers) + ids[i : n + i], return_inverse=True)
    twice = np.bincount(key)[key] > 1
    covered = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(twice)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + window, -1)
    return int(np.count_nonzero(np.cumsum(covered[:-1])))


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Text], bool]


def _too_many_symbols(t: Text) -> bool:
    return 5 * t.n_symbols > max(1, len(t.words))


def _odd_word_length(t: Text) -> bool:
    return bool(t.words) and not 2 * len(t.words) <= t.word_chars <= 15 * len(t.words)


def _few_letters(t: Text) -> bool:
    return bool(t.text) and 2 * sum(map(str.isalpha, t.text)) < t.word_chars


def _shouting(t: Text) -> bool:
    upper = sum([w.isupper() for w in t.text.split()])
    return 2 * upper > len(t.words)


def _same_lines(t: Text) -> bool:
    lines = t.text.count("\n") + 1
    return lines >= 4 and 10 * t.n_dup_lines > 6 * lines


def _one_word_rules(t: Text) -> bool:
    return bool(t.words) and 10 * Counter(t.words).most_common(1)[0][1] > 3 * len(t.words)


RULES = (
    Rule("one_word_rules", _one_word_rules),
    Rule("few_letters", _few_letters),
    Rule("shouting", _shouting),
    Rule("same_lines", _same_lines),
    Rule("odd_word_length", _odd_word_length),
    Rule("too_many_symbols", _too_many_symbols),
)


@dataclass(frozen=True)
class Measured:
    """Of one rule on the sample: texts seen, texts rejected, seconds taken."""

    name: str
    seen: int
    rejected: int
    seconds: float

    @property
    def worth(self) -> float:
        return self.rejected / max(self.seconds, 1e-9)


def measure(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample: int = SAMPLE) -> list[Measured]:
    """Each rule's cost and selectivity on a bounded sample, measured where the texts are."""
    ids = docs.select("doc_id").where("doc_id IS NOT NULL").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).distinct()
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(ids), "doc_id")

    def try_all(text: str | None) -> tuple:
        t = Text(text)
        result: list = [not base_counts(t)[-1]]
        for rule in rules if result[0] else ():
            start = time.perf_counter()
            rejected = rule.rejects(t)
            result += [int(rejected), time.perf_counter() - start]
        return (*result, *[0] * (1 + 2 * len(rules) - len(result)))

    names = [f"{k}{i}" for i in range(len(rules)) for k in ("r", "s")]
    tried = struct_udf(try_all, ["passed", *names], ["boolean", *["int", "double"] * len(rules)])("text")
    # One row of an id: its text may be repeated any number of times.
    one = texts.select("doc_id", tried.alias("t")).groupBy("doc_id").agg(F.min("t").alias("t")).select("t.*").where("passed")
    totals = one.agg(F.count(F.lit(1)).alias("n"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names]).first()
    return [Measured(r.name, totals.n, int(totals[f"r{i}"]), float(totals[f"s{i}"])) for i, r in enumerate(rules)]


def ordered(rules: tuple[Rule, ...], measured: list[Measured]) -> tuple[Rule, ...]:
    """Most rejections per second first; rules of equal worth as listed."""
    worth = {m.name: m.worth for m in measured}
    return tuple(sorted(rules, key=lambda r: -worth[r.name]))


def base_counts(t: Text) -> tuple:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    n = len(t.words)
    failed = n < MIN_WORDS or 100 * t.n_repeat_words > MAX_REPEATED_PERCENT * n
    return n, t.word_chars, t.n_symbols, t.n_dup_lines, t.n_repeat_words, failed


def judge(text: str | None, cascade: tuple[Rule, ...]) -> tuple:
    """n_words, the base counts, base_failed, kept, and the rule that rejected it."""
    t = Text(text)
    base = base_counts(t)
    by = None if base[-1] else next((r.name for r in cascade if r.rejects(t)), None)
    return *base, not base[-1] and by is None, by


def judge_documents(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample: int = SAMPLE) -> DataFrame:
    """One row per document: doc_id, n_words, the base counts, base_failed, kept, rejected_by.

    ``rejected_by`` is the first rule in the measured order, so that it may differ between runs.
    """
    cascade = ordered(rules, measure(docs, rules, sample))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rejected_by"]
    types = ["long"] * 5 + ["boolean"] * 2 + ["string"]
    verdict = struct_udf(lambda t: judge(t, cascade), names, types)
    return docs.select("doc_id", verdict(F.col("text").cast("string")).alias("v")).select("doc_id", "v.*")
