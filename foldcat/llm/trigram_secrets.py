"""Secrets in texts: an inverted index of trigrams finds which documents a rule can match at all.

From each rule's regular expression follows a Boolean query: which trigrams a matching text must hold,
as alternatives of sets. The index lists, for each trigram that some query names, the documents that
hold it (in lower case). A query intersects the lists of an alternative's trigrams; only its documents
are searched by the expression. A rule without mandatory trigrams searches all documents. The index
never loses a match, as every trigram of an alternative stands in each text that matches by it.

Everything runs as DataFrame expressions. Positions count code points, the end is exclusive.

Defined results: a NULL or empty text has no spans. Documents with a NULL id are not in the index and
are searched by all rules; rows that share an id share its candidates and are searched each. Other
columns are not read. Texts are searched whole. An empty table gives no rows.
"""

from __future__ import annotations

import itertools
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from foldcat.operators.membership import key_bitmap, with_chance
from foldcat.staging import cut

# Candidates are sent to all executors if they are no more than this; else a sketch of them is.
BROADCAST_ROWS = 2_000_000
_MOST_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``group`` of a match must have ``least`` characters, or the match is dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# The three base rules, then public formats of tokens and keys. The pattern of hex has
# its least length inside, which gives the same spans as dropping shorter runs.
BASE_RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]+"),
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ ){0,2}PRIVATE KEY-----"),
)
RULES = BASE_RULES + MORE_RULES

Alternatives = set[frozenset[str]]  # any of these sets must be held whole
_ANYTHING: Alternatives = {frozenset()}


def _trigrams(strings: set[str]) -> Alternatives:
    return {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}


def _both(a: Alternatives, b: Alternatives) -> Alternatives:
    joined = {x | y for x, y in itertools.product(a, b)}
    return joined if len(joined) <= _MOST_STRINGS else a


def _look(node) -> tuple[set[str] | None, Alternatives]:
    """Of one node of the parsed expression: the strings it can match if few, and its query."""
    kind, value = str(node[0]), node[1]
    if kind == "LITERAL":
        return {chr(value).lower()}, _ANYTHING
    if kind == "AT":
        return {""}, _ANYTHING
    if kind == "IN" and all(str(k) == "LITERAL" for k, _ in value) and len(value) <= 8:
        return {chr(c).lower() for _, c in value}, _ANYTHING
    if kind == "SUBPATTERN":
        return _sequence(value[-1])
    if kind == "BRANCH":
        looked = [_sequence(branch) for branch in value[1]]
        query = set().union(*(_query(*x) for x in looked))
        if all(strings is not None for strings, _ in looked):
            strings = set().union(*(s for s, _ in looked))
            return (strings if len(strings) <= _MOST_STRINGS else None), query
        return None, query
    if kind in ("MAX_REPEAT", "MIN_REPEAT"):
        least, most, inner = value
        strings, query = _sequence(inner)
        if (least, most) == (1, 1):
            return strings, query
        if (least, most) == (0, 1) and strings is not None:
            return strings | {""}, _ANYTHING
        return None, (_query(strings, query) if least else _ANYTHING)
    return None, _ANYTHING


def _query(strings: set[str] | None, query: Alternatives) -> Alternatives:
    return query if strings is None else _both(_trigrams(strings), query)


def _sequence(nodes) -> tuple[set[str] | None, Alternatives]:
    strings, query, whole = {""}, _ANYTHING, True
    for node in nodes:
        found, own = _look(node)
        query = _both(query, own)
        if found is not None and len(strings) * len(found) <= _MOST_STRINGS:
            strings = {a + b for a, b in itertools.product(strings, found)}
        else:
            query = _both(query, _trigrams(strings))
            strings, whole = (found if found is not None and len(found) <= _MOST_STRINGS else {""}), False
    return (strings, query) if whole else (None, _both(query, _trigrams(strings)))


def trigram_query(pattern: str) -> Alternatives:
    """Alternatives of lower-case trigrams, one of which every match holds; an empty set: no demand."""
    query = _query(*_sequence(re._parser.parse(pattern)))
    return {a for a in query if not any(b < a for b in query)}


def candidates(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(doc_id, kinds) of documents that some indexed rule may match."""
    wanted = [
        (rule.kind, number, trigram, len(alternative))
        for rule in rules
        for number, alternative in enumerate(sorted(trigram_query(rule.pattern), key=sorted))
        for trigram in sorted(alternative)
    ]
    spark = docs.sparkSession
    queries = spark.createDataFrame(wanted, "kind string, alternative int, trigram string, needed int")
    vocabulary = F.array(*[F.lit(t) for t in sorted({w[2] for w in wanted})])
    # The text is lowered once for all trigrams.
    held = F.transform(F.array(F.lower("text")), lambda low: F.filter(vocabulary, lambda t: F.contains(low, t)))[0]
    index = docs.where("doc_id IS NOT NULL").select("doc_id", F.explode(held).alias("trigram")).distinct()
    met = index.join(F.broadcast(queries), "trigram")  # as many rows as the rules' trigrams
    whole = met.groupBy("doc_id", "kind", "alternative").agg(F.count(F.lit(1)).alias("held"), F.first("needed").alias("needed"))
    return whole.where("held = needed").groupBy("doc_id").agg(F.collect_set("kind").alias("kinds"))


_SPANS = "array<struct<start:int,end:int,tested:int>>"


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is named."""
    return F.transform(F.array(value), use)[0]


def _laid_out(steps: Column) -> Column:
    """The spans of alternating gaps and matches, counted from 0, and where the last one ends."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("found"))

    def step(state, x):
        begins = state["at"] + x["gap"]
        ends = begins + x["m"]["long"]
        span = F.struct(begins.alias("start"), ends.alias("end"), x["m"]["tested"].alias("tested"))
        return F.struct(ends.alias("at"), F.concat(state["found"], F.array(span)).alias("found"))

    return F.aggregate(steps, start, step)


def _laid_out_by_blocks(steps: Column) -> Column:
    """The same spans by blocks of as many steps as there are blocks, each moved to where it begins.

    Appending copies the array, so that one run over n matches would cost their square.
    """
    width = F.ceil(F.sqrt(F.size(steps))).cast("int")
    last = F.floor((F.size(steps) - 1) / width).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), last), lambda i: _laid_out(F.slice(steps, i * width + 1, width)))

    def moved(blocks):
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("begins"))
        begins = F.aggregate(
            blocks,
            start,
            lambda s, b: F.struct((s["at"] + b["at"]).alias("at"), F.concat(s["begins"], F.array(s["at"])).alias("begins")),
            lambda s: s["begins"],
        )
        return F.flatten(F.zip_with(blocks, begins, lambda b, by: F.transform(b["found"], lambda s: F.struct(
            (s["start"] + by).alias("start"), (s["end"] + by).alias("end"), s["tested"].alias("tested")
        ))))

    return F.when(F.size(steps) == 0, F.array().cast(_SPANS)).otherwise(_bound(blocks, moved))


def spans_of(text: Column, rule: Rule) -> Column:
    """Leftmost non-overlapping matches as (start, end, tested); gaps and matches alternate."""
    matches = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    if rule.group:
        tested = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
        matches = F.zip_with(matches, tested, lambda m, g: F.struct(F.length(m).alias("long"), F.length(g).alias("tested")))
    else:
        matches = F.transform(matches, lambda m: F.struct(F.length(m).alias("long"), F.length(m).alias("tested")))
    gaps = F.transform(F.split(text, rule.pattern, -1), F.length)

    # The last gap has no match behind it.
    steps = F.filter(F.zip_with(gaps, matches, lambda g, m: F.struct(g.alias("gap"), m.alias("m"))), lambda x: x["m"].isNotNull())
    return F.filter(_bound(steps, _laid_out_by_blocks), lambda s: s["tested"] >= rule.least)


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: doc_id, n_<kind> of the base rules, base_sha256, spans, n_spans."""
    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    indexed = {r.kind for r in rules if trigram_query(r.pattern) - _ANYTHING and frozenset() not in trigram_query(r.pattern)}
    found = cut(candidates(texts, tuple(r for r in rules if r.kind in indexed)))
    if found.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        known = texts.join(F.broadcast(found), "doc_id", "left")
    else:
        # A sketch of the candidates' ids goes to the texts. All indexed rules search those that it takes for
        # candidates, a few others too: a rule finds nothing in a text that is none of its candidates.
        kinds = F.when(F.col("_chance"), F.array(*[F.lit(kind) for kind in sorted(indexed)]))
        known = with_chance(texts, key_bitmap(found, ["doc_id"]), ["doc_id"]).withColumn("kinds", kinds)
    none = F.array().cast(_SPANS)
    columns = []
    for rule in rules:
        spans = spans_of(F.col("text"), rule)
        if rule.kind in indexed:
            may = F.col("doc_id").isNull() | F.array_contains("kinds", rule.kind)
            spans = F.when(F.coalesce(may, F.lit(False)), spans).otherwise(none)
        columns.append(spans.alias(rule.kind))
    searched = known.select("doc_id", *columns)

    def joined(some: tuple[Rule, ...]) -> Column:
        def ranked(kind: str, rank: int) -> Column:
            return F.transform(kind, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end")))

        parts = [ranked(r.kind, rank) for rank, r in enumerate(some)]
        kinds = F.array(*[F.lit(r.kind) for r in some])
        ordered = F.array_sort(F.concat(*parts))
        return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s["start"], s["end"])), ",")

    base = tuple(r for r in rules if r.kind in {b.kind for b in BASE_RULES})
    return searched.select(
        "doc_id",
        *[F.size(r.kind).cast("long").alias(f"n_{r.kind}") for r in base],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(rules).alias("spans"),
    )
