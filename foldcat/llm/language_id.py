"""Language of a text by sparse multinomial logistic regression on TF-IDF of hashed character n-grams.

Training is FTRL-proximal with elastic net, one example at a time. The L1 penalty is the greatest by which
no more examples kept apart are wrong; on these the softmax is then calibrated by one temperature. Document frequencies come from all documents of the training
fold, weights from a bounded sample of them.

Defined results: a NULL text or one without a letter is ``und`` with score 0; rows whose id or
language is NULL are not learned from; with one learned language all other texts get it with score 1,
with none they are ``und``. Texts of any length are used whole. Ties go to the language that sorts
first. Repeated rows get equal results, and of rows that share an
id and language one is learned from at most. Other columns are not read, an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from foldcat.llm.text import bound_batches, fold_of, struct_udf

BUCKETS = 1 << 15
ORDERS = (1, 2, 3)
# At most this many documents of each language are learned from: those of the least xxhash64 of the id.
SAMPLE_PER_LANGUAGE = 1_500
EPOCHS = 3
# Strengths of the L1 penalty, tried in this order as long as no more of the examples apart are wrong.
L1 = (1e-2, 3e-2, 0.1, 0.3, 1.0)
TEMPERATURES = (0.005, 50.0)
_PARTS = 256
_PIECE = 1 << 18  # code points of a long text that are hashed at a time


def term_counts(text: str) -> np.ndarray:
    """How often each hashed n-gram of a text occurs; runs of non-letters count as one blank."""
    lowered = "".join([c if c.isalpha() else " " for c in text.lower()]) if not text.isascii() else text.lower().translate(_BLANK)
    squeezed = f" {' '.join(lowered.split())} "
    codes = np.frombuffer(squeezed.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    counts = np.zeros(BUCKETS, np.int64)
    for start in range(0, len(codes), _PIECE):
        for order in ORDERS:
            part = codes[start : start + _PIECE + order - 1]
            if len(part) < order:
                continue
            mixed = np.zeros(len(part) - order + 1, np.uint64)
            for i in range(order):
                mixed = (mixed + part[i : len(part) - order + 1 + i] + np.uint64(order)) * np.uint64(0x9E3779B97F4A7C15)
                mixed ^= mixed >> np.uint64(29)
            counts += np.bincount((mixed >> np.uint64(49)).astype(np.int64), minlength=BUCKETS)
    return counts


_BLANK = {i: " " for i in range(128) if not chr(i).isalpha()}


@dataclass(frozen=True)
class Languages:
    names: tuple[str, ...]
    idf: np.ndarray
    weights: np.ndarray  # by language and bucket, the last for the intercept
    temperature: float

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.names or not any(map(str.isalpha, text)):
            return "und", 0.0
        p = softmax(self.weights @ vector(term_counts(text), self.idf) / self.temperature)
        best = int(np.argmax(p))
        return self.names[best], float(p[best])


def vector(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF with damped counts, of length one, and a constant at the end."""
    x = np.log1p(counts) * idf
    norm = np.sqrt(x @ x)
    return np.append(x / norm if norm else x, 1.0)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def ftrl(x: list, y: np.ndarray, classes: int, epochs: int, alpha=0.5, beta=1.0, l1=1e-3, l2=1e-3, seed=3) -> np.ndarray:
    """FTRL-proximal for the softmax; each example is (buckets, values) and touches those alone."""
    z = np.zeros((classes, BUCKETS + 1))
    n = np.zeros((classes, BUCKETS + 1))

    def weights(at):
        zi, ni = z[:, at], n[:, at]
        return np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2))

    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(y)):
            at, v = x[i]
            w = weights(at)
            g = softmax(w @ v)
            g[y[i]] -= 1.0
            step = g[:, None] * v
            sigma = (np.sqrt(n[:, at] + step**2) - np.sqrt(n[:, at])) / alpha
            z[:, at] += step - sigma * w
            n[:, at] += step**2
    return weights(np.arange(BUCKETS + 1))


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts each bucket occurs, and how many texts there are; over all rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(BUCKETS + 1, np.int64), False
        for batch in batches:
            for text in batch.column(0):
                if text.is_valid:
                    seen = True
                    total[:BUCKETS] += term_counts(text.as_py()) > 0
                    total[BUCKETS] += 1
        if seen:
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    bound_batches(texts.sparkSession)
    rows = texts.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    df = np.zeros(BUCKETS + 1, np.int64)
    for r in rows:  # at most BUCKETS + 1 rows
        df[r.bucket] = r.n
    return df[:BUCKETS], int(df[BUCKETS])


def _packed(text: str | None) -> tuple[bytes, bytes]:
    counts = term_counts(text or "")
    at = np.flatnonzero(counts)
    return at.astype(np.uint16).tobytes(), counts[at].tobytes()


def fit_languages(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Languages:
    """Learn from documents whose crc32 of the id modulo 3 is not 1 and whose language is known."""
    train = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    train = train.where((fold_of(F.col("doc_id"), 3) != 1) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    frequencies, total = document_frequencies(train.select("text"))
    idf = np.log((1 + total) / (1 + frequencies)) + 1
    # The first of each part of a language, then the first of these: no task ranks a whole language.
    part = F.pmod(F.xxhash64("doc_id", F.lit("part")), F.lit(_PARTS))
    ids = train.select("doc_id", "lang").distinct().withColumn("part", part)
    for group in (["lang", "part"], ["lang"]):
        first = Window.partitionBy(*group).orderBy(F.xxhash64("doc_id"), "doc_id")
        ids = ids.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= per_language)
    ids = F.broadcast(ids.select("doc_id", "lang"))  # per_language rows a language
    pack = struct_udf(_packed, ["at", "counts"], ["binary", "binary"])
    packed = train.join(ids, ["doc_id", "lang"]).select("doc_id", "lang", pack("text").alias("p"))
    # One row of an id and language, however often the id is repeated.
    rows = packed.groupBy("doc_id", "lang").agg(F.min("p").alias("p")).select("doc_id", "lang", "p.*").collect()
    rows.sort(key=lambda r: (r.lang, r.doc_id))
    names = tuple(sorted({r.lang for r in rows}))
    if len(names) < 2:
        return Languages(names, idf, np.zeros((len(names), BUCKETS + 1)), 1.0)
    x = []
    for r in rows:
        at = np.frombuffer(r.at, np.uint16).astype(np.int64)
        v = np.log1p(np.frombuffer(r.counts, np.int64)) * idf[at]
        norm = np.sqrt(v @ v)
        x.append((np.append(at, BUCKETS), np.append(v / norm if norm else v, 1.0)))
    y = np.array([names.index(r.lang) for r in rows])
    apart = np.arange(len(y)) % 5 == 0  # for the temperature
    if apart.all() or len(set(y[~apart])) < len(names):
        apart[:] = False
    learn = np.flatnonzero(~apart)
    held = np.flatnonzero(apart) if apart.any() else learn
    best, weights = -1.0, np.zeros((len(names), BUCKETS + 1))
    for l1 in L1:
        tried = ftrl([x[i] for i in learn], y[learn], len(names), EPOCHS, l1=l1)
        z = np.array([tried[:, x[i][0]] @ x[i][1] for i in held])
        right = float((z.argmax(1) == y[held]).mean())
        if right < best:
            break  # of equally right ones the sparsest is used
        best, weights, scores = right, tried, z
    return Languages(names, idf, weights, temperature(scores, y[held]))


def temperature(z: np.ndarray, y: np.ndarray) -> float:
    """The temperature of least loss against labels that are a little less than certain.

    As in Platt's scaling each label counts as if one more example of every class had been seen, so that
    scores that part all examples rightly do not call for ever greater certainty.
    """
    n, classes = z.shape
    target = np.full((n, classes), 1 / (n + classes))
    target[np.arange(n), y] += n / (n + classes)
    grid = np.geomspace(*TEMPERATURES, 121)
    loss = [-(target * np.log(softmax(z / t) + 1e-300)).sum(1).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def language_of(text: Column, model: Languages, docs: DataFrame) -> Column:
    """Struct lang_pred, score. The model is broadcast: languages times buckets numbers."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return struct_udf(lambda t: shared.value.predict(t), ["lang_pred", "score"], ["string", "double"])(text.cast("string"))


def identify_documents(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    model = fit_languages(docs, per_language)
    said = docs.select("doc_id", language_of(F.col("text"), model, docs).alias("said"))
    held_out = F.coalesce(fold_of(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out")
    return said.select("doc_id", held_out, "said.*")
