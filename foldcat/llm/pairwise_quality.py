"""Document quality by Bradley-Terry: a linear score whose differences explain which of two is better.

For a pair of labelled documents the model says P(i better than j) = sigmoid(w . (x_i - x_j)), so the
weights come from a logistic loss on feature differences and no intercept exists. The cut is then set
at a quantile of the training scores, the one that parts the labels best, and scores are mapped to
(0, 1) by a logistic curve that gives 0.3 at the cut.

Defined results: a NULL or empty text has the features of an empty text (all zero) and the score of
such; documents whose label or id is NULL are never learned from; several labels of one id all count;
without labels of both kinds every score is 0.5. Texts of any length are used whole. Repeated rows get
equal scores. Only the text is read, so other columns do not matter. An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from foldcat.llm.text import fold_of, struct_udf

# At most this many labelled documents of each label are learned from: those of the least xxhash64 of
# the id. This bounds what meets on the driver; it does not depend on the size of the corpus.
SAMPLE_PER_LABEL = 6_000
PAIRS = 60_000
THRESHOLD = 0.3
_L2 = 1e-4

_CLASSES = 8  # letter, upper case, digit, space, line break, sentence mark, other mark, not ASCII


def _ascii_classes() -> np.ndarray:
    table = np.full(128, 6, np.uint8)
    for code in range(128):
        c = chr(code)
        if c == "\n":
            table[code] = 4
        elif c.isspace():
            table[code] = 3
        elif c.isdigit():
            table[code] = 2
        elif c.isalpha():
            table[code] = 1 if c.isupper() else 0
        elif c in ".,;:?'\"()-":
            table[code] = 5
    return table


_TABLE = _ascii_classes()
FEATURES = (
    "upper", "digits", "breaks", "stops", "marks", "other_letters", "words", "word_length", "spread",
    "different_words", "most_common_word", "one_letter", "ends_in_mark", "marked_words", "upper_words",
    "different_lines", "repeated_bigrams", "line_words",
)


def features(text: str | None) -> np.ndarray:
    """Shape of a text, free of its language; all zero without words."""
    out = np.zeros(len(FEATURES))
    words = text.split() if text else []
    if not words:
        return out
    n, size = len(words), len(text)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = np.bincount(np.where(codes < 128, _TABLE[np.minimum(codes, 127)], 7), minlength=_CLASSES)
    letters = max(1, int(kinds[0] + kinds[1] + kinds[7]))
    lengths = np.fromiter(map(len, words), np.int64, n)
    counts = Counter(words)
    ends = Counter([w[-1] for w in words])
    starts = Counter([w[0] for w in words])
    lines = [line for line in text.split("\n") if line.strip()]
    pairs = len(set(zip(words, words[1:])))
    out[:] = (
        kinds[1] / letters,
        kinds[2] / size,
        kinds[4] / n,
        kinds[5] / n,
        kinds[6] / n,
        kinds[7] / letters,
        np.log1p(n),
        lengths.mean() / 10,
        lengths.std() / 10,
        len(counts) / n,
        counts.most_common(1)[0][1] / n,
        np.count_nonzero(lengths == 1) / n,
        sum([k for c, k in ends.items() if not (c.isalnum() or c in ".,;:?!'\")")]) / n,
        ends["!"] / n,
        sum([k for c, k in starts.items() if c.isupper()]) / n,
        len(set(lines)) / len(lines),
        1 - pairs / max(1, n - 1),
        np.log1p(n / len(lines)),
    )
    return out


@dataclass(frozen=True)
class Ranking:
    """Scaled weights, the cut on the latent score, and the slope of the final curve."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float
    slope: float

    def latent(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        shift = np.log(THRESHOLD / (1 - THRESHOLD)) if self.slope else 0.0
        return 1 / (1 + np.exp(-np.clip(self.slope * (self.latent(x) - self.cut) + shift, -40, 40)))


def fit_pairs(x: np.ndarray, good: np.ndarray, pairs: int = PAIRS, seed: int = 7) -> Ranking:
    """Learn from feature rows and whether each is good. One pair holds one row of either kind."""
    d = x.shape[1] if x.ndim == 2 else len(FEATURES)
    if not good.any() or good.all():
        return Ranking(np.zeros(d), np.ones(d), np.zeros(d), 0.0, 0.0)
    mean, scale = x.mean(0), x.std(0) + 1e-3
    z = np.clip((x - mean) / scale, -8, 8)
    rng = np.random.default_rng(seed)
    better, worse = np.flatnonzero(good), np.flatnonzero(~good)
    diff = z[rng.choice(better, pairs)] - z[rng.choice(worse, pairs)]
    w = np.zeros(d)
    for _ in range(25):  # Newton steps on the mean logistic loss
        p = 1 / (1 + np.exp(-np.clip(diff @ w, -30, 30)))
        gradient = -((1 - p) @ diff) / pairs + _L2 * w
        curvature = (diff * (p * (1 - p))[:, None]).T @ diff / pairs + _L2 * np.eye(d)
        step = np.linalg.solve(curvature, gradient)
        w -= step / max(1.0, np.abs(step).max() / 2)
        if np.abs(step).max() < 1e-6:
            break
    s = z @ w
    # The quantile that parts the labels best, midway between the scores around it.
    order = np.sort(s)
    cuts = np.append(order[0] - 1.0, (order[1:] + order[:-1]) / 2)
    up, low = np.sort(s[good]), np.sort(s[~good])
    kept = 1 - np.searchsorted(up, cuts) / len(up)
    dropped = np.searchsorted(low, cuts) / len(low)
    right = kept + dropped
    cut = float(np.median(cuts[right >= right.max() - 1e-12]))
    spread = max(1e-6, np.median(np.abs(s - cut)))
    return Ranking(mean, scale, w, cut, float(min(20.0, 3.0 / spread)))


def labelled_sample(docs: DataFrame, labels: DataFrame, per_label: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows and labels of a bounded sample of labelled documents.

    The ids are chosen from the labels alone; only their texts are looked at.
    """
    known = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").select("doc_id", "quality")
    halves = [known.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label) for q in (0, 1)]
    chosen = F.broadcast(halves[0].unionByName(halves[1]))  # at most 2 * per_label rows
    shape = struct_udf(lambda t: (features(t).tobytes(),), ["x"], ["binary"])
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    shaped = texts.join(chosen, "doc_id").select("doc_id", "quality", shape("text")["x"].alias("x"))
    # One row of an id and label, however often the id is repeated.
    rows = shaped.groupBy("doc_id", "quality").agg(F.min("x").alias("x")).collect()
    rows.sort(key=lambda r: (r.doc_id, r.quality))
    x = np.array([np.frombuffer(r.x) for r in rows]).reshape(len(rows), len(FEATURES))
    return x, np.array([r.quality == 1 for r in rows], bool)


def fit_quality(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL) -> Ranking:
    """Learn from labels of documents outside the held-out fold (crc32 of the id modulo 5 is 0)."""
    return fit_pairs(*labelled_sample(docs, labels.where(fold_of(F.col("doc_id"), 5) != 0), per_label))


def quality_score(text: Column, model: Ranking) -> Column:
    """The score of a text, 0 to 1."""
    return struct_udf(lambda t: (float(model.score(features(t)[None, :])[0]),), ["score"], ["double"])(text.cast("string"))["score"]


def score_documents(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    model = fit_quality(docs, labels, per_label)
    scored = docs.select("doc_id", quality_score(F.col("text"), model).alias("score"))
    return scored.select(
        "doc_id",
        F.coalesce(fold_of(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, per_label: int = SAMPLE_PER_LABEL) -> DataFrame:
    """The documents that the classifier does not reject, with all their columns."""
    model = fit_quality(docs, labels, per_label)
    return docs.where(quality_score(docs["text"], model) >= THRESHOLD)
