"""Toxicity: cumulative-link ordinal regression over the words of a text, with one set of weights for all thresholds."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .linear import DIMS, Features, Ftrl, sample_features, score_texts, sigmoid
from .shared import table
from .text import Words

#: Labelled documents to learn from, at most.
SAMPLE_ROWS = 10_000
PASSES = 10
#: Lengths in bytes of the word beginnings that are features.
STEMS = (4, 5, 6)
#: What makes a feature telling, see telling().
LEAST_DOCS, LEAST_Z = 6, 4.0
#: Severity grades: 0 is clean, 1 to GRADES - 1 are toxic.
GRADES = 4
#: A document is flagged when the probability of a grade above 0 is at least this.
THRESHOLD = 0.35


def features(texts: list[bytes]) -> Features:
    """The distinct words of each text without marks and digits, and their beginnings, lower-cased; each has the value 1.

    Beginnings of some lengths let a stem count whatever ending it has.
    """
    words = Words([t.lower() for t in texts])
    letter = ((words.buf >= 97) & (words.buf <= 122)) | (words.buf >= 128)
    found = [words.hashes(np.where(letter, words.buf.astype(np.uint64) + np.uint64(1), np.uint64(0)))]
    found += [words.hashes(prefix=n) + np.uint64(n) for n in STEMS]
    text = np.tile(words.text_of, len(found))
    key = np.unique(text * DIMS + (np.concatenate(found) % np.uint64(DIMS)).astype(np.int64))
    return key // DIMS, key % DIMS, np.ones(len(key))


def telling(sample: Sequence[tuple]) -> np.ndarray:
    """Which weights are learnt: features that toxic documents have far more often than by chance.

    A feature must be in LEAST_DOCS documents of the sample or more, and the number of toxic
    ones among them LEAST_Z standard deviations above what the share of toxic documents gives.
    """
    count = lambda x: np.bincount(np.concatenate([np.zeros(0, np.int64), *x]), minlength=DIMS)
    toxic, n = count(at for _, y, at, _ in sample if y > 0), count(at for _, _, at, _ in sample)
    p = sum(y > 0 for _, y, _, _ in sample) / max(1, len(sample))
    return (n >= LEAST_DOCS) & (toxic - n * p >= LEAST_Z * np.sqrt(n * p * (1 - p))) & (toxic > 0)


def grade(sample: Sequence[tuple], marker: np.ndarray) -> list[tuple]:
    """The sample with severity grades for the 0/1 labels, and with the telling features alone.

    Labels above 1 are grades already. If they say toxic or not, how severe is read from the number of telling features. Toxic
    documents with more of them than a third, or two thirds, of the toxic ones get grade 2 or 3.
    """
    kept = [(i, y, at[marker[at]], x[marker[at]]) for i, y, at, x in sample]
    if max((y for _, y, _, _ in kept), default=0) > 1:
        return kept
    steps = np.quantile([len(at) for _, y, at, _ in kept if y > 0] or [0], [1 / 3, 2 / 3])
    return [(i, 1 + int((len(at) > steps).sum()) if y > 0 else 0, at, x) for i, y, at, x in kept]


def train(sample: Sequence[tuple], passes: int = PASSES) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds: P(grade > k) = sigmoid(weights . x - thresholds[k])."""
    model, cuts, cut_n = Ftrl(alpha=0.5, beta=1.0, l1=0.3, l2=0.01, positive=True), np.arange(1.0, GRADES), np.full(GRADES - 1, 1.0)
    for _ in range(passes):
        for _, y, at, x in sample:
            w = model.weights(at)
            above = np.concatenate(([1.0], sigmoid(x @ w - cuts), [0.0]))  # P(grade >= k)
            p = max(above[y] - above[y + 1], 1e-9)
            d = above * (1 - above)
            model.step(at, x, w, -(d[y] - d[y + 1]) / p)
            slope = np.zeros(GRADES - 1)  # of the loss by each threshold
            if y > 0:
                slope[y - 1] = d[y] / p
            if y < GRADES - 1:
                slope[y] = -d[y + 1] / p
            cut_n += slope * slope
            cuts = np.maximum.accumulate(cuts - 1.0 * slope / np.sqrt(cut_n) + np.arange(GRADES - 1) * 1e-9)
    return model.weights(), cuts


def toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, severity, grade, predicted.

    ``score`` is the probability that the grade is above 0, ``severity`` the expected grade,
    ``grade`` the likeliest one and ``predicted`` 1 if score reaches the threshold. Learns from
    at most ``sample_rows`` labelled documents whose crc32(doc_id) mod 5 is not 0 and whose toxic
    is not null. Null and empty texts have no words and get what the thresholds alone say; equal texts
    tie, and repeated rows are scored each. Other columns are ignored; an empty table gives no rows.

    ``toxic`` may hold real grades, 0 to GRADES - 1. Where it is only 0 or 1, grades 2 and 3 are set by the
    number of telling features (see grade()), so that ``severity`` then says how much of a text is toxic.
    """
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    known = labels.where((fold != 0) & F.col("toxic").isNotNull()).select("doc_id", F.least(F.greatest(F.col("toxic").cast("int"), F.lit(0)), F.lit(GRADES - 1)).alias("label"))
    sample = sample_features(docs, known, features, sample_rows)
    weights, cuts = train(grade(sample, telling(sample)))

    def finish(dots: np.ndarray) -> dict[str, np.ndarray]:
        above = sigmoid(dots[:, None] - cuts[None, :])
        each = -np.diff(np.concatenate([np.ones((len(dots), 1)), above, np.zeros((len(dots), 1))], axis=1), axis=1)
        return {"score": above[:, 0], "severity": above.sum(axis=1), "grade": each.argmax(axis=1).astype(np.int32), "predicted": (above[:, 0] >= threshold).astype(np.int32)}

    marked = docs.select("doc_id", "text", F.coalesce(fold == 0, F.lit(False)).alias("held_out"))
    return score_texts(marked, features, weights, finish, "score double, severity double, grade int, predicted int", ["doc_id", "held_out"])


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
