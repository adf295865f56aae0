"""Quality classifier: logistic regression over hashed word n-grams, trained with FTRL steps."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .linear import Features, Ftrl, ngrams, sample_features, score_texts, shapes, sigmoid
from .shared import table
from .text import Words

#: Labelled documents to learn from, at most.
SAMPLE_ROWS = 6000
PASSES = 3
THRESHOLD = 0.3


def features(texts: list[bytes]) -> Features:
    """Word uni- and bigrams, and uni- to trigrams of word shapes; each kind adds up to 1 in a text."""
    words = Words([t.lower() for t in texts])
    plain, shape = words.hashes(), shapes(Words(texts))
    found = [(*ngrams(words, plain, 1, 1)[:2], 0.5), (*ngrams(words, plain, 2, 2), 0.5)]
    found += [(*ngrams(words, shape, n, 2 + n), 1.0) for n in (1, 2, 3)]
    text, cell, value = [], [], []
    for t, c, share in found:
        text.append(t)
        cell.append(c)
        value.append(share / np.bincount(t, minlength=len(texts))[t])
    return np.concatenate(text), np.concatenate(cell), np.concatenate(value)


def train(sample: Sequence[tuple], passes: int = PASSES) -> tuple[np.ndarray, float]:
    """Weights and bias. ``sample``: (doc_id, label, weight numbers, values)."""
    model, bias, bias_n = Ftrl(alpha=0.5, beta=1e-3, l1=1e-4, l2=1e-3), 0.0, 1e-3
    for _ in range(passes):
        for _, label, at, x in sample:
            w = model.weights(at)
            slope = float(sigmoid(bias + x @ w)) - label
            model.step(at, x, w, slope)
            bias_n += slope * slope
            bias -= 0.1 * slope / np.sqrt(bias_n)
    return model.weights(), bias


def quality_scores(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, threshold: float = THRESHOLD, key: Column | None = None) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1, higher: label 1 likelier), predicted (1: score >= threshold).

    Learns from at most ``sample_rows`` labelled documents whose crc32(doc_id) mod 5 is not 0 (the others,
    those with a null id not among them, are held_out) and whose quality is not null; the score depends on
    the text alone, so equal texts tie. Null and empty texts, which have no features, get the score of the
    bias. Without labels every score is 0.5. Repeated rows are scored each. Other columns are ignored, and
    only the text goes through Python. ``key``: what stands for a row instead of doc_id, under that name.
    """
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    known = labels.where((fold != 0) & F.col("quality").isNotNull()).select("doc_id", F.col("quality").cast("int").alias("label"))
    weights, bias = train(sample_features(docs, known, features, sample_rows))

    def finish(dots: np.ndarray) -> dict[str, np.ndarray]:
        score = sigmoid(dots + bias)
        return {"score": score, "predicted": (score >= threshold).astype(np.int32)}

    rows = docs.select((F.col("doc_id") if key is None else key).alias("doc_id"), "text", F.coalesce(fold == 0, F.lit(False)).alias("held_out"))
    return score_texts(rows, features, weights, finish, "score double, predicted int", ["doc_id", "held_out"])


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
