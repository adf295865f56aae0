"""Hashed sparse features and linear models that are trained with follow-the-regularised-leader steps."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import Words, as_bytes, pieces, rolling

#: Weights of a model; a feature's hash picks one.
DIMS = 1 << 20

#: What features() gives: text number, weight number and value of each feature; repeated ones add up.
Features = tuple[np.ndarray, np.ndarray, np.ndarray]


def _classes() -> np.ndarray:
    """Byte classes for word shapes: upper case, digits and marks stand out, other letters are alike."""
    out = np.arange(1, 257, dtype=np.uint64)
    out[ord("a") : ord("z") + 1] = 300
    out[128:] = 300
    out[ord("A") : ord("Z") + 1] = 301
    out[ord("0") : ord("9") + 1] = 302
    return out


CLASSES = _classes()


def shapes(words: Words) -> np.ndarray:
    """A hash of each word's byte classes with runs of one class taken together."""
    c = CLASSES[words.buf]
    new = np.ones(len(c), dtype=bool)
    new[1:] = c[1:] != c[:-1]
    new[words.start] = True
    return words.hashes(np.where(new, c, np.uint64(0)))


def ngrams(words: Words, h: np.ndarray, n: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """Text number and weight number of each n-gram that lies within one text."""
    g = rolling(h, n) + np.uint64(salt)
    text = words.text_of[: len(g)]
    inside = text == words.text_of[n - 1 :][: len(g)]
    return text[inside], (g[inside] % np.uint64(DIMS)).astype(np.int64)


@dataclass
class Ftrl:
    """FTRL-proximal over DIMS weights, none below 0 if ``positive``. ``step`` takes the gradient of the loss by the score."""

    alpha: float
    beta: float
    l1: float
    l2: float
    positive: bool = False

    def __post_init__(self) -> None:
        self.z, self.n = np.zeros(DIMS), np.zeros(DIMS)

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z = self.z[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2)
        return np.where((z if self.positive else -np.abs(z)) >= -self.l1, 0.0, w)

    def step(self, at: np.ndarray, x: np.ndarray, w: np.ndarray, slope: float) -> None:
        g = slope * x
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


class Sample(Sequence):
    """Rows (doc_id, label, weight numbers, values) in a given order; one is made when it is asked for, so they take the driver no more than the table."""

    def __init__(self, rows: pa.Table, order: pa.Array):
        self.rows, self.order = rows, order.to_pylist()

    def __len__(self) -> int:
        return len(self.order)

    def __getitem__(self, k: int) -> tuple:
        doc_id, label, at, x = (c[self.order[k]] for c in self.rows.columns)
        return doc_id.as_py(), label.as_py(), np.frombuffer(at.as_buffer(), np.int32).astype(np.int64), np.frombuffer(x.as_buffer(), np.float32).astype(float)


def sample_features(docs: DataFrame, labels: DataFrame, features: Callable[[list[bytes]], Features], rows: int) -> Sample:
    """(doc_id, label, weight numbers, values) of at most ``rows`` labelled documents, picked by a hash of their ids.

    ``labels``: doc_id and label. The bound keeps the training sample small enough for the
    driver at any size of the corpus; the texts themselves stay on the executors.
    """
    order = F.xxhash64(F.col("doc_id").cast("string"), F.lit("sample"))
    chosen = labels.orderBy(order, "doc_id", "label").limit(rows)
    picked = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, at, x = as_bytes(batch["text"]), [], []
            for i, j in pieces(texts):
                text, cell, value = features(texts[i:j])
                key, back = np.unique(text * DIMS + cell, return_inverse=True)
                total = np.bincount(back, weights=value, minlength=len(key))
                cut = np.searchsorted(key, np.arange(j - i + 1) * DIMS)
                at += [(key[a:b] % DIMS).astype(np.int32).tobytes() for a, b in zip(cut, cut[1:])]
                x += [total[a:b].astype(np.float32).tobytes() for a, b in zip(cut, cut[1:])]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["label"].cast(pa.int32()), pa.array(at, pa.binary()), pa.array(x, pa.binary())], ["doc_id", "label", "at", "x"])

    got = picked.mapInArrow(extract, "doc_id long, label int, at binary, x binary").withColumn("o", order).toArrow()
    size = pc.binary_length(got["x"])
    return Sample(got.select(["doc_id", "label", "at", "x"]), pc.sort_indices(pa.table({"o": got["o"], "doc_id": got["doc_id"], "n": size}), [("o", "ascending"), ("doc_id", "ascending"), ("n", "ascending")]))


def score_texts(docs: DataFrame, features: Callable[[list[bytes]], Features], weights: np.ndarray, finish: Callable[[np.ndarray], dict[str, np.ndarray]], schema: str, keep: list[str]) -> DataFrame:
    """Sparse dot products of the weights with each document's features, finished to the columns of ``schema``.

    schema: the columns that ``finish`` makes of the dot products. They come behind the columns
    ``keep`` of ``docs``, which must not have their names.
    """
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in batches:
            texts, dots = as_bytes(batch["text"]), []
            for i, j in pieces(texts):
                text, cell, value = features(texts[i:j])
                dots.append(np.bincount(text, weights=value * w[cell], minlength=j - i))
            made = finish(np.concatenate(dots) if dots else np.zeros(0))
            yield pa.RecordBatch.from_pydict({c: batch[c] for c in keep} | made)

    docs = docs.select(*dict.fromkeys([*keep, "text"]))
    out = docs.select(*keep).schema
    for field in T.StructType.fromDDL(schema):
        out = T.StructType([*out.fields, field])
    return docs.mapInArrow(score, out)


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))
