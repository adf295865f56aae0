"""Language identification by prediction by partial matching over bytes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import table
from .text import as_bytes, pieces

#: Documents to learn each language from, in expectation.
SAMPLE_DOCS = 400
#: Contexts of three bytes that the sample has at least so often get statistics of their own.
LEAST_CONTEXT = 16
BREAK = b"\n\n\n"


@dataclass
class Model:
    """Frozen code lengths: ``cost[state * symbols + symbol]`` has the bits that each language needs.

    ``symbol`` folds the bytes that no sample has into one, ``state`` maps the last three
    symbols to the longest context with statistics.
    """

    languages: list[str]
    symbol: np.ndarray
    symbols: int
    state: np.ndarray
    cost: np.ndarray

    def bits(self, texts: list[bytes]) -> np.ndarray:
        """Code length of each text under each language: texts x languages."""
        sizes = np.fromiter((len(t) + 3 for t in texts), np.int64, len(texts))
        s = self.symbol[np.frombuffer(BREAK + BREAK.join(texts), dtype=np.uint8)]
        at = self.state[(s[:-3].astype(np.int64) * self.symbols + s[1:-2]) * self.symbols + s[2:-1]] * self.symbols + s[3:]
        # the bytes of a text are followed by the break before the next one, which counts for it too
        each = np.take(self.cost, at, axis=0)
        first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        out = np.zeros((len(texts), len(self.languages)))
        full = first < len(each)
        if full.any():
            out[full] = np.add.reduceat(each, first[full], axis=0, dtype=np.float64)
        return out


def quads(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The distinct runs of four bytes of a text between breaks, as numbers, and how often each comes."""
    x = np.frombuffer(BREAK + text + BREAK, dtype=np.uint8).astype(np.int64)
    return np.unique(((x[:-3] << 8 | x[1:-2]) << 8 | x[2:-1]) << 8 | x[3:], return_counts=True)


def fit(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
    """Context trees of up to three bytes for each language, with escapes as in method C, from its counted quads()."""
    languages = sorted(counts)
    quad = [[counts[x][0] >> s & 255 for s in (24, 16, 8, 0)] for x in languages]
    seen = np.unique(np.concatenate([*[q for four in quad for q in four], np.frombuffer(BREAK, np.uint8)]))
    symbol = np.zeros(256, dtype=np.int32)
    symbol[seen] = np.arange(1, len(seen) + 1)
    a = len(seen) + 1
    codes = [[symbol[q].astype(np.int64) for q in four] for four in quad]
    weight = [counts[x][1].astype(np.int64) for x in languages]
    count = lambda at, n, size: np.bincount(at, weights=n, minlength=size)
    triples = [(p * a + q) * a + r for p, q, r, _ in codes]
    total = sum(count(t, n, a**3) for t, n in zip(triples, weight))
    deep = np.flatnonzero(total >= LEAST_CONTEXT)
    number = np.full(a**3, -1, dtype=np.int64)
    number[deep] = np.arange(len(deep))
    cost = np.zeros((a * a + len(deep), a, len(languages)), dtype=np.float32)

    def level(counts: np.ndarray, below: np.ndarray) -> np.ndarray:
        """Bits of each symbol after each context; unseen symbols escape to what the shorter context needs."""
        n, d = counts.sum(axis=1, keepdims=True), (counts > 0).sum(axis=1, keepdims=True)
        with np.errstate(divide="ignore", invalid="ignore"):
            hit, escape = -np.log2(counts / (n + d)), np.where(n > 0, -np.log2(d / (n + d)), 0.0)
        return np.where(counts > 0, hit, escape + below)

    for k, ((_, q, r, s), t, n) in enumerate(zip(codes, triples, weight)):
        zero = level(count(s, n, a)[None, :], np.full((1, a), 8.0))
        one = level(count(r * a + s, n, a * a).reshape(a, a), zero)
        two = level(count((q * a + r) * a + s, n, a**3).reshape(a * a, a), np.tile(one, (a, 1)))
        in_deep = number[t] >= 0
        three = level(count(number[t][in_deep] * a + s[in_deep], n[in_deep], len(deep) * a).reshape(len(deep), a), two[deep % (a * a)])
        cost[: a * a, :, k], cost[a * a :, :, k] = two, three
    state = np.where(number >= 0, number + a * a, np.arange(a**3) % (a * a)).astype(np.int32)
    return Model(languages, symbol, a, state, cost.reshape(-1, len(languages)))


def counted_quads(sample: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """quads() of each language's texts (lang, text), counted on the executors; the driver gets one number for each run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), lower(as_bytes(batch["text"]))):
                quad, n = quads(text)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(quad), pa.string()), pa.array(quad), pa.array(n.astype(np.int64))], ["lang", "quad", "n"])

    found = sample.select("lang", "text").mapInArrow(run, "lang string, quad long, n long").groupBy("lang", "quad").agg(F.sum("n").alias("n")).toArrow()
    lang, quad, n = np.array(found["lang"].to_pylist(), object), found["quad"].to_numpy(), found["n"].to_numpy()
    return {x: (quad[lang == x].astype(np.int64), n[lang == x].astype(np.int64)) for x in set(lang)}


def lower(texts: list[bytes]) -> list[bytes]:
    return [t.decode("utf-8", "replace").lower().encode() for t in texts]


def identify(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score.

    Learns from the text and non-null lang of documents whose crc32(doc_id) mod 3 is not 1:
    of each language about ``sample_docs``, picked by a hash of the id. The prediction is
    the language whose trees need the fewest bits for the whole text (ties: the first by name),
    the score its share of the likelihood. Texts that are null or have no letter are ``und``
    with score 0, and so is every text when there is nothing to learn from. Rows that repeat an id are each
    learnt from and predicted. Runs of four bytes of the sample are counted on the executors; the model takes
    some 70 MB a language at most. Other columns are ignored; an empty table gives no rows.
    """
    fold = F.crc32(F.col("doc_id").cast("string")) % 3
    known = docs.where((fold != 1) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "lang", "text")
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    draw = F.conv(F.substring(F.md5(F.concat(F.lit("lang:"), F.col("doc_id").cast("string"))), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))
    rate = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, sample_docs / n))]) if counts else None
    sample = known.where(draw < F.try_element_at(rate, F.col("lang"))) if counts else known.limit(0)
    found = counted_quads(sample) if counts else {}
    shared = docs.sparkSession.sparkContext.broadcast(fit(found) if found else None)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts, has_letter = lower(as_bytes(batch["text"])), batch["has_letter"].to_pylist()
            lang, score = ["und"] * len(texts), np.zeros(len(texts))
            for i, j in pieces(texts) if model else ():
                bits = model.bits(texts[i:j])
                best = bits.argmin(axis=1)
                share = 1 / np.exp2(np.maximum(bits.min(axis=1, keepdims=True) - bits, -1000)).sum(axis=1)
                for k in range(i, j):
                    if has_letter[k]:
                        lang[k], score[k] = model.languages[best[k - i]], share[k - i]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["held_out"], pa.array(lang, pa.string()), pa.array(score)], ["doc_id", "held_out", "lang_pred", "score"])

    return docs.select(
        "doc_id", "text", F.coalesce(fold == 1, F.lit(False)).alias("held_out"), F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("has_letter")
    ).mapInArrow(predict, "doc_id long, held_out boolean, lang_pred string, score double")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
