"""A corpus pipeline: quality filter, exact and near dedup, mixing, and encoding, each over all its predecessor kept.

Part of the subpackage fieldloom.llm. Rows are told apart by their id and text, so a row that is dropped
takes none with it that has only its id. Columns may have any names; all but the last stage keep them.
Null and empty texts are documents like others: the classifier scores them, all of them are equal to each
other, they link with nothing else, take no words of the mix and have no tokens. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldloom.llm.exact_dedup import exact_dedup, text_digest
from fieldloom.llm.jaccard import jaccard_components
from fieldloom.llm.mixing import emit
from fieldloom.llm.quality import quality_scores
from fieldloom.llm.sentencepieces import token_digests
from fieldloom.llm.shared import parted, row_key, saved, table, without

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Rows of an Arrow batch between Spark and Python, at most: all stages share the executors, whose memory follows the largest batches.
BATCH_ROWS = 2000


def small_batches(stage: Stage) -> Stage:
    """The stage with at most BATCH_ROWS rows in the session's Arrow batches; what is set lower stays."""

    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        rows = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
        if not 0 < rows <= BATCH_ROWS:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
        return stage(spark, docs, sf_dir)

    return run


@small_batches
def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    scored = saved(quality_scores(docs, table(spark, sf_dir, "labels"), key=row_key()))
    return without(docs, scored.where("predicted = 0").select("doc_id"), row_key(), scored.count())


@small_batches
def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id; of rows that repeat it with its text, one."""
    key = F.concat_ws(":", "doc_id", "text_sha256").alias("key")
    found = saved(exact_dedup(docs).select(key, "kept"))
    n = found.count()
    own = F.concat_ws(":", F.col("doc_id").cast("string"), text_digest("text"))
    left = without(docs, found.where("NOT kept").select("key"), own, n)
    again = saved(found.where("kept").groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"))
    if again.isEmpty():
        return left
    once, more = parted(saved(left), again, own, n)
    packed = more.select(F.struct(*[F.col(f"`{c}`") for c in more.columns]).alias("row"), own.alias("key"))
    return once.unionByName(packed.dropDuplicates(["key"]).select("row.*"))


@small_batches
def distinct_groups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links join, the one with the smallest id; rows that share an id go together."""
    found = saved(jaccard_components(docs).select("doc_id", "component_id"))
    return without(docs, found.where("doc_id <> component_id").select("doc_id"), "doc_id", found.count())


@small_batches
def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them; rows that share an id are taken alike."""
    return emit(docs)


@small_batches
def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, tokens_sha256 and round_trip of each document of the mix."""
    return token_digests(docs)


STAGES = [
    ("quality classifier", good_quality),
    ("exact dedup", distinct_texts),
    ("n-gram Jaccard join", distinct_groups),
    ("mixing sources to target weights", mixture),
    ("SentencePiece encoding and decoding", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


#: The classifier, the Jaccard join's links and the pieces are not expressible in SQL.
ORACLE_SQL = None
