"""Exact duplicates by two passes over a Bloom filter of text digests."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import BLOCK_BITS, bits_for, dealt, join_unique, maybe_in, saved, shuffle_partitions, table, unpacked

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bits of the filter for each row. Its size is bounded by shared.MAX_BITS, 128 MB.
BITS_PER_ROW = 64
#: Bits that a digest sets, and cells that a task merges at a time, about, at most.
HASHES, GROUP_CELLS = 2, 1 << 24


def text_digest(text_col: str) -> Column:
    """The digest of a text with A-Z lower-cased; null counts as empty."""
    return F.sha2(F.translate(F.coalesce(F.col(text_col), F.lit("")), UPPER, LOWER).cast("binary"), 256)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), text_digest(text_col).alias("text_sha256"))


def cells(bits: int) -> list[Column]:
    """The HASHES cells, 0 .. bits - 1, that a digest sets: parts of the digest itself."""
    return [(F.conv(F.substring("text_sha256", 1 + 15 * k, 15), 16, 10).cast("long") % bits).alias(f"c{k}") for k in range(HASHES)]


def filter_of_repeats(rows: DataFrame, n_rows: int, bits: int) -> DataFrame:
    """(block, bits): the first pass, a Bloom filter of the cells that two or more rows set.

    Each batch of a partition sends the cells that it has set, once, or twice if several of its rows
    set them; the packed pieces are merged by ranges of cells. The rows themselves stay where they
    are. All cells of a repeated digest are set twice, so none is lost.
    """
    parts = min(bits // BLOCK_BITS, 1 << (max(shuffle_partitions(rows.sparkSession), n_rows * HASHES // GROUP_CELLS) - 1).bit_length())
    kind = np.uint32

    def own_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, n = np.unique(np.concatenate([c.to_numpy() for c in batch.columns]), return_counts=True)
            at = np.repeat(at, np.minimum(n, 2))
            yield dealt(at // (bits // parts), parts, at=at.astype(kind))

    def merged(t: pa.Table) -> pa.Table:
        at, n = np.unique(unpacked(t, "at", kind), return_counts=True)
        at = at[n > 1].astype(np.int64)
        blocks = np.unique(at // BLOCK_BITS)
        maps = np.zeros((len(blocks), BLOCK_BITS), bool)
        maps[np.searchsorted(blocks, at // BLOCK_BITS), at % BLOCK_BITS] = True
        packed = np.packbits(maps, axis=1, bitorder="little")
        # blocks are counted from 1, as Spark's bitmap functions do
        return pa.table({"block": blocks + 1, "bits": pa.array([x.tobytes() for x in packed], pa.binary())})

    pieces = rows.select(*cells(bits)).mapInArrow(own_cells, "part int, at binary")
    return pieces.groupBy("part").applyInArrow(merged, "block long, bits binary")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits_per_row: int = BITS_PER_ROW) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z only; null counts as empty. Of equal
    texts the row with the largest id stays. The second pass tests each row against the filter of the
    first: rows with a cell that is set once pass straight through, the others shuffle and are grouped by
    their whole digest. False positives only cost a shuffled row. Rows that repeat an id are rows of
    their own: if they have the text of the id that stays, all of them stay, as in OP8_SQL. A row without an id
    stays only if all rows of its text have none. An empty
    table gives no rows; other columns are ignored.
    """
    rows = saved(digests(docs, id_col, text_col))
    n_rows = rows.count()
    bits = bits_for(n_rows, bits_per_row)
    blocks = saved(filter_of_repeats(rows, n_rows, bits))  # at most MAX_BITS / 8 bytes
    tested = rows.withColumn("all_set", F.lit(True))
    for cell in cells(bits):
        tested = maybe_in(tested, cell + 1, blocks).withColumn("all_set", F.col("all_set") & F.col("_maybe")).drop("_maybe")
    single = tested.where("NOT all_set").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256"
    )
    maybe = saved(tested.where("all_set").drop("all_set"))
    groups = saved(maybe.groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"), F.count("*").alias("rows")))
    grouped = join_unique(maybe, groups, "text_sha256", "rows", maybe.count())
    return single.unionByName(
        grouped.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
    )


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


OP8_SQL = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""
