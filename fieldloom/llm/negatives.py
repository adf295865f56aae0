"""Hard negatives by a vertical scan: blocks of columns, read in each anchor's order of largest components."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import saved, shuffle_partitions, table

POSITIVES, NEGATIVES = 5, 10
#: A negative's score lies within these percentages of its positive's.
LOW, HIGH = 30, 90
#: A component x counts as floor(SCALE * x).
SCALE = 256
#: Components of a block of rows, about, at most: 32 MB as doubles. A block has at least MIN_ROWS rows where there are so many.
BLOCK_VALUES, MIN_ROWS = 1 << 22, 2048
#: Anchors of a chunk, about, at most; a tile is a block and a chunk.
CHUNK_ROWS = 2048
#: Dimensions that are added between two looks at the bounds.
STEP = 8
MAX_LONG = (1 << 63) - 1

ROWS = "dim int, part int, ids binary, labels binary, kind string, columns binary"
WINDOWS = ", starts binary, positives binary, scores binary"


def whole(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) of doubles: as float64 where that is exact, else as Python's integers."""
    with np.errstate(over="ignore"):
        y = np.floor(x * scale)
    if np.abs(y).max(initial=0) < 1 << 53:
        return y
    return np.array([math.floor(v * scale) if abs(v) < 1e300 else int(v) * scale for v in x.ravel()], object).reshape(x.shape)


def packed(key: tuple, t: pa.Table, part: int) -> tuple[pa.RecordBatch, np.ndarray]:
    """A block as one row, its vectors sorted by label and id, column after column; and which rows of ``t`` these are.

    Of rows that repeat an id one stays, the one with the smallest label and then the smallest vector.
    """
    ids, labels = t["vec_id"].to_numpy(), t["label"].to_numpy()
    x = t["embedding"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
    order = np.lexsort((labels, ids))
    first = np.flatnonzero(np.diff(ids[order], prepend=ids[order[0]] - 1))
    for a, b in zip(first, np.append(first[1:], len(ids))):
        if b - a > 1:
            order[a] = min(order[a:b], key=lambda k: (labels[k], tuple(x[k])))
    rows = order[first]
    rows = rows[np.lexsort((ids[rows], labels[rows]))]
    with np.errstate(over="ignore"):
        kind = "f4" if (x == x.astype(np.float32)).all() else "f8"
    columns = np.ascontiguousarray(x[rows].T.astype(kind))
    values = [key[0].as_py(), part, ids[rows].astype(np.int64).tobytes(), labels[rows].astype(np.int64).tobytes(), kind, columns.tobytes()]
    return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.string(), pa.binary()))], ["dim", "part", "ids", "labels", "kind", "columns"]), rows


class Block:
    """Rows of a packed block: ids, labels, and whole components with each dimension's extremes."""

    def __init__(self, t: pa.Table, scale: int):
        at = lambda name, kind: np.frombuffer(t[name][0].as_buffer(), kind)
        self.ids, self.labels = at("ids", np.int64), at("labels", np.int64)
        self.x = whole(at("columns", t["kind"][0].as_py()).astype(np.float64).reshape(-1, len(self.ids)), scale)
        self.low, self.high = self.x.min(axis=1), self.x.max(axis=1)
        if "starts" in t.column_names:
            self.starts, self.positives, self.scores = at("starts", np.int64), at("positives", np.int64), at("scores", np.int64)

    def largest(self) -> list[int]:
        return [int(max(abs(a), abs(b))) for a, b in zip(self.low, self.high)]


def exact_kind(a: Block, b: Block) -> type:
    """A type that holds every inner product, and every part of one, of two blocks exactly; both are made ready for it."""
    if 2 * sum(p * q for p, q in zip(a.largest(), b.largest())) < 1 << 53:
        return np.float64
    for block in (a, b):
        block.x, block.low, block.high = (np.array([int(v) for v in x.ravel()], object).reshape(x.shape) for x in (block.x, block.low, block.high))
    return object


class Scan:
    """The scan of a block for one anchor: partial products of the rows still in the bitmap, and what may yet come."""

    def __init__(self, rows: Block, q: np.ndarray, kind: type):
        self.q, self.x = q, rows.x
        self.order = np.array(sorted(range(len(q)), key=lambda d: -abs(q[d])))
        a, b = q * rows.low, q * rows.high
        # what the dimensions from a step on can add, at most and at least
        behind = lambda v: np.concatenate((np.cumsum(v[self.order][::-1])[::-1], np.zeros(1, v.dtype)))
        self.most, self.least = behind(np.maximum(a, b)), behind(np.minimum(a, b))
        self.kind = kind

    def run(self, alive: np.ndarray, keep) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) of the rows of the bitmap ``alive`` that ``keep(lower, upper)`` keeps, step after step."""
        at = np.flatnonzero(alive)
        part = np.zeros(len(at), self.kind)
        for k in range(0, len(self.order), STEP):
            if not len(at):
                break
            dims = self.order[k : k + STEP]
            x = self.x[dims]
            part = part + self.q[dims] @ (x if len(at) == x.shape[1] else x[:, at])
            end = min(k + STEP, len(self.order))
            kept = keep(part + self.least[end], part + self.most[end])
            at, part = at[kept], part[kept]
        return at, part


def kth_largest(x: np.ndarray, k: int):
    if len(x) < k:
        return None
    return np.sort(x)[len(x) - k] if x.dtype == object else np.partition(x, len(x) - k)[len(x) - k]


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best scores, ties by the smaller id."""
    if scores.dtype == object:
        return np.array(sorted(range(len(ids)), key=lambda j: (-scores[j], ids[j]))[:k], np.int64)
    return np.lexsort((ids, -scores))[:k]


def as_longs(x: np.ndarray) -> np.ndarray:
    return np.array([min(max(int(v), -MAX_LONG), MAX_LONG) for v in x], np.int64)


def positives_in(rows: Block, anchors: Block, k: int) -> Iterator[tuple]:
    """(anchor, row, score): each anchor's ``k`` best other rows of its label in the block."""
    kind = exact_kind(rows, anchors)
    for i, (own, label) in enumerate(zip(anchors.ids, anchors.labels)):
        alive = (rows.labels == label) & (rows.ids != own)

        def keep(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
            floor = kth_largest(lower, k)
            return np.ones(len(lower), bool) if floor is None else upper >= floor

        at, scores = Scan(rows, anchors.x[:, i], kind).run(alive, keep)
        for j in best(rows.ids[at], scores, k):
            yield own, rows.ids[at[j]], scores[j]


def negatives_in(rows: Block, anchors: Block, k: int, low: int, high: int) -> Iterator[tuple]:
    """(anchor, positive, row, positive's score, score): the ``k`` best rows of other labels in each positive's window."""
    kind = exact_kind(rows, anchors)
    for i, (own, label) in enumerate(zip(anchors.ids, anchors.labels)):
        mine = slice(anchors.starts[i], anchors.starts[i + 1])
        # low * p <= 100 * n <= high * p in whole numbers
        windows = [(int(p), -(-low * int(s) // 100), high * int(s) // 100, int(s)) for p, s in zip(anchors.positives[mine], anchors.scores[mine])]
        open_ = [w for w in windows if w[1] <= w[2]]

        def keep(lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
            out = np.zeros(len(lower), bool)
            for _, first, last, _ in open_:
                sure = kth_largest(lower[(lower >= first) & (upper <= last)], k)
                out |= (upper >= (first if sure is None else sure)) & (lower <= last)
            return out

        at, scores = Scan(rows, anchors.x[:, i], kind).run(rows.labels != label, keep) if open_ else (np.zeros(0, np.int64),) * 2
        for p, first, last, s in open_:
            there = np.flatnonzero((scores >= first) & (scores <= last))
            for j in there[best(rows.ids[at[there]], scores[there], k)]:
                yield own, p, rows.ids[at[j]], s, scores[j]


def usable_vector(vector: str) -> Column:
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce(~bad & (F.size(vector) > 0), F.lit(False))


def hard_negatives(
    vectors: DataFrame, anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, scale: int = SCALE, block_values: int = BLOCK_VALUES, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors``: vec_id, label, embedding; ``anchor`` tells the rows that are anchors. A row's score is the
    inner product of floor(scale * x) of its components with the anchor's. An anchor's positives are its best
    ``positives`` other rows of its label; for each of them come the best ``negatives`` rows of other labels whose
    score lies within ``low`` and ``high`` percent of the positive's. Ties go by the smaller id.

    Rows lie in blocks of columns, anchors in chunks, and each block meets each chunk in one task. A task reads
    the dimensions in the order of the anchor's components and drops from the bitmap of candidates whatever the
    extremes of the dimensions still to come rule out; a window is resolved exactly when none are left.
    All decisions are exact at any size of the components; scores beyond a long are given as the largest long.

    Rows with a null id or label, a null or empty vector, or a null or non-finite component take no part. Vectors of
    different lengths are not compared. Of rows that repeat an id, the one with the smallest label and then the
    smallest vector counts. An empty table gives no rows; other columns are ignored. The tiles grow with rows times anchors.
    """
    parts = shuffle_partitions(vectors.sparkSession)
    good = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable_vector("embedding"))
    rows = saved(good.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"), F.size("embedding").alias("dim"), anchor.alias("anchor")))
    n, n_anchors, dim = rows.agg(F.count("*"), F.count_if("anchor"), F.max("dim")).first()
    dim = dim or 1
    n_blocks = max(1, -(-n * dim // block_values), min(-(-n // MIN_ROWS), 2 * parts))
    n_chunks = max(1, -(-n_anchors * dim // block_values), -(-n_anchors // chunk_rows))

    part_of = lambda k: F.pmod(F.xxhash64("vec_id"), F.lit(k)).cast("int").alias("part")
    keyed = lambda df, k, *more: df.select("dim", part_of(k), "vec_id", "label", "embedding", *more).groupBy("dim", "part")

    def block(key: tuple, t: pa.Table) -> pa.Table:
        return pa.Table.from_batches([packed(key, t, key[1].as_py())[0]])

    def block_with_windows(key: tuple, t: pa.Table) -> pa.Table:
        out, kept = packed(key, t, key[1].as_py())
        t = t.take(kept)
        lists = t["positives"].combine_chunks()
        starts = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy())))
        flat = lists.flatten()
        own = [starts, flat.field("id").to_numpy(), flat.field("score").to_numpy()]
        return pa.Table.from_batches([pa.RecordBatch.from_arrays([*out.columns, *[pa.array([x.astype(np.int64).tobytes()], pa.binary()) for x in own]], [*out.schema.names, "starts", "positives", "scores"])])

    blocks = saved(keyed(rows, n_blocks).applyInArrow(block, ROWS))

    def tiles(chunks: DataFrame, f, schema: str) -> DataFrame:
        names = [x.split()[0] for x in schema.split(", ")]

        def meet(_: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
            found = list(f(Block(left, scale), Block(right, scale))) if left.num_rows and right.num_rows else []
            columns = [as_longs(c) for c in zip(*found)] if found else [np.zeros(0, np.int64) for _ in names]
            return pa.table(dict(zip(names, columns)))

        every = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
        a = blocks.withColumnRenamed("part", "block").withColumn("chunk", every(n_chunks)).groupBy("dim", "block", "chunk")
        b = chunks.withColumnRenamed("part", "chunk").withColumn("block", every(n_blocks)).groupBy("dim", "block", "chunk")
        return a.cogroup(b).applyInArrow(meet, schema)

    def ranked(df: DataFrame, keys: list[str], score: str, row: str, k: int) -> DataFrame:
        return df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(score), row))).where(F.col("rank") <= k)

    anchors = rows.where("anchor")
    chunks = saved(keyed(anchors, n_chunks).applyInArrow(block, ROWS))
    near = tiles(chunks, lambda a, b: positives_in(a, b, positives), "anchor_id long, id long, score long")
    near = saved(ranked(near, ["anchor_id"], "score", "id", positives))
    own = near.groupBy(F.col("anchor_id").alias("vec_id")).agg(F.collect_list(F.struct("id", "score")).alias("positives"))  # POSITIVES entries at most
    chunks = saved(keyed(anchors.join(own, "vec_id"), n_chunks, "positives").applyInArrow(block_with_windows, ROWS + WINDOWS))
    found = tiles(chunks, lambda a, b: negatives_in(a, b, negatives, low, high), "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long")
    out = ranked(found, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives)
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.select("vec_id", label.alias("label"), "embedding"), F.col("vec_id") % 100 == 0)


OP13_SQL = """
WITH v AS (SELECT CAST(vec_id AS BIGINT) AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
           FROM embeddings WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT a.id AS anchor_id, a.label = b.label AS same, b.id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
      FROM v a JOIN v b ON a.id <> b.id WHERE a.id % 100 = 0),
pos AS (SELECT * FROM p WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (SELECT pos.anchor_id, pos.id AS positive_id, p.id AS negative_id, pos.score AS positive_score, p.score AS negative_score
      FROM pos JOIN p ON pos.anchor_id = p.anchor_id AND NOT p.same AND 30 * pos.score <= 100 * p.score AND 100 * p.score <= 90 * pos.score)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY negative_score DESC, negative_id) AS INT) AS rank,
       negative_id, positive_score, negative_score FROM n
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY negative_score DESC, negative_id) <= 10
"""
