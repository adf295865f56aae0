"""Near-duplicate vectors: int8 tile products with error bounds, and full precision for what may be above the threshold."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import connected_components, join_unique, merge_labels, saved, table

THRESHOLD = 0.95
#: Vectors of a block, in expectation at most; a tile compares two blocks.
BLOCK_ROWS = 4000
#: Pivots, at most; they are picked from a hash-ordered sample and only decide which tiles can be left out.
MAX_PIVOTS = 128
#: Rows of a tile that are multiplied at a time, and pairs that are computed in full precision at a time.
STRIP, PAIRS = 512, 50_000
#: Slack for rounding in the bounds and angles.
SLACK = 1e-6


def unit(x: np.ndarray) -> np.ndarray:
    """Vectors of length 1. The largest component is made 1 first, so that squares neither overflow nor vanish."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


class Quantised:
    """Unit vectors as int8 numbers with a scale each, and a bound of what that loses.

    With x = s q + e, two vectors' product differs from s s' q.q' by at most
    |e| (1 + |e'|) + |e'| (1 + |e|) + |e| |e'|, as |s q| <= 1 + |e|.
    """

    def __init__(self, x: np.ndarray):
        self.scale = np.abs(x).max(axis=1) / 127
        q = np.rint(x / self.scale[:, None])
        self.error = np.linalg.norm(x - q * self.scale[:, None], axis=1)
        # float32 holds the int8 products' sums exactly below 2^24
        self.q = q.astype(np.float32 if 127 * 127 * x.shape[1] < 1 << 24 else np.float64)

    def upper(self, rows: slice, other: Quantised) -> np.ndarray:
        """An upper bound of the products of these rows with all of the other's."""
        product = self.q[rows] @ other.q.T
        product *= self.scale[rows, None].astype(product.dtype)
        product *= other.scale[None, :].astype(product.dtype)
        e, f = self.error[rows, None], other.error[None, :]
        product += (e + f + 3 * e * f + SLACK).astype(product.dtype)
        return product


def linked(x: np.ndarray, y: np.ndarray, threshold: float):
    """Pairs (row of x, row of y) with a product of at least the threshold, a strip of rows at a time."""
    a, b = Quantised(x), Quantised(y)
    for at in range(0, len(x), STRIP):
        rows = slice(at, min(at + STRIP, len(x)))
        i, j = np.nonzero(a.upper(rows, b) >= threshold)
        i += at
        for k in range(0, len(i), PAIRS):
            a_rows, b_rows = i[k : k + PAIRS], j[k : k + PAIRS]
            near = np.einsum("ij,ij->i", x[a_rows], y[b_rows]) >= threshold
            yield a_rows[near], b_rows[near]


def compare_tile(tile: pa.Table, threshold: float) -> pa.Table:
    """Links between the two blocks of a tile, or within its one block: per vector the copies it links to, and its tile label."""
    vec, size, side = (tile[c].to_numpy() for c in ("vec_id", "size", "side"))
    x = unit(tile["embedding"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vec), -1))
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    alone = not len(right)
    other = left if alone else right
    links, label = np.zeros(len(vec), np.int64), np.arange(len(vec))
    if len(left) and len(other):
        for i, j in linked(x[left], x[other], threshold):
            i, j = left[i], other[j]
            if alone:
                i, j = i[i != j], j[i != j]
            links += np.bincount(i, weights=size[j], minlength=len(vec)).astype(np.int64)
            if not alone:
                links += np.bincount(j, weights=size[i], minlength=len(vec)).astype(np.int64)
            merge_labels(label, i, j)
    some = np.flatnonzero(links > 0)
    return pa.table({"vec_id": vec[some], "links": links[some], "root": vec[label[some]]})


def usable(embedding: str):
    """Whether a vector can be compared: no null or non-finite component, and not all zero."""
    bad = F.exists(embedding, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return F.coalesce(~bad & F.exists(embedding, lambda v: v != 0), F.lit(False))


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, block_rows: int = BLOCK_ROWS, max_pivots: int = MAX_PIVOTS) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    Two vectors link when their cosine in double precision is at least ``threshold``. Equal
    vectors are compared once and counted as often as they come. All other pairs are compared
    in tiles of two blocks. A block holds vectors around one pivot; a tile is left out only if
    the angles between the pivots and to their farthest vectors rule out a link. A tile gives
    one row per linked vector, so groups of near copies stay linear in the output.
    Vectors that are null, empty, zero or hold null or non-finite components link with nothing,
    and vectors of different lengths do not link. An id stands for one vector; repeated rows count as copies.
    """
    spark = vectors.sparkSession
    all_rows = vectors.select("vec_id", "embedding", usable("embedding").alias("ok"))
    key = F.concat_ws(":", F.hex(F.xxhash64("embedding")), F.hex(F.xxhash64(F.lit(1), "embedding")))
    rows = saved(all_rows.where("ok").select("vec_id", "embedding", key.alias("key")))
    classes = saved(rows.groupBy("key").agg(F.min("vec_id").alias("rep"), F.count("*").alias("size"), F.first("embedding").alias("embedding")))
    n = classes.count()
    reps = classes.select(F.col("rep").alias("vec_id"), "size", "embedding", F.size("embedding").alias("dim"))

    n_pivots = max(1, min(max_pivots, n // block_rows))
    sample = reps.orderBy(F.xxhash64("vec_id")).limit(n_pivots).select("dim", "embedding").collect()
    pivots = {d: unit(np.array([r["embedding"] for r in sample if r["dim"] == d], float)) for d in {r["dim"] for r in sample}}

    def place(batches):
        for batch in batches:
            dim = batch["dim"].to_numpy()
            cell, angle = np.zeros(len(dim), np.int32), np.full(len(dim), np.pi)
            flat, cut = batch["embedding"].flatten().to_numpy(zero_copy_only=False).astype(np.float64), np.concatenate(([0], np.cumsum(dim)))
            for d in np.unique(dim):
                mine = np.flatnonzero(dim == d)
                if d in pivots:
                    x = unit(np.stack([flat[cut[k] : cut[k + 1]] for k in mine]))
                    product = x @ pivots[d].T
                    cell[mine] = product.argmax(axis=1)
                    angle[mine] = np.arccos(np.clip(product.max(axis=1), -1, 1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(angle)], [*batch.schema.names, "cell", "angle"])

    placed = saved(reps.mapInArrow(place, T.StructType([*reps.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("angle", T.DoubleType())])))
    # one row per length and pivot: bounded by max_pivots and the number of lengths
    cells = placed.groupBy("dim", "cell").agg(F.max("angle").alias("radius"), F.count("*").alias("n")).orderBy("dim", "cell").collect()
    reach = float(np.arccos(threshold)) + SLACK
    pairs = []
    for k, a in enumerate(cells):
        for b in cells[k:]:
            if a["dim"] == b["dim"]:
                p = pivots.get(a["dim"])
                between = 0.0 if a["cell"] == b["cell"] or p is None else float(np.arccos(np.clip(p[a["cell"]] @ p[b["cell"]], -1, 1)))
                if between <= a["radius"] + b["radius"] + reach:
                    pairs += [(a["dim"], a["cell"], b["cell"], True)] + [(a["dim"], b["cell"], a["cell"], False)] * (a["cell"] != b["cell"])
    blocks = {(c["dim"], c["cell"]): -(-c["n"] // block_rows) for c in cells}
    tiles = spark.createDataFrame(
        [(d, a, b, lower, blocks[d, a], blocks[d, b]) for d, a, b, lower in pairs], "dim int, cell int, other int, lower boolean, own_blocks int, other_blocks int"
    )
    # each vector goes to the tiles of its block: with every block of the other cells, and with its own cell's
    own = (F.pmod(F.xxhash64("vec_id"), F.col("own_blocks"))).cast("int")
    sent = placed.join(F.broadcast(tiles), ["dim", "cell"]).withColumn("own", own).withColumn("partner", F.explode(F.sequence(F.lit(0), F.col("other_blocks") - 1)))
    first = F.when(F.col("cell") == F.col("other"), F.col("own") <= F.col("partner")).otherwise(F.col("lower"))
    sent = sent.select(
        "vec_id", "size", "embedding", "dim",
        F.when(first, F.col("cell")).otherwise(F.col("other")).alias("a"), F.when(first, F.col("own")).otherwise(F.col("partner")).alias("a_block"),
        F.when(first, F.col("other")).otherwise(F.col("cell")).alias("b"), F.when(first, F.col("partner")).otherwise(F.col("own")).alias("b_block"),
        F.when(first, 0).otherwise(1).alias("side"),
    )
    keys = ["dim", "a", "a_block", "b", "b_block"]
    found = saved(sent.groupBy(*keys).applyInArrow(lambda t: compare_tile(t, threshold), "vec_id long, links long, root long"))
    joined = connected_components(found.select(F.col("vec_id").alias("a"), F.col("root").alias("b")))
    linked_reps = saved(
        found.groupBy("vec_id").agg(F.sum("links").alias("links"))
        .join(joined.withColumnRenamed("node", "vec_id"), "vec_id", "left")
    )
    known = saved(
        classes.select("key", "rep", "size").join(linked_reps.withColumnRenamed("vec_id", "rep"), "rep", "left")
        .select("key", (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "rep").alias("component_id"), "size")
    )
    good = join_unique(rows.select("vec_id", "key"), known, "key", "size", rows.count()).select("vec_id", "n_links", "component_id")
    bad = all_rows.where(~F.col("ok")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return good.unionByName(bad).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op5_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))

