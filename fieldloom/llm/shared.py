"""Building blocks the operators share: saved tables, hot-key joins, bitmaps, components."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A key is hot when it holds at least this share of the rows, so at most 1 / HOT_SHARE keys are.
HOT_SHARE = 1 / 500
#: ``bitmap_construct_agg`` makes blocks of this many bits.
BLOCK_BITS = 32768
#: Upper bound of a bitmap's size, and so of what a bitmap costs to broadcast (128 MB).
MAX_BITS = 1 << 30
#: Narrow rows of a file, at least, where saved() knows how many there are.
ROWS_PER_FILE = 20_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession) -> str:
    """A new path in the shared folder of ``spark.checkpoint.dir``, or in a local one in tests."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def saved(df: DataFrame, rows: int | None = None) -> DataFrame:
    """The rows of ``df`` as a written table: cuts lineage and survives lost executors.

    ``rows``: about how many there are at most, if known; few rows are then written as few files.
    """
    path = scratch_path(df.sparkSession)
    if rows is not None and (files := -(-rows // ROWS_PER_FILE)) < shuffle_partitions(df.sparkSession):
        df = df.coalesce(max(1, files))
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove saved() tables that nothing reads any more: all that was made of them must be saved itself."""
    for t in tables:
        path = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t.scratch_path)
        path.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def join_unique(left: DataFrame, right: DataFrame, key: str, count: str, total: int, how: str = "inner") -> DataFrame:
    """Join ``left`` to ``right``, a saved table whose ``key`` is unique and whose ``count`` says how many left rows it meets.

    Keys that hold at least HOT_SHARE of ``total`` rows go by broadcast: there are at most
    1 / HOT_SHARE of them, whatever the input's size. All others are shuffled, and no task
    then gets more than that share from one key. Null keys match nothing.
    """
    limit = max(2, int(total * HOT_SHARE))
    hot = hot_keys(right, key, count, limit)
    cold = right.where(F.col(count) < limit).drop(count)
    if not hot:
        return left.join(cold.hint("merge"), key, how)
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False))
    hot_rows = left.where(is_hot).join(F.broadcast(right.where(F.col(count) >= limit).drop(count)), key)
    return left.where(~is_hot).join(cold.hint("merge"), key, how).unionByName(hot_rows)


def hot_keys(counts: DataFrame, key: str, count: str, limit: int) -> list:
    """The keys that are met ``limit`` times or more: as many as all rows over ``limit``, at most."""
    return [r[0] for r in counts.where(F.col(count) >= limit).select(key).collect()]


def bits_for(rows: int, per_row: int) -> int:
    """A power of two of about ``per_row`` bits a row, within fixed bounds."""
    return min(MAX_BITS, max(1 << 20, 1 << int(max(1, rows * per_row) - 1).bit_length()))


def bitmap_blocks(df: DataFrame, cell: str) -> DataFrame:
    """One row for each block of BLOCK_BITS cells that occur: (block, bits)."""
    return df.groupBy(F.bitmap_bucket_number(F.col(cell)).alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(F.col(cell))).alias("bits")
    )


def bit_is_set(bits: str, cell: str):
    """Whether a cell's bit is set in its block; false without a block."""
    at = F.bitmap_bit_position(F.col(cell))
    byte = F.conv(F.hex(F.substring(F.col(bits), F.lit(1) + F.floor(at / 8).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))


def collect_bitmap(df: DataFrame, cell: str, bits: int) -> np.ndarray:
    """Cells 0 .. bits-1 as a byte array of bits / 8 bytes, at most MAX_BITS / 8."""
    out = np.zeros(bits // 8, dtype=np.uint8)
    # bitmap_bucket_number counts from 1 for the cells 1 .. BLOCK_BITS, so cells are moved up by one
    for batch in bitmap_blocks(df.select((F.col(cell) + 1).alias(cell)), cell).toArrow().to_batches():
        for block, bits_of in zip(batch["block"].to_pylist(), batch["bits"]):
            at = (block - 1) * BLOCK_BITS // 8
            part = np.frombuffer(bits_of.as_buffer(), dtype=np.uint8)[: len(out) - at]
            out[at : at + len(part)] |= part
    return out


def dealt(to: np.ndarray, parts: int, **columns: np.ndarray) -> pa.RecordBatch:
    """The columns dealt to ``parts`` parts by ``to``, packed into one row for each part that gets any."""
    order = np.argsort(to.astype(np.uint16 if parts <= 1 << 16 else np.int64), kind="stable")
    cut = np.searchsorted(to[order], np.arange(parts + 1))
    full = np.flatnonzero(np.diff(cut))
    packed = [pa.array([x[cut[b] : cut[b + 1]].tobytes() for b in full], pa.binary()) for x in (c[order] for c in columns.values())]
    return pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), *packed], ["part", *columns])


def unpacked(t: pa.Table, column: str, kind=np.uint64) -> np.ndarray:
    return np.frombuffer(b"".join(t[column].to_pylist()), kind)


def in_bitmap(bitmap: np.ndarray, cells: np.ndarray) -> np.ndarray:
    return (bitmap[cells >> np.uint64(3)] >> (cells & np.uint64(7)).astype(np.uint8)) & 1 == 1


def maybe_in(df: DataFrame, cell, blocks: DataFrame) -> DataFrame:
    """``df`` with ``_maybe``: whether the cell (from 1 on) is set in the bitmap of ``blocks``, which is bounded and broadcast."""
    tested = df.withColumn("_cell", cell).withColumn("block", F.bitmap_bucket_number("_cell")).join(F.broadcast(blocks), "block", "left")
    return tested.withColumn("_maybe", bit_is_set("bits", "_cell")).drop("block", "bits", "_cell")


def row_key(id_col: str = "doc_id", text_col: str = "text"):
    """What tells the rows of a table of documents apart: their id with two hashes of their text."""
    text = F.col(text_col)
    return F.concat_ws(":", F.col(id_col).cast("string"), F.hex(F.xxhash64(text)), F.hex(F.xxhash64(F.lit(1), text)))


def parted(df: DataFrame, marked: DataFrame, key, rows: int) -> tuple[DataFrame, DataFrame]:
    """The rows of ``df`` whose ``key`` is not in ``marked``, a table of one column, and those whose key is.

    A bitmap of hashed keys, bounded by MAX_BITS, tells which rows may be marked; only those shuffle,
    all others pass straight through. A null key is never marked. ``rows``: about how many rows ``df``
    has. Its columns may have any names.
    """
    bits = bits_for(rows, 64)
    cell = F.pmod(F.xxhash64("key"), F.lit(bits)) + 1
    marked = marked.toDF("key").where(F.col("key").isNotNull()).distinct()
    blocks = saved(bitmap_blocks(marked.select(cell.alias("_cell")), "_cell"))
    packed = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), (F.col(key) if isinstance(key, str) else key).alias("key"))
    tested = maybe_in(packed, cell, blocks)
    passed, maybe = tested.where(~F.col("_maybe")).select("row.*"), tested.where("_maybe").select("row", "key")
    return passed.unionByName(maybe.join(marked.hint("merge"), "key", "left_anti").select("row.*")), maybe.join(marked.hint("merge"), "key", "left_semi").select("row.*")


def without(df: DataFrame, dropped: DataFrame, key, rows: int) -> DataFrame:
    """The rows of ``df`` whose ``key`` is not in ``dropped``, see parted()."""
    return parted(df, dropped, key, rows)[0]


def merge_labels(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Give both ends of each link the smaller label, until no link joins two labels."""
    while (apart := label[i] != label[j]).any():
        i, j = i[apart], j[apart]
        low, high = np.minimum(label[i], label[j]), np.maximum(label[i], label[j])
        to = np.arange(len(label))
        np.minimum.at(to, high, low)
        label[:] = to[label]


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): each node of the edge table with the smallest node it reaches.

    Alternates the large-star and small-star steps on saved tables until nothing changes, so
    each round costs two shuffles of a shrinking table. Hubs are aggregated before they
    shuffle, and join_unique keeps their edges spread.
    """
    edges = edges.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi")).where("lo < hi").distinct()
    now = saved(edges)
    n = now.count()
    if not n:
        return now.select(F.col("lo").alias("node"), F.col("hi").alias("component"))
    before = None
    while True:
        # large star: neighbours above a node move to the smallest node next to it
        both = now.select(F.col("lo").alias("n"), F.col("hi").alias("m")).unionByName(now.select(F.col("hi").alias("n"), F.col("lo").alias("m")))
        least = saved(both.groupBy("n").agg(F.least(F.min("m"), F.col("n")).alias("least"), F.count("*").alias("rows")), 2 * n)
        large = join_unique(both, least, "n", "rows", 2 * n).where("m > n").select(F.col("least").alias("lo"), F.col("m").alias("hi")).where("lo < hi").distinct()
        # small star: a node and its lower neighbours move to the smallest of them
        large = saved(large, n)
        lower = saved(large.groupBy("hi").agg(F.min("lo").alias("least"), F.count("*").alias("rows")), n)
        small = (
            join_unique(large, lower, "hi", "rows", n)
            .select(F.explode(F.array(F.struct(F.col("least").alias("lo"), F.col("lo").alias("hi")), F.struct(F.col("least").alias("lo"), F.col("hi")))).alias("e"))
            .select("e.lo", "e.hi").where("lo < hi").distinct()
        )
        last, now = now, saved(small, n)
        discard(last, least, large, lower)
        after = now.agg(F.count("*"), F.sum(F.xxhash64("lo", "hi").cast("decimal(20,0)"))).first()
        if after == before:
            return now.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(
                now.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
            )
        before, n = after, after[0]
