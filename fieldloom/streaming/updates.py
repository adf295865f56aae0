"""Streams of changed rows and of new files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import id_from_name
from ..operators.changes import status_events
from ..operators.inventory import reusable_rows
from ..operators.ranking import dedupe
from ..sources.tables import ended_folders, publish_partition, remove_folder

#: Batches whose rows are read besides the last base, at most; after so many a new base is written.
COMPACT_EVERY = 16
BUCKETS = 64


def newest_rows(df: DataFrame, key: str, order: str) -> DataFrame:
    """The row of each key with the largest ``order``; ties fall to the largest of the other columns, so no order of arrival matters."""
    return dedupe(df, [key], [F.desc_nulls_last(order), *[F.desc_nulls_last(c) for c in sorted(df.columns) if c not in (key, order)]])


def bucket_of(key: str, buckets: int):
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def read_upserted(spark: SparkSession, target: str, schema: T.StructType, key: str, order: str, before: int | None = None, ids: DataFrame | None = None, buckets: int = BUCKETS) -> DataFrame:
    """The newest row of each key in a log of stream_upsert(), as of the batches below ``before`` if that is given.

    The log is the last base and the deltas behind it. ``ids``: a table of keys; only their rows come back,
    and of the base only the buckets of those are read.
    """
    whole = lambda kind: [n for n in ended_folders(spark, target, kind) if before is None or n < before]
    base = max(whole("base-"), default=None)
    parts = [spark.read.schema(schema).parquet(f"{target}/delta-{n}") for n in whole("delta-") if base is None or n > base]
    if base is not None:
        old = spark.read.schema(T.StructType([*schema.fields, T.StructField("_bucket", T.IntegerType())])).parquet(f"{target}/base-{base}")
        if ids is not None:
            touched = [r[0] for r in ids.select(bucket_of(key, buckets)).distinct().collect()]  # ``buckets`` at most
            old = old.where(F.col("_bucket").isin(touched))
        parts.append(old.drop("_bucket"))
    if ids is not None:
        parts = [p.join(ids.select(key), key, "left_semi").select(*schema.names) for p in parts]
    out = spark.createDataFrame([], schema)
    for p in parts:  # COMPACT_EVERY and a base at most
        out = out.unionByName(p)
    return newest_rows(out, key, order)


def fold_batch(batch: DataFrame, number: int, target: str, key: str, order: str, buckets: int = BUCKETS, compact_every: int = COMPACT_EVERY, events: str | None = None, fields: list[str] = []) -> None:
    """Add a batch to the log: its newest rows as a delta, and after ``compact_every`` batches all rows as a new base.

    A batch that is folded again writes the same folders again. A new base leaves the one before it and the
    deltas between both, so that a batch which is repeated, and readers that have begun, find what they need; all
    that is older is removed. So the log has two states of the table and 2 * ``compact_every`` deltas at most.
    """
    spark, schema = batch.sparkSession, batch.schema
    delta = f"{target}/delta-{number}"
    newest_rows(batch, key, order).write.mode("overwrite").parquet(delta)
    if events:
        new = spark.read.schema(schema).parquet(delta)
        old = read_upserted(spark, target, schema, key, order, number, new, buckets)
        now = newest_rows(old.unionByName(new), key, order)
        publish_partition(status_events(old, now, key, fields).withColumn("batch", F.lit(number)), events, "batch")
    bases = [n for n in ended_folders(spark, target, "base-") if n < number]
    last = max(bases, default=-1)
    if number - last < compact_every:
        return
    state = read_upserted(spark, target, schema, key, order, number + 1, buckets=buckets).withColumn("_bucket", bucket_of(key, buckets))
    state.repartition(buckets, "_bucket").write.mode("overwrite").partitionBy("_bucket").parquet(f"{target}/base-{number}")
    for kind in ("base-", "delta-"):
        for n in ended_folders(spark, target, kind):
            if n < last or (kind == "delta-" and n == last):
                remove_folder(spark, f"{target}/{kind}{n}")


def stream_upsert(
    spark: SparkSession, source: str, schema: T.StructType, target: str, checkpoint: str, key: str, order: str, buckets: int = BUCKETS, events: str | None = None, fields: list[str] = [], files_per_batch: int = 1000, compact_every: int = COMPACT_EVERY
) -> None:
    """Fold a folder's new files into a target table; the row of each key with the largest ``order`` wins, whenever it comes.

    A batch costs what it brings: it is written as a delta and does not read the table, unless ``events``, a path
    for the changes of ``fields``, one partition a batch, asks for the former rows of its keys. A late row
    changes nothing and makes no event. read_upserted() gives the table.
    """
    fold = lambda batch, number: fold_batch(batch, number, target, key, order, buckets, compact_every, events, fields)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def stream_new_files(spark: SparkSession, root: str, glob: str, out: str, checkpoint: str, id_pattern: str = r"^(\d+)", known: DataFrame | None = None, clean: str = "clean") -> None:
    """Inventory rows (id, name, path, size_bytes, modified) of files that have arrived since the last call, each once.

    ``known``: an earlier inventory with name, size_bytes, modified, the column ``clean`` and what was found out
    about each file. A file whose row there is clean and unchanged keeps those columns and is marked reused, so only the
    others need another look. Contents are never read: the column is not among those selected.
    """
    files = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", glob).load(root)
    name = F.element_at(F.split("path", "/"), -1)
    rows = files.select(id_from_name(name, id_pattern).alias("id"), name.alias("name"), "path", F.col("length").alias("size_bytes"), F.col("modificationTime").alias("modified"))

    def add(batch: DataFrame, number: int) -> None:
        if known is not None:
            more = [c for c in known.columns if c not in batch.columns]
            old = reusable_rows(batch.select("name", "size_bytes", "modified"), known, "name", ["size_bytes", "modified"], clean).select("name", F.lit(True).alias("reused"))
            batch = batch.join(old.dropDuplicates(["name"]), "name", "left").withColumn("reused", F.coalesce("reused", F.lit(False)))
            found = known.where(F.col(clean)).dropDuplicates(["name"]).select("name", *more)
            batch = batch.join(found, "name", "left").select(*rows.columns, "reused", *[F.when(F.col("reused"), F.col(c)).alias(c) for c in more])
        publish_partition(batch.withColumn("batch", F.lit(number)), out, "batch")

    rows.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
