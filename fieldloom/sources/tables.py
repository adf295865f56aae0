"""Reading and writing tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from ..functions.scalars import normalise_id
from .listing import FolderListing

#: Folders of a table in buckets.
BUCKETS = 64


def read_delimited(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file with header whose separator is ; if the header has more of those than commas; all columns are text."""
    head = spark.read.text(path).limit(1).first()
    line = head[0].lstrip("﻿") if head else ""
    df = spark.read.csv(path, header=True, sep=";" if line.count(";") > line.count(",") else ",")
    return df.toDF(*[c.lstrip("﻿").strip() for c in df.columns])


def read_optional(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet table, or an empty one of the schema if there is none."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], schema)


def read_parts(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Part files of one table whose columns differ: the schema's columns, null where a part lacks one."""
    df = spark.read.option("mergeSchema", True).parquet(root)
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def read_ids(spark: SparkSession, path: str, aliases: tuple[str, ...] = ("recording_id", "id")) -> DataFrame:
    """(id): the distinct ids of a delimited list, from the first of the usual column names that it has."""
    df = harmonise_columns(read_delimited(spark, path), {"id": list(aliases)}, ["id"])
    return df.select(normalise_id(F.col("id")).alias("id")).where("id <> ''").distinct()


def list_files(spark: SparkSession, root: str, glob: str, id_pattern: str) -> DataFrame:
    """One row per file below ``root``: id from the name, path, size and time; contents are not read.

    Folders are listed by the executors, see listing.FolderListing.
    """
    spark.dataSource.register(FolderListing)
    files = spark.read.format("folder_listing").option("glob", glob).load(root)
    return files.select("name", F.regexp_extract("name", id_pattern, 1).alias("id"), "path", "size_bytes", "modified")


def read_json_docs(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.option("multiLine", True).option("recursiveFileLookup", True).json(root).withColumn("file", F.col("_metadata.file_path"))


def lookup_rows(df: DataFrame, ids: list | DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows of some ids: a short list goes into the scan as a filter, a table of ids is joined."""
    found = df.where(F.col(key).isin(ids)) if isinstance(ids, list) else df.join(ids.select(key).distinct(), key, "left_semi")
    return found.select(key, *columns)


def publish_buckets(df: DataFrame, path: str, key: str, buckets: int = BUCKETS) -> None:
    """Write a table in folders by a hash of its key, sorted by the key within each, for look_up_buckets()."""
    dealt = df.withColumn("_bucket", bucket_of(F.col(key), buckets)).repartition(buckets, "_bucket").sortWithinPartitions("_bucket", key)
    dealt.write.mode("overwrite").option("compression", "zstd").partitionBy("_bucket").parquet(path)


def look_up_buckets(spark: SparkSession, path: str, ids: DataFrame, key: str, columns: list[str], buckets: int = BUCKETS) -> DataFrame:
    """Rows of the ids of a table from publish_buckets(): only the folders of their hashes are read.

    Up to ``buckets`` ids also go into the scan, where the sorted files' statistics leave out all other row groups.
    """
    wanted = ids.select(key).distinct()
    touched = [r[0] for r in wanted.select(bucket_of(F.col(key), buckets)).distinct().collect()]  # ``buckets`` at most
    rows = spark.read.parquet(path).where(F.col("_bucket").isin(touched))
    few = [r[0] for r in wanted.limit(buckets + 1).collect()]
    rows = rows.where(F.col(key).isin(few)) if len(few) <= buckets else rows.join(wanted, key, "left_semi")
    return rows.select(key, *columns)


def bucket_of(key, buckets: int):
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def harmonise_columns(df: DataFrame, aliases: dict[str, list[str]], required: list[str]) -> DataFrame:
    """Columns by their usual names, whatever their case or alias; a missing required one is an error."""
    lower = {c.lower(): c for c in df.columns}
    found = {name: next((lower[a.lower()] for a in [name, *others] if a.lower() in lower), None) for name, others in aliases.items()}
    if missing := [c for c in required if not found.get(c)]:
        raise ValueError(f"missing columns: {missing}")
    renamed = {v: k for k, v in found.items() if v}
    return df.select(*[F.col(c).alias(renamed.get(c, c)) for c in df.columns])


def union_layers(layers: dict[tuple[str, str], DataFrame], required: list[str]) -> DataFrame:
    """Layers on top of each other with source_file and source_layer; those without the required columns are left out."""
    usable = {k: df for k, df in layers.items() if set(required) <= set(df.columns)}
    if not usable:
        raise ValueError(f"no layer has the columns {required}")
    tagged = [df.withColumn("source_file", F.lit(f)).withColumn("source_layer", F.lit(name)) for (f, name), df in usable.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def required_columns(df: DataFrame, columns: list[str]) -> list[str]:
    """The columns that are missing."""
    return [c for c in columns if c not in df.columns]


def schema_equal(a: DataFrame, b: DataFrame, ignore: tuple[str, ...] = ()) -> bool:
    """Whether two tables have the same columns of the same types, whatever their order."""
    kinds = lambda df: {f.name: f.dataType for f in df.schema if f.name not in ignore}
    return kinds(a) == kinds(b)


def concat_parts(parts: list[DataFrame], schema: T.StructType | None = None) -> DataFrame:
    """Parts of one table on top of each other; with a schema its columns come first and are filled."""
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return out if schema is None else align_to_schema(out, schema)


def align_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns first, missing ones with typed zeros, then the others."""
    zero = {T.StringType: "0", T.BooleanType: False, T.IntegerType: 0, T.LongType: 0, T.DoubleType: 0.0}
    own = [(F.col(f.name) if f.name in df.columns else F.lit(zero.get(type(f.dataType)))).cast(f.dataType).alias(f.name) for f in schema]
    return df.select(*own, *[c for c in df.columns if c not in schema.names])


def hadoop_folder(spark: SparkSession, path: str):
    """The file system of a path, and the path as Hadoop has it."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return root.getFileSystem(spark._jsc.hadoopConfiguration()), root


def ended_folders(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """The numbers n of the folders <prefix><n> below a path whose write has ended."""
    fs, root = hadoop_folder(spark, path)
    names = [x.getPath().getName() for x in fs.listStatus(root)] if fs.exists(root) else []
    whole = lambda n: n.startswith(prefix) and n[len(prefix) :].isdigit() and fs.exists(hadoop_folder(spark, f"{path}/{n}/_SUCCESS")[1])
    return sorted(int(n[len(prefix) :]) for n in names if whole(n))


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, root = hadoop_folder(spark, path)
    fs.delete(root, True)


def versions(spark: SparkSession, path: str) -> list[int]:
    """The whole versions v=<n> of a published table: those whose write has ended."""
    return ended_folders(spark, path, "v=")


def publish(df: DataFrame, path: str) -> int:
    """Write a table's next version, a folder v=<n> below ``path``; gives its number.

    Spark's marker of an ended write makes it the current one, so a job that fails leaves the old version.
    """
    n = next(iter(versions(df.sparkSession, path)[::-1]), -1) + 1
    df.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/v={n}")
    return n


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The current version of a table that publish() has written."""
    return spark.read.parquet(f"{path}/v={versions(spark, path)[-1]}")


def publish_partition(df: DataFrame, path: str, key: str) -> None:
    """Replace only the partitions that ``df`` has rows of."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(key).parquet(path)


def append_events(df: DataFrame, path: str, run_id: str) -> None:
    """Add a run's events; a run that is written again replaces its own."""
    publish_partition(df.withColumn("run_id", F.lit(run_id)), path, "run_id")


def summary_record(df: DataFrame, flags: list[str], counted: list[str] = []) -> DataFrame:
    """One JSON record: rows, how many have each flag, and how often each value of the counted columns comes."""
    one = df.agg(F.count("*").alias("rows"), *[F.count_if(F.col(f)).alias(f) for f in flags])
    for c in counted:
        n = df.groupBy(F.coalesce(F.col(c).cast("string"), F.lit("missing")).alias("v")).agg(F.count("*").alias("n"))
        one = one.crossJoin(n.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("v", "n")))).alias(f"{c}_counts")))
    return one.select(F.to_json(F.struct(*one.columns)).alias("summary"))
