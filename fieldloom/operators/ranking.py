"""Top-k decisions with a total order, so ties always fall the same way."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rank_in(df: DataFrame, keys: list[str], order: list[Column], out: str = "rank") -> DataFrame:
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def top_k(df: DataFrame, keys: list[str], order: list[Column], k: int, out: str = "rank") -> DataFrame:
    """At most k rows of each group; all of them if k is 0 or less."""
    ranked = rank_in(df, keys, order, out)
    return ranked.where(F.col(out) <= k) if k > 0 else ranked


def dedupe(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return top_k(df, keys, order, 1, "_rn").drop("_rn")


def share_of_total(counts: DataFrame, n: str, out: str = "share") -> DataFrame:
    total = counts.agg(F.sum(n).alias("_total"))
    return counts.crossJoin(F.broadcast(total)).withColumn(out, F.col(n) / F.col("_total")).drop("_total")


def top2_across(df: DataFrame, columns: list[str]) -> DataFrame:
    """The largest and second largest of several columns of a row."""
    ordered = F.sort_array(F.array(*[F.coalesce(F.col(c), F.lit(0)) for c in columns]), asc=False)
    return df.withColumn("top", F.element_at(ordered, 1)).withColumn("second", F.element_at(ordered, 2)).withColumn("delta", F.col("top") - F.col("second"))


def value_counts(df: DataFrame, column: str, k: int) -> DataFrame:
    value = F.coalesce(F.col(column).cast("string"), F.lit("missing")).alias("value")
    return df.groupBy(value).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(k)


def sample_examples(df: DataFrame, group: str, order: str, n: int) -> DataFrame:
    """The first ``n`` rows of each group."""
    return top_k(df, [group], [F.asc(order)], n, "_rn").drop("_rn")


def sort_numeric_id(df: DataFrame, key: str) -> DataFrame:
    """Rows by the number that an id stands for; ids that are not numbers come last, by name. For the final write only."""
    return df.orderBy(F.col(key).try_cast("bigint").asc_nulls_last(), F.asc(key))
