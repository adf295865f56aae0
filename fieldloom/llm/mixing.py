"""Mixing sources to target weights by whole repeats and one hash-seeded Bernoulli copy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import saved, table

#: Weights of the sources in code point order, repeated as often as needed.
WEIGHTS = (5, 2, 1)
#: Share of all sizes that the sources take together.
SHARE = 1.5
#: No target is above this many times its source's size.
LIMIT = 2
SEED = "mix"
#: Draws of each source; the one that comes nearest to its target counts.
DRAWS = 16
#: Source statistics of up to this many sources are broadcast; more are joined by shuffle.
MAX_BROADCAST_SOURCES = 100_000


def word_count(text):
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, limit: int = LIMIT) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row per source.

    A source takes the share of its weight unless that is above ``limit`` times its size; then
    it takes the limit and the rest is shared again. Sources fill up in the order of
    limit * size / weight, so one pass over the sources in that order finds all that are full.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.row_number().over(order) - 1) % len(weights) + 1)
    s = sizes.withColumn("weight", w).withColumn("cap", F.col("source_size") * limit)
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, whole = fill.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    s = (
        s.withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("weight_from", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("wanted", F.sum("source_size").over(whole) * F.lit(float(share)))
        .withColumn("level", (F.col("wanted") - F.col("cap_before")) / F.col("weight_from"))
        .withColumn("full", F.col("weight") * F.col("level") >= F.col("cap"))
        .withColumn("open_level", F.min(F.when(~F.col("full"), F.struct(F.col("cap") / F.col("weight"), "level"))).over(whole)["level"])
    )
    return s.select("source", "source_size", F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.col("weight") * F.coalesce("open_level", F.lit(0.0))).alias("target"))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS, share: float = SHARE, limit: int = LIMIT, seed: str = SEED) -> DataFrame:
    """``docs`` with size, source_size, target and copies, the number of times the mix emits the row.

    The rate of a source is target / source_size; a document comes floor(rate) times, plus once
    more if a number made from a hash of the seed and its id is below the fraction. Of DRAWS such seeds each source has
    the one whose words come nearest to its target, the first of equals, so that few documents do not miss it by chance.
    Null texts have size 0, a null source is a source of its own, and one without words takes nothing.
    Clashing column names are overwritten. Rows that repeat an id decide alike.
    """
    own = saved(docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("_from"), word_count(F.col(text_col)).alias("_n")))
    sizes = saved(own.groupBy(F.col("_from").alias("source")).agg(F.sum("_n").alias("source_size")))
    few = sizes.count() <= MAX_BROADCAST_SOURCES
    rates = saved(source_targets(sizes, weights, share, limit).select(F.col("source").alias("_source"), F.col("source_size").alias("_size"), F.col("target").alias("_target")))
    rate = F.when(F.col("_size") > 0, F.col("_target") / F.col("_size")).otherwise(0.0)

    def copies(name: str, draw) -> Column:
        hashed = F.md5(F.concat(F.lit(f"{seed}-"), draw.cast("string"), F.lit(":"), F.col(name).cast("string")))
        drawn = F.coalesce(F.conv(F.substring(hashed, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52)), F.lit(0.5))
        return (F.floor(rate) + F.when(drawn < rate - F.floor(rate), 1).otherwise(0)).cast("long")

    met = own.join(F.broadcast(rates) if few else rates, F.col("_from").eqNullSafe(F.col("_source")))
    taken = met.groupBy("_source", "_size", "_target").agg(*[F.sum(F.col("_n") * copies("_id", F.lit(k))).alias(f"_t{k}") for k in range(1, DRAWS + 1)])
    nearest = F.array_min(F.array(*[F.struct(F.abs(F.col(f"_t{k}") - F.col("_target")).alias("miss"), F.lit(k).alias("draw")) for k in range(1, DRAWS + 1)]))
    rates = saved(taken.select("_source", "_size", "_target", nearest["draw"].alias("_draw")))
    sized = docs.withColumn("size", word_count(F.col(text_col)))
    joined = sized.join(F.broadcast(rates) if few else rates, F.col(source_col).eqNullSafe(F.col("_source")))
    out = joined.withColumn("source_size", F.col("_size")).withColumn("target", F.col("_target")).withColumn("copies", copies(id_col, F.col("_draw")))
    return out.drop("_source", "_size", "_target", "_draw")


def emit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as the mix takes it, with its own columns, whatever their names.

    Null texts and sources are taken as in mixed(), repeated rows each by itself; an empty table gives no rows.
    """
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(source_col).alias("source"))
    out = mixed(packed, **options).where("copies > 0")
    return out.select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))).select("row.*")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixed(docs).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


MIX_SQL = """
WITH d AS (
  SELECT *, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size FROM {docs}),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM d GROUP BY source),
c AS (
  SELECT *, source_size * 2 AS cap,
         coalesce(sum(source_size * 2) OVER b, 0) AS cap_before,
         sum(weight) OVER () - coalesce(sum(weight) OVER b, 0) AS weight_from,
         CAST(sum(source_size) OVER () AS DOUBLE) * 1.5 AS wanted
  FROM s WINDOW b AS (ORDER BY CAST(source_size * 2 AS DOUBLE) / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT *, (wanted - cap_before) / weight_from AS level, weight * ((wanted - cap_before) / weight_from) >= cap AS is_full FROM c),
o AS (SELECT level AS open_level FROM l WHERE NOT is_full ORDER BY CAST(cap AS DOUBLE) / weight, source NULLS LAST LIMIT 1),
r AS (
  SELECT source, source_size, CASE WHEN is_full THEN CAST(cap AS DOUBLE) ELSE weight * coalesce((SELECT open_level FROM o), 0.0) END AS target
  FROM l),
m AS (
  SELECT d.*, r.source_size, r.target, CASE WHEN r.source_size > 0 THEN r.target / r.source_size ELSE 0.0 END AS rate
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source),
q AS (SELECT m.*, k, CAST(CAST('0x' || substr(md5('mix-' || CAST(k AS VARCHAR) || ':' || CAST(doc_id AS VARCHAR)), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0 AS drawn
      FROM m CROSS JOIN (SELECT unnest(range(1, 17)) AS k) AS ks),
p AS (SELECT *, CAST(floor(rate) AS BIGINT) + CASE WHEN drawn < rate - floor(rate) THEN 1 ELSE 0 END AS copies FROM q),
w AS (SELECT source, k AS draw FROM p GROUP BY source, k, target QUALIFY row_number() OVER (PARTITION BY source ORDER BY abs(sum(size * copies) - target), k) = 1),
n AS (SELECT p.* FROM p JOIN w ON p.source IS NOT DISTINCT FROM w.source AND k = draw)
"""

OP6_SQL = MIX_SQL.format(docs="documents") + "SELECT doc_id, size, source_size, target, size * copies AS taken FROM n"
