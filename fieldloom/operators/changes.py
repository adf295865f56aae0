"""Change capture between two states of a keyed table, and keyed replacement."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import dedupe


def changed_ids(current: DataFrame, previous: DataFrame, key: str, fingerprint: str) -> DataFrame:
    """(key, change): new, changed or deleted ids."""
    c, p = current.select(key, F.col(fingerprint).alias("_c"), F.lit(True).alias("_in_c")), previous.select(key, F.col(fingerprint).alias("_p"), F.lit(True).alias("_in_p"))
    change = F.when(F.col("_in_p").isNull(), "new").when(F.col("_in_c").isNull(), "deleted").when(~F.col("_c").eqNullSafe(F.col("_p")), "changed")
    return c.join(p, key, "full_outer").select(key, change.alias("change")).where("change IS NOT NULL")


def upsert_by_id(existing: DataFrame, replacement: DataFrame, ids: DataFrame, key: str, order: list[Column] | None = None) -> DataFrame:
    """Rows of the given ids give way to the replacement's; all other rows stay.

    With ``order`` only the first row of each id in the replacement counts, the latest one say.
    """
    if order is not None:
        replacement = dedupe(replacement, [key], order)
    return existing.join(ids.select(key).distinct(), key, "left_anti").unionByName(replacement, allowMissingColumns=True)


def status_events(previous: DataFrame, current: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, field, previous, current) for added and deleted ids and every changed field; null equals empty."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    side = lambda df, name: df.select(key, F.lit(True).alias(f"_{name}"), *[text(f).alias(f"{name}_{f}") for f in fields])
    both = side(previous, "p").join(side(current, "c"), key, "full_outer")
    record = lambda f, a, b: F.struct(F.lit(f).alias("field"), a.alias("previous"), b.alias("current"))
    whole = F.when(F.col("_p").isNull(), F.array(record("record", F.lit(""), F.lit("added")))).when(F.col("_c").isNull(), F.array(record("record", F.lit("present"), F.lit("deleted"))))
    changed = F.filter(F.array(*[record(f, F.col(f"p_{f}"), F.col(f"c_{f}")) for f in fields]), lambda r: r["previous"] != r["current"])
    return both.select(key, F.explode(F.coalesce(whole, changed)).alias("r")).select(key, "r.*")


def affected_ids(reasons: list[tuple[DataFrame, str, str]], key: str) -> DataFrame:
    """(key, domain, reasons) from frames of ids with a domain and a reason each."""
    rows = reduce(DataFrame.unionByName, [df.select(key, F.lit(d).alias("domain"), F.lit(r).alias("reason")) for df, d, r in reasons])
    return rows.groupBy(key, "domain").agg(F.array_join(F.sort_array(F.collect_set("reason")), "|").alias("reasons"))


def id_union(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.select(key).union(b.select(key)).distinct()


def id_intersect(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.select(key).intersect(b.select(key))


def id_except(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.select(key).subtract(b.select(key))


def restrict_to_ids(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return df.join(ids.select(key), key, "left_semi")


def pending(work: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return work.join(done.select(key), key, "left_anti")


def preserve_columns(current: DataFrame, previous: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Carry columns over from the previous state where it has a value."""
    old = previous.select(key, *[F.col(c).alias(f"_old_{c}") for c in columns])
    out = current.join(old, key, "left")
    for c in columns:
        out = out.withColumn(c, F.coalesce(f"_old_{c}", c) if c in current.columns else F.col(f"_old_{c}"))
    return out.drop(*[f"_old_{c}" for c in columns])


def enrich_left(df: DataFrame, right: DataFrame, key: str, columns: list[str], order: list[Column]) -> DataFrame:
    """Left join with the right side's first row of each key."""
    return df.join(dedupe(right, [key], order).select(key, *columns), key, "left")


def compare_tables(a: DataFrame, b: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Keys that only one table has, or whose columns differ."""
    left, right = (df.select(key, F.lit(True).alias(f"_{n}"), *[F.col(c).alias(f"{n}_{c}") for c in columns]) for df, n in ((a, "a"), (b, "b")))
    differ = reduce(lambda x, y: x | y, [~F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}")) for c in columns])
    origin = F.when(F.col("_b").isNull(), "left_only").when(F.col("_a").isNull(), "right_only").when(differ, "differs")
    return left.join(right, key, "full_outer").select(key, origin.alias("origin")).where("origin IS NOT NULL")


def stack_variants(frames: dict[str, DataFrame], tag: str, primary: str) -> DataFrame:
    """Frames of one schema on top of each other with their name and whether it is the primary one."""
    tagged = [df.withColumn(tag, F.lit(name)).withColumn("is_primary", F.lit(name == primary)) for name, df in frames.items()]
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), tagged)


def id_reason_export(df: DataFrame, key: str, reason: str) -> DataFrame:
    return df.groupBy(key).agg(F.array_join(F.sort_array(F.collect_set(reason)), "|").alias("reasons"))
