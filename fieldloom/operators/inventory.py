"""File inventories, scores and time-series quality as grouped aggregates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import coded, join_codes, split_issues, to_number, truthy


def issue_rollup(detail: DataFrame, key: str, issues: str, order: str, prefix: str = "") -> DataFrame:
    """Distinct issue tokens of each id, behind ``prefix``, in the order in which they come first."""
    tokens = detail.select(key, order, F.posexplode(split_issues(F.col(issues))).alias("pos", "token"))
    first = tokens.groupBy(key, "token").agg(F.min(F.struct(order, "pos")).alias("at"))
    sorted_ = F.transform(F.sort_array(F.collect_list(F.struct("at", "token"))), lambda s: F.concat(F.lit(prefix), s["token"]))
    return first.groupBy(key).agg(join_codes(sorted_).alias("codes"))


def compact(detail: DataFrame, key: str, exists: str, issue: str, name: str, issues: str | None = None) -> DataFrame:
    """One row per id: whether a file exists, whether one has issues, how many there are, the first by name, and the codes of all."""
    out = detail.groupBy(key).agg(F.bool_or(exists).alias("exists"), F.bool_or(issue).alias("has_issues"), F.count("*").alias("n_files"), F.min(F.when(F.col(exists), F.col(name))).alias("first_file"))
    if issues is None:
        return out
    return out.join(issue_rollup(detail, key, issues, name), key, "left").withColumn("codes", F.coalesce("codes", F.lit("")))


def score_rollup(scores: DataFrame, key: str, score: str, lo: float = 0.0, hi: float = 1.0) -> DataFrame:
    """Rows, missing, out-of-range and largest valid score of each id, with issue codes."""
    value = to_number(F.col(score))
    inside = value.between(lo, hi)
    out = scores.groupBy(key).agg(
        F.count("*").alias("n_rows"), F.count_if(value.isNull()).alias("n_missing"), F.count_if(~inside).alias("n_out_of_range"), F.max(F.when(inside, value)).alias("score")
    )
    codes = [F.when(F.col("n_rows") > 1, "duplicate_score"), F.when(F.col("n_missing") > 0, "missing_score"), F.when(F.col("n_out_of_range") > 0, "score_out_of_range")]
    return out.withColumn("codes", F.array_join(F.array_compact(F.array(*codes)), "|"))


def merge_scores(files: DataFrame, scores: DataFrame, key: str, issues: str = "issues") -> DataFrame:
    """Inventory and scores side by side; what only one side has gets an issue behind those of the file.

    Ids without a file get a row of their own, whose record_type is score_only.
    """
    both = files.withColumn("_f", F.lit(True)).join(scores.withColumn("_s", F.lit(True)), key, "full_outer")
    own = split_issues(F.col(issues)) if issues in files.columns else F.array().cast("array<string>")
    more = F.when(F.col("_f").isNull(), F.array(F.lit("missing_file"))).when(F.col("_s").isNull(), F.array(F.lit("missing_score"))).otherwise(F.array().cast("array<string>"))
    out = both.withColumn("issue", join_codes(F.concat(own, more))).withColumn("record_type", F.when(F.col("_f").isNull(), "score_only").otherwise("file"))
    return out.drop("_f", "_s")


def reusable_rows(now: DataFrame, previous: DataFrame, key: str, same: list[str], clean: str) -> DataFrame:
    """Previous rows whose file is unchanged and had no issues."""
    old = previous.where(F.col(clean)).select(key, *[F.col(c).alias(f"_p_{c}") for c in same])
    joined = now.join(old, key)
    for c in same:
        joined = joined.where(F.col(c).eqNullSafe(F.col(f"_p_{c}")))
    return joined.drop(*[f"_p_{c}" for c in same])


def needs_download(ids: DataFrame, inventory: DataFrame, retry: DataFrame, key: str, url: str, budget: int, requested: DataFrame | None = None, forced: bool = False, missing_only: bool = False) -> DataFrame:
    """(key, url, reason, attempts) of the ids to download.

    ``ids``: key and url; ``inventory``: key, exists, has_issues; ``retry``: key, url, attempts, terminal. Taken are
    all ids if ``forced``, requested ones, and those without a good file; in ``missing_only`` mode those without
    any file, of the requested ones if there are some. Attempts start afresh when an id is forced or its
    url has changed; ids whose attempts are used up or that failed for good are left out.
    """
    have = inventory.groupBy(key).agg(F.bool_or("exists").alias("_e"), F.bool_or(F.col("exists") & ~F.col("has_issues")).alias("_g"), F.bool_or("has_issues").alias("_i"))
    state = retry.select(key, F.col(url).alias("_u"), F.col("attempts").alias("_a"), F.col("terminal").alias("_t"))
    out = ids.select(key, F.trim(F.coalesce(url, F.lit(""))).alias(url)).dropDuplicates([key]).join(have, key, "left").join(state, key, "left")
    asked = F.lit(requested is None) if missing_only else F.lit(False)
    if requested is not None:
        out = out.join(requested.select(key, F.lit(True).alias("_r")).distinct(), key, "left")
        asked = F.coalesce("_r", F.lit(False))
    out = out.withColumn("_asked", asked)
    exists, good = F.coalesce("_e", F.lit(False)), F.coalesce("_g", F.lit(False)) & ~F.coalesce("_i", F.lit(True))
    chosen = ~exists & F.col("_asked") if missing_only else F.lit(forced) | F.col("_asked") | ~good
    fresh = F.lit(forced) | ~F.coalesce(F.trim("_u") == F.col(url), F.lit(False))
    out = out.where(chosen).withColumn("attempts", F.when(fresh, F.lit(0)).otherwise(F.coalesce("_a", F.lit(0))).cast("int"))
    left = out.where((F.col("attempts") < budget) & (fresh | ~F.coalesce("_t", F.lit(False))))
    reason = F.when(F.lit(forced), "forced").when(~exists, "missing").when(~good, "has_issues").otherwise("requested")
    return left.select(key, url, reason.alias("reason"), "attempts")


def eligible_files(files: DataFrame, key: str, checks: list[str], issues: str, newest: str, path: str) -> DataFrame:
    """``files`` with eligibility (accepted or rejected) and eligibility_codes.

    Accepted is the newest file of each id that passes all ``checks`` and has no issues, ties by path.
    """
    passed = reduce(lambda a, b: a & b, [truthy(F.col(c)) for c in checks], F.coalesce(F.trim(issues), F.lit("")) == "")
    place = F.row_number().over(Window.partitionBy(key, "_ok").orderBy(F.desc_nulls_last(newest), path))
    out = files.withColumn("_ok", passed).withColumn("_place", place)
    codes = F.when(~F.col("_ok"), F.when(F.coalesce(F.trim(issues), F.lit("")) == "", "inventory_issue").otherwise(F.col(issues))).when(F.col("_place") > 1, "duplicate_valid_file_for_id").otherwise("")
    return out.withColumns({"eligibility": F.when(F.col("_ok") & (F.col("_place") == 1), "accepted").otherwise("rejected"), "eligibility_codes": codes}).drop("_ok", "_place")


def mark_duplicates(df: DataFrame, key: str, order: list) -> DataFrame:
    """``df`` with is_repeat (not the first row of its key) and is_shared (its key has several rows)."""
    w = Window.partitionBy(key)
    return df.withColumn("is_repeat", F.row_number().over(w.orderBy(*order)) > 1).withColumn("is_shared", F.count("*").over(w) > 1)


def in_extent(df: DataFrame, bounds: DataFrame, x: str, y: str, margin: float = 500.0) -> DataFrame:
    """Rows within a layer's bounds (one row: xmin, ymin, xmax, ymax) and a margin around them."""
    near = F.col(x).between(F.col("xmin") - margin, F.col("xmax") + margin) & F.col(y).between(F.col("ymin") - margin, F.col("ymax") + margin)
    return df.crossJoin(F.broadcast(bounds.select("xmin", "ymin", "xmax", "ymax").limit(1))).where(near).drop("xmin", "ymin", "xmax", "ymax")


def extent(df: DataFrame, x: str, y: str, cls: str | None = None) -> DataFrame:
    """One row: rows, bounds and, of a layer with classes, how many rows each class has as class=n joined by |."""
    out = df.agg(F.count("*").alias("n_rows"), F.min(x).alias("xmin"), F.min(y).alias("ymin"), F.max(x).alias("xmax"), F.max(y).alias("ymax"))
    if cls is None:
        return out
    n = df.groupBy(F.coalesce(F.col(cls).cast("string"), F.lit("missing")).alias("c")).agg(F.count("*").alias("n"))
    counts = n.agg(F.array_join(F.sort_array(F.collect_list(F.concat_ws("=", "c", "n"))), "|").alias("class_counts"))
    return out.crossJoin(F.broadcast(counts))  # one row each


def expected_media_ids(source: DataFrame, key: str, url: str, existing: DataFrame) -> DataFrame:
    wanted = source.where(F.trim(F.coalesce(url, F.lit(""))) != "").select(key).distinct()
    return wanted.join(existing.select(key), key, "left_anti")


def presence_summary(df: DataFrame, exists: str, issue: str) -> DataFrame:
    e, i = F.coalesce(exists, F.lit(False)), F.coalesce(issue, F.lit(False))
    return df.agg(F.count_if(e).alias("present"), F.count_if(~e).alias("missing"), F.count_if(i).alias("issues"), F.count_if(e & ~i).alias("clean"))


def series_qc(series: DataFrame, key: str, ts: str, ranges: dict[str, tuple[float, float] | None], expected_rows: int, step: int, window: DataFrame | None = None, max_null: float = 0.0) -> DataFrame:
    """Quality of each id's time series: counts, shares, and codes of what is wrong.

    ``ranges``: the required columns and what their values lie between, if that is known; a column that
    ``series`` lacks is missing in all of them. ``ts`` is text or a time; unparsable ones stop the checks of
    times. ``window``: key, first, last of the times that an id should have.
    """
    have = [c for c in ranges if c in series.columns]
    parsed = series.withColumn("_t", F.col(ts).try_cast("timestamp"))
    parsed = parsed.withColumn("_gap", F.unix_timestamp("_t") - F.unix_timestamp(F.lag("_t").over(Window.partitionBy(key).orderBy("_t"))))
    odd = [~F.col(c).between(*ranges[c]) for c in have if ranges[c]]
    out = parsed.groupBy(key).agg(
        F.count("*").alias("n_rows"), F.greatest(F.lit(0.0), F.lit(0.0), *[F.avg(F.col(c).isNull().cast("double")) for c in have]).alias("null_fraction"),
        F.count_if(F.col("_t").isNull()).alias("n_unparsable"), F.count_if(F.col("_gap") == 0).alias("n_duplicate"), F.count_if(F.col("_gap") != step).alias("n_wrong_step"),
        sum((F.count_if(x) for x in odd), F.lit(0).cast("long")).alias("n_out_of_range"), F.min("_t").alias("first_ts"), F.max("_t").alias("last_ts"),
    )
    off = F.lit(False)
    if window is not None:
        out = out.join(window.select(key, F.col("first").alias("_first"), F.col("last").alias("_last")), key, "left")
        off = F.coalesce((F.col("first_ts") != F.col("_first")) | (F.col("last_ts") != F.col("_last")), F.lit(False))
    parsable = F.col("n_unparsable") == 0
    codes = coded(
        (F.col("n_rows") != expected_rows, "unexpected_row_count"), (F.lit(len(have) < len(ranges)), "missing_required_column"), (F.col("null_fraction") > max_null, "missing_value"),
        (~parsable, "unparseable_datetime"), (parsable & (F.col("n_duplicate") > 0), "duplicate_datetime"), (parsable & (F.col("n_wrong_step") > 0), "unexpected_time_interval"),
        (parsable & off, "unexpected_time_window"), (F.col("n_out_of_range") > 0, "implausible_value"),
    )
    return out.withColumn("codes", codes).drop("_first", "_last")


def complete_periods(names: DataFrame, name: str, pattern: str) -> DataFrame:
    """(variable, year) with files of all twelve months; the pattern's groups are variable, year and month."""
    part = lambda i: F.regexp_extract(name, pattern, i)
    found = names.where(F.col(name).rlike(pattern)).select(part(1).alias("variable"), part(2).cast("int").alias("year"), part(3).cast("int").alias("month"))
    return found.where("month between 1 and 12").groupBy("variable", "year").agg(F.count_distinct("month").alias("n")).where("n = 12").drop("n")
