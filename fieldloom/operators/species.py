"""Classifier output: work lists, top-k labels, plausibility, consensus and completeness."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import clean_label, coded, hash_shard, local_parts, month_in_window, segment_bounds, to_number, work_key
from .ranking import dedupe, rank_in, top_k


#: Models of a work list, at most; the list is broadcast.
MAX_MODELS = 10_000


def worklist(recordings: DataFrame, models: DataFrame, key: str, shards: int) -> DataFrame:
    """Every recording with every model of the short model list, its key and shard. The list is counted, then broadcast."""
    if models.count() > MAX_MODELS:
        raise ValueError(f"more than {MAX_MODELS} models")
    out = recordings.crossJoin(F.broadcast(models))
    return out.withColumn("work_key", work_key(F.col(key).cast("string"), F.col("model"))).withColumn("shard", hash_shard(F.col(key).cast("string"), shards))


def melt_scores(raw: DataFrame, keys: list[str], scores: str, labels: str | None = None, seconds: float = 3.0) -> DataFrame:
    """(keys, segment, start, end, label, score) of what models return, whatever its form, as JSON text or VARIANT.

    Forms: {segment: {label: score}}, where a segment that is no number is 0; {label: score} of segment 0; lists of
    scores, one or one a segment, by themselves or below any name, whose labels are those of the array column ``labels``,
    if it has as many. All forms are exploded by one path and told apart by what is found at each depth.
    Scores that are no finite numbers, and lists without labels, have no rows.
    """
    v = F.try_parse_json(scores) if raw.schema[scores].dataType.simpleString() == "string" else F.col(scores)
    out = raw.select(*keys, v.alias("_v"), (F.lit(None).cast("array<string>") if labels is None else F.col(labels)).alias("_labels"))
    below = lambda df, k: df.lateralJoin(df.sparkSession.tvf.variant_explode_outer(F.col("_v" if k == 1 else f"_v{k - 1}").outer()).toDF(f"_p{k}", f"_k{k}", f"_v{k}"))
    for k in (1, 2, 3):
        out = below(out, k)
    v1, v2, v3 = (F.col(f"_v{k}") for k in (1, 2, 3))
    named, deep, deepest = F.col("_k1").isNotNull(), v2.isNotNull(), v3.isNotNull()
    number = F.when(F.col("_k1").rlike(r"^\d+$"), F.col("_k1").try_cast("int")).otherwise(0)
    case = lambda segment, at, label, value, row: F.struct(segment.cast("int").alias("segment"), at.cast("int").alias("at"), label.cast("string").alias("label"), value.alias("v"), row.alias("row"))
    zero, none, no_row = F.lit(0), F.lit(None), F.lit(None).cast("variant")
    cell = (
        F.when(deepest & named & F.col("_k2").isNull() & F.col("_k3").isNull(), case(F.col("_p2"), F.col("_p3"), none, v3, v2))
        .when(deep & ~deepest & named & F.col("_k2").isNotNull(), case(number, none, F.col("_k2"), v2, no_row))
        .when(deep & ~deepest & named, case(zero, F.col("_p2"), none, v2, v1))
        .when(deep & ~deepest & ~named & F.col("_k2").isNull(), case(F.col("_p1"), F.col("_p2"), none, v2, v1))
        .when(~deep & named, case(zero, none, F.col("_k1"), v1, no_row))
        .when(~deep & ~named & v1.isNotNull(), case(zero, F.col("_p1"), none, v1, F.col("_v")))
    )
    out = out.select(*keys, "_labels", cell.alias("c")).select(*keys, "_labels", "c.*")
    width = F.size(F.try_variant_get("row", "$", "array<variant>"))
    by_index = F.when(F.size("_labels") == width, F.get("_labels", F.col("at")))
    score = to_number(F.try_variant_get("v", "$", "string"))
    out = out.withColumn("label", clean_label(F.when(F.col("at").isNull(), F.col("label")).otherwise(by_index))).withColumn("score", score)
    bounds = segment_bounds(F.col("segment"), F.lit(float(seconds)))
    good = F.col("score").isNotNull() & (F.col("at").isNull() | (F.size("_labels") == width))
    return out.where(good).select(*keys, "segment", bounds["start"].alias("start"), bounds["end"].alias("end"), "label", "score")


def melt_embeddings(raw: DataFrame, keys: list[str], vectors: str, seconds: float) -> DataFrame:
    out = raw.select(*keys, F.posexplode(vectors).alias("segment", "embedding"))
    return out.withColumn("start", F.col("segment") * seconds).withColumn("dim", F.size("embedding"))


def embedding_shape(melted: DataFrame, key: str, dim: int) -> DataFrame:
    """Per recording: segments, how many have another dimension than ``dim``, and whether all are right."""
    out = melted.groupBy(key).agg(F.count("*").alias("n_segments"), F.count_if(F.col("dim") != dim).alias("n_wrong_dim"))
    return out.withColumn("valid", F.col("n_wrong_dim") == 0)


def with_month(df: DataFrame, meta: DataFrame, key: str, ts: str) -> DataFrame:
    """``df`` with the local month of its recording, null where that is unknown."""
    months = meta.select(key, F.month(local_parts(F.col(ts).cast("string"))["local"]).alias("month"))
    return df.join(dedupe(months, [key], [F.asc_nulls_last("month")]), key, "left")


def segment_top_k(preds: DataFrame, keys: list[str], threshold: float, k: int) -> DataFrame:
    """The k best labels of each segment that reach the threshold; ties by label."""
    good = preds.where((F.trim("species") != "") & ~F.isnan("score") & (F.col("score") >= threshold))
    return top_k(good, keys, [F.desc("score"), F.asc("species")], k)


def plausibility(preds: DataFrame, allow: DataFrame, month: str) -> DataFrame:
    """accepted, flagged (not accepted here, or out of season) or not_evaluated (not in the reference)."""
    out = preds.join(allow, "species", "left")
    season = month_in_window(F.col(month), F.col("start_month"), F.col("end_month"))
    status = F.when(F.col("accepted_name").isNull(), "not_evaluated").when(~F.col("present") | ~F.coalesce(season, F.lit(True)), "flagged").otherwise("accepted")
    return out.withColumn("status", status)


def species_by_model(preds: DataFrame, key: str) -> DataFrame:
    """Per id, species and model: best score, segments, taxon group and plausibility. Species go by their accepted name where they have one."""
    name = F.coalesce("accepted_name", "species") if "accepted_name" in preds.columns else F.col("species")
    first = lambda c: (F.min(c) if c in preds.columns else F.min(F.lit(None).cast("string"))).alias(c)
    return preds.groupBy(key, name.alias("species"), "model").agg(F.max("score").alias("score"), F.count_distinct("segment").alias("segments"), first("taxon_group"), first("status"))


def consensus(preds: DataFrame, key: str) -> DataFrame:
    """Per id and species: models, best score, segments (a sum over models) and taxon group, ranked in the id."""
    out = species_by_model(preds, key).groupBy(key, "species").agg(F.count_distinct("model").alias("support"), F.max("score").alias("score"), F.sum("segments").alias("segments"), F.min("taxon_group").alias("taxon_group"))
    return rank_in(out, [key], [F.desc("support"), F.desc("score"), F.desc("segments"), F.asc("species")])


def recording_summary(ranked: DataFrame, key: str) -> DataFrame:
    """Per id: species, birds and others among them, the best score, and the first species with its support."""
    top = lambda c: F.max(F.when(F.col("rank") == 1, F.col(c)))
    bird = F.coalesce(F.lower("taxon_group").contains("bird"), F.lit(False))
    return ranked.groupBy(key).agg(
        F.count("*").alias("n_species"), F.count_if(bird).alias("n_birds"), F.count_if(~bird).alias("n_others"), F.max("score").alias("max_score"), top("species").alias("top_species"), top("support").alias("top_support")
    )


def completion_qc(work: DataFrame, done: DataFrame, key: str, required: list[str], failed: DataFrame | None = None) -> DataFrame:
    """Per id: expected and finished models, status, codes, and whether all required models are done.

    validated without a code, partial if some model is done, else failed. ``failed``: key, model, error.
    """
    both = completion_detail(work, done, key, required, failed)
    names = lambda c: F.array_join(F.sort_array(F.collect_set(F.when(c, F.col("model")))), "|")
    out = both.groupBy(key).agg(names(F.col("expected")).alias("models_expected"), names(F.col("complete")).alias("models_complete"), F.count_if(F.col("required") & F.col("complete")).alias("_n"), F.bool_or(F.col("error") != "").alias("_f"), F.bool_or("complete").alias("_any"))
    out = out.withColumn("required_complete", F.col("_n") == len(required))
    out = out.withColumn("codes", coded((~F.col("required_complete"), "required_models_incomplete"), (F.col("_f"), "model_inference_failed"))).withColumn("has_issues", F.col("codes") != "")
    status = F.when(~F.col("has_issues"), "validated").when(F.col("_any"), "partial").otherwise("failed")
    return out.withColumn("status", status).drop("_n", "_f", "_any")


def completion_detail(work: DataFrame, done: DataFrame, key: str, required: list[str], failed: DataFrame | None = None) -> DataFrame:
    """(key, model, expected, required, complete, error) of all ids in ``work``."""
    out = work.select(key, "model", F.lit(True).alias("expected")).distinct()
    finished = done.select(key, "model", F.lit(True).alias("_done")).distinct().join(work.select(key).distinct(), key, "left_semi")
    out = out.join(finished, [key, "model"], "full_outer")
    if failed is not None:
        errors = failed.groupBy(key, "model").agg(F.min("error").alias("error")).join(work.select(key).distinct(), key, "left_semi")
        out = out.join(errors, [key, "model"], "full_outer")
    error = F.coalesce("error", F.lit("")) if failed is not None else F.lit("")
    return out.select(key, "model", F.coalesce("expected", F.lit(False)).alias("expected"), F.col("model").isin(required).alias("required"), F.coalesce("_done", F.lit(False)).alias("complete"), error.alias("error"))


def shard_verification(work: DataFrame, done: DataFrame, key: str, required: list[str] = [], states: DataFrame | None = None, shards: int | None = None) -> DataFrame:
    """Per model and shard: expected and missing work, codes, and whether what is wrong blocks (its model is required).

    ``done``: model, key, work_key; work is finished if its own work_key is there. ``states``: model, shard, status,
    n_failed, shard_count of the shards that have run; of others the state is missing.
    """
    keyed = ["model", key, *(["work_key"] if "work_key" in done.columns else [])]
    joined = work.select("shard", *keyed).join(done.select(*keyed, F.lit(True).alias("_done")).distinct(), keyed, "left")
    out = joined.groupBy("model", "shard").agg(F.count("*").alias("n_expected"), F.count_if(F.col("_done").isNull()).alias("n_missing"))
    rules = [(F.col("n_missing") > 0, "missing_work_key")]
    if states is not None:
        out = out.join(states.select("model", "shard", F.col("status").alias("_s"), F.col("n_failed").alias("_f"), F.col("shard_count").alias("_k")), ["model", "shard"], "left")
        known = F.col("_s").isNotNull()
        rules = [
            (~known, "missing_state"), (known & (F.col("_s") != "complete"), "non_complete_state"), (known & (F.coalesce("_f", F.lit(0)) > 0), "failed_ids"),
            (known & (F.coalesce("_k", F.lit(-1)) != shards), "shard_count_mismatch"), (known & (F.col("n_missing") > 0), "missing_work_key"),
        ]
    out = out.withColumn("codes", coded(*rules)).withColumn("complete", F.col("codes") == "")
    return out.withColumn("blocking", ~F.col("complete") & F.col("model").isin(required)).drop("_s", "_f", "_k")


def batch_score(work: DataFrame, scorer: Callable[[pd.DataFrame], pd.Series], key: str) -> DataFrame:
    """(key, score, error): scores of a user's function by batches.

    A batch that fails is halved until the rows that fail are alone; those have the error in place of a
    score, all others keep theirs. Finished keys are left out with pending() before.
    """

    def scored(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
        try:
            yield pd.DataFrame({key: pdf[key], "score": scorer(pdf).astype(float), "error": None})
        except Exception as e:
            if len(pdf) == 1:
                yield pd.DataFrame({key: pdf[key], "score": [None], "error": [f"{type(e).__name__}: {e}"]})
            else:
                half = len(pdf) // 2
                yield from scored(pdf.iloc[:half])
                yield from scored(pdf.iloc[half:])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield from scored(pdf)

    return work.mapInPandas(run, f"{key} {work.schema[key].dataType.simpleString()}, score double, error string")
