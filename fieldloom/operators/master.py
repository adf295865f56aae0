"""One row per id: what each domain says of it, readiness flags and blocking codes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import lonlat_to_laea
from ..functions.scalars import agreement, coded, grid_id_of, join_codes, local_parts, split_issues, to_number, truthy, valid_coordinates, valid_timestamp
from .changes import upsert_by_id
from .ranking import dedupe


def domain_status(exists: Column, has_issues: Column) -> Column:
    return F.when(~F.coalesce(exists, F.lit(False)), "missing").when(F.coalesce(has_issues, F.lit(False)), "has_issues").otherwise("validated")


def coalesce_aliases(df: DataFrame, target: str, sources: list[str]) -> DataFrame:
    """``target`` from itself and then the sources that there are, which go."""
    found = [c for c in [target, *sources] if c in df.columns]
    if not found:
        return df
    return df.withColumn(target, F.coalesce(*found)).drop(*[c for c in found if c != target])


def base_table(metadata: DataFrame, key: str, datetime: str, lat: str, lon: str) -> DataFrame:
    """(key, lat, lon, datetime_local, datetime_utc, date_local, time_local) of each id's first row."""
    parts = metadata.select(key, to_number(F.col(lat)).alias("lat"), to_number(F.col(lon)).alias("lon"), F.col(datetime).alias("datetime_local"), local_parts(F.col(datetime)).alias("_t"))
    once = dedupe(parts, [key], [F.asc_nulls_last("datetime_local"), F.asc_nulls_last("lat"), F.asc_nulls_last("lon")])
    return once.select(key, "lat", "lon", F.when(F.col("_t.local").isNotNull(), F.col("datetime_local")).alias("datetime_local"), F.col("_t.utc").alias("datetime_utc"), F.col("_t.date").alias("date_local"), F.col("_t.time").alias("time_local"))


def attach_inventory(table: DataFrame, inventory: DataFrame | None, key: str, prefix: str, issues: list[DataFrame] = [], extra: dict[str, str] = {}) -> DataFrame:
    """``table`` with prefix_exists, prefix_has_issues and prefix_issue_codes of a file inventory.

    ``inventory``: key, exists, has_issues, codes and the columns named by ``extra`` (name in the table:
    name in the inventory), one row a key; without one everything is missing. ``issues``: frames of key
    and codes, such as those of details and of retries. Codes come in that order behind missing_file.
    """
    names = [f"{prefix}_exists", f"{prefix}_has_issues", f"{prefix}_issue_codes"]
    if inventory is None:
        missing = [F.lit(False), F.lit(True), F.lit("missing_file|inventory_not_run")]
        return table.withColumns(dict(zip(names, missing)) | {c: F.lit(None).cast("string") for c in extra})
    own = dedupe(inventory, [key], [F.desc_nulls_last("exists"), F.asc_nulls_last("codes")])
    out = table.join(own.select(key, F.col("exists").alias("_e"), F.col("has_issues").alias("_h"), F.col("codes").alias("_c0"), *[F.col(c).alias(n) for n, c in extra.items()]), key, "left")
    for i, frame in enumerate(issues, 1):
        out = out.join(frame.select(key, F.col("codes").alias(f"_c{i}")), key, "left")
    exists = F.coalesce("_e", F.lit(False))
    codes = F.flatten(F.array(F.when(exists, F.array().cast("array<string>")).otherwise(F.array(F.lit("missing_file"))), *[split_issues(F.col(f"_c{i}")) for i in range(len(issues) + 1)]))
    out = out.withColumn("_codes", join_codes(codes))
    out = out.withColumns(dict(zip(names, [exists, F.coalesce("_h", F.lit(True)) | (F.col("_codes") != ""), F.col("_codes")])))
    return out.drop("_e", "_h", "_codes", *[f"_c{i}" for i in range(len(issues) + 1)])


def attach_series_status(table: DataFrame, compact: DataFrame | None, key: str, prefix: str) -> DataFrame:
    """As attach_inventory for a series inventory whose columns have one of several usual names."""
    if compact is not None:
        for target, sources in {"exists": [f"{prefix}_exists", "weather_exists"], "has_issues": [f"{prefix}_has_issues", "weather_has_issues"], "codes": [f"{prefix}_issue_codes", "issue_codes"]}.items():
            compact = coalesce_aliases(compact, target, sources)
            if target not in compact.columns:
                compact = compact.withColumn(target, {"exists": F.lit(False), "has_issues": F.lit(True), "codes": F.lit("")}[target])
        compact = compact.withColumn("exists", truthy(F.col("exists"))).withColumn("has_issues", truthy(F.col("has_issues")))
    return attach_inventory(table, compact, key, prefix)


def raster_status(quality: DataFrame) -> DataFrame:
    """One row (codes) for a raster quality table: status, square and numbers of constant and empty lines of each file."""
    lines = reduce(lambda a, b: a | b, [F.coalesce(F.col(c), F.lit(0)) > 0 for c in ("constant_rows", "constant_cols", "nodata_rows", "nodata_cols")])
    rules = {"all_nodata": F.upper("status") == "ONLY_NODATA", "unexpected_shape": ~F.coalesce("square", F.lit(False)), "raster_structure_warning": lines}
    found = quality.agg(F.count("*").alias("n"), *[F.coalesce(F.bool_or(c), F.lit(False)).alias(k) for k, c in rules.items()])
    return found.select(F.when(F.col("n") == 0, "qc_not_run").otherwise(coded(*[(F.col(k), k) for k in rules])).alias("codes"))


def attach_raster_status(table: DataFrame, quality: DataFrame, exists: bool, prefix: str) -> DataFrame:
    """What is known of one raster product, which holds for every id: one row is joined to all."""
    one = raster_status(quality).withColumn("codes", F.col("codes") if exists else join_codes(F.concat(F.array(F.lit("missing_raster")), split_issues(F.regexp_replace("codes", "qc_not_run", "")))))
    out = table.crossJoin(F.broadcast(one.limit(1)))
    return out.withColumns({f"{prefix}_exists": F.lit(exists), f"{prefix}_has_issues": F.col("codes") != "", f"{prefix}_issue_codes": F.col("codes")}).drop("codes")


def attach_cell_class(table: DataFrame, cells: DataFrame, cell: str, suffix: str, columns: dict[str, str]) -> DataFrame:
    """Class columns of the grid cell that ``cell`` names, as majority_formation_<suffix> and so on.

    ``columns``: what the cell table calls majority, status, value, second, delta, disputed and, where it has
    shares in percent instead, coverage_pct and gap_pct. Hundredths of a percent are worked out from
    those, the second value from the difference, and the flag from a difference of 200 or less.
    """
    has = lambda c: c in columns
    own = cells.select(F.col(columns["cell"]).alias(cell), *[F.col(c).alias(f"_{n}") for n, c in columns.items() if n != "cell"])
    out = table.join(dedupe(own, [cell], [F.desc_nulls_last("_majority")]), cell, "left")
    whole = lambda c: F.rint(F.col(c)).cast("long")
    centi = lambda c: F.rint(F.col(c) * 100).cast("long")
    value = whole("_value") if has("value") else centi("_coverage_pct") if has("coverage_pct") else F.lit(None).cast("long")
    delta = whole("_delta") if has("delta") else centi("_gap_pct") if has("gap_pct") else F.lit(None).cast("long")
    out = out.withColumns({f"majority_formation_{suffix}": F.col("_majority"), f"majority_formation_status_{suffix}": F.col("_status") if has("status") else F.lit(None).cast("string"), f"majority_value_{suffix}": value, f"majority_delta_{suffix}": delta})
    second = whole("_second") if has("second") else F.col(f"majority_value_{suffix}") - F.col(f"majority_delta_{suffix}")
    disputed = truthy(F.col("_disputed")) if has("disputed") else F.coalesce(F.col(f"majority_delta_{suffix}") <= 200, F.lit(False))
    out = out.withColumns({f"second_value_{suffix}": second, f"majority_disputed_{suffix}": disputed, f"grid_{suffix}_assignment_exists": F.col(cell).isNotNull(), f"grid_{suffix}_has_majority_formation": F.col("_majority").isNotNull()})
    return out.drop(*[f"_{n}" for n in columns])


def attach_completion(table: DataFrame, qc: DataFrame, key: str, extra: list[str]) -> DataFrame:
    """bioacoustic_ columns of the completeness check: status, has_issues, issue_codes, required_models_complete and ``extra``."""
    own = dedupe(qc, [key], [F.desc("status")]).select(key, F.col("status").alias("_s"), F.col("has_issues").alias("_h"), F.col("codes").alias("_c"), F.col("required_complete").alias("_r"), *extra)
    out = table.join(own, key, "left")
    return out.withColumns({
        "bioacoustic_status": F.coalesce("_s", F.lit("not_started")), "bioacoustic_has_issues": F.coalesce("_h", F.lit(True)),
        "bioacoustic_issue_codes": F.when(F.col("_s").isNull(), F.coalesce("_c", F.lit("bioacoustic_result_missing"))).otherwise(F.coalesce("_c", F.lit(""))),
        "bioacoustic_required_models_complete": F.coalesce("_r", F.lit(False)),
    }).drop("_s", "_h", "_c", "_r")


def attach_points(table: DataFrame, points: DataFrame, key: str) -> DataFrame:
    """inside_lrt_polygon and lrt_polygon_count of the point table."""
    own = points.select(key, F.col("inside_polygon").alias("_i"), F.col("n_polygons").alias("_n"))
    out = table.join(own, key, "left")
    return out.withColumn("inside_lrt_polygon", F.coalesce("_i", F.lit(False))).withColumn("lrt_polygon_count", F.coalesce("_n", F.lit(0).cast("long"))).drop("_i", "_n")


#: The domains of the master table with a file inventory each, in the order of their blocking codes.
MEDIA = ("sound", "weather_point", "sentinel", "photo")


def domain_statuses(table: DataFrame) -> DataFrame:
    """metadata_status, one status for each inventory, formation statuses, and whether both formations agree."""
    good = valid_timestamp(F.col("datetime_local"), F.col("datetime_utc")) & valid_coordinates(F.col("lat"), F.col("lon"))
    out = table.withColumn("metadata_status", F.when(good, "validated").otherwise("has_issues"))
    out = out.withColumns({f"{p}_status": domain_status(F.col(f"{p}_exists"), F.coalesce(f"{p}_has_issues", F.lit(True))) for p in MEDIA})
    out = out.withColumns({f"formation_{r}_status": domain_status(F.col(f"grid_{r}_assignment_exists"), ~F.coalesce(f"grid_{r}_has_majority_formation", F.lit(False))) for r in ("100m", "10m")})
    return out.withColumns({f"{c}_100m_10m_agree": agreement(F.col(f"majority_{c}_100m"), F.col(f"majority_{c}_10m")) for c in ("formation", "formation_status")})


def readiness_flags(table: DataFrame) -> DataFrame:
    """The seven ready_for_ flags of domain_statuses()' table."""
    valid = lambda c: F.coalesce(F.col(f"{c}_status") == "validated", F.lit(False))
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    general = valid("metadata") & valid("sound") & valid("weather_point") & valid("sentinel")
    raster = yes("weather_raster_100m_exists") & ~F.coalesce("weather_raster_100m_has_issues", F.lit(True))
    flags = {
        "general_analysis": general,
        "formation_analysis_100m": general & valid("formation_100m"),
        "direct_lrt_analysis": general & yes("inside_lrt_polygon"),
        "formation_weather_raster_analysis_100m": general & valid("formation_100m") & raster,
        "formation_analysis_10m": general & valid("formation_10m"),
        "multimodal_analysis": general & valid("photo"),
        "bioacoustic_analysis": valid("sound") & valid("bioacoustic") & yes("bioacoustic_required_models_complete"),
    }
    return table.withColumns({f"ready_for_{k}": v for k, v in flags.items()})


def blocking_codes(table: DataFrame) -> DataFrame:
    """record_blocking_issue_codes: in a fixed order, what keeps an id from being ready."""
    codes = [(~valid_timestamp(F.col("datetime_local"), F.col("datetime_utc")), "timestamp_missing_or_invalid"), (~valid_coordinates(F.col("lat"), F.col("lon")), "coordinates_missing_or_invalid")]
    for p in MEDIA:
        codes += [(F.col(f"{p}_status") == "missing", f"{p}_missing"), (F.col(f"{p}_status") == "has_issues", f"{p}_issue")]
    codes += [(~F.coalesce(f"grid_{r}_has_majority_formation", F.lit(False)), f"grid_{r}_missing_majority_formation") for r in ("100m", "10m")]
    return table.withColumn("record_blocking_issue_codes", coded(*codes))


def record_status(table: DataFrame) -> DataFrame:
    """validated, has_issues (nothing of the core is valid) or partial."""
    whole = F.col("ready_for_general_analysis") & F.col("ready_for_formation_analysis_100m") & F.col("ready_for_formation_analysis_10m")
    none = reduce(lambda a, b: a & b, [F.col(f"{p}_status") != "validated" for p in ("metadata", "sound", "weather_point", "sentinel")])
    return table.withColumn("record_status", F.when(none, "has_issues").when(whole, "validated").otherwise("partial"))


def release_status(table: DataFrame, previous: DataFrame | None, key: str) -> DataFrame:
    """approved stays approved; validated records need a review; others are not started."""
    now = F.when(F.col("record_status") == "validated", "manual_review_required").otherwise("not_started")
    if previous is None:
        return table.withColumn("release_status", now)
    old = previous.where(F.lower("release_status") == "approved").select(key, F.lit(True).alias("_approved")).distinct()
    return table.join(old, key, "left").withColumn("release_status", F.when(F.col("_approved"), "approved").otherwise(now)).drop("_approved")


def projected(table: DataFrame, columns: dict[str, str]) -> DataFrame:
    """The fixed columns of a table (name: type) in order; one that it lacks is null."""
    return table.select(*[(F.col(c) if c in table.columns else F.lit(None)).cast(kind).alias(c) for c, kind in columns.items()])


def master_table(base: DataFrame, attach: list, key: str, columns: list[str] | dict[str, str], previous: DataFrame | None = None, ids: DataFrame | None = None) -> DataFrame:
    """The master table: ``base`` (see base_table) with what each function of ``attach`` adds, then statuses, flags and codes.

    ``columns``: their names, or names and types of a fixed form of which some may be missing. With ``ids`` only these
    are worked out and replace their rows in ``previous``.
    """
    table = base if ids is None else base.join(ids.select(key).distinct(), key, "left_semi")
    table = reduce(lambda df, f: f(df), attach, table)
    table = release_status(record_status(blocking_codes(readiness_flags(domain_statuses(table)))), previous, key)
    form = lambda df: projected(df, columns) if isinstance(columns, dict) else df.select(*columns)
    return form(table) if previous is None or ids is None else upsert_by_id(form(previous), form(table), ids, key)


def assign_cell(points: DataFrame, cells: DataFrame, key: str, x: str, y: str, cell: str, res: int, lonlat: bool = False) -> DataFrame:
    """``points`` with ``cell``, the id of the grid cell that holds them if it is in ``cells``.

    A point on a border lies in all cells that share it; the first of their ids counts, of those in ``cells``. Only such
    points are looked up more than once, by a shuffle: all points may lie on borders. ``x`` and ``y`` are the grid's coordinates, or longitude and latitude.
    """
    px, py = lonlat_to_laea(F.col(x), F.col(y)) if lonlat else (F.col(x), F.col(y))
    placed = points.select("*", F.inline(F.array(F.struct(px.alias("_x"), py.alias("_y")))))
    known = cells.select(cell).distinct()
    border = F.coalesce((F.pmod("_x", F.lit(res)) == 0) | (F.pmod("_y", F.lit(res)) == 0), F.lit(False))
    inner = placed.where(~border).withColumn("_cell", F.when(F.col("_x").isNotNull() & F.col("_y").isNotNull(), grid_id_of(F.col("_x"), F.col("_y"), res)))
    inner = inner.join(known.select(F.col(cell).alias("_cell"), F.col(cell)), "_cell", "left").select(*points.columns, cell)
    around = lambda c: F.when(F.pmod(c, F.lit(res)) == 0, F.array(F.col(c), F.col(c) - res)).otherwise(F.array(c))
    near = placed.where(border).select(key, "_x", "_y").distinct().withColumn("_cx", F.explode(around("_x"))).withColumn("_cy", F.explode(around("_y")))
    first = near.withColumn(cell, grid_id_of(F.col("_cx"), F.col("_cy"), res)).join(known.hint("merge"), cell).groupBy(key).agg(F.min(cell).alias(cell))
    return inner.unionByName(placed.where(border).join(first, key, "left").select(*points.columns, cell))


def point_status(lat: Column, lon: Column, cell: Column, inside: Column) -> Column:
    """What became of a point; being in a polygon counts more than its cell."""
    return (
        F.when(F.coalesce(inside, F.lit(False)), "inside_lrt_polygon").when(lat.isNull() | lon.isNull(), "missing_coordinates")
        .when(cell.isNull(), "outside_majority_grid").otherwise("inside_majority_grid_outside_lrt")
    )


def point_table(points: DataFrame, cells: DataFrame, matches: DataFrame, key: str | list[str], cell: str, counts: list[str]) -> DataFrame:
    """One row per point: its cell's columns, its polygons' counts (0 without any) and lists, and its status.

    ``points``: key, lat, lon and cell (see assign_cell); ``cells``: one row a cell; ``matches``: match_summary() by ``key``, which may be the point's place.
    """
    out = points.join(cells, cell, "left").join(matches, key, "left")
    out = out.withColumns({c: F.coalesce(F.col(c), F.lit(0)).cast("long") for c in counts})
    out = out.withColumns({"inside_majority_grid": F.col(cell).isNotNull(), "inside_polygon": F.col(counts[0]) > 0})
    return out.withColumn("processing_status", point_status(F.col("lat"), F.col("lon"), F.col(cell), F.col("inside_polygon")))


def readiness(master: DataFrame, domains: list[str]) -> DataFrame:
    """ready_<domain> flags, whether all hold, and the blocking codes in the domains' order."""
    for d in domains:
        master = master.withColumn(f"ready_{d}", F.coalesce(F.col(f"{d}_status") == "validated", F.lit(False)))
    flags = [F.col(f"ready_{d}") for d in domains]
    codes = F.array_join(F.array_compact(F.array(*[F.when(~F.col(f"ready_{d}"), F.concat(F.lit(f"{d}_"), F.coalesce(F.col(f"{d}_status"), F.lit("not_run")))) for d in domains])), "|")
    out = master.withColumn("ready_all", reduce(lambda a, b: a & b, flags)).withColumn("blocking_codes", codes)
    return out.withColumn("record_status", F.when(F.col("ready_all"), "validated").when(reduce(lambda a, b: a | b, flags), "partial").otherwise("pending"))


def readiness_gate(master: DataFrame, rules: dict[str, Column], strict: bool) -> DataFrame:
    """Ids that fail each rule; under a strict policy any failure is critical."""
    counts = master.agg(*[F.count_if(~F.coalesce(c, F.lit(False))).alias(k) for k, c in rules.items()])
    rows = counts.select(F.explode(F.array(*[F.struct(F.lit(k).alias("rule"), F.col(k).alias("not_ready")) for k in rules])).alias("r")).select("r.*")
    return rows.withColumn("critical", (F.col("not_ready") > 0) & F.lit(strict))


def all_any(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[f(F.coalesce(c, F.lit(False))).alias(f"{n}_{c}") for c in columns for n, f in (("all", F.bool_and), ("any", F.bool_or))])


def variant_counts(variants: DataFrame, key: str, flags: list[str], expected: int) -> DataFrame:
    """Per id: variants, how many have each flag, and whether all expected ones are there with all flags."""
    out = variants.groupBy(key).agg(F.count("*").alias("n_variants"), *[F.count_if(F.col(f)).alias(f"n_{f}") for f in flags])
    return out.withColumn("complete", reduce(lambda a, b: a & b, [F.col(f"n_{f}") == expected for f in flags], F.col("n_variants") == expected))


def variant_summary(variants: DataFrame, variant: str, key: str, constants: list[str], flags: list[str]) -> DataFrame:
    """Per variant: rows, ids, columns that are constant in it, and how many rows have each flag."""
    return variants.groupBy(variant).agg(
        F.count(key).alias("row_count"), F.count_distinct(key).alias("recording_count"), *[F.max(c).alias(c) for c in constants], *[F.count_if(F.col(f)).alias(f"recordings_{f}") for f in flags]
    )


def temporal_summary(variants: DataFrame, year: str, variant: str, key: str, flags: list[str]) -> DataFrame:
    """Per year and variant: ids, and how many rows have each flag; rows without a year are left out."""
    dated = variants.where(F.col(year).isNotNull())
    return dated.groupBy(year, variant).agg(F.count_distinct(key).alias("recording_count"), *[F.count_if(F.col(f)).alias(f"recordings_{f}") for f in flags])


def latest_per_group(runs: DataFrame, group: str, ts: str, status: str) -> DataFrame:
    """Runs, how many have each status as a map, and the latest run's status."""
    by_status = runs.groupBy(group, status).agg(F.count("*").alias("n"), F.max(ts).alias("at"))
    counts = F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.coalesce(F.col(status).cast("string"), F.lit("")), "n")))).alias("statuses")
    return by_status.groupBy(group).agg(F.sum("n").alias("n_runs"), F.max_by(status, F.struct("at", status)).alias("latest_status"), counts)


def validate_rows(df: DataFrame, rules: dict[str, Column], unique: str) -> DataFrame:
    """Rows that break each declared rule, and rows beyond the first of each key."""
    checks = df.agg(*[F.count_if(~F.coalesce(c, F.lit(False))).alias(k) for k, c in rules.items()])
    extra = df.groupBy(unique).agg((F.count("*") - 1).alias("x")).agg(F.sum("x").alias("duplicate_keys"))
    return checks.crossJoin(extra)


def contract_rules(contract: dict[str, dict]) -> dict[str, Column]:
    """Rules for validate_rows from a declared contract: of each column its ``type``, ``enum``, ``minimum``, ``maximum``, ``pattern``, ``required``."""
    rules = {}
    for name, of in contract.items():
        c, holds = F.col(name), []
        if "type" in of:
            holds.append((f"{name}_type", c.try_cast(of["type"]).isNotNull()))
        if "enum" in of:
            holds.append((f"{name}_enum", c.isin(*of["enum"])))
        for bound, test in (("minimum", lambda v: c >= v), ("maximum", lambda v: c <= v)):
            if bound in of:
                holds.append((f"{name}_{bound}", test(of[bound])))
        if "pattern" in of:
            holds.append((f"{name}_pattern", c.rlike(of["pattern"])))
        rules |= {k: c.isNull() | v for k, v in holds}
        if of.get("required"):
            rules[f"{name}_required"] = c.isNotNull()
    return rules


def artifact_check(spark, expected: dict[str, bool]) -> DataFrame:
    """(path, required, rows, state) of Parquet outputs: present, empty, missing, or optional_missing."""
    from pyspark.errors import AnalysisException

    found = []
    for path, required in expected.items():
        try:
            n = spark.read.parquet(path).count()
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            n = None
        found.append((path, required, n, "present" if n else "empty" if n == 0 else "missing" if required else "optional_missing"))
    return spark.createDataFrame(found, "path string, required boolean, rows long, state string")
