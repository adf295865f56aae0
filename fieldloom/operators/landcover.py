"""Majority decisions over an intersection table (cell, class, status, code, source polygon, year, area)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import cell_centroid_lonlat, usable_rings
from ..functions.scalars import centi_percent, classify_prefix, parse_grid_id
from .ranking import dedupe, rank_in, sample_examples, share_of_total


def class_area(ix: DataFrame, cell: str, cls: str, area: str, cell_area: float) -> DataFrame:
    """Area and coverage in percent by cell and class; a null class is kept."""
    out = ix.groupBy(cell, cls).agg(F.sum(area).alias("area"))
    return out.withColumn("percent", F.col("area") / F.lit(cell_area) * 100)


def class_count(ix: DataFrame, cell: str, cls: str) -> DataFrame:
    return ix.groupBy(cell).agg(F.count_distinct(cls).alias("n_classes")).withColumn("multiple", F.col("n_classes") > 1)


def majority(areas: DataFrame, cell: str, cls: str, value: str, threshold: float) -> DataFrame:
    """Top and second class of each cell, their gap, and whether the gap is within the threshold.

    Ties fall to the smaller class; without a second class its value is 0.
    """
    ranked = rank_in(areas.where(F.col(cls).isNotNull()), [cell], [F.desc(value), F.asc(cls)])
    at = lambda k, c: F.max(F.when(F.col("rank") == k, F.col(c)))
    out = ranked.groupBy(cell).agg(at(1, cls).alias("majority"), at(1, value).alias("majority_value"), at(2, cls).alias("second"), F.coalesce(at(2, value), F.lit(0)).alias("second_value"))
    return out.withColumn("delta", F.col("majority_value") - F.col("second_value")).withColumn("disputed", F.col("delta") <= threshold)


def top3_metrics(ranked: DataFrame, cell: str, label: str, value: str, rank: str = "rank") -> DataFrame:
    """The three largest values of a cell, their sum and share, and the ratios of the first to the others."""
    at = lambda k, c: F.max(F.when(F.col(rank) == k, F.col(c)))
    out = ranked.groupBy(cell).agg(
        *[at(k, label).alias(f"label{k}") for k in (1, 2, 3)], *[at(k, value).alias(f"value{k}") for k in (1, 2, 3)],
        F.sum(F.when(F.col(rank) <= 3, F.col(value))).alias("top3_sum"), F.sum(value).alias("total"),
    )
    ratio = lambda a, b: F.col(a) / F.nullif(F.col(b), F.lit(0))
    return out.withColumn("top3_share", ratio("top3_sum", "total")).withColumn("ratio12", ratio("value1", "value2")).withColumn("ratio13", ratio("value1", "value3")).drop("total")


def majority_rows(ix: DataFrame, decided: DataFrame, cell: str, cls: str) -> DataFrame:
    """The rows that belong to their cell's majority class."""
    return ix.join(decided.select(cell, F.col("majority").alias(cls)), [cell, cls])


def mixed_status(rows: DataFrame, cell: str, src: str, status: str) -> DataFrame:
    out = rows.groupBy(cell).agg(F.count_distinct(src).alias("n_polygons"), F.count_distinct(status).alias("n_statuses"))
    return out.withColumn("mixed", F.col("n_statuses") > 1)


def majority_status(rows: DataFrame, cell: str, status: str, area: str, allowed: tuple[str, ...] = ("A", "B", "C")) -> DataFrame:
    """The status with the largest area in the majority class, of the allowed ones; ties fall to the first."""
    sums = rows.where(F.col(status).isin(*allowed)).groupBy(cell, status).agg(F.sum(area).alias("status_area")).where("status_area > 0")
    return dedupe(sums, [cell], [F.desc("status_area"), F.asc(status)])


def representative_row(rows: DataFrame, cell: str, area: str, src: str, columns: list[str]) -> DataFrame:
    """Columns of the largest piece; ties fall to the smallest source id, then to the smallest values."""
    return dedupe(rows.select(cell, area, src, *columns), [cell], [F.desc(area), F.asc(src), *[F.asc_nulls_last(c) for c in columns]])


def majority_year(rows: DataFrame, cell: str, year: str, area: str) -> DataFrame:
    sums = rows.groupBy(cell, year).agg(F.sum(area).alias("year_area"))
    return dedupe(sums, [cell], [F.desc("year_area"), F.desc_nulls_last(year)])


def pivot_share(long: DataFrame, cell: str, cls: str, value: str, classes: list[str]) -> DataFrame:
    return long.groupBy(cell).pivot(cls, classes).agg(F.sum(value)).na.fill(0)


def status_matrix(ix: DataFrame, cell: str, cls: str, status: str, area: str, cell_area: float) -> DataFrame:
    """Long form of the matrix: hundredths of a percent by cell, class and status; null statuses drop out."""
    known = ix.where(F.col(status).isNotNull() & F.col(cls).isNotNull())
    out = known.groupBy(cell, cls, status).agg(F.sum(area).alias("_area"))
    return out.select(cell, cls, status, centi_percent(F.col("_area"), cell_area).alias("value"))


def matrix_summary(matrix: DataFrame, cell: str, cls: str, value: str = "value", threshold: int = 200) -> DataFrame:
    """Totals by class and the majority of the rounded values; cells whose values are all 0 go."""
    totals = matrix.groupBy(cell, cls).agg(F.sum(value).alias("total")).where("total > 0")
    n = totals.groupBy(cell).agg(F.count("*").alias("n_classes"))
    return majority(totals, cell, cls, "total", threshold).join(n, cell)


def wide_matrix(ix: DataFrame, cell: str, cls: str, code: str, status: str, area: str, cell_area: float, classes: list[str], codes: list[str], threshold: int = 200, statuses: list[str] = [], allowed: tuple[str, ...] = ("A", "B", "C")) -> DataFrame:
    """The whole matrix, one row per cell: a column for each class and each code, how many of each are above 0,
    the majority class with its status, the second value, the difference, and whether it is within the threshold.

    Values are hundredths of a percent by class (or code) and status, added up; ``classes`` and ``codes`` name
    the columns, and with ``statuses`` each has one <name>_<status> for each of these too. The status is the allowed one
    with the largest value in the majority class, ties to the first; null if none of these has a value.
    Areas are added up once and then dealt by cell; all that follows needs no further shuffle.
    """
    known = ix.where(F.col(status).isNotNull())
    sums = known.groupBy(cell, cls, code, status).agg(F.sum(area).alias("_area")).repartition(cell)

    def side(name: str) -> DataFrame:
        """(cell, _e, _s): the names with a value in the cell, largest first, and the values of names and statuses."""
        values = sums.where(F.col(name).isNotNull()).groupBy(cell, name, status).agg(centi_percent(F.sum("_area"), cell_area).alias("_v"))
        good = F.col(status).isin(*allowed) & (F.col("_v") > 0)
        totals = values.groupBy(cell, name).agg(
            F.sum("_v").alias("_t"), F.min(F.when(good, F.struct((-F.col("_v")).alias("v"), F.col(status).alias("s")))).alias("_b"), F.map_from_entries(F.collect_list(F.struct(status, "_v"))).alias("_m")
        ).where("_t > 0")
        entry = F.struct((-F.col("_t")).alias("t"), F.col(name).alias("n"), F.col("_b.s").alias("s"), F.col("_m").alias("m"))
        keyed = F.map_from_entries(F.collect_list(F.struct(F.col(name), F.struct((-entry["t"]).alias("t"), entry["m"].alias("m")))))
        order = F.sort_array(F.collect_list(F.struct(entry["t"].alias("t"), entry["n"].alias("n"), entry["s"].alias("s"))))
        return totals.groupBy(cell).agg(order.alias(f"_{name}"), keyed.alias(f"_{name}_of"))

    out = side(cls).join(side(code), cell, "left")
    first, second = (F.get(f"_{cls}", i) for i in (0, 1))
    summary = {"majority": first["n"], "majority_value": -first["t"], "second": second["n"], "second_value": F.coalesce(-second["t"], F.lit(0))}
    out = out.withColumns(summary | {"n_classes": F.size(f"_{cls}").cast("long"), "n_codes": F.coalesce(F.size(F.col(f"_{code}")).cast("long"), F.lit(0)), "majority_status": first["s"]})
    out = out.withColumn("delta", F.col("majority_value") - F.col("second_value")).withColumn("disputed", F.col("delta") <= threshold)
    value = lambda c, n: F.coalesce(F.try_element_at(f"_{c}_of", F.lit(n))["t"], F.lit(0)).alias(n)
    part = lambda c, n, s: F.coalesce(F.try_element_at(F.try_element_at(f"_{c}_of", F.lit(n))["m"], F.lit(s)), F.lit(0)).alias(f"{n}_{s}")
    wide = [value(c, n) for c, names in ((cls, classes), (code, codes)) for n in names] + [part(c, n, s) for c, names in ((cls, classes), (code, codes)) for n in names for s in statuses]
    return out.select(cell, *summary, "delta", "disputed", "n_classes", "n_codes", "majority_status", *wide)


def coarsen(cells: DataFrame, x: str, y: str, cls: str, resolutions: list[int], modes: list[str] = []) -> DataFrame:
    """Cells by class on coarser grids, all resolutions in one job; the class with most cells wins, ties by name.

    ``modes``: columns whose most frequent value in the coarse cell is given as mode_<column>, ties to the smallest.
    cx and cy are the coarse cell's centre.
    """
    many = cells.withColumn("res", F.explode(F.array(*[F.lit(r) for r in resolutions])))
    many = many.withColumn("gx", F.floor(F.col(x) / F.col("res"))).withColumn("gy", F.floor(F.col(y) / F.col("res")))
    keys = ["res", "gx", "gy"]
    counts = many.groupBy(*keys, cls).agg(F.count("*").alias("n"))
    counts = counts.withColumn("n_cells", F.sum("n").over(Window.partitionBy(*keys)))
    out = dedupe(counts, keys, [F.desc("n"), F.asc_nulls_last(cls)])
    for c in modes:
        most = dedupe(many.where(F.col(c).isNotNull()).groupBy(*keys, c).agg(F.count("*").alias("_n")), keys, [F.desc("_n"), F.asc(c)])
        out = out.join(most.select(*keys, F.col(c).alias(f"mode_{c}")), keys, "left")
    return out.withColumn("cx", (F.col("gx") + 0.5) * F.col("res")).withColumn("cy", (F.col("gy") + 0.5) * F.col("res"))


def majority_grid(cells: DataFrame, summary: DataFrame, cell: str, columns: list[str]) -> DataFrame:
    """Cells with a majority: the summary's columns, south-west corner, centre, and the centre's longitude and latitude."""
    out = cells.select(cell, *columns).join(summary.where(F.col("majority").isNotNull()), cell)
    part = parse_grid_id(F.col(cell))
    out = out.withColumn("_g", part)
    res, n, e = (F.col(f"_g.{c}") for c in ("res", "n", "e"))
    out = out.withColumns({"x0": e * res, "y0": n * res, "cx": (e + 0.5) * res, "cy": (n + 0.5) * res})
    lon, lat = cell_centroid_lonlat(n, e, res)
    return out.withColumn("lon", lon).withColumn("lat", lat).drop("_g")


def matrix_stats(wide: DataFrame, classes: list[str], threshold: int = 200) -> DataFrame:
    """One row: cells, the largest value, flags that are true, and how many flags, class counts and differences do not follow from the class columns."""
    ordered = F.sort_array(F.array(*[F.coalesce(F.col(c), F.lit(0)) for c in classes], F.lit(0)), asc=False)
    above = sum(((F.coalesce(F.col(c), F.lit(0)) > 0).cast("int") for c in classes), F.lit(0))
    return wide.agg(
        F.count("*").alias("n_rows"), F.max(ordered[0]).alias("max_value"), F.count_if("disputed").alias("flag_true"), F.count_if(F.col("disputed") != (F.col("delta") <= threshold)).alias("flag_errors"),
        F.count_if(F.col("n_classes") != above).alias("count_errors"), F.count_if(F.col("delta") != ordered[0] - ordered[1]).alias("delta_errors"),
    )


def drop_bad(polygons: DataFrame, rings: str) -> DataFrame:
    """Polygons without an outer ring of three points or more and an area go, and so do such holes. Rings that cross themselves are not mended."""
    return polygons.withColumn(rings, usable_rings(F.col(rings))).where(F.col(rings).isNotNull())


def explode_parts(polygons: DataFrame, parts: str, rings: str) -> DataFrame:
    """One row for each part of a multipolygon, whose rings are each element of ``parts``."""
    return polygons.select("*", F.posexplode(parts).alias("part", rings)).drop(parts)


def class_share(cells: DataFrame, cls: str) -> DataFrame:
    return share_of_total(cells.groupBy(cls).agg(F.count("*").alias("n")), "n")


def refine_grid(cells: DataFrame, n: str, e: str, factor: int = 10) -> DataFrame:
    """Each cell's factor * factor finer cells."""
    steps = lambda: F.explode(F.sequence(F.lit(0), F.lit(factor - 1)))
    out = cells.withColumn("_i", steps()).withColumn("_j", steps())
    return out.withColumn("fine_n", F.col(n) * factor + F.col("_i")).withColumn("fine_e", F.col(e) * factor + F.col("_j")).drop("_i", "_j")


def parent_join(fine: DataFrame, coarse: DataFrame, n: str, e: str, factor: int = 10) -> DataFrame:
    keyed = fine.withColumn("_pn", F.floor(F.col("fine_n") / factor)).withColumn("_pe", F.floor(F.col("fine_e") / factor))
    parent = coarse.withColumnRenamed(n, "_pn").withColumnRenamed(e, "_pe")
    return keyed.join(parent, ["_pn", "_pe"], "left").withColumnRenamed("_pn", "parent_n").withColumnRenamed("_pe", "parent_e")


def definition_crosstab(df: DataFrame, code: str, stored: str, rules: list[tuple[str, str]]) -> DataFrame:
    """Rows by expected and stored class, with what share of the stored class each makes."""
    out = df.withColumn("expected", classify_prefix(F.col(code), rules, "other")).groupBy("expected", F.col(stored).alias("stored")).agg(F.count("*").alias("n"))
    return out.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("stored")))


def definition_changes(df: DataFrame, code: str, stored: str, rules: list[tuple[str, str]], current: list[tuple[str, str]], critical: float = 0.0) -> DataFrame:
    """Per code: rows, its class by two sets of rules, how many are stored as another class than the first says, and whether that is critical."""
    named = df.withColumn("expected", classify_prefix(F.col(code), rules, "other")).withColumn("current", classify_prefix(F.col(code), current, "other"))
    out = named.groupBy(F.col(code).alias("code"), "expected", "current").agg(F.count("*").alias("n"), F.count_if(~F.col(stored).eqNullSafe(F.col("expected"))).alias("n_mismatch"))
    return out.withColumn("mismatch_share", F.col("n_mismatch") / F.col("n")).withColumn("critical", (F.col("mismatch_share") > critical) | (F.col("expected") != F.col("current")))


def flag_correction(df: DataFrame, delta: str, flag: str, threshold: float) -> DataFrame:
    new = F.col(delta) <= threshold
    return df.agg(F.count_if(F.col(flag)).alias("old_true"), F.count_if(new).alias("new_true"), F.count_if(new != F.col(flag)).alias("changed"))


def matrix_rules(classes: list[str], codes: dict[str, list[str]], limit: int, threshold: int) -> dict:
    """What breaks each rule of validate_matrix(). Columns that are null count as 0, and stored numbers that are null as wrong."""
    values = [F.coalesce(F.col(c), F.lit(0)).cast("double") for c in classes]
    ordered = F.sort_array(F.array(*values, *[F.lit(0.0)] * (len(values) < 2)), asc=False)
    above = lambda columns: F.exists(F.array(*[F.coalesce(F.col(c), F.lit(0)) for c in columns]), lambda v: v > 0).cast("int")
    stored, delta = lambda c: F.coalesce(F.col(c), F.lit(-1)), F.coalesce(F.col("delta"), F.lit(0))
    return {
        "value_above_limit": ordered[0] > limit,
        "delta_above_limit": delta > limit,
        "disputed_mismatch": (delta <= threshold) != F.coalesce(F.col("disputed"), F.lit(False)),
        "n_classes_mismatch": sum((above([c]) for c in classes), F.lit(0)) != stored("n_classes"),
        "n_codes_mismatch": sum((above(columns) for columns in codes.values()), F.lit(0)) != stored("n_codes"),
        "majority_mismatch": stored("majority_value") != F.rint(ordered[0]),
        "second_mismatch": stored("second_value") != F.rint(ordered[1]),
        "delta_mismatch": stored("delta") != F.rint(ordered[0] - ordered[1]),
    }


def validate_matrix(df: DataFrame, classes: list[str], codes: dict[str, list[str]], limit: int = 10000, threshold: int = 200) -> DataFrame:
    """One row: how many rows of a stored matrix break each rule, and how many rules are broken in all.

    What is stored is compared with what its class columns and, for each code, the columns of its statuses say.
    """
    rules = matrix_rules(classes, codes, limit, threshold)
    out = df.agg(F.count("*").alias("n_rows"), *[F.count_if(c).alias(k) for k, c in rules.items()])
    return out.withColumn("issues_total", sum((F.col(k) for k in rules), F.lit(0)))


def matrix_examples(df: DataFrame, cell: str, n: int, classes: list[str], codes: dict[str, list[str]], limit: int = 10000, threshold: int = 200) -> DataFrame:
    """(rule, cell): the first ``n`` cells that break each rule of validate_matrix()."""
    rules = matrix_rules(classes, codes, limit, threshold)
    broken = df.select(cell, F.explode(F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in rules.items()]))).alias("rule"))
    return sample_examples(broken, "rule", cell, n)


def match_summary(matches: DataFrame, key: str | list[str], columns: list[str]) -> DataFrame:
    """Per point: matches, how many values of each column, those values joined, and that it is inside.

    Matches are first counted by point and value, where they are found, so that only a row a value is moved and gathered.
    """
    keys = [key] if isinstance(key, str) else key
    last = len(columns) - 1
    level = {c: 2 ** len(columns) - 1 - 2 ** (last - i) for i, c in enumerate(columns)}  # grouping_id() of a point's values of a column
    counts = matches.groupingSets([[*keys, c] for c in columns] or [keys], *keys, *columns).agg(F.count("*").alias("_n"), F.grouping_id().alias("_level"))
    of = lambda c: F.when(F.col("_level") == level[c], F.col(c))
    joined = lambda c: F.array_join(F.sort_array(F.collect_set(of(c).cast("string"))), "|")
    n = F.sum(F.when(F.col("_level") == (level[columns[0]] if columns else 0), F.col("_n")))
    out = counts.groupBy(*keys).agg(n.alias("n_matches"), *[F.count(of(c)).alias(f"n_{c}") for c in columns], *[joined(c).alias(f"all_{c}") for c in columns])
    return out.withColumn("inside", F.lit(True))
