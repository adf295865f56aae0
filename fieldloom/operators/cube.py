"""Cubes and rasters as long tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import coded, hour_series, window_hours


#: Nodes of an axis, at most; axes are broadcast as arrays.
MAX_AXIS = 1 << 20


def axes_of(cube: DataFrame) -> DataFrame:
    """One row (xs, ys): the sorted coordinates of a cube's nodes."""
    sized = lambda c: F.when(F.size(c) <= MAX_AXIS, c).otherwise(F.raise_error(F.lit("an axis has too many nodes")))
    out = cube.agg(*[F.sort_array(F.collect_set(c)).alias(f"{c}s") for c in "xy"])
    return out.select(*[sized(F.col(c)).alias(c) for c in ("xs", "ys")])


def nearest(axis: Column, v: Column) -> Column:
    """The value of a sorted array that is nearest, by binary search; of two as near, the larger one."""
    n = F.size(axis)
    half = lambda s: F.shiftright(s["low"] + s["high"], 1)
    narrowed = lambda s, _: F.when(s["low"] >= s["high"], s).when(F.try_element_at(axis, half(s)) < v, F.struct((half(s) + 1).alias("low"), s["high"].alias("high"))).otherwise(F.struct(s["low"].alias("low"), half(s).alias("high")))
    steps = F.sequence(F.lit(1), F.ceil(F.log2(n + 1)).cast("int"))
    first = F.aggregate(steps, F.struct(F.lit(1).alias("low"), (n + 1).alias("high")), narrowed)["low"]
    below, above = F.try_element_at(axis, F.greatest(first - 1, F.lit(1))), F.try_element_at(axis, F.greatest(F.least(first, n), F.lit(1)))
    return F.when((n > 0) & v.isNotNull() & ~F.isnan(v), F.when(v - below < above - v, below).otherwise(above))


def sample_cube(points: DataFrame, cube: DataFrame, key: str, variables: list[str], days: int, tz: str, margin: float = 500.0, axes: DataFrame | None = None) -> DataFrame:
    """(key, var, hour, local, value, inside): each variable at the nearest node for every hour of each point's window.

    ``points``: key, x, y and ts, the local clock time in ``tz``; the window has the day of ts and ``days`` times 24 hours
    before. ``cube``: var, x, y, ts (UTC), value on any sorted axes, one row a node and hour. ``axes`` is the row of axes_of(), if
    it is known. A point over ``margin`` outside the axes is not inside and has no values; hours that the cube
    lacks have none either. Only the hours between the first and the last window are read of the cube.
    """
    near_axis = lambda c: F.col(c).between(F.try_element_at(f"{c}s", F.lit(1)) - margin, F.try_element_at(f"{c}s", F.lit(-1)) + margin)
    inside = F.coalesce(near_axis("x") & near_axis("y"), F.lit(False))
    window = points.select(key, "x", "y", window_hours(F.col("ts"), days, tz).alias("w"))
    first, last = window.agg(F.min("w.first"), F.max("w.last")).first()
    own = window.crossJoin(F.broadcast(axes_of(cube) if axes is None else axes)).withColumn("inside", inside)  # one row
    nodes = own.select(key, "inside", "w", *[F.when(F.col("inside"), nearest(F.col(f"{c}s"), F.col(c).cast("double"))).alias(f"n{c}") for c in "xy"])
    asked = nodes.select(key, "inside", "nx", "ny", F.explode(hour_series(F.col("w.first"), F.col("w.last"))).alias("hour"))
    asked = asked.withColumn("var", F.explode(F.array(*[F.lit(v) for v in variables])))
    read = cube.where(F.col("var").isin(variables))
    if first is not None:
        read = read.where(F.col("ts").between(F.lit(first), F.lit(last)))
    read = read.select("var", F.col("x").alias("nx"), F.col("y").alias("ny"), F.col("ts").alias("hour"), "value")
    out = asked.join(read, ["var", "nx", "ny", "hour"], "left")
    return out.select(key, "var", "hour", F.from_utc_timestamp("hour", tz).alias("local"), "value", "inside")


def monthly_quantiles(cube: DataFrame, probabilities: list[float], scale: int, nodata: int, accuracy: int | None = None) -> DataFrame:
    """Scaled quantiles of the finite values by variable, node and month, as 16-bit numbers; a month without values is nodata.

    Exact: equal values count together, and a running count of the sorted values gives those next to each quantile's place.
    No group is gathered in memory, so a month may have any number of years; a month's values are
    sorted on disk if need be. With ``accuracy`` from a bounded sketch of them instead.
    """
    v = F.when(F.abs("value") < float("inf"), F.col("value"))
    keys = ["var", "x", "y", "month"]
    cube = cube.select("var", "x", "y", F.month("ts").alias("month"), v.alias("value"))
    if accuracy is not None:
        out = cube.groupBy(*keys).agg(F.percentile_approx("value", F.array(*[F.lit(p) for p in probabilities]), accuracy).alias("q"))
        return out.select(*keys, *[scaled(F.col("q")[i], scale, nodata).alias(f"p{round(p * 100)}") for i, p in enumerate(probabilities)])
    counts = cube.groupBy(*keys, "value").agg(F.count("value").alias("n"))
    w = Window.partitionBy(*keys)
    ranked = counts.withColumn("upto", F.sum("n").over(w.orderBy(F.asc_nulls_first("value")))).withColumn("total", F.sum("n").over(w))
    columns, places = [], []
    for k, p in enumerate(probabilities):
        at = (F.col("total") - 1) * F.lit(p)
        low = F.floor(at)
        has = lambda i: (F.col("upto") > i) & (F.col("upto") - F.col("n") <= i)
        places += [F.max(F.when(has(low), F.col("value"))).alias(f"a{k}"), F.max(F.when(has(F.least(low + 1, F.col("total") - 1)), F.col("value"))).alias(f"b{k}"), F.max(at - low).alias(f"t{k}")]
        a, b, t = F.col(f"a{k}"), F.col(f"b{k}"), F.col(f"t{k}")
        columns.append(scaled(F.when(t < 0.5, a + (b - a) * t).otherwise(b - (b - a) * (1 - t)), scale, nodata).alias(f"p{round(p * 100)}"))
    return ranked.groupBy(*keys).agg(*places).select(*keys, *columns)


#: Nodes on a side of a lattice block.
BLOCK = 8


def lattice_blocks(nodes: DataFrame, keys: list[str], block: int = BLOCK) -> DataFrame:
    """(keys, bi, bj, values): a lattice (keys, i, j, value) as blocks of arrays, row by row, null where a node is missing.

    A block has ``block`` nodes a side and one more, the first ones of the blocks behind it, so that all nodes around a
    place within a block are in its array.
    """
    side = block + 1
    homes = lambda c: F.when(F.pmod(c, F.lit(block)) == 0, F.array(F.floor(c / block), F.floor(c / block) - 1)).otherwise(F.array(F.floor(c / block)))
    dealt = nodes.select(*keys, "i", "j", "value", F.explode(homes(F.col("i"))).alias("bi")).withColumn("bj", F.explode(homes(F.col("j"))))
    at = (F.col("i") - F.col("bi") * block) * side + F.col("j") - F.col("bj") * block
    found = dealt.groupBy(*keys, "bi", "bj").agg(F.map_from_entries(F.collect_list(F.struct(at.cast("int").alias("at"), "value"))).alias("m"))
    return found.select(*keys, "bi", "bj", F.transform(F.sequence(F.lit(0), F.lit(side * side - 1)), lambda k: F.try_element_at("m", k)).alias("values"))


def resample_to_grid(blocks: DataFrame, cells: DataFrame, x0: float, y0: float, step: float, keys: list[str], project=None, scale: int | None = None, nodata: int = -32768, block: int = BLOCK) -> DataFrame:
    """``cells`` (x, y and others) with the bilinear mean of the four lattice nodes around them for each of ``keys``.

    ``blocks``: lattice_blocks() of nodes that stand ``step`` apart from (x0, y0) on. ``project`` takes a cell's x and y to
    the lattice's projection. A cell meets the one block that it lies in. Null and missing nodes leave the mean
    to the others by their weights; a cell without any, in a block of the lattice, has no value. With
    ``scale`` values are 16-bit numbers, scaled and rounded, and ``nodata`` where there is none.
    """
    px, py = project(F.col("x"), F.col("y")) if project else (F.col("x"), F.col("y"))
    # a generator keeps the projection from being worked out anew wherever its result is used
    placed = cells.select("*", F.inline(F.array(F.struct(((px - x0) / step).alias("_u"), ((py - y0) / step).alias("_v")))))
    placed = placed.withColumns({"bi": F.floor(F.floor("_u") / block), "bj": F.floor(F.floor("_v") / block)})
    met = placed.join(blocks, ["bi", "bj"])
    u, v = F.col("_u") - F.col("bi") * block, F.col("_v") - F.col("bj") * block
    corners = [((F.floor(u) + i), (F.floor(v) + j)) for i in (0, 1) for j in (0, 1)]
    value = lambda i, j: F.get("values", (i * (block + 1) + j).cast("int"))
    weight = lambda i, j: F.when(value(i, j).isNotNull(), (1 - F.abs(u - i)) * (1 - F.abs(v - j))).otherwise(0.0)
    total = sum((weight(i, j) for i, j in corners), F.lit(0.0))
    mean = sum((weight(i, j) * F.coalesce(value(i, j), F.lit(0.0)) for i, j in corners), F.lit(0.0)) / F.nullif(total, F.lit(0.0))
    out = met.withColumn("value", mean).select(*keys, *cells.columns, "value")
    return out if scale is None else out.withColumn("value", scaled(F.col("value"), scale, nodata))


def scaled(q: Column, scale: int, nodata: int) -> Column:
    """A value as a 16-bit number, nodata if it is null."""
    kept = F.when(q.isNotNull(), F.least(F.greatest(F.rint(q * scale), F.lit(-32768.0)), F.lit(32767.0)))
    return F.coalesce(kept, F.lit(float(nodata))).cast("short")


def tile_layout(bounds: DataFrame, tile: float) -> DataFrame:
    """(tx, ty, xmin, ymin): the tiles that cover the bounds (one row), by stable numbers from the origin."""
    span = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / tile), F.greatest(F.ceil(F.col(b) / tile) - 1, F.floor(F.col(a) / tile))))
    out = bounds.withColumn("tx", span("xmin", "xmax")).withColumn("ty", span("ymin", "ymax"))
    return out.select("tx", "ty", (F.col("tx") * tile).alias("xmin"), (F.col("ty") * tile).alias("ymin"))


def band_stats(pixels: DataFrame, nodata: float) -> DataFrame:
    v = F.when((F.col("value") != nodata) & ~F.isnan("value"), F.col("value"))
    out = pixels.groupBy("file", "band").agg(F.count(v).alias("n_valid"), F.count_if(v.isNull()).alias("n_invalid"), F.min(v).alias("min"), F.max(v).alias("max"), F.avg(v).alias("mean"), F.stddev_pop(v).alias("std"))
    return out.withColumn("status", F.when(F.col("n_valid") == 0, "all_nodata").when(F.col("min") == F.col("max"), "constant").otherwise("ok"))


def raster_stats(pixels: DataFrame, nodata: float, bands: int | None = None, max_nodata: float = 1.0) -> DataFrame:
    """Per file: bands, values, nodata, NaN and infinite ones, the share without a finite value, extremes and issue codes."""
    is_nodata = F.col("value").isNull() | (F.col("value") == nodata)
    nan, inf = ~is_nodata & F.isnan("value"), ~is_nodata & (F.abs("value") == float("inf"))
    v = F.when(~is_nodata & ~F.isnan("value") & (F.abs("value") < float("inf")), F.col("value"))
    out = pixels.groupBy("file").agg(
        F.count_distinct("band").alias("n_bands"), F.count("*").alias("n_values"), F.count_if(is_nodata).alias("n_nodata"), F.count_if(nan).alias("n_nan"), F.count_if(inf).alias("n_inf"),
        F.count(v).alias("n_finite"), F.min(v).alias("min"), F.max(v).alias("max"),
    )
    out = out.withColumn("empty_fraction", 1 - F.col("n_finite") / F.col("n_values"))
    codes = coded(
        (F.lit(False) if bands is None else F.col("n_bands") != bands, "unexpected_band_count"), (F.col("n_finite") == 0, "all_nodata"), (F.col("n_nan") > 0, "nan_values"), (F.col("n_inf") > 0, "infinite_values"),
        ((F.col("n_finite") > 0) & (F.col("empty_fraction") > max_nodata), "too_much_nodata"), (F.col("min") == F.col("max"), "constant"),
    )
    return out.withColumn("codes", codes)


def constant_lines(pixels: DataFrame, nodata: float) -> DataFrame:
    """Rows and columns of each band that are constant or hold no data."""
    v = F.when(F.col("value") != nodata, F.col("value"))

    def lines(axis: str) -> DataFrame:
        out = pixels.groupBy("file", "band", F.lit(axis).alias("axis"), F.col(axis).alias("line")).agg(F.count(v).alias("n"), F.min(v).alias("lo"), F.max(v).alias("hi"), F.count("*").alias("n_all"))
        kind = F.when(F.col("n") == 0, "nodata").when((F.col("lo") == F.col("hi")) & (F.col("n_all") > 1), "constant")
        return out.select("file", "band", "axis", "line", kind.alias("kind")).where("kind IS NOT NULL")

    return lines("row").unionByName(lines("col"))
