"""Polygons against grids, points and each other: every edge goes only to the cells that it crosses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import NO_EDGE, area_in_square, crossings, cuts_square, edge_area, edges_of, is_above, met_by, on_edge, spans, terms
from ..functions.scalars import rank_of


#: A square that is parted has so many parts on each side.
SPLIT = 4
#: Up to so many edges of a polygon in a tile are columns, so that points meet them in compiled code.
FEW = 4
#: Points of one place that meet the polygons together.
LOT = 1000


def edges(polygons: DataFrame, keys: list[str], rings: str) -> DataFrame:
    """(keys, edge): one row per edge of each polygon."""
    return polygons.select(*keys, F.explode(edges_of(F.col(rings))).alias("edge"))


def at_x(e: Column, x: Column) -> Column:
    """An edge's height at x."""
    return e["ya"] + (e["yb"] - e["ya"]) * (x - e["xa"]) / F.nullif(e["xb"] - e["xa"], F.lit(0.0))


def heights(e: Column, x0: Column, size: float) -> tuple[Column, Column]:
    """The lowest and highest point of an edge within the column from x0 on."""
    left, right = F.greatest(F.least(e["xa"], e["xb"]), x0), F.least(F.greatest(e["xa"], e["xb"]), x0 + size)
    a, b = F.coalesce(at_x(e, left), e["ya"]), F.coalesce(at_x(e, right), e["yb"])
    return F.least(a, b), F.greatest(a, b)


def downward(keys: list[str], column: str, row: str) -> Window:
    return Window.partitionBy(*keys, column).orderBy(F.desc(row))


def overlay(polygons: DataFrame, keys: list[str], rings: str, res: int) -> DataFrame:
    """(keys, e, n, area): exact area of each polygon in each cell that it covers; ``keys`` tell polygons apart.

    A sweep down each column: an edge adds what lies below it to the cells that it crosses, and its width to a running sum
    from there on, which is the area of the cells below until another edge takes it away. So the rows are
    the cells that edges cross and those that are covered, however high a polygon is.
    """
    e = F.col("edge")
    cut = edges(polygons, keys, rings).where("edge.xa <> edge.xb AND edge.sign <> 0")
    cut = cut.withColumn("e", F.explode(F.sequence(F.floor(F.least(e["xa"], e["xb"]) / res), F.ceil(F.greatest(e["xa"], e["xb"]) / res) - 1)))
    x0 = F.col("e") * F.lit(float(res))
    low, high = heights(e, x0, float(res))
    low, high = F.floor(low / res), F.ceil(high / res) - 1
    width = F.least(F.greatest(e["xa"], e["xb"]), x0 + res) - F.greatest(F.least(e["xa"], e["xb"]), x0)
    part = lambda n: edge_area(e["xa"], e["ya"], e["xb"], e["yb"], x0, n * F.lit(float(res)), F.lit(float(res))) * e["sign"]
    cell = lambda n, fill, part: F.struct(n.alias("n"), fill.alias("fill"), part.alias("part"))
    none = F.lit(0.0)
    crossed = F.when(high >= low, F.transform(F.sequence(low, high), lambda n: cell(n, none, part(n)))).otherwise(F.array().cast("array<struct<n:bigint,fill:double,part:double>>"))
    fill = width * res * F.signum(e["xa"] - e["xb"]) * e["sign"]
    rows = cut.select(*keys, "e", F.explode(F.concat(F.array(cell(low - 1, fill, none)), crossed)).alias("c")).select(*keys, "e", "c.*")
    sums = rows.groupBy(*keys, "e", "n").agg(F.sum("fill").alias("fill"), F.sum("part").alias("part"))
    w = downward(keys, "e", "n")
    swept = sums.withColumn("run", F.sum("fill").over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("next", F.lead("n").over(w))
    least = res * res * 1e-9  # what rounding leaves is no area
    area = lambda n, a: F.struct(n.alias("n"), a.alias("area"))
    below = F.when((F.col("run") > least) & (F.col("next") < F.col("n") - 1), F.transform(F.sequence(F.col("next") + 1, F.col("n") - 1), lambda n: area(n, F.col("run")))).otherwise(F.array().cast("array<struct<n:bigint,area:double>>"))
    return swept.select(*keys, "e", F.explode(F.concat(F.array(area(F.col("n"), F.col("run") + F.col("part"))), below)).alias("c")).select(*keys, "e", "c.*").where(F.col("area") > least)


def tile_index(polygons: DataFrame, keys: list[str], rings: str, tile: float) -> DataFrame:
    """(keys, tx, ty, edges, inside): the tiles that a polygon covers or that its edges touch.

    ``edges`` are those that touch the tile, and ``inside`` says whether the point just right of and just above its
    lower left corner is in the polygon. Tiles within the polygon have no edges. So no edge goes farther than the tiles
    that it touches; corners come from a sweep down each column, as in overlay().
    """
    e, size = F.col("edge"), F.lit(float(tile))
    column = lambda f, axis: F.floor(f(e[f"{axis}a"], e[f"{axis}b"]) / size)
    cut = edges(polygons, keys, rings).withColumn("tx", F.explode(F.sequence(column(F.least, "x"), column(F.greatest, "x"))))
    x0 = F.col("tx") * size
    low, high = heights(e, x0, float(tile))
    slack = tile * 1e-9  # a tile too many does no harm
    low, high = F.floor((low - slack) / size), F.floor((high + slack) / size)
    guess = F.floor(at_x(e, x0) / size)
    highest = F.when(is_above(e, x0, (guess + 1) * size), guess + 1).when(is_above(e, x0, guess * size), guess).when(is_above(e, x0, (guess - 1) * size), guess - 1)
    cut = cut.withColumns({"low": low, "high": high, "corner": F.when(spans(e, "x", x0), highest)})
    least, most = (F.coalesce(f(c, "corner"), c) for f, c in ((F.least, F.col("low")), (F.greatest, F.col("high"))))
    rows = cut.withColumn("ty", F.explode(F.sequence(least, most)))
    touched, crosses = F.col("ty").between(F.col("low"), F.col("high")), F.coalesce(F.col("ty") == F.col("corner"), F.lit(False)).cast("int")
    rows = rows.select(*keys, "tx", "ty", F.when(touched, e).alias("edge"), crosses.alias("crosses"))
    tiles = rows.groupBy(*keys, "tx", "ty").agg(F.collect_list("edge").alias("edges"), F.sum("crosses").alias("crosses"))
    w = downward(keys, "tx", "ty")
    swept = tiles.withColumn("inside", F.sum("crosses").over(w.rowsBetween(Window.unboundedPreceding, 0)) % 2 == 1).withColumn("next", F.lead("ty").over(w))
    kind = "array<struct<ty:bigint,edges:array<struct<xa:double,ya:double,xb:double,yb:double,sign:double>>,inside:boolean>>"
    own = F.struct("ty", "edges", "inside")
    below = F.when(F.col("inside") & (F.col("next") < F.col("ty") - 1), F.transform(F.sequence(F.col("next") + 1, F.col("ty") - 1), lambda n: F.struct(n.alias("ty"), F.slice("edges", 1, 0).alias("edges"), F.lit(True).alias("inside"))))
    out = swept.select(*keys, "tx", F.explode(F.concat(F.array(own).cast(kind), F.coalesce(below.cast(kind), F.array().cast(kind)))).alias("r")).select(*keys, "tx", "r.*")
    return out.where(F.col("inside") | (F.size("edges") > 0))


def assign_polygons(points: DataFrame, polygons: DataFrame, rings: str, tile: int, keys: list[str] | None = None) -> DataFrame:
    """All polygons that hold a point strictly inside, with the columns of both; points without coordinates are in none.

    A point meets the tiles of its place in the polygons' index; there the edges between it and the tile's corner
    decide, and in a tile without edges nothing is left to test. ``keys`` tell polygons apart, all their columns unless given.
    Points of one place are tested once. Points and tiles are shuffled, never broadcast: the size of
    a file says little on that of its rows, and the driver would gather them.
    """
    own = [c for c in polygons.columns if c != rings]
    keys = keys or own
    # few rows, much work: as many tasks as there are partitions
    parts = int(polygons.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    index = tile_index(polygons.repartition(parts, *keys), keys, rings, tile).repartition(parts, "tx", "ty")
    size, x, y = F.lit(float(tile)), F.col("_x"), F.col("_y")
    corner = F.col("tx") * size, F.col("ty") * size
    placed = points.select(F.struct(*points.columns).alias("_p"), F.col("x").cast("double").alias("_x"), F.col("y").cast("double").alias("_y")).where(~F.isnan("_x") & ~F.isnan("_y"))
    placed = placed.withColumns({"tx": F.floor(x / size), "ty": F.floor(y / size)}).repartition(parts, "tx", "ty")
    lot = F.floor((F.row_number().over(Window.partitionBy("tx", "ty", "_x", "_y").orderBy("_x")) - 1) / LOT)
    placed = placed.withColumn("_lot", lot).groupBy("tx", "ty", "_x", "_y", "_lot").agg(F.collect_list("_p").alias("_p"))
    placed = placed.select("tx", "ty", F.coalesce("_x", F.lit(0.0)).alias("_x"), F.coalesce("_y", F.lit(0.0)).alias("_y"), "_p")  # never null, so that no test of nulls is compiled

    def met(kind: Column, row: Column, columns: dict[str, Column], found: Column) -> DataFrame:
        """Tiles of one kind with their points. They are parted behind the shuffle, so that there is one for both kinds."""
        part = index.select(*keys, "tx", "ty", F.coalesce("inside", F.lit(False)).alias("_inside"), F.explode_outer(F.when(kind, F.array(row))).alias("_row")).where("_row IS NOT NULL")
        part = part.select(*keys, "tx", "ty", "_inside", *[c.alias(k) for k, c in columns.items()])
        return placed.hint("merge").join(part, ["tx", "ty"]).where(found).select(F.inline("_p"), *keys)

    names = list(terms({c: F.lit(0.0) for c in ("xa", "ya", "xb", "yb")}, *corner))
    of_edges = F.transform("edges", lambda e: F.struct(*[c.alias(k) for k, c in terms(e, *corner).items()]))
    columns, inside, border = {}, F.col("_inside"), F.lit(False)
    for i in range(FEW):
        columns |= {f"_{k}{i}": F.coalesce(F.get("_row", F.lit(i))[k], F.lit(NO_EDGE.get(k, 0.0))) for k in names}
        up, right, on = met_by({k: F.col(f"_{k}{i}") for k in names}, x, y)
        inside, border = inside != (up != right), border | on
    few = met(F.size("edges") <= FEW, of_edges, columns, inside & ~border)
    odd = crossings(F.col("_edges"), *corner, x, y) % 2 == 1
    many = met(F.size("edges") > FEW, F.col("edges"), {"_edges": F.col("_row")}, (F.col("_inside") != odd) & ~F.exists("_edges", lambda e: on_edge(e, x, y)))
    found = few.unionByName(many)
    return found if set(keys) == set(own) else found.join(polygons.select(*own), keys)


def resolve_overlaps(polygons: DataFrame, keys: list[str], cls: str, year: str, status: str, src: str, rings: str, res: float, levels: int = 3) -> DataFrame:
    """(keys, area): what is left of each polygon when better ones of its class take what both cover.

    The newer year wins, then the better status, then the smaller source id. Squares of ``res`` * 4^``levels`` are
    parted into 4 x 4 where edges of two polygons or more pass that still count there: not those below a polygon that
    covers the square. In all others the areas are exact: one polygon's edges leave the rest to what covers the square
    below. At ``res`` the square's centre decides, so the error is at most one such square wherever edges
    of two polygons meet in it. A polygon that has lost everything goes. ``keys`` tell polygons apart and hold the other columns.
    """
    own = list(dict.fromkeys([*keys, cls, year, status, src]))
    top = float(res * SPLIT**levels)
    index = tile_index(polygons, own, rings, top)
    best = F.struct(F.coalesce(F.col(year).cast("long"), F.lit(-1)).alias("y"), rank_of(F.col(status)).alias("s"), (-F.col(src)).alias("i"), F.struct(*keys).alias("k"))
    inner = lambda edges, x0, y0, size: F.filter(edges, lambda e: cuts_square(e, x0, y0, size))
    x0, y0, size = F.col("x0"), F.col("y0"), F.col("size")
    cells = index.select(F.col(cls).alias("cls"), best.alias("best"), "tx", "ty", (F.col("tx") * top).alias("x0"), (F.col("ty") * top).alias("y0"), F.lit(top).alias("size"), "edges", "inside")
    cells = cells.withColumn("edges", inner(F.col("edges"), x0, y0, size)).where("inside OR size(edges) > 0")
    # few rows, much work: as many tasks as there are partitions
    cells = cells.repartition(int(polygons.sparkSession.conf.get("spark.sql.shuffle.partitions")), "cls", "tx", "ty")
    w = Window.partitionBy("cls", "tx", "ty", "x0", "y0", "size")

    def counted(df: DataFrame) -> DataFrame:
        """Those that still count in their square, and how many of them have edges in it."""
        full = F.size("edges") == 0
        df = df.withColumn("cover", F.max(F.when(full, F.col("best"))).over(w)).where("cover IS NULL OR best >= cover")
        return df.withColumn("open", F.count_if(F.size("edges") > 0).over(w))

    cells = counted(cells)
    steps = F.array(*[F.struct(F.lit(float(i)).alias("i"), F.lit(float(j)).alias("j")) for i in range(SPLIT) for j in range(SPLIT)])
    whole = F.array(F.struct(F.lit(-1.0).alias("i"), F.lit(-1.0).alias("j")))
    split = F.col("step.i") >= 0
    part = F.when(split, size / SPLIT).otherwise(size)
    moved = lambda c, k: F.when(split, F.col(c) + F.col(f"step.{k}") * size / SPLIT).otherwise(F.col(c))
    nx, ny = F.col("nx"), F.col("ny")
    kept = F.when(split, inner(F.col("edges"), nx, ny, F.col("part"))).otherwise(F.col("edges"))
    turned = F.when(split, F.col("inside") != (crossings(F.col("edges"), x0, y0, nx, ny) % 2 == 1)).otherwise(F.col("inside"))
    for _ in range(levels):
        parts = cells.withColumn("step", F.explode(F.when(F.col("open") > 1, steps).otherwise(whole))).withColumns({"part": part, "nx": moved("x0", "i"), "ny": moved("y0", "j")})
        parts = parts.withColumns({"kept": kept, "turned": turned})  # under new names: within a lambda a new x0 would hide the old one
        cells = counted(parts.select("cls", "best", "tx", "ty", nx.alias("x0"), ny.alias("y0"), F.col("part").alias("size"), F.col("kept").alias("edges"), F.col("turned").alias("inside")).where("inside OR size(edges) > 0"))
    centre = F.col("inside") != (crossings(F.col("edges"), x0, y0, x0 + size / 2, y0 + size / 2) % 2 == 1)
    cells = cells.withColumn("part", F.when(F.size("edges") > 0, area_in_square(F.col("edges"), F.col("inside"), x0, y0, size)).otherwise(0.0))
    cells = cells.withColumn("taken", F.sum("part").over(w)).withColumn("first", F.max(F.when(centre, F.col("best"))).over(w))
    exact = F.when(F.size("edges") > 0, F.col("part")).otherwise(size * size - F.col("taken"))
    area = F.when(F.col("open") < 2, exact).when(F.col("best") == F.col("first"), size * size).otherwise(0.0)
    out = cells.groupBy("best").agg(F.sum(area).alias("area")).where(F.col("area") > float(res) ** 2 * 1e-9)
    return out.select("best.k.*", "area")
