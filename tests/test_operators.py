import collections
import glob
import math
import os
import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fieldloom.functions import scalars as S
from fieldloom.functions.geo import lonlat_to_laea, point
from fieldloom.operators import changes, cube, inventory, landcover, master, ranking, shapes, species
from fieldloom.plans import queries as plans
from fieldloom.sources import tables
from fieldloom.streaming.updates import fold_batch, read_upserted, stream_new_files, stream_upsert

SF = "/root/testdata/sf0.001"


def ordered(df):
    df = df[sorted(df.columns)]
    return df.sort_values(list(df.columns)).reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(plans.SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    got = plans.QUERIES[name](spark, SF).toPandas()
    pd.testing.assert_frame_equal(ordered(got), ordered(con.sql(plans.SQL[name]).df()), check_dtype=False)


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_ids_and_codes(spark):
    cases = {"12.0": "12", " 7": "7", "x": "", "": "", "nan": ""}
    for text, want in cases.items():
        assert one(spark, S.normalise_id(F.lit(text))) == want
    assert one(spark, S.truthy(F.lit(" Yes "))) is True and one(spark, S.truthy(F.lit("1.0"))) is False
    assert one(spark, S.normalise_code(F.lit(" 9110.0 "))) == "9110" and one(spark, S.normalise_code(F.lit("nan"))) is None
    assert one(spark, S.split_issues(F.lit("Bad Tone: 3 | ;x"))) == ["bad_tone", "x"]
    assert one(spark, S.hash_shard(F.lit("123"), 16)) == 13


def test_times(spark):
    wall = lambda t: one(spark, S.parse_walltime(F.lit(t), "Europe/Berlin"))
    assert str(wall("2024-05-01T04:30:00+02:00")) == "2024-05-01 04:30:00"
    assert wall("invalid") is None and wall("2024-03-31 02:30:00") is None and wall("2024-10-27 02:30:00") is None
    assert one(spark, S.format_iso_offset(F.lit("2024-07-01 10:00:00").cast("timestamp"), "Europe/Berlin")) == "2024-07-01T10:00:00+02:00"
    assert one(spark, S.month_in_window(F.lit(1), F.lit(10), F.lit(2))) is True


def test_projection_example(spark):
    x, y = lonlat_to_laea(F.lit(5.0), F.lit(50.0))
    assert abs(one(spark, x) - 3962799.451) < 0.01 and abs(one(spark, y) - 2999718.853) < 0.01


def ring(*corners):
    return F.array(*[point(F.lit(x), F.lit(y)) for x, y in corners])


def square(x, y, size):
    return ring((x, y), (x + size, y), (x + size, y + size), (x, y + size))


def test_triangle_areas_add_up(spark):
    rings = F.array(ring((10, 10), (290, 40), (120, 280)))
    got = shapes.overlay(spark.range(1).select("id", rings.alias("rings")), ["id"], "rings", 100)
    assert abs(got.agg(F.sum("area")).first()[0] - abs((280 * 270 - 30 * 110) / 2)) < 1e-6


OUTER = [(13.0, 7.0), (305.0, 61.0), (250.0, 180.0), (310.0, 330.0), (40.0, 290.0), (90.0, 150.0)]
HOLE = [(120.0, 110.0), (220.0, 120.0), (180.0, 230.0)]


def shoelace(p):
    return abs(sum(x0 * y1 - x1 * y0 for (x0, y0), (x1, y1) in zip(p, p[1:] + p[:1]))) / 2


def in_rings(rings, x, y):
    odd = False
    for r in rings:
        for (xa, ya), (xb, yb) in zip(r, r[1:] + r[:1]):
            if (ya > y) != (yb > y) and x < xa + (xb - xa) * (y - ya) / (yb - ya):
                odd = not odd
    return odd


def star(rng, x, y, n, size, whole=False):
    """A ring of n points around a place, on whole coordinates if asked, so that edges meet corners and borders of cells."""
    angles = sorted(rng.uniform(0, 6.283) for _ in range(n))
    at = [(x + math.cos(a) * rng.uniform(0.4, 1) * size, y + math.sin(a) * rng.uniform(0.4, 1) * size) for a in angles]
    return [(float(round(a / 10) * 10), float(round(b / 10) * 10)) if whole else (a, b) for a, b in at]


def is_simple(r):
    cross = lambda o, a, b: (a[0] - o[0]) * (b[1] - o[1]) - (a[1] - o[1]) * (b[0] - o[0])
    pairs = [(r[i], r[(i + 1) % len(r)], r[j], r[(j + 1) % len(r)]) for i in range(len(r)) for j in range(i + 2, len(r)) if (i, j) != (0, len(r) - 1)]
    return shoelace(r) > 0 and not any(cross(a, b, p) * cross(a, b, q) <= 0 and cross(p, q, a) * cross(p, q, b) <= 0 for a, b, p, q in pairs)


def as_rings(spark, polygons):
    """(id, rings) of lists of rings."""
    rows = [(i, [[{"x": x, "y": y} for x, y in r] for r in rings]) for i, rings in enumerate(polygons)]
    return spark.createDataFrame(rows, "id long, rings array<array<struct<x:double,y:double>>>")


def test_overlay_of_any_polygon_matches_small_cells(spark):
    """Areas by cell against the number of points of a fine lattice inside, with a hole, in either direction of the rings."""
    polygons = [[OUTER, HOLE], [OUTER[::-1], HOLE], [OUTER, HOLE[::-1]]]
    got = shapes.overlay(as_rings(spark, polygons), ["id"], "rings", 100).collect()
    for k, rings in enumerate(polygons):
        cells = {(r["e"], r["n"]): r["area"] for r in got if r["id"] == k}
        small = collections.Counter((i // 50, j // 50) for i in range(200) for j in range(200) if in_rings(rings, 2 * i + 1, 2 * j + 1))
        assert set(small) <= set(cells) and all(abs(cells[c] - 4 * n) < 400 for c, n in small.items())
        assert abs(sum(cells.values()) - shoelace(OUTER) + shoelace(HOLE)) < 1e-6


def test_edges_go_to_no_more_cells_than_they_cross(spark):
    """A high polygon with many short edges: rows of overlay() and of the tile index follow crossed and covered cells."""
    n = 2000
    left = [(float(i % 2), i * 10.0) for i in range(n)]
    polygon = [[*left, (250.0, (n - 1) * 10.0), (250.0, 0.0)]]
    df = as_rings(spark, [polygon])
    out = shapes.overlay(df, ["id"], "rings", 100)
    assert out.count() == 3 * 200 and abs(out.agg(F.sum("area")).first()[0] - shoelace(polygon[0])) < 1e-3
    swept = out._jdf.queryExecution().optimizedPlan().toString()
    assert swept.count("Generate explode") == 4  # of edges, their columns, the cells that they cross, and those between
    index = shapes.tile_index(df, ["id"], "rings", 100.0).select("tx", "ty", F.size("edges").alias("n"), "inside").collect()
    assert sum(r["n"] for r in index) < 2 * n and max(r["n"] for r in index) < 40 and sum(r["n"] == 0 and r["inside"] for r in index) > 150


@pytest.mark.parametrize("seed", [1, 2])
def test_index_areas_and_points_match_overlay_and_ray_casting(spark, seed):
    """Stars on whole coordinates, tiles with corners on them: areas of tiles as overlay() has them, points by a ray."""
    from fieldloom.functions.geo import area_in_square, cuts_square

    rng = random.Random(seed)
    polygons = [[OUTER, HOLE], *[[star(rng, rng.uniform(0, 200), rng.uniform(0, 200), 9, 150, k % 2 == 0)] for k in range(12)]]
    polygons = [p for p in polygons if all(map(is_simple, p))]
    df = as_rings(spark, polygons)
    corner = F.col("tx") * 50.0, F.col("ty") * 50.0, F.lit(50.0)
    index = shapes.tile_index(df, ["id"], "rings", 50.0).withColumn("edges", F.filter("edges", lambda e: cuts_square(e, *corner)))
    areas = {(r["id"], r["tx"], r["ty"]): r["a"] for r in index.select("id", "tx", "ty", area_in_square(F.col("edges"), F.col("inside"), *corner).alias("a")).collect()}
    want = {(r["id"], r["e"], r["n"]): r["area"] for r in shapes.overlay(df, ["id"], "rings", 50).collect()}
    assert set(want) <= set(areas) and all(abs(a - want.get(k, 0.0)) < 1e-5 for k, a in areas.items())
    points = [(i, rng.choice([rng.uniform(-50, 350), 50.0 * rng.randrange(6)]), rng.choice([rng.uniform(-50, 350) + 1e-3, 10.0 * rng.randrange(30)])) for i in range(400)]
    found = {(r["id"], r["pid"]) for r in shapes.assign_polygons(spark.createDataFrame(points, "pid long, x double, y double"), df, "rings", 50, ["id"]).collect()}

    def border(rings, x, y):
        return any(min(a[0], b[0]) <= x <= max(a[0], b[0]) and min(a[1], b[1]) <= y <= max(a[1], b[1]) and abs((b[0] - a[0]) * (y - a[1]) - (b[1] - a[1]) * (x - a[0])) < 1e-9 for r in rings for a, b in zip(r, r[1:] + r[:1]))

    assert found == {(k, i) for k, rings in enumerate(polygons) for i, x, y in points if in_rings(rings, x, y) and not border(rings, x, y)} and len(found) > 300


def test_overlaps_of_any_polygons_come_near_small_cells(spark):
    rng = random.Random(7)
    polygons = [[r] for r in (star(rng, rng.uniform(50, 150), rng.uniform(50, 150), 8, 90, True) for _ in range(12)) if is_simple(r)][:7]
    rows = as_rings(spark, polygons).select("id", (F.col("id") % 2).alias("cls"), (F.col("id") % 3).cast("int").alias("year"), F.lit("A").alias("status"), "rings")
    got = {r["id"]: r["area"] for r in shapes.resolve_overlaps(rows, ["id"], "cls", "year", "status", "id", "rings", 0.5).collect()}
    taken = collections.Counter()
    for i in range(600):
        for j in range(600):
            inside = [k for k, rings in enumerate(polygons) if in_rings(rings, i / 2 - 50 + 0.26, j / 2 - 50 + 0.27)]
            for c in (0, 1):
                if own := [k for k in inside if k % 2 == c]:
                    taken[max(own, key=lambda k: (k % 3, -k))] += 0.25
    assert set(taken) - {k for k, a in taken.items() if a < 50} <= set(got) and all(abs(got.get(k, 0) - a) < 0.02 * a + 60 for k, a in taken.items())
    alone = shapes.resolve_overlaps(rows.where("id = 3"), ["id"], "cls", "year", "status", "id", "rings", 64.0).first()["area"]
    assert abs(alone - shoelace(polygons[3][0])) < 1e-6  # no other polygon: exact at any size


def test_points_on_borders_and_in_holes_are_outside(spark):
    rings = F.array(square(0, 0, 100), square(40, 40, 20))
    polys = spark.range(1).select(F.lit(7).alias("poly"), rings.alias("rings"))
    points = spark.createDataFrame([(1, 10.0, 10.0), (2, 50.0, 50.0), (3, 0.0, 50.0), (4, 40.0, 50.0), (5, 100.0, 100.0), (6, 99.0, 1.0), (7, 130.0, 50.0)], "id long, x double, y double")
    assert sorted(r["id"] for r in shapes.assign_polygons(points, polys, "rings", 30).collect()) == [1, 6]
    bad = spark.range(1).select(F.array(ring((0, 0), (1, 1))).alias("rings"))
    assert landcover.drop_bad(bad, "rings").count() == 0 and landcover.drop_bad(polys, "rings").count() == 1
    parts = spark.range(1).select(F.array(F.array(square(0, 0, 1)), F.array(square(5, 5, 1))).alias("parts"))
    assert landcover.explode_parts(parts, "parts", "rings").count() == 2


def broadcasts(df):
    """Tables that the plan broadcasts, as it was made for sizes of files below Spark's limit."""
    return df._jdf.queryExecution().executedPlan().toString().count("BroadcastExchange")


def test_points_meet_polygons_without_broadcast_and_in_compiled_code(spark):
    """Few bytes of a file may be many points: none are gathered on the driver. Edges in columns are tested in a method that is small enough to be compiled."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        out = plans.points_in_polygons(spark, SF)
        assert broadcasts(out) == 0
        debug = spark._jvm.org.apache.spark.sql.execution.debug.__getattr__("package$").__getattr__("MODULE$")
        parts = debug.codegenString(out._jdf.queryExecution().executedPlan()).split("== Subtree ")
        sizes = [int(x.split("maxMethodCodeSize:")[1].split(";")[0]) for x in parts if "SortMergeJoin [tx" in x[:3000] and "_dx0" in x]
        assert sizes and max(sizes) < 8000  # the JVM compiles no longer ones
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_points_of_one_place_and_points_that_are_nowhere(spark):
    """All points of a place are found, however many; NaN is no place, though tile 0 is covered; decimals are places as doubles are."""
    polys = spark.range(2).select((F.col("id") + 7).alias("poly"), F.array(square(-50, -50, 200)).alias("rings"))
    points = spark.range(2500).select("id", F.lit("10.5").cast("decimal(20,1)").alias("x"), F.lit(20.25).alias("y"))
    got = shapes.assign_polygons(points, polys, "rings", 30)
    assert got.columns == ["id", "x", "y", "poly"] and got.schema["x"].dataType == points.schema["x"].dataType
    assert got.count() == 5000 and got.distinct().count() == 5000
    nowhere = spark.createDataFrame([(1, float("nan"), 5.0), (2, 5.0, float("nan")), (3, None, 5.0), (4, float("inf"), 5.0), (5, 5.0, 5.0), (6, -0.0, 0.0), (7, 0.0, -0.0)], "id long, x double, y double")
    assert sorted(r["id"] for r in shapes.assign_polygons(nowhere, polys, "rings", 30).collect()) == [5, 5, 6, 6, 7, 7]


def test_summary_of_matches_gathers_values_and_not_matches(spark):
    rows = [(1, "b", "x"), (1, "a", "x"), (1, "b", None), (2, None, None), (2, None, None), (3, "a", "y")]
    matches = spark.createDataFrame(rows, "id long, formation string, code string")
    out = landcover.match_summary(matches, "id", ["formation", "code"])
    assert sorted(map(tuple, out.collect())) == [(1, 3, 2, 1, "a|b", "x", True), (2, 2, 0, 0, "", "", True), (3, 1, 1, 1, "a", "y", True)]
    assert sorted(map(tuple, landcover.match_summary(matches, "id", []).collect())) == [(1, 3, True), (2, 2, True), (3, 1, True)]
    assert sorted(map(tuple, landcover.match_summary(matches, ["id", "code"], ["formation"]).collect()), key=str) == sorted([(1, "x", 2, 2, "a|b", True), (1, None, 1, 1, "b", True), (2, None, 2, 0, "", True), (3, "y", 1, 1, "a", True)], key=str)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    lists = [line for line in plan.splitlines() if "collect_set" in line]
    below = plan[plan.rindex("collect_set") :]
    assert len(lists) == 1 and "count(1)" in below  # values are counted before they are gathered


def test_places_are_summarised_once_without_broadcast(spark):
    out = plans.match_summary(spark, SF)
    assert broadcasts(out) == 0
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("collect_set") < plan.index("Aggregate [x#", plan.index("count(1)"))  # places are told apart below the summary


def test_point_table_sends_no_points_through_the_driver(spark):
    out = plans.point_table(spark, SF)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [tx#" in plan and "BroadcastHashJoin [tx#" not in plan
    assert not [line for line in plan.splitlines() if "BroadcastHashJoin [grid_id#" in line and "BuildLeft" in line]  # points on borders of cells
    joins = [line for line in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join LeftOuter" in line]
    assert any("lat#" in j and "lon#" in j for j in joins)  # one summary a place


def test_of_overlapping_polygons_only_the_overlap_goes(spark):
    rows = [(1, "f", 2020, "B", 0.0), (2, "f", 2021, "C", 50.0), (3, "f", 2021, "A", 80.0), (4, "g", 2000, "C", 0.0)]
    df = spark.createDataFrame(rows, "poly long, cls string, year int, status string, x double")
    rings = F.array(F.array(*[point(F.col("x") + dx, F.lit(dy)) for dx, dy in ((0, 0), (100, 0), (100, 100), (0, 100))]))
    got = shapes.resolve_overlaps(df.withColumn("rings", rings), ["poly"], "cls", "year", "status", "poly", "rings", 10)
    assert {r["poly"]: r["area"] for r in got.collect()} == {1: 5000.0, 2: 3000.0, 3: 10000.0, 4: 10000.0}


def test_projections_go_back_and_forth(spark):
    from fieldloom.functions.geo import cell_centroid_lonlat, laea_to_lonlat, lonlat_to_lcc

    for lon, lat in ((5.0, 50.0), (10.0, 52.0), (14.2, 47.3), (-8.0, 61.0)):
        x, y = lonlat_to_laea(F.lit(lon), F.lit(lat))
        back = laea_to_lonlat(x, y)
        assert abs(one(spark, back[0]) - lon) < 1e-7 and abs(one(spark, back[1]) - lat) < 1e-7
    x, y = lonlat_to_lcc(F.lit(10.0), F.lit(52.0))
    assert abs(one(spark, x) - 4000000) < 1e-6 and abs(one(spark, y) - 2800000) < 1e-6
    near = [one(spark, c) for c in lonlat_to_lcc(F.lit(10.0), F.lit(52.01))]
    assert abs(near[0] - 4000000) < 1e-6 and 1060 < near[1] - 2800000 < 1113
    lon, lat = cell_centroid_lonlat(F.lit(32100), F.lit(43210), 100)
    assert abs(one(spark, lon) - 10.0007) < 1e-3 and abs(one(spark, lat) - 52.0004) < 1e-3


def test_quantiles_between_values(spark):
    """At 100 parts a value just between two is a tie of rounding, which the nearer neighbour's side decides as numpy does."""
    import numpy as np

    values = [9.85, 9.96, 1.0, 3.25, 7.125, 2.5]
    df = spark.createDataFrame([("v", 0.0, 0.0, v) for v in [*values, float("nan"), float("inf")]], "var string, x double, y double, value double").withColumn("ts", F.lit("2024-05-01").cast("timestamp"))
    got = cube.monthly_quantiles(df, [0.1, 0.5, 0.9], 100, -9999).first()
    assert [got["p10"], got["p50"], got["p90"]] == [int(np.rint(np.quantile(values, p) * 100)) for p in (0.1, 0.5, 0.9)]
    assert cube.monthly_quantiles(df, [0.5], 100, -9999, accuracy=1000).first()["p50"] in (250, 325, 713)
    none = df.where("value > 1e300")
    assert cube.monthly_quantiles(none, [0.5], 100, -9999).first()["p50"] == -9999
    pixels = spark.createDataFrame([("f", 1, v) for v in (1.0, float("nan"), -9999.0, float("inf"))], "file string, band int, value double")
    stats = cube.raster_stats(pixels, -9999, 2).first()
    assert (stats["n_nan"], stats["n_inf"], stats["n_nodata"], stats["n_finite"]) == (1, 1, 1, 1) and stats["codes"] == "unexpected_band_count|nan_values|infinite_values|constant"
    assert cube.band_stats(pixels.where("value < 2 or value <> value"), -9999).first()["n_valid"] == 1


def test_instants_and_sources_of_times(spark):
    utc = lambda t: str(one(spark, S.to_instant(F.lit(t).cast("timestamp"), "Europe/Berlin")))
    assert utc("2024-03-31 02:30:00") == "2024-03-31 01:00:00" and utc("2024-10-27 02:30:00") == "2024-10-27 00:30:00" and utc("2024-07-01 12:00:00") == "2024-07-01 10:00:00"
    part = one(spark, S.local_parts(F.lit("2024-05-01T04:30:00+02:00")))
    assert (str(part["local"]), part["utc"], part["date"], part["time"]) == ("2024-05-01 04:30:00", "2024-05-01T02:30:00Z", "2024-05-01", "04:30:00")
    assert one(spark, S.local_parts(F.lit("nothing")))["utc"] is None and one(spark, S.local_parts(F.lit("2024-05-01")))["time"] == "00:00:00"
    got = one(spark, S.time_source(F.lit("bad"), F.lit("2024-05-01 04:30"), ("localtimes", "datetime"), "Europe/Berlin"))
    assert got["source"] == "datetime" and got["step"].startswith("fallback_to_datetime; ")
    assert one(spark, S.time_source(F.lit(None), F.lit("x"), ("a", "b"), "UTC"))["step"] == "no_parseable_datetime"
    assert one(spark, S.months_spanning(F.lit("2024-01-30 10:00:00").cast("timestamp"), F.lit("2024-03-01").cast("timestamp"))) == ["2024-01", "2024-02", "2024-03"]
    assert one(spark, S.duration_issue(F.lit(58.5), 60, 1)) == "duration_not_60s:observed=58.500000s,allowed=59-61s" and one(spark, S.duration_issue(F.lit(60.5), 60, 1)) is None


def test_contract_rules_and_artifacts(spark, tmp_path):
    contract = {"id": {"type": "bigint", "required": True}, "kind": {"enum": ["a", "b"]}, "n": {"minimum": 0, "maximum": 5}, "code": {"pattern": "^[a-z]+$"}}
    df = spark.createDataFrame([("1", "a", 3, "x"), ("y", "c", 9, "7"), (None, None, None, None)], "id string, kind string, n int, code string")
    got = master.validate_rows(df, master.contract_rules(contract), "id").first().asDict()
    assert got == {"id_type": 1, "id_required": 1, "kind_enum": 1, "n_minimum": 0, "n_maximum": 1, "code_pattern": 1, "duplicate_keys": 0}
    spark.range(3).write.parquet(str(tmp_path / "full"))
    spark.range(0).write.parquet(str(tmp_path / "empty"))
    states = master.artifact_check(spark, {str(tmp_path / "full"): True, str(tmp_path / "empty"): True, str(tmp_path / "no"): True, str(tmp_path / "maybe"): False})
    assert [r["state"] for r in states.collect()] == ["present", "empty", "missing", "optional_missing"]


def test_master_update_of_some_ids(spark):
    base = spark.createDataFrame([(1, 1.0, 2.0, "t", "u"), (2, 95.0, 2.0, None, None)], "id long, lat double, lon double, datetime_local string, datetime_utc string")
    media = spark.createDataFrame([(1, True, False, ""), (2, True, True, "Bad Tone")], "id long, exists boolean, has_issues boolean, codes string")
    cells = spark.createDataFrame([("c", "forest", "A", 71.239, 1.5)], "cell string, majority string, status string, pct double, gap double")
    qc = spark.createDataFrame([(1, "validated", False, "", True)], "id long, status string, has_issues boolean, codes string, required_complete boolean")
    attach = [lambda df, p=p: master.attach_inventory(df, media, "id", p) for p in master.MEDIA]
    attach += [lambda df: master.attach_completion(df, qc, "id", []), lambda df: master.attach_points(df, spark.createDataFrame([(1, True, 2)], "id long, inside_polygon boolean, n_polygons long"), "id")]
    attach += [lambda df: df.withColumn("c1", F.lit("c")).withColumn("c2", F.lit(None).cast("string"))]
    columns = {"cell": "cell", "majority": "majority", "status": "status", "coverage_pct": "pct", "gap_pct": "gap"}
    attach += [lambda df: master.attach_cell_class(df, cells, "c1", "100m", columns), lambda df: master.attach_cell_class(df, cells, "c2", "10m", columns)]
    attach += [lambda df: master.attach_raster_status(df, spark.createDataFrame([], "status string, square boolean, constant_rows int, constant_cols int, nodata_rows int, nodata_cols int"), True, "weather_raster_100m")]
    keep = ["id", "sound_issue_codes", "majority_value_100m", "second_value_100m", "majority_disputed_100m", "ready_for_general_analysis", "ready_for_bioacoustic_analysis", "ready_for_direct_lrt_analysis", "record_status", "release_status", "weather_raster_100m_issue_codes"]
    first = master.master_table(base, attach, "id", keep)
    got = {r["id"]: r.asDict() for r in first.collect()}
    assert got[1] == dict(zip(keep, [1, "", 7124, 6974, True, True, True, True, "partial", "not_started", "qc_not_run"]))
    assert got[2]["sound_issue_codes"] == "bad_tone" and got[2]["record_status"] == "has_issues" and not got[2]["ready_for_bioacoustic_analysis"]
    before = first.withColumn("release_status", F.lit("Approved")).withColumn("record_status", F.lit("old"))
    later = {r["id"]: (r["record_status"], r["release_status"]) for r in master.master_table(base, attach, "id", keep, before, spark.createDataFrame([(2,)], "id long")).collect()}
    assert later == {1: ("old", "Approved"), 2: ("has_issues", "approved")}


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "a.csv").write_text("﻿id;name\n1;x,y\n")
    assert tables.read_delimited(spark, str(tmp_path / "a.csv")).first().asDict() == {"id": "1", "name": "x,y"}
    schema = spark.range(1).schema
    assert tables.read_optional(spark, str(tmp_path / "none"), schema).count() == 0
    tables.append_events(spark.range(2), str(tmp_path / "log"), "r1")
    tables.append_events(spark.range(3), str(tmp_path / "log"), "r1")
    tables.append_events(spark.range(1), str(tmp_path / "log"), "r2")
    assert spark.read.parquet(str(tmp_path / "log")).count() == 4
    assert tables.list_files(spark, str(tmp_path), "*.csv", r"^(\w)").first()["id"] == "a"
    assert tables.harmonise_columns(spark.range(1).toDF("Recording_ID"), {"id": ["recording_id"]}, ["id"]).columns == ["id"]


def test_upsert_is_idempotent_and_events_are_empty(spark):
    old = spark.createDataFrame([(1, "a"), (2, None)], "id long, s string")
    new = spark.createDataFrame([(2, "b")], "id long, s string")
    once = changes.upsert_by_id(old, new, new, "id")
    assert sorted(map(tuple, changes.upsert_by_id(once, new, new, "id").collect())) == [(1, "a"), (2, "b")]
    assert changes.status_events(old, old, "id", ["s"]).count() == 0


def test_top_k_and_failed_rows(spark):
    df = spark.createDataFrame([("A", 0.9), ("B", 0.8), ("C", 0.7), ("D", 0.05)], "species string, score double").withColumn("g", F.lit(1))
    assert [r["species"] for r in species.segment_top_k(df, ["g"], 0.1, 2).orderBy("rank").collect()] == ["A", "B"]
    assert ranking.top_k(df, ["g"], [F.asc("species")], 0).count() == 4

    def scorer(p):
        if (p["species"] == "C").any():
            raise ValueError("no C")
        return p["species"].map(ord)

    got = {r["species"]: (r["score"], r["error"]) for r in species.batch_score(df.select("species").coalesce(1), scorer, "species").collect()}
    assert got == {"A": (65.0, None), "B": (66.0, None), "C": (None, "ValueError: no C"), "D": (68.0, None)}
    ids = spark.createDataFrame([("10",), ("9",), ("x",), ("1",)], "id string")
    assert [r["id"] for r in ranking.sort_numeric_id(ids, "id").collect()] == ["1", "9", "10", "x"]
    months = species.with_month(spark.createDataFrame([(1,), (2,), (3,)], "id long"), spark.createDataFrame([(1, "2024-06-30T23:30:00-02:00"), (2, "bad")], "id long, ts string"), "id", "ts")
    assert {r["id"]: r["month"] for r in months.collect()} == {1: 6, 2: None, 3: None}


def test_downloads_forced_or_missing_only(spark):
    ids = spark.createDataFrame([(1, "u1"), (2, "u2"), (3, "u3"), (4, None)], "id long, url string")
    have = spark.createDataFrame([(1, True, False), (2, True, True)], "id long, exists boolean, has_issues boolean")
    retry = spark.createDataFrame([(2, "u2", 5, False), (3, "old", 5, True), (4, "", 1, True)], "id long, url string, attempts int, terminal boolean")
    run = lambda **o: {r["id"]: (r["reason"], r["attempts"]) for r in inventory.needs_download(ids, have, retry, "id", "url", 5, **o).collect()}
    assert run() == {3: ("missing", 0)}
    assert run(forced=True) == {i: ("forced", 0) for i in (1, 2, 3, 4)}
    assert run(missing_only=True) == {3: ("missing", 0)} and run(missing_only=True, requested=spark.createDataFrame([(1,)], "id long")) == {}
    assert run(requested=spark.createDataFrame([(1,)], "id long")) == {1: ("requested", 0), 3: ("missing", 0)}


def test_complete_year(spark):
    names = spark.createDataFrame([(f"tas_2024{m:02}0100.nc",) for m in range(1, 13)] + [("tas_20230101.nc",)], "name string")
    assert [tuple(r) for r in inventory.complete_periods(names, "name", r"^(\w+?)_(\d{4})(\d{2})").collect()] == [("tas", 2024)]


UPSERTS = "id int, v string, t int"


def stream_files(spark, path, batches):
    for rows in batches:
        spark.createDataFrame(rows, UPSERTS).coalesce(1).write.mode("append").parquet(path)


@pytest.mark.parametrize("seed", [1, 2])
def test_stream_in_any_order_matches_batch(spark, tmp_path, seed):
    rng = random.Random(seed)
    rows = [(rng.randrange(30), rng.choice("abc"), rng.choice([None, *range(12)])) for _ in range(200)]
    rng.shuffle(rows)
    batches = [rows[i : i + 20] for i in range(0, 200, 20)]
    stream_files(spark, str(tmp_path / "in"), batches)
    kind = spark.createDataFrame([], UPSERTS).schema
    args = (spark, str(tmp_path / "in"), kind, str(tmp_path / "out"), str(tmp_path / "c"), "id", "t", 4, str(tmp_path / "events"), ["v", "t"], 1, 3)
    for _ in range(2):  # a second call finds nothing new
        stream_upsert(*args)
    got = read_upserted(spark, str(tmp_path / "out"), kind, "id", "t")
    best = {}
    for i, v, t in rows:
        best[i] = max(best.get(i, (-1, "")), (-1 if t is None else t, v))
    assert {r["id"]: (-1 if r["t"] is None else r["t"], r["v"]) for r in got.collect()} == best
    one_id = spark.createDataFrame([(rows[0][0],)], "id int")
    assert read_upserted(spark, str(tmp_path / "out"), kind, "id", "t", ids=one_id, buckets=4).count() == 1
    names = os.listdir(tmp_path / "out")
    assert sum(n.startswith("base-") for n in names) <= 2 and sum(n.startswith("delta-") for n in names) <= 6
    # the events of all batches lead from nothing to the table
    told = {}
    for r in spark.read.parquet(str(tmp_path / "events")).orderBy("batch").collect():
        assert r["field"] == "record" or told.get((r["id"], r["field"]), r["previous"]) == r["previous"]
        told[r["id"], r["field"]] = r["current"]
    assert {i for i, f in told if f == "record"} == set(best)
    assert all(told[i, "t"] == str(t) for i, (t, _) in best.items() if (i, "t") in told)


def test_late_rows_lose_and_batches_can_be_repeated(spark, tmp_path):
    kind = spark.createDataFrame([], UPSERTS).schema
    batches = [[(1, "new", 10), (2, "x", 1)], [(1, "old", 3)], [(2, "y", 2)], [(3, "z", 1)]]
    fold = lambda n: fold_batch(spark.createDataFrame(batches[n], UPSERTS), n, str(tmp_path / "out"), "id", "t", 4, 2, str(tmp_path / "events"), ["v"])
    for n in (0, 1, 1, 2, 3, 3):
        fold(n)
    state = lambda before=None: sorted(map(tuple, read_upserted(spark, str(tmp_path / "out"), kind, "id", "t", before).collect()))
    assert state() == [(1, "new", 10), (2, "y", 2), (3, "z", 1)] and state(3) == [(1, "new", 10), (2, "y", 2)]
    events = spark.read.parquet(str(tmp_path / "events"))
    assert sorted((r["id"], r["field"], r["current"]) for r in events.collect()) == [(1, "record", "added"), (2, "record", "added"), (2, "v", "y"), (3, "record", "added")]


def test_new_files_come_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    known = None
    for name in ("7_a.wav", "8_b.wav", "c.txt", "9_c.wav"):
        (tmp_path / "in" / name).write_text("x" * int(name[0]) if name[0].isdigit() else "")
        if name == "9_c.wav":
            at = pd.Timestamp(os.stat(tmp_path / "in" / name).st_mtime_ns // 10**6 * 10**6).to_pydatetime()
            known = spark.createDataFrame([(name, 9, at, True, 5), ("8_b.wav", 8, at, True, 6)], "name string, size_bytes long, modified timestamp, clean boolean, duration int")
        stream_new_files(spark, str(tmp_path / "in"), "*.wav", str(tmp_path / "out"), str(tmp_path / "c"), known=known)
    got = spark.read.option("mergeSchema", True).parquet(str(tmp_path / "out")).orderBy("name").collect()
    assert [(r["id"], r["name"], r["size_bytes"], r["reused"], r["duration"]) for r in got] == [("7", "7_a.wav", 7, None, None), ("8", "8_b.wav", 8, None, None), ("9", "9_c.wav", 9, True, 5)]


def test_versions_parts_and_layers(spark, tmp_path):
    path = str(tmp_path / "t")
    assert [tables.publish(spark.range(n), path) for n in (1, 2)] == [0, 1] and tables.read_published(spark, path).count() == 2
    with pytest.raises(Exception):
        tables.publish(spark.range(3).select(F.raise_error(F.lit("stop")).alias("id")), path)
    assert tables.read_published(spark, path).count() == 2
    spark.range(1).write.parquet(str(tmp_path / "p/a"))
    parts = tables.read_parts(spark, str(tmp_path / "p/a"), spark.createDataFrame([], "id long, name string").schema)
    parts.write.parquet(str(tmp_path / "q"))
    assert parts.first().asDict() == {"id": 0, "name": None}
    (tmp_path / "ids.csv").write_text("ID,x\n7.0,a\nbad,b\n7,c\n")
    assert [r["id"] for r in tables.read_ids(spark, str(tmp_path / "ids.csv")).collect()] == ["7"]
    both = tables.union_layers({("f", "a"): spark.range(1), ("f", "b"): spark.range(1).toDF("other")}, ["id"])
    assert [r.asDict() for r in both.collect()] == [{"id": 0, "source_file": "f", "source_layer": "a"}]
    assert tables.schema_equal(spark.range(1).withColumn("k", F.lit(1)), spark.range(2), ("k",)) and tables.required_columns(spark.range(1), ["id", "z"]) == ["z"]
    wide = tables.concat_parts([spark.range(1).select("id"), spark.range(1).withColumn("n", F.lit(2))], spark.createDataFrame([], "n int, id long").schema)
    assert wide.columns == ["n", "id"] and wide.count() == 2
    assert tables.lookup_rows(spark.range(9), [2, 3], "id", []).count() == 2
    flags = spark.createDataFrame([(True, "a"), (False, None)], "ok boolean, kind string")
    assert tables.summary_record(flags, ["ok"], ["kind"]).first()[0] == '{"rows":2,"ok":1,"kind_counts":{"a":1,"missing":1}}'
    (tmp_path / "j").mkdir()
    (tmp_path / "j/x.json").write_text('{"a": 1}')
    assert tables.read_json_docs(spark, str(tmp_path / "j")).first()["a"] == 1


def test_windows_of_a_zone_and_nodes_of_any_axis(spark):
    """Berlin has 23 hours on 2024-03-31 and 25 on 2024-10-27; windows are whole days of 24 hours before midnight there."""
    axis = [-3.0, 0.0, 1.0, 10.0]
    rows = [(i, v) for i, v in enumerate([-9.0, -1.5, -1.6, 0.5, 0.4999, 5.5, 99.0, 1.0, float("nan"), None])]
    got = spark.createDataFrame(rows, "i int, v double").select("i", cube.nearest(F.array(*map(F.lit, axis)), F.col("v")).alias("x")).orderBy("i")
    assert [r["x"] for r in got.collect()] == [-3.0, 0.0, -3.0, 1.0, 0.0, 10.0, 10.0, 1.0, None, None]
    walls = ["2024-03-31 05:30:00", "2024-04-01 00:30:00", "2024-10-27 02:30:00", "2024-10-28 01:00:00"]
    for wall in walls:
        own = pd.Timestamp(wall).tz_localize("Europe/Berlin", ambiguous=True, nonexistent="shift_forward").normalize()
        want = [(t.tz_convert("Europe/Berlin").tz_localize(None), t.tz_convert("UTC").tz_localize(None)) for t in (own - pd.Timedelta(days=2), own + pd.Timedelta(hours=23))]
        ts = F.lit(wall).cast("timestamp")
        local, utc = one(spark, S.expected_window(ts, 2, "Europe/Berlin")), one(spark, S.window_hours(ts, 2, "Europe/Berlin"))
        assert [(a, b) for a, b in zip(local, utc)] == want and (utc["last"] - utc["first"]).total_seconds() == 71 * 3600
    points = spark.createDataFrame([(1, 5.4, -8.0, pd.Timestamp("2024-03-31 05:30:00").to_pydatetime()), (2, 11.0, 0.0, pd.Timestamp("2024-03-31 05:30:00").to_pydatetime()), (3, None, 0.0, pd.Timestamp("2024-03-31 05:30:00").to_pydatetime())], "id int, x double, y double, ts timestamp")
    hours = pd.date_range("2024-03-30 20:00", periods=30, freq="1h")
    nodes = spark.createDataFrame([("t", x, y, h, x + i) for x in (0.0, 1.0, 10.0) for y in (0.0,) for i, h in enumerate(hours.to_pydatetime())], "var string, x double, y double, ts timestamp, value double")
    got = cube.sample_cube(points, nodes, "id", ["t"], 0, "Europe/Berlin", margin=9.0).orderBy("id", "hour").collect()
    assert len(got) == 72 and [r["value"] for r in got if r["id"] == 1] == [1.0 + 3 + i for i in range(24)]
    assert {r["inside"] for r in got if r["id"] < 3} == {True} and [r["inside"] for r in got if r["id"] == 3] == [False] * 24
    assert all(r["value"] is None for r in got if r["id"] == 3) and cube.sample_cube(points, nodes.limit(0), "id", ["t"], 0, "UTC").where("value IS NOT NULL OR inside").count() == 0


def test_status_of_the_majority_is_an_allowed_one(spark):
    """The largest status of cell a is K and cell b has nothing else; ties go to the first letter."""
    ix = spark.createDataFrame([("a", "f", "1", "K", 60.0), ("a", "f", "1", "B", 20.0), ("a", "f", "2", "A", 20.0), ("a", "g", "3", "C", 30.0), ("b", "f", "1", "K", 50.0), ("c", None, "1", "A", 5.0), ("d", "f", None, "C", 7.0)], "cell string, cls string, code string, status string, area double")
    got = {r["cell"]: r for r in landcover.wide_matrix(ix, "cell", "cls", "code", "status", "area", 100.0, ["f", "g", "h"], ["1", "2"], statuses=["A", "K"]).collect()}
    a, b, d = got["a"], got["b"], got["d"]
    assert set(got) == {"a", "b", "d"} and (a["majority"], a["majority_status"], a["majority_value"], a["second_value"], a["n_classes"], a["n_codes"]) == ("f", "A", 10000, 3000, 2, 3)
    assert (b["majority_status"], b["n_codes"], d["n_codes"], d["majority_status"]) == (None, 1, 0, "C")
    assert (a["f"], a["h"], a["f_K"], a["f_A"], a["1"], a["1_K"], a["2_K"]) == (10000, 0, 6000, 2000, 8000, 6000, 0)


def test_folders_are_listed_in_partitions(spark, tmp_path):
    """The same rows as Spark's own listing, over nested folders, one partition a folder."""
    for name in ("a.wav", "x/1_b.wav", "x/y/z/2_c.wav", "x/y/no.txt", "w/3_d.WAV", "w/4_e.mp3"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(name)
    got = tables.list_files(spark, str(tmp_path), "*.{wav,mp3}", r"^(\d+)_")
    assert got.rdd.getNumPartitions() == 3
    own = spark.read.format("binaryFile").option("pathGlobFilter", "*.{wav,mp3}").option("recursiveFileLookup", True).load(str(tmp_path))
    want = {(r["path"], r["length"], r["modificationTime"]) for r in own.drop("content").collect()}
    assert {(r["path"], r["size_bytes"], r["modified"]) for r in got.collect()} == want and len(want) == 4
    assert {r["name"]: r["id"] for r in got.collect()} == {"a.wav": "", "1_b.wav": "1", "2_c.wav": "2", "4_e.mp3": "4"}


def test_lookups_read_only_their_buckets(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.publish_buckets(spark.range(5000).withColumn("v", F.col("id") * 2), path, "id", 32)
    few = tables.look_up_buckets(spark, path, spark.createDataFrame([(7,), (7,), (4999,), (10**9,)], "id long"), "id", ["v"], 32)
    assert sorted(map(tuple, few.collect())) == [(7, 14), (4999, 9998)]
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_bucket" in plan or "PartitionFilters: [_bucket" in plan
    files = few.select(F.input_file_name()).distinct().count()
    assert files <= 2 and "PushedFilters: [In(id" in plan
    many = tables.look_up_buckets(spark, path, spark.range(100).where("id % 2 = 0"), "id", ["v"], 32)
    assert many.count() == 50


def test_a_fixed_form_has_all_its_columns(spark):
    got = master.projected(spark.createDataFrame([(1, "x")], "id int, b string"), {"b": "string", "c": "boolean", "id": "bigint"})
    assert got.dtypes == [("b", "string"), ("c", "boolean"), ("id", "bigint")] and tuple(got.first()) == ("x", None, 1)


def test_points_without_place_or_cell(spark):
    cells = spark.createDataFrame([("10mN0E0",), ("10mN0E1",), ("10mN1E1",)], "cell string")
    points = spark.createDataFrame([(1, 10.0, 5.0), (2, 10.0, 10.0), (3, None, 1.0), (4, 25.0, 5.0), (5, 5.0, 5.0), (6, 20.0, 20.0)], "id int, x double, y double")
    assert {r["id"]: r["cell"] for r in master.assign_cell(points, cells, "id", "x", "y", "cell", 10).collect()} == {1: "10mN0E0", 2: "10mN0E0", 3: None, 4: None, 5: "10mN0E0", 6: "10mN1E1"}
