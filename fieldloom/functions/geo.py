"""Polygons and projections as Column expressions.

A ring is array<struct<x,y>> without the closing point; the rings of a polygon are its outer ring and then its holes.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: GRS80 ellipsoid and the European equal-area projection (centre, false origin).
GRS80_A, GRS80_F = 6378137.0, 1 / 298.257222101
LAEA_LAT, LAEA_LON, LAEA_X, LAEA_Y = 52.0, 10.0, 4321000.0, 3210000.0


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def following(ring: Column) -> Column:
    """The ring moved by one, so that zipping gives its edges."""
    return F.concat(F.slice(ring, 2, F.size(ring)), F.slice(ring, 1, 1))


def ring_area(ring: Column) -> Column:
    """Signed area by the shoelace formula."""
    cross = F.zip_with(ring, following(ring), lambda a, b: a["x"] * b["y"] - b["x"] * a["y"])
    return F.when(F.size(ring) >= 3, F.aggregate(cross, F.lit(0.0), lambda s, v: s + v) / 2).otherwise(0.0)


def area_below(p: Column, q: Column, length: Column, height: Column) -> Column:
    """Area between 0 and a line from height p to q over ``length``, the line kept within 0 .. ``height``."""
    upto = lambda t: F.when(t <= 0, F.lit(0.0)).when(t <= height, t * t / 2).otherwise(height * height / 2 + height * (t - height))
    level = F.least(F.greatest(p, F.lit(0.0)), height)
    return length * F.when(p == q, level).otherwise((upto(q) - upto(p)) / F.nullif(q - p, F.lit(0.0)))


def edge_area(xa: Column, ya: Column, xb: Column, yb: Column, x0: Column, y0: Column, size: Column) -> Column:
    """What an edge adds to the signed area of its ring within a square cell: the area below it, right to left counts against."""
    left, right = F.greatest(F.least(xa, xb), x0), F.least(F.greatest(xa, xb), x0 + size)
    at = lambda x: ya + (yb - ya) * (x - xa) / F.nullif(xb - xa, F.lit(0.0)) - y0
    return F.when(right > left, area_below(at(left), at(right), right - left, size) * F.signum(xa - xb)).otherwise(0.0)


def edges_of(rings: Column) -> Column:
    """array<struct<xa,ya,xb,yb,sign>>: the edges of all rings.

    ``sign`` is how an edge from right to left counts in the polygon's area, whatever the direction of
    its ring: 1 or -1, and the other way round for holes; 0 in rings without an area.
    """
    signed = F.transform(rings, lambda r, i: F.struct(r.alias("r"), (F.signum(ring_area(r)) * F.when(i == 0, 1.0).otherwise(-1.0)).alias("s")))
    edge = lambda s: lambda a, b: F.struct(a["x"].alias("xa"), a["y"].alias("ya"), b["x"].alias("xb"), b["y"].alias("yb"), s.alias("sign"))
    return F.flatten(F.transform(signed, lambda x: F.zip_with(x["r"], following(x["r"]), edge(x["s"]))))


def side(e: Column, x: Column, y: Column) -> Column:
    """Above 0 if a point lies left of an edge, seen along it, and 0 if it is on its line."""
    return (e["xb"] - e["xa"]) * (y - e["ya"]) - (e["yb"] - e["ya"]) * (x - e["xa"])


def on_edge(e: Column, x: Column, y: Column) -> Column:
    return (side(e, x, y) == 0) & x.between(F.least(e["xa"], e["xb"]), F.greatest(e["xa"], e["xb"])) & y.between(F.least(e["ya"], e["yb"]), F.greatest(e["ya"], e["yb"]))


def spans(e: Column, axis: str, v: Column) -> Column:
    return (e[f"{axis}a"] > v) != (e[f"{axis}b"] > v)


def is_above(e: Column, x: Column, y: Column) -> Column:
    """Whether an edge that spans x runs above the point just right of x and just above y, by less than it is right."""
    s = side(e, x, y) * F.signum(e["xb"] - e["xa"])
    return (s < 0) | ((s == 0) & ((e["yb"] - e["ya"]) * (e["xb"] - e["xa"]) > 0))


def crossings(edges: Column, x0: Column, y0: Column, x: Column, y: Column) -> Column:
    """How many edges a way crosses that goes up from (x0, y0) to y and then right to x.

    Its ends lie just right of and just above these points, so that edges through them count once or not at all.
    """
    up = lambda e: spans(e, "x", x0) & is_above(e, x0, y0) & ~is_above(e, x0, y)
    right = lambda e: spans(e, "y", y) & (side(e, x0, y) * F.signum(e["yb"] - e["ya"]) > 0) & (side(e, x, y) * F.signum(e["yb"] - e["ya"]) <= 0)
    return F.size(F.filter(edges, lambda e: up(e) | right(e))) + F.size(F.filter(edges, lambda e: up(e) & right(e)))


#: What terms() are of an edge that is not there: it meets nothing.
NO_EDGE = {"y0": math.inf, "up": math.inf}


def terms(e: Column, x0: Column, y0: Column) -> dict[str, Column]:
    """What an edge has to do with the ways of crossings() from (x0, y0), as numbers for met_by()."""
    turn = F.when(e["yb"] < e["ya"], -1.0).otherwise(1.0)
    dx, dy = e["xb"] - e["xa"], e["yb"] - e["ya"]
    low = F.when(dx * dy > 0, F.lit(5e-324)).otherwise(0.0)  # at or above the least number is above 0
    return {
        "xa": e["xa"], "ya": e["ya"], "dx": dx * turn, "dy": dy * turn, "left": dy * (x0 - e["xa"]) * turn, "turn": F.signum(dx) * turn,
        "x0": F.least(e["xa"], e["xb"]), "x1": F.greatest(e["xa"], e["xb"]), "y0": F.least(e["ya"], e["yb"]), "y1": F.greatest(e["ya"], e["yb"]),
        "up": F.when(spans(e, "x", x0) & is_above(e, x0, y0), low).otherwise(math.inf),
    }


def met_by(t: dict[str, Column], x: Column, y: Column) -> tuple[Column, Column, Column]:
    """Whether an edge with these terms() crosses the way up, whether it crosses the way right, and whether (x, y) lies on it.

    The same numbers as in side(), is_above() and on_edge(), in so few steps that a join of many edges is still compiled.
    """
    at = t["dx"] * (y - t["ya"])
    up = (at - t["left"]) * t["turn"] >= t["up"]
    right = (y >= t["y0"]) & (y < t["y1"]) & (at > t["left"]) & (at <= t["dy"] * (x - t["xa"]))
    on = (y >= t["y0"]) & (y <= t["y1"]) & (x >= t["x0"]) & (x <= t["x1"]) & (at == t["dy"] * (x - t["xa"]))
    return up, right, on


def cuts_square(e: Column, x0: Column, y0: Column, size: Column) -> Column:
    """Whether an edge passes through the inside of a square, not only along its border."""
    corners = [side(e, x, y) for x in (x0, x0 + size) for y in (y0, y0 + size)]
    beside = lambda axis, v: (F.greatest(e[f"{axis}a"], e[f"{axis}b"]) > v) & (F.least(e[f"{axis}a"], e[f"{axis}b"]) < v + size)
    return beside("x", x0) & beside("y", y0) & (F.least(*corners) < 0) & (F.greatest(*corners) > 0)


def area_in_square(edges: Column, inside: Column, x0: Column, y0: Column, size: Column) -> Column:
    """A polygon's area in a square, from the edges that pass through it and whether its lower left corner is inside.

    What lies below the parts of the edges within the square, and the whole height below the parts of its top that are inside.
    """
    top = y0 + size

    def within(e: Column) -> Column:
        left, right = F.greatest(F.least(e["xa"], e["xb"]), x0), F.least(F.greatest(e["xa"], e["xb"]), x0 + size)
        at = lambda x: e["ya"] + (e["yb"] - e["ya"]) * (x - e["xa"]) / F.nullif(e["xb"] - e["xa"], F.lit(0.0)) - y0
        p, q = at(left), at(right)
        over = F.when(p == q, (p >= size).cast("double")).otherwise((F.greatest(q - size, F.lit(0.0)) - F.greatest(p - size, F.lit(0.0))) / F.nullif(q - p, F.lit(0.0)))
        part = area_below(p, q, right - left, size) - over * (right - left) * size
        return F.when(right > left, part * F.signum(e["xa"] - e["xb"]) * e["sign"]).otherwise(0.0)

    below = F.aggregate(F.transform(edges, within), F.lit(0.0), lambda s, v: s + v)
    corner = (inside.cast("int") + F.size(F.filter(edges, lambda e: spans(e, "x", x0) & is_above(e, x0, y0) & ~is_above(e, x0, top)))) % 2
    at = lambda e: e["xa"] + (e["xb"] - e["xa"]) * (top - e["ya"]) / F.nullif(e["yb"] - e["ya"], F.lit(0.0))
    turned = lambda e: F.when((e["ya"] >= top) != (e["yb"] >= top), -F.signum(e["yb"] - e["ya"]) * e["sign"] * F.greatest(F.least(x0 + size - at(e), size), F.lit(0.0)) * (at(e) > x0).cast("double")).otherwise(0.0)
    open_top = corner * size + F.aggregate(F.transform(edges, turned), F.lit(0.0), lambda s, v: s + v)
    return below + size * open_top


def usable_rings(rings: Column) -> Column:
    """Rings of three points or more with an area; a polygon without its outer ring has none."""
    good = lambda r: (F.size(r) >= 3) & (ring_area(r) != 0)
    return F.when(F.coalesce(good(rings[0]), F.lit(False)), F.filter(rings, lambda r: F.coalesce(good(r), F.lit(False))))


def lonlat_to_laea(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Easting and northing of the ellipsoidal Lambert azimuthal equal-area projection."""
    e2 = GRS80_F * (2 - GRS80_F)
    e = math.sqrt(e2)

    def q_of(sin, log):
        return (1 - e2) * (sin / (1 - e2 * sin * sin) - log((1 - e * sin) / (1 + e * sin)) / (2 * e))

    qp, q0 = q_of(1.0, math.log), q_of(math.sin(math.radians(LAEA_LAT)), math.log)
    b0, rq = math.asin(q0 / qp), GRS80_A * math.sqrt(qp / 2)
    phi = math.radians(LAEA_LAT)
    d = GRS80_A * (math.cos(phi) / math.sqrt(1 - e2 * math.sin(phi) ** 2)) / (rq * math.cos(b0))
    beta = F.asin(q_of(F.sin(F.radians(lat)), F.log) / qp)
    dl = F.radians(lon - LAEA_LON)
    b = F.sqrt(F.lit(2.0) / (1 + math.sin(b0) * F.sin(beta) + math.cos(b0) * F.cos(beta) * F.cos(dl))) * rq
    x = b * d * F.cos(beta) * F.sin(dl) + LAEA_X
    y = b / d * (math.cos(b0) * F.sin(beta) - math.sin(b0) * F.cos(beta) * F.cos(dl)) + LAEA_Y
    return x, y


#: Standard parallels and origin of the European conformal conic projection (centre, false origin).
LCC_LAT1, LCC_LAT2, LCC_LAT0, LCC_LON0, LCC_X, LCC_Y = 35.0, 65.0, 52.0, 10.0, 4000000.0, 2800000.0


def laea_to_lonlat(x: Column, y: Column) -> tuple[Column, Column]:
    """Longitude and latitude of easting and northing; the latitude by the series of the authalic one."""
    e2 = GRS80_F * (2 - GRS80_F)
    e = math.sqrt(e2)
    q_of = lambda s: (1 - e2) * (s / (1 - e2 * s * s) - math.log((1 - e * s) / (1 + e * s)) / (2 * e))
    qp, phi = q_of(1.0), math.radians(LAEA_LAT)
    b0, rq = math.asin(q_of(math.sin(phi)) / qp), GRS80_A * math.sqrt(qp / 2)
    d = GRS80_A * (math.cos(phi) / math.sqrt(1 - e2 * math.sin(phi) ** 2)) / (rq * math.cos(b0))
    dx, dy = (x - LAEA_X) / d, (y - LAEA_Y) * d
    rho = F.sqrt(dx * dx + dy * dy)
    c = F.asin(rho / (2 * rq)) * 2
    beta = F.when(rho == 0, F.lit(b0)).otherwise(F.asin(F.cos(c) * math.sin(b0) + dy * F.sin(c) * math.cos(b0) / F.nullif(rho, F.lit(0.0))))
    lon = F.atan2(dx * F.sin(c), rho * math.cos(b0) * F.cos(c) - dy * math.sin(b0) * F.sin(c))
    series = (e2 / 3 + 31 * e2**2 / 180 + 517 * e2**3 / 5040, 23 * e2**2 / 360 + 251 * e2**3 / 3780, 761 * e2**3 / 45360)
    lat = beta + sum((k * F.sin(beta * (2 * i)) for i, k in enumerate(series, 1)), F.lit(0.0))
    return F.degrees(lon) + LAEA_LON, F.degrees(lat)


def lonlat_to_lcc(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Easting and northing of the ellipsoidal Lambert conformal conic projection with two standard parallels."""
    e = math.sqrt(GRS80_F * (2 - GRS80_F))
    m_of = lambda p: math.cos(p) / math.sqrt(1 - (e * math.sin(p)) ** 2)
    t_at = lambda p: math.tan(math.pi / 4 - p / 2) / ((1 - e * math.sin(p)) / (1 + e * math.sin(p))) ** (e / 2)
    p1, p2, p0 = map(math.radians, (LCC_LAT1, LCC_LAT2, LCC_LAT0))
    n = (math.log(m_of(p1)) - math.log(m_of(p2))) / (math.log(t_at(p1)) - math.log(t_at(p2)))
    f = m_of(p1) / (n * t_at(p1) ** n)
    phi = F.radians(lat)
    t = F.tan(F.lit(math.pi / 4) - phi / 2) / F.pow((1 - F.sin(phi) * e) / (1 + F.sin(phi) * e), F.lit(e / 2))
    r, theta = F.pow(t, F.lit(n)) * (GRS80_A * f), F.radians(lon - LCC_LON0) * n
    return r * F.sin(theta) + LCC_X, F.lit(GRS80_A * f * t_at(p0) ** n + LCC_Y) - r * F.cos(theta)


def cell_centroid_lonlat(n: Column, e: Column, res: Column | int) -> tuple[Column, Column]:
    """Longitude and latitude of a grid cell's centre."""
    return laea_to_lonlat((e + 0.5) * res, (n + 0.5) * res)


def laea_to_lcc(x: Column, y: Column) -> tuple[Column, Column]:
    """From the equal-area to the conformal conic projection."""
    return lonlat_to_lcc(*laea_to_lonlat(x, y))
