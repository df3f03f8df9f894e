"""Spatial operators on coordinates: points (x, y), lines as arrays of points, polygons as arrays of rings.

Everything is metres in one projection (project_lcc). Features meet through square grid cells: each is exploded to the
cells of its box and joined on the cell by equality, then tested exactly. Cell size is a parameter; adaptive execution
splits crowded cells, and pairs that share several cells are made one after the test.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pluvia.functions.text import parse_crossing, street_candidates
from pluvia.operators.agg import union_by_name
from pluvia.operators.kd import nearest_by_parts
from pluvia.sources.rounds import settled

# Lambert conformal conic of Mexico on GRS80 (EPSG:6372).
_A, _F = 6378137.0, 1 / 298.257222101
_E = math.sqrt(2 * _F - _F * _F)
_LAT0, _LON0, _LAT1, _LAT2, _X0, _Y0 = 12.0, -102.0, 17.5, 29.5, 2_500_000.0, 0.0


def _m(lat: float) -> float:
    return math.cos(math.radians(lat)) / math.sqrt(1 - (_E * math.sin(math.radians(lat))) ** 2)


def _t(lat: float) -> float:
    s = _E * math.sin(math.radians(lat))
    return math.tan(math.pi / 4 - math.radians(lat) / 2) / ((1 - s) / (1 + s)) ** (_E / 2)


_N = (math.log(_m(_LAT1)) - math.log(_m(_LAT2))) / (math.log(_t(_LAT1)) - math.log(_t(_LAT2)))
_G = _m(_LAT1) / (_N * _t(_LAT1) ** _N)
_R0 = _A * _G * _t(_LAT0) ** _N


def project_lcc(lon: Column, lat: Column) -> tuple[Column, Column]:
    phi = F.radians(lat)
    s = F.sin(phi) * _E
    t = F.tan(math.pi / 4 - phi / 2) / F.pow((1 - s) / (1 + s), F.lit(_E / 2))
    r, theta = _A * _G * F.pow(t, F.lit(_N)), F.radians(lon - _LON0) * _N
    return _X0 + r * F.sin(theta), _Y0 + _R0 - r * F.cos(theta)


def unproject_lcc(x: Column, y: Column) -> tuple[Column, Column]:
    """(lon, lat), by five fixed iterations (below a tenth of a millimetre)."""
    dx, dy = x - _X0, _R0 - (y - _Y0)
    t = F.pow(F.hypot(dx, dy) / (_A * _G), F.lit(1 / _N))
    phi = math.pi / 2 - 2 * F.atan(t)
    for _ in range(5):
        s = F.sin(phi) * _E
        phi = math.pi / 2 - 2 * F.atan(t * F.pow((1 - s) / (1 + s), F.lit(_E / 2)))
    return F.degrees(F.atan2(dx, dy) / _N) + _LON0, F.degrees(phi)


def points_from_lonlat(df: DataFrame, lon: str, lat: str) -> DataFrame:
    """Adds x and y, null if a coordinate is."""
    x, y = project_lcc(F.col(lon), F.col(lat))
    both = F.col(lon).isNotNull() & F.col(lat).isNotNull()
    return df.withColumn("x", F.when(both, x)).withColumn("y", F.when(both, y))


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def line(*xy: tuple[Column, Column]) -> Column:
    return F.array(*[point(x, y) for x, y in xy])


def box_polygon(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.array(line((x0, y0), (x1, y0), (x1, y1), (x0, y1)))


def edges(points: Column, close: bool) -> Column:
    """array<struct<ax, ay, bx, by>> of consecutive points; a ring is closed."""
    end = F.concat(points, F.slice(points, 1, 1)) if close else points
    pairs = F.arrays_zip(F.slice(end, F.lit(1), F.size(end) - 1).alias("a"), F.slice(end, F.lit(2), F.size(end) - 1).alias("b"))
    return F.transform(pairs, lambda p: F.struct(p["a"]["x"].alias("ax"), p["a"]["y"].alias("ay"), p["b"]["x"].alias("bx"), p["b"]["y"].alias("by")))


def polygon_edges(rings: Column) -> Column:
    return F.flatten(F.transform(rings, lambda r: edges(r, True)))


def _total(items: Column, value) -> Column:
    return F.aggregate(items, F.lit(0.0), lambda acc, e: acc + value(e))


def ring_area(ring: Column) -> Column:
    """Signed area, positive counter-clockwise. Coordinates are taken relative to the first point."""
    ox, oy = ring[0]["x"], ring[0]["y"]
    return _total(edges(ring, True), lambda e: (e["ax"] - ox) * (e["by"] - oy) - (e["bx"] - ox) * (e["ay"] - oy)) / 2


def polygon_area(rings: Column) -> Column:
    """Shell less holes, in square metres."""
    rest = F.slice(rings, F.lit(2), F.greatest(F.size(rings) - 1, F.lit(0)))
    return F.abs(ring_area(rings[0])) - F.aggregate(rest, F.lit(0.0), lambda acc, r: acc + F.abs(ring_area(r)))


def _side(ax, ay, bx, by, px, py):
    return (bx - ax) * (py - ay) - (by - ay) * (px - ax)


def properly_cross(p, q) -> Column:
    d1, d2 = _side(p["ax"], p["ay"], p["bx"], p["by"], q["ax"], q["ay"]), _side(p["ax"], p["ay"], p["bx"], p["by"], q["bx"], q["by"])
    d3, d4 = _side(q["ax"], q["ay"], q["bx"], q["by"], p["ax"], p["ay"]), _side(q["ax"], q["ay"], q["bx"], q["by"], p["bx"], p["by"])
    return (d1 * d2 < 0) & (d3 * d4 < 0)


def polygon_measures(df: DataFrame, rings: str = "rings") -> DataFrame:
    """Adds km2, centroid_x, centroid_y (of the shell) and valid (no two edges of the shell cross)."""
    shell = F.col(rings)[0]
    ox, oy, e = shell[0]["x"], shell[0]["y"], F.col("_e")
    cross = lambda s: (s["ax"] - ox) * (s["by"] - oy) - (s["bx"] - ox) * (s["ay"] - oy)
    twice = _total(e, cross)
    cx = ox + F.try_divide(_total(e, lambda s: (s["ax"] + s["bx"] - 2 * ox) * cross(s)), 3 * twice)
    cy = oy + F.try_divide(_total(e, lambda s: (s["ay"] + s["by"] - 2 * oy) * cross(s)), 3 * twice)
    crossing = F.exists(e, lambda p: F.exists(e, lambda q: properly_cross(p, q)))
    return df.withColumn("_e", edges(shell, True)).withColumn("km2", polygon_area(F.col(rings)) / 1e6).withColumn("centroid_x", cx).withColumn("centroid_y", cy).withColumn("valid", ~crossing).drop("_e")


def inside(edge_list: Column, x: Column, y: Column) -> Column:
    """Ray casting over all rings; the lower and left borders belong to the polygon."""
    crosses = lambda e: (e["ay"] > y) != (e["by"] > y)
    hit = lambda e: crosses(e) & (x < (e["bx"] - e["ax"]) * (y - e["ay"]) / F.when(crosses(e), e["by"] - e["ay"]).otherwise(1.0) + e["ax"])
    return F.size(F.filter(edge_list, hit)) % 2 == 1


def _cells(lo: Column, hi: Column, cell: float) -> Column:
    return F.explode(F.sequence(F.floor(lo / cell), F.floor(hi / cell)))


def with_cells(df: DataFrame, x0: Column, y0: Column, x1: Column, y1: Column, cell: float) -> DataFrame:
    """Each row once per grid cell of its box, as _cx and _cy."""
    return df.withColumn("_cx", _cells(x0, x1, cell)).withColumn("_cy", _cells(y0, y1, cell))


def cell_index(polygons: DataFrame, poly: str, rings: str, cell: float) -> DataFrame:
    """(_p, _cx, _cy, _in, _e): for each cell that a polygon meets, whether the cell's middle is inside and the edges that come near the cell.

    Edges are dealt to the cells along them. Middles are settled row by row of cells: an edge that crosses the height of the middles gives one
    place, and between the first and second, third and fourth.. place of a row the middles are inside. So the rows follow the
    edges and the cells covered, not cells times edges.
    """
    e = polygons.select(F.col(poly).alias("_p"), F.inline(polygon_edges(F.col(rings))))
    near = e.select("_p", F.struct(*CORNERS).alias("_e"), F.inline(_along(*[F.col(c) for c in CORNERS], 0.0, cell)))
    near = near.groupBy("_p", "_cx", "_cy").agg(F.collect_list("_e").alias("_e"))
    # rows whose middles lie at or above the lower and below the upper end
    low, high = F.least("ay", "by") / cell - 0.5, F.greatest("ay", "by") / cell - 0.5
    rows = e.where(F.ceil(low) < F.ceil(high)).select("*", F.explode(F.sequence(F.ceil(low), F.ceil(high) - 1)).alias("_cy"))
    x = (F.col("bx") - F.col("ax")) * ((F.col("_cy") + 0.5) * cell - F.col("ay")) / (F.col("by") - F.col("ay")) + F.col("ax")
    w = Window.partitionBy("_p", "_cy").orderBy("x")
    spans = rows.select("_p", "_cy", x.alias("x")).withColumn("n", F.row_number().over(w)).withColumn("x2", F.lead("x").over(w)).where("n % 2 = 1")
    first, end = F.ceil(F.col("x") / cell - 0.5), F.ceil(F.col("x2") / cell - 0.5)
    held = spans.where(first < end).select("_p", F.explode(F.sequence(first, end - 1)).alias("_cx"), "_cy").withColumn("_in", F.lit(True))
    whole = near.join(held, ["_p", "_cx", "_cy"], "full")
    none = F.expr("cast(array() AS array<struct<ax:double,ay:double,bx:double,by:double>>)")
    return whole.select("_p", "_cx", "_cy", F.coalesce("_in", F.lit(False)).alias("_in"), F.coalesce("_e", none).alias("_e"))


def inside_cell(x: Column, y: Column, cell: float) -> Column:
    """Whether a point of the cell _cx, _cy is inside: the way from the cell's middle, level and then upright, crosses the cell's edges only.
    Lower and left borders belong to the polygon, as in `inside`."""
    mx, my = (F.col("_cx") + 0.5) * cell, (F.col("_cy") + 0.5) * cell

    def crosses(e: Column) -> Column:
        level, upright = (e["ay"] > my) != (e["by"] > my), (e["ax"] > x) != (e["bx"] > x)
        at = (e["bx"] - e["ax"]) * (my - e["ay"]) / F.when(level, e["by"] - e["ay"]).otherwise(1.0) + e["ax"]
        height = (e["by"] - e["ay"]) * (x - e["ax"]) / F.when(upright, e["bx"] - e["ax"]).otherwise(1.0) + e["ay"]
        return (level & ((mx < at) != (x < at))).cast("int") + (upright & ((height > my) != (height > y))).cast("int")

    return (F.aggregate("_e", F.col("_in").cast("int"), lambda n, e: n + crosses(e)) % 2) == 1


def point_in_polygon(points: DataFrame, key: str, polygons: DataFrame, poly: str, rings: str = "rings", how: str = "left", cell: float = 1000.0) -> DataFrame:
    """points with the id of a containing polygon, the smallest on overlap. how: left keeps points in none, inner drops them."""
    pts = points.select(key, F.col("x").alias("_x"), F.col("y").alias("_y")).dropna().withColumn("_cx", F.floor(F.col("_x") / cell)).withColumn("_cy", F.floor(F.col("_y") / cell))
    hit = pts.join(cell_index(polygons, poly, rings, cell), ["_cx", "_cy"]).where(inside_cell(F.col("_x"), F.col("_y"), cell))
    one = hit.groupBy(key).agg(F.min("_p").alias(poly))
    return points.join(one, key, how)


def segments(df: DataFrame, key: str, points: str | None = None, rings: str | None = None) -> DataFrame:
    """(key, ax, ay, bx, by): the segments of lines, the edges of polygons, or points as segments of no length."""
    if points is None and rings is None:
        return df.where("x is not null and y is not null").select(key, F.col("x").alias("ax"), F.col("y").alias("ay"), F.col("x").alias("bx"), F.col("y").alias("by"))
    return df.select(key, F.inline(polygon_edges(F.col(rings)) if rings else edges(F.col(points), False)))


def point_segment2(px, py, ax, ay, bx, by) -> Column:
    """Squared distance of a point and a segment, which may be a point."""
    vx, vy, wx, wy = bx - ax, by - ay, px - ax, py - ay
    along, length2, off = wx * vx + wy * vy, vx * vx + vy * vy, vx * wy - vy * wx
    return F.when(along <= 0, wx * wx + wy * wy).when(along >= length2, (px - bx) * (px - bx) + (py - by) * (py - by)).otherwise(off * off / length2)


def segment_distance(p: str = "", q: str = "o") -> Column:
    """Distance of the segments in columns <p>ax.. and <q>ax..; 0 if they cross. Where the columns are known not to be null
    (`known`), the compiled code is small enough for the JVM to optimise, and ten times as fast."""
    a, b = {k: F.col(p + k) for k in CORNERS}, {k: F.col(q + k) for k in CORNERS}
    ends = [point_segment2(a[f"{e}x"], a[f"{e}y"], b["ax"], b["ay"], b["bx"], b["by"]) for e in "ab"]
    ends += [point_segment2(b[f"{e}x"], b[f"{e}y"], a["ax"], a["ay"], a["bx"], a["by"]) for e in "ab"]
    return F.when(properly_cross(a, b), F.lit(0.0)).otherwise(F.sqrt(F.least(*ends)))


CORNERS = ("ax", "ay", "bx", "by")
#: Rows of a result that a task is meant to make from pairs of places, and the most rows of a side that may be broadcast for it.
COPIED_ROWS, HELD_ROWS = 4_000_000, 500_000


def known(df: DataFrame, columns) -> DataFrame:
    """The rows in which none of the columns is null."""
    return df.where(" and ".join(f"`{c}` is not null" for c in columns))


def _along(ax: Column, ay: Column, bx: Column, by: Column, pad: float, cell: Column | float) -> Column:
    """array<struct<cx, cy>> of the grid cells near a segment: it is walked in steps of a cell, so a diagonal has as many
    cells as its length needs and not those of its whole box."""
    n = F.greatest(F.lit(1), F.ceil(F.hypot(bx - ax, by - ay) / cell).cast("int"))

    def step(i: Column) -> Column:
        u, v = (i - 1) / n, i / n
        x, y, x2, y2 = ax + u * (bx - ax), ay + u * (by - ay), ax + v * (bx - ax), ay + v * (by - ay)
        span = lambda p, q: F.sequence(F.floor((F.least(p, q) - pad) / cell), F.floor((F.greatest(p, q) + pad) / cell))
        return F.flatten(F.transform(span(x, x2), lambda cx: F.transform(span(y, y2), lambda cy: F.struct(cx.alias("_cx"), cy.alias("_cy")))))

    return F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(1), n), step)))


def near_segments(a: DataFrame, key: str, b: DataFrame, other: str, d: float, cell: float | None = None) -> DataFrame:
    """Pairs of segments within d: (key, other, both segments, d), the left ones widened by d. The cell is d or, if longer, the mean
    length of the right segments, so that neither side has many cells a segment. A pair comes once per cell that both are near."""
    a, b, corners = known(a, CORNERS), known(b, CORNERS), CORNERS
    if cell is None:
        mean = b.agg(F.avg(F.hypot(F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")))).first()[0] or 0.0
        cell = max(d, mean, 1.0)
    left = a.select("*", F.inline(_along(*[F.col(c) for c in corners], d, cell)))
    right = b.select(other, *[F.col(c).alias("o" + c) for c in corners], F.inline(_along(*[F.col(c) for c in corners], 0.0, cell)))
    return left.join(right, ["_cx", "_cy"]).drop("_cx", "_cy").withColumn("d", segment_distance()).where(F.col("d") <= d)


def alike(segs: DataFrame, key: str, same: str) -> DataFrame:
    """(key, same): for a feature of a single segment the smallest one with equal corners, for any other itself."""
    per = known(segs, CORNERS).groupBy(key).agg(F.count("*").alias("_n"), *[F.first(c).alias(c) for c in CORNERS])
    per = settled(per)
    one = per.where("_n = 1").groupBy(*CORNERS).agg(F.min(key).alias(same))
    return settled(per.where("_n = 1").join(one, list(CORNERS)).select(key, same).unionByName(per.where("_n > 1").select(key, F.col(key).alias(same))))


def _copied(pairs: DataFrame, a: DataFrame, key: str, b: DataFrame, other: str) -> DataFrame:
    """The pairs (_a, _b and more) of features that stand for others, for all of them: a has (key, _a), b (other, _b). Few pairs may
    stand for very many, so they are dealt to as many tasks as the result needs and meet what fits a broadcast there."""
    size = lambda df, same, n: df.groupBy(same).agg(F.count("*").alias(n))
    rows = pairs.join(size(a, "_a", "_na"), "_a").join(size(b, "_b", "_nb"), "_b").agg(F.sum(F.col("_na") * F.col("_nb"))).first()[0] or 0
    n = min(20_000, max(int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / COPIED_ROWS)))
    (many, of_many, id_many), (few, of_few, id_few) = sorted(((a, "_a", key), (b, "_b", other)), key=lambda s: -s[0].count())
    wide = pairs.repartition(n, of_many).join(many.repartition(n, of_many), of_many)
    held = few if few.count() > HELD_ROWS else F.broadcast(few)
    return wide.join(held, of_few).select(F.col(id_many), F.col(id_few), *[c for c in pairs.columns if c not in ("_a", "_b")])


def within_distance(a: DataFrame, key: str, b: DataFrame, other: str, d: float, cell: float | None = None) -> DataFrame:
    """(key, other, d): pairs of features, given as segments, that are within d. Features at one place are compared once."""
    same_a, same_b = alike(a, key, "_a"), alike(b, other, "_b")
    first = lambda segs, of, same, name: segs.join(same.where(F.col(of) == F.col(name)).select(of), of, "left_semi").select(F.col(of).alias(name), *CORNERS)
    near = near_segments(first(a, key, same_a, "_a"), "_a", first(b, other, same_b, "_b"), "_b", d, cell).groupBy("_a", "_b").agg(F.min("d").alias("d"))
    return _copied(settled(near), same_a, key, same_b, other).select(key, other, "d")


def nearest(a: DataFrame, key: str, b: DataFrame, other: str, k: int = 1, limit: float = math.inf) -> DataFrame:
    """(key, other, d, r): the k nearest features of each feature within `limit`, both given as segments, ties by id.

    The right side is parted where it is dense (see kd.py), so a feature far off or long segments cost nothing elsewhere. Features with
    fewer than k within the limit keep those. Segments with coordinates that are null or not finite are left out.
    """
    finite = " and ".join(f"abs({c}) < 1e300" for c in CORNERS)
    right = b.where(finite).select(other, *[F.col(c).alias("o" + c) for c in CORNERS])
    return nearest_by_parts(a.where(finite), key, right, other, [("ax", "bx"), ("ay", "by")], segment_distance(), k, limit)


def nearest_polygon(points: DataFrame, key: str, polygons: DataFrame, poly: str, rings: str = "rings") -> DataFrame:
    """(key, poly, d): the nearest polygon, distance 0 inside, the smallest id on ties."""
    within = point_in_polygon(points.select(key, "x", "y"), key, polygons, poly, rings, how="inner").select(key, poly, F.lit(0.0).alias("d"))
    rest = points.join(within, key, "left_anti")
    near = nearest(segments(rest, key), key, segments(polygons, poly, rings=rings), poly).select(key, poly, "d")
    return within.unionByName(near)


def knn_lines(points: DataFrame, key: str, lines: DataFrame, line_id: str, k: int = 3, radii: tuple[float, ...] = (5000.0, 15000.0)) -> DataFrame:
    """Wide: id_seg_1.., dist_seg_1.. of the k nearest lines (both given as segments) within the last radius. The radii before it
    change nothing, as the search follows the density of the lines. What is still short stays null."""
    found = nearest(points, key, lines, line_id, k, limit=radii[-1])
    one = lambda i, c: F.max(F.when(F.col("r") == i, F.col(c)))
    wide = found.groupBy(key).agg(*[one(i, line_id).alias(f"id_seg_{i}") for i in range(1, k + 1)], *[one(i, "d").alias(f"dist_seg_{i}") for i in range(1, k + 1)])
    return points.select(key).distinct().join(wide, key, "left")


def near_zone(lines: DataFrame, line_id: str, zone: DataFrame, d: float) -> DataFrame:
    """Ids of lines within d of any feature of the zone (both as segments)."""
    return within_distance(lines, line_id, zone.withColumn("_z", F.lit(1)), "_z", d).select(line_id)


def location_context(points: DataFrame, key: str, polygons: DataFrame, poly: str, rings: str = "rings", assign: float = 500.0, near: float = 1000.0) -> DataFrame:
    """(key, poly, method, context, d): polygon that holds the point, or the nearest within `assign`; context inside, near
    (within `near`) or road_or_rural. The distance is always kept."""
    got = nearest_polygon(points, key, polygons, poly, rings)
    method = F.when(F.col("d") == 0, "within").when(F.col("d") <= assign, "nearest")
    context = F.when(F.col("d") == 0, "inside").when(F.col("d") <= near, "near").otherwise("road_or_rural")
    out = got.select(key, F.when(method.isNotNull(), F.col(poly)).alias(poly), method.alias("method"), context.alias("context"), "d")
    return points.select(key).join(out, key, "left")


def line_pieces(lines: DataFrame, line_id: str, polygons: DataFrame, poly: str, rings: str = "rings", cell: float = 1000.0) -> DataFrame:
    """(line_id, poly, ax, ay, bx, by): the parts of line segments inside each polygon. A segment is cut at the borders of cells and where
    it meets the edges of its cells; a piece belongs if its middle is inside."""
    segs = known(lines, CORNERS).select(line_id, *CORNERS, F.inline(_along(*[F.col(c) for c in CORNERS], 0.0, cell)))
    dx, dy = F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")

    def reach(start: str, step: Column, at: str) -> tuple[Column, Column]:
        """Where the segment is within the cell in one direction."""
        ends = [(F.col(at) + k) * cell - F.col(start) for k in (0, 1)]
        u, v = (F.try_divide(d, step) for d in ends)
        still = (ends[0] <= 0) & (ends[1] > 0)
        return F.when(step == 0, F.when(still, 0.0).otherwise(2.0)).otherwise(F.least(u, v)), F.when(step == 0, F.when(still, 1.0).otherwise(-1.0)).otherwise(F.greatest(u, v))

    (x0, x1), (y0, y1) = reach("ax", dx, "_cx"), reach("ay", dy, "_cy")
    segs = segs.withColumn("_u0", F.greatest(x0, y0, F.lit(0.0))).withColumn("_u1", F.least(x1, y1, F.lit(1.0))).where("_u0 < _u1")
    pairs = segs.join(cell_index(polygons, poly, rings, cell).where(F.col("_in") | (F.size("_e") > 0)), ["_cx", "_cy"])

    def meet(e) -> Column:
        ex, ey = e["bx"] - e["ax"], e["by"] - e["ay"]
        return F.try_divide((e["ax"] - F.col("ax")) * ey - (e["ay"] - F.col("ay")) * ex, dx * ey - dy * ex)

    cuts = F.filter(F.transform("_e", meet), lambda u: u.isNotNull() & (u > F.col("_u0")) & (u < F.col("_u1")))
    marks = F.array_sort(F.array_distinct(F.concat(F.array("_u0", "_u1"), cuts)))
    spans = pairs.withColumn("_u", marks).withColumn("_s", F.explode(F.expr("transform(sequence(1, size(_u) - 1), i -> struct(element_at(_u, i) AS s, element_at(_u, i + 1) AS t))")))
    mid = (F.col("_s.s") + F.col("_s.t")) / 2
    kept = spans.where(inside_cell(F.col("ax") + mid * dx, F.col("ay") + mid * dy, cell))
    at = lambda c, d, u: (F.col(c) + F.col(f"_s.{u}") * d)
    return kept.select(line_id, F.col("_p").alias(poly), at("ax", dx, "s").alias("ax"), at("ay", dy, "s").alias("ay"), at("ax", dx, "t").alias("bx"), at("ay", dy, "t").alias("by"))


def line_length_in_polygon(lines: DataFrame, line_id: str, polygons: DataFrame, poly: str, rings: str = "rings", cell: float = 1000.0) -> DataFrame:
    """(poly, km): length of all lines inside each polygon, 0 without any."""
    pieces = line_pieces(lines, line_id, polygons, poly, rings, cell)
    sums = pieces.groupBy(poly).agg((F.sum(F.hypot(F.col("bx") - F.col("ax"), F.col("by") - F.col("ay"))) / 1000).alias("km"))
    return polygons.select(poly).join(sums, poly, "left").fillna(0.0, subset=["km"])


def _triangle_overlaps(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Shared area of each pair of counter-clockwise triangles [n, 3, 2]: all are cut by the second's edges at once."""
    poly, count = a, np.full(len(a), 3)
    for i in range(3):
        p, q = b[:, i, None], b[:, (i + 1) % 3, None]
        j = np.arange(poly.shape[1])
        nxt = np.where(j + 1 < count[:, None], j + 1, 0)
        there = j < count[:, None]
        side = (q - p)[..., 0] * (poly - p)[..., 1] - (q - p)[..., 1] * (poly - p)[..., 0]
        other, far = np.take_along_axis(side, nxt, 1), np.take_along_axis(poly, nxt[..., None], 1)
        meets = there & (side * other < 0)
        u = np.where(meets, side / np.where(meets, side - other, 1.0), 0.0)
        slots = np.stack([poly, poly + (far - poly) * u[..., None]], 2).reshape(len(poly), -1, 2)
        kept = np.stack([there & (side >= 0), meets], 2).reshape(len(poly), -1)
        count = kept.sum(axis=1)
        order = np.argsort(~kept, axis=1, kind="stable")[:, : max(int(count.max(initial=0)), 1)]
        poly = np.take_along_axis(slots, order[..., None], 1)
    j = np.arange(poly.shape[1])
    there = j < count[:, None]
    far = np.take_along_axis(poly, np.where(j + 1 < count[:, None], j + 1, 0)[..., None], 1)
    return np.abs(np.where(there, poly[..., 0] * far[..., 1] - far[..., 0] * poly[..., 1], 0.0).sum(axis=1)) / 2


def _fans(corners, origin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counter-clockwise triangles of a polygon and their signs: shells count up, holes down."""
    shapes, signs = [], []
    flat = np.array([(q["ring"], q["x"], q["y"]) for q in corners], dtype=float).reshape(-1, 3)
    for n in range(int(flat[:, 0].max(initial=-1)) + 1):
        p = flat[flat[:, 0] == n, 1:] - origin
        if len(p) < 3:
            continue
        t = np.stack([np.broadcast_to(p[0], (len(p) - 2, 2)), p[1:-1], p[2:]], 1)
        area = (t[:, 1, 0] - t[:, 0, 0]) * (t[:, 2, 1] - t[:, 0, 1]) - (t[:, 2, 0] - t[:, 0, 0]) * (t[:, 1, 1] - t[:, 0, 1])
        whole = 1.0 if (area.sum() >= 0) == (n == 0) else -1.0
        t, area = t[area != 0], area[area != 0]
        shapes.append(np.where((area < 0)[:, None, None], t[:, ::-1], t))
        signs.append(whole * np.sign(area))
    return np.concatenate([np.zeros((0, 3, 2)), *shapes]), np.concatenate([np.zeros(0), *signs])


def _corners(rings: Column) -> Column:
    """Corners with their ring's number: rings of different lengths don't fit the arrays that batches become."""
    return F.flatten(F.transform(rings, lambda r, n: F.transform(r, lambda p: F.struct(n.alias("ring"), p["x"].alias("x"), p["y"].alias("y")))))


def _overlap(a: str | Column, b: str | Column) -> Column:
    """Shared area of two polygons given by their corners."""
    return F.pandas_udf(_overlaps, "double")(a, b)


def _overlaps(a: pd.Series, b: pd.Series) -> pd.Series:
    return shared_areas(a, b)


def shared_areas(a: pd.Series, b: pd.Series, chunk: int = 100_000) -> pd.Series:
    """Triangles of all pairs of a batch are cut together, at most about `chunk` pairs of triangles at a time."""
    out = np.zeros(len(a))

    def settle(held: list) -> None:
        t, v, s, k = (np.concatenate(x) for x in zip(*held, strict=True))
        np.add.at(out, k, s * _triangle_overlaps(t, v))

    held, size = [], 0
    for k, (p, q) in enumerate(zip(a, b, strict=True)):
        origin = np.array([p[0]["x"], p[0]["y"]]) if len(p) else np.zeros(2)
        (t, s), (v, u) = _fans(p, origin), _fans(q, origin)
        for at in range(0, len(t), max(1, chunk // max(len(v), 1))):
            part = slice(at, at + max(1, chunk // max(len(v), 1)))
            n = len(t[part])
            held.append((np.repeat(t[part], len(v), axis=0), np.tile(v, (n, 1, 1)), np.repeat(s[part], len(u)) * np.tile(u, n), np.full(n * len(v), k)))
            size += n * len(v)
            if size >= chunk:
                settle(held)
                held, size = [], 0
    if held:
        settle(held)
    return pd.Series(out, dtype="float64")


def polygon_overlap_area(a: DataFrame, key: str, b: DataFrame, other: str, rings: str = "rings", cell: float = 1000.0) -> DataFrame:
    """(key, other, m2): area shared by each pair of polygons that share any. Polygons are fanned into signed triangles,
    so simple polygons with holes are exact."""
    def boxed(df, k, name):
        xs, ys = F.transform(F.flatten(rings), lambda p: p["x"]), F.transform(F.flatten(rings), lambda p: p["y"])
        one = df.select(k, _corners(F.col(rings)).alias(name), F.array_min(xs).alias("x0"), F.array_min(ys).alias("y0"), F.array_max(xs).alias("x1"), F.array_max(ys).alias("y1"))
        return with_cells(one, F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1"), cell).drop("x0", "y0", "x1", "y1")

    pairs = boxed(a, key, "_a").join(boxed(b, other, "_b"), ["_cx", "_cy"]).dropDuplicates([key, other])
    return pairs.select(key, other, _overlap("_a", "_b").alias("m2")).where("m2 > 1e-6")


def largest_band(polygons: DataFrame, key: str, cuts: list[float], names: list[str], rings: str = "rings") -> DataFrame:
    """(key, band): the horizontal band (y below each cut in turn) that holds most of each polygon's area; ties by name."""
    spark, far = polygons.sparkSession, 1e8
    lows, highs = [-far, *cuts], [*cuts, far]
    bands = spark.createDataFrame([(n, float(lo), float(hi)) for n, lo, hi in zip(names, lows, highs, strict=True)], "band string, lo double, hi double")
    ys = F.transform(F.flatten(rings), lambda p: p["y"])
    xs = F.transform(F.flatten(rings), lambda p: p["x"])
    span = polygons.select(key, _corners(F.col(rings)).alias("_c"), F.array_min(ys).alias("y0"), F.array_max(ys).alias("y1"), F.array_min(xs).alias("x0"), F.array_max(xs).alias("x1"))
    pairs = span.join(F.broadcast(bands), (F.col("y1") > F.col("lo")) & (F.col("y0") < F.col("hi")))  # as many bands as names
    x0, y0, x1, y1 = F.col("x0") - 1, F.greatest("lo", F.col("y0") - 1), F.col("x1") + 1, F.least("hi", F.col("y1") + 1)
    strip = F.array(*[F.struct(F.lit(0).alias("ring"), x.alias("x"), y.alias("y")) for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1))])
    shared = pairs.withColumn("_m", _overlap(F.col("_c"), strip))
    best = shared.groupBy(key).agg(F.min(F.struct((-F.col("_m")).alias("m"), "band")).alias("b"))
    return best.select(key, F.col("b.band").alias("band"))


def clip_layer(city: DataFrame, poly: str, points: DataFrame | None = None, lines: DataFrame | None = None, areas: DataFrame | None = None, key: str = "id", rings: str = "rings") -> dict[str, DataFrame]:
    """Features that fall in the city: points inside, lines cut at the border (as segments), polygons that overlap it."""
    out = {}
    if points is not None:
        out["points"] = point_in_polygon(points, key, city, poly, rings, how="inner").drop(poly)
    if lines is not None:
        out["lines"] = line_pieces(lines, key, city, poly, rings).drop(poly).distinct()
    if areas is not None:
        hit = polygon_overlap_area(areas, key, city, poly, rings).select(key).distinct()
        out["areas"] = areas.join(hit, key, "left_semi")
    return out


def area_by_group(polygons: DataFrame, group: str, rings: str = "rings") -> DataFrame:
    return polygons.groupBy(group).agg((F.sum(polygon_area(F.col(rings))) / 1e6).alias("km2"))


def haversine_km(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    h = F.sin(F.radians(lat2 - lat1) / 2) ** 2 + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(F.radians(lon2 - lon1) / 2) ** 2
    return 2 * 6371.0 * F.asin(F.sqrt(F.when(h > 1, 1.0).otherwise(h)))


def haversine_to_center(df: DataFrame, lon: str, lat: str, clon: str, clat: str, km2: str) -> DataFrame:
    """Adds km to the centre and the same relative to the root of the area."""
    out = df.withColumn("center_km", haversine_km(F.col(lon), F.col(lat), F.col(clon), F.col(clat)))
    return out.withColumn("center_relative", F.try_divide(F.col("center_km"), F.sqrt(km2)))


def planar_to_center(df: DataFrame, lon: str, lat: str, group: str) -> DataFrame:
    """Adds planar_km: equirectangular km to the mean position of the group."""
    mean = df.groupBy(group).agg(F.avg(lon).alias("_lo"), F.avg(lat).alias("_la"))
    dx, dy = (F.col(lon) - F.col("_lo")) * 111.32 * F.cos(F.radians("_la")), (F.col(lat) - F.col("_la")) * 110.57
    return df.join(mean, group).withColumn("planar_km", F.hypot(dx, dy)).drop("_lo", "_la")


def hex_counts(points: DataFrame, size: float, cap: int = 100) -> DataFrame:
    """(q, r, n, shown): points per flat-sided hexagon with side `size`, in axial coordinates; shown is n up to the cap."""
    qf, rf = (math.sqrt(3) / 3 * F.col("x") - F.col("y") / 3) / size, (2.0 / 3 * F.col("y")) / size
    base = points.where("x is not null and y is not null").select(qf.alias("qf"), rf.alias("rf")).withColumn("sf", -F.col("qf") - F.col("rf"))
    for c in "qrs":
        base = base.withColumn(c, F.round(f"{c}f")).withColumn(f"d{c}", F.abs(F.col(c) - F.col(f"{c}f")))
    q = F.when((F.col("dq") > F.col("dr")) & (F.col("dq") > F.col("ds")), -F.col("r") - F.col("s")).otherwise(F.col("q"))
    r = F.when((F.col("dq") > F.col("dr")) & (F.col("dq") > F.col("ds")), F.col("r")).when(F.col("dr") > F.col("ds"), -F.col("q") - F.col("s")).otherwise(F.col("r"))
    return base.groupBy(q.cast("long").alias("q"), r.cast("long").alias("r")).agg(F.count("*").alias("n")).withColumn("shown", F.least(F.col("n"), F.lit(cap)))


def line_km(points: Column) -> Column:
    return _total(edges(points, False), lambda e: F.hypot(e["bx"] - e["ax"], e["by"] - e["ay"])) / 1000


def length_by(lines: DataFrame, by: str, name: str, points: str = "points") -> DataFrame:
    """km per class, lines, and names that occur more than once in it."""
    per = lines.groupBy(by, name).agg(F.sum(line_km(F.col(points))).alias("k"), F.count("*").alias("c"))
    return per.groupBy(by).agg(F.sum("k").alias("km"), F.sum("c").alias("lines"), F.count_if(F.col("c") > 1).alias("repeated_names"))


def network_summary(lines: DataFrame, by: str, enabled: str, code: str, points: str = "points") -> DataFrame:
    """Per basin: segments, disabled ones with percentage and km, total km, number of reason codes among the disabled."""
    km, off = line_km(F.col(points)), F.col(enabled) == 0
    got = lines.withColumn("_k", km).groupBy(by).agg(F.count("*").alias("segments"), F.count_if(off).alias("disabled"), F.sum("_k").alias("km"), F.coalesce(F.sum(F.when(off, F.col("_k"))), F.lit(0.0)).alias("disabled_km"), F.count_distinct(F.when(off, F.col(code))).alias("codes"))
    return got.withColumn("disabled_percent", F.col("disabled") * 100.0 / F.col("segments"))


def representative_point(lines: DataFrame, name: str, wanted: DataFrame, wanted_name: str, line_id: str, points: str = "points") -> DataFrame:
    """(wanted_name, x, y): midpoint of the longest segment of the street with that exact name, else of the first candidate street.
    A point on the line, though not the one that other libraries would choose."""
    seg = lines.select(name, line_id, F.inline(edges(F.col(points), False))).withColumn("_l", F.hypot(F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")))
    best = seg.groupBy(name).agg(F.min(F.struct((-F.col("_l")).alias("l"), line_id, ((F.col("ax") + F.col("bx")) / 2).alias("x"), ((F.col("ay") + F.col("by")) / 2).alias("y"))).alias("b"))
    cands = street_candidates(wanted, wanted_name, lines, name)
    ranked = cands.groupBy(wanted_name).agg(F.min(F.struct((F.upper(wanted_name) != F.col(name)).alias("o"), F.col(name).alias("n"))).alias("c"))
    return ranked.select(wanted_name, F.col("c.n").alias(name)).join(best, name).select(wanted_name, F.col("b.x").alias("x"), F.col("b.y").alias("y"))


def has_feature(polygons: DataFrame, poly: str, points: DataFrame, key: str, rings: str = "rings") -> DataFrame:
    hit = point_in_polygon(points, key, polygons, poly, rings, how="inner").select(poly).distinct().withColumn("has", F.lit(True))
    return polygons.select(poly).join(hit, poly, "left").withColumn("has", F.coalesce("has", F.lit(False)))


def crossing_points(pairs: DataFrame, first: str, second: str, streets: DataFrame, street: str, tol: float = 50.0) -> DataFrame:
    """(pair columns, x, y, gap): where two sets of streets meet. pairs has one row per (pair id columns.., first, second)
    street names; the closest segments within tol (all within a centimetre of the least gap) give the midpoints of their
    shortest links, counted once per 0.1 m. Segments meet by named pair and cell, so only those of one pair are ever compared, and streets
    that are equal segments meet once for all their names."""
    ids = [c for c in pairs.columns if c not in (first, second)]
    used = streets.select(street, F.inline(edges(F.col("points"), False)))
    same = alike(used, street, "_s")
    held = same if same.count() > HELD_ROWS else F.broadcast(same)
    as_one = lambda name, out: held.select(F.col(street).alias(name), F.col("_s").alias(out))
    pairs = settled(pairs.join(as_one(first, "_sa"), first).join(as_one(second, "_sb"), second).select(*ids, "_sa", "_sb"))
    named = settled(pairs.select("_sa", "_sb").distinct())
    used = known(settled(used.withColumnRenamed(street, "_sa").join(named.select("_sa").union(named.select("_sb")).distinct(), "_sa", "left_semi")), CORNERS)
    cell = max(tol, used.agg(F.avg(F.hypot(F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")))).first()[0] or 0.0, 1.0)

    def side(name: str, pad: float, prefix: str) -> DataFrame:
        cells = used.select(F.col("_sa").alias(name), *[F.col(c).alias(prefix + c) for c in CORNERS], _along(*[F.col(c) for c in CORNERS], pad, cell).alias("_cells"))
        return named.join(cells, name).select("_sa", "_sb", *[prefix + c for c in CORNERS], F.inline("_cells"))

    met = side("_sa", tol, "").join(side("_sb", 0.0, "o"), ["_sa", "_sb", "_cx", "_cy"]).drop("_cx", "_cy")
    met = settled(met.withColumn("d", segment_distance()).where(F.col("d") <= tol))
    # what is a centimetre over the least gap of its own streets is so over that of any set that holds them
    least = met.groupBy("_sa", "_sb").agg(F.min("d").alias("_least"))
    x, y = link_midpoint()
    spots = met.join(least, ["_sa", "_sb"]).where(F.col("d") <= F.col("_least") + 0.01).select("_sa", "_sb", x.alias("x"), y.alias("y"), "d").distinct()
    spots = settled(spots)
    # dealt by set at once: the least gap and the spots of a set then need no further exchange
    found = pairs.join(F.broadcast(spots) if spots.count() <= HELD_ROWS else spots, ["_sa", "_sb"]).repartition(*ids)
    found = found.withColumn("gap", F.min("d").over(Window.partitionBy(*ids))).where(F.col("d") <= F.col("gap") + 0.01)
    found = found.withColumn("_x", F.round("x", 1)).withColumn("_y", F.round("y", 1))
    return found.groupBy(*ids, "_x", "_y").agg(F.min(F.struct("x", "y", "gap")).alias("p")).select(*ids, "p.x", "p.y", "p.gap")


def link_midpoint(p: str = "", q: str = "o") -> tuple[Column, Column]:
    """Middle of the shortest link between two segments; where they cross, the crossing."""
    a, b = {k: F.col(p + k) for k in ("ax", "ay", "bx", "by")}, {k: F.col(q + k) for k in ("ax", "ay", "bx", "by")}
    dx, dy, ex, ey = a["bx"] - a["ax"], a["by"] - a["ay"], b["bx"] - b["ax"], b["by"] - b["ay"]
    u = F.try_divide((b["ax"] - a["ax"]) * ey - (b["ay"] - a["ay"]) * ex, dx * ey - dy * ex)

    def foot(px, py, s):
        length2 = (s["bx"] - s["ax"]) ** 2 + (s["by"] - s["ay"]) ** 2
        v = F.coalesce(F.try_divide((px - s["ax"]) * (s["bx"] - s["ax"]) + (py - s["ay"]) * (s["by"] - s["ay"]), length2), F.lit(0.0))
        v = F.greatest(F.lit(0.0), F.least(F.lit(1.0), v))
        fx, fy = s["ax"] + v * (s["bx"] - s["ax"]), s["ay"] + v * (s["by"] - s["ay"])
        return F.struct(F.hypot(px - fx, py - fy).alias("d"), ((px + fx) / 2).alias("x"), ((py + fy) / 2).alias("y"))

    links = F.array_min(F.array(*[foot(s[f"{e}x"], s[f"{e}y"], o) for s, o in ((a, b), (b, a)) for e in "ab"]))
    cross = properly_cross(a, b)
    return F.when(cross, a["ax"] + u * dx).otherwise(links["x"]), F.when(cross, a["ay"] + u * dy).otherwise(links["y"])


def locate_expressions(expressions: DataFrame, expr: str, streets: DataFrame, street: str, tol: float = 50.0) -> DataFrame:
    """(expr, cross, x, y, gap) for each crossing named in each distinct expression: parsed, both names resolved to streets, and
    their meeting points found. One plan for all expressions."""
    parsed = settled(expressions.select(expr).distinct().withColumn("_s", parse_crossing(F.col(expr))).where("_s is not null"))
    crosses = parsed.select(expr, F.col("_s")[0].alias("main"), F.explode(F.slice("_s", F.lit(2), F.size("_s") - 1)).alias("cross"))
    names = crosses.select(F.col("main").alias("name")).union(crosses.select("cross"))
    cands = settled(street_candidates(names, "name", streets, street))
    first = cands.withColumnsRenamed({"name": "main", street: "_a"})
    second = cands.withColumnsRenamed({"name": "cross", street: "_b"})
    pairs = crosses.join(first, "main").join(second, "cross").select(expr, "cross", "_a", "_b")
    return crossing_points(pairs, "_a", "_b", streets, street, tol)


def locate_mentions(crossings: DataFrame, expr: str, streets: DataFrame, street: str, polygons: DataFrame, poly: str) -> DataFrame:
    """Adds lat, lon (6 decimals), polygon id, gap and match_method (cruce_geocodificado or unmatched) to crossing mentions.
    The place is the mean of the distinct points of an expression; its polygon the nearest one."""
    crossings = settled(crossings)
    spots = locate_expressions(crossings, expr, streets, street).withColumn("_x", F.round("x", 1)).withColumn("_y", F.round("y", 1))
    spots = spots.groupBy(expr, "_x", "_y").agg(F.min(F.struct("x", "y")).alias("p"), F.max("gap").alias("gap"))
    centre = spots.groupBy(expr).agg(F.avg("p.x").alias("x"), F.avg("p.y").alias("y"), F.max("gap").alias("gap"))
    placed = centre.join(nearest_polygon(centre, expr, polygons, poly).select(expr, poly), expr, "left")
    lon, lat = unproject_lcc(F.col("x"), F.col("y"))
    placed = placed.select(expr, poly, F.round(lat, 6).alias("lat"), F.round(lon, 6).alias("lon"), "x", "y", "gap")
    method = F.when(F.col("lat").isNotNull(), "cruce_geocodificado").otherwise("unmatched")
    return crossings.join(placed, expr, "left").withColumn("match_method", method)


def build_locations(mentions: DataFrame, located: DataFrame, key: str, poly: str, expr: str = "expression") -> DataFrame:
    """Named mentions and located crossings in one table; crossings with the same place count once per document, those without a
    place once per phrase."""
    crossings = located.select(key, F.lit("cruce").alias("location_type"), F.col(expr).alias("raw_text"), poly, "lat", "lon", "source_field", "match_method")
    rest = F.struct("raw_text", "source_field", "match_method", poly, "location_type")
    once = crossings.where("lat is not null").groupBy(key, "lat", "lon").agg(F.min(rest).alias("r")).select(key, "r.location_type", "r.raw_text", f"r.{poly}", "lat", "lon", "r.source_field", "r.match_method")
    return union_by_name([mentions, once, crossings.where("lat is null")])


def geocode_quality(located: DataFrame, polygons: DataFrame, poly: str, expr: str = "expression") -> DataFrame:
    """rows, located, exact (gap 0), inside the assigned polygon, failed percentage."""
    found = located.where("x is not null").select(F.xxhash64(expr, "x", "y").alias("_k"), "x", "y", poly).dropDuplicates(["_k"])
    held = point_in_polygon(found.select("_k", "x", "y"), "_k", polygons, poly, how="inner").select("_k", F.col(poly).alias("_in"))
    both = located.withColumn("_k", F.xxhash64(expr, "x", "y")).join(held, "_k", "left")
    ok = F.col("x").isNotNull()
    got = both.agg(F.count("*").alias("rows"), F.count_if(ok).alias("located"), F.count_if(F.col("gap") == 0).alias("exact"), F.count_if(F.col("_in") == F.col(poly)).alias("inside"))
    return got.withColumn("failed_percent", F.try_divide((F.col("rows") - F.col("located")) * 100.0, F.col("rows")))


def location_precision(gap: Column, address: Column) -> Column:
    return F.when(address, "calle (dirección)").when(gap == 0, "cruce exacto").when(gap.isNotNull(), F.concat(F.lit("cruce aproximado ("), F.bround(gap, 0).cast("int"), F.lit(" m)")))


def mentions_by_area(mentions: DataFrame, poly: str, points: DataFrame, key: str, polygons: DataFrame, months: list[int] | None = None, date: str = "date") -> DataFrame:
    """(poly, n): named mentions by id plus geocoded points by the polygon that holds them, in the given months."""
    from pluvia.operators.resolve import outer_add

    chosen = lambda df: df.where(F.month(date).isin(months)) if months else df
    named = chosen(mentions).where(F.col(poly).isNotNull()).groupBy(poly).agg(F.count("*").alias("n"))
    held = point_in_polygon(chosen(points), key, polygons, poly, how="inner").groupBy(poly).agg(F.count("*").alias("n"))
    return outer_add(named, held, poly)


def footprint(mentions: DataFrame, post: str, place: str, method: str, exact: str) -> DataFrame:
    """Per post: mentions, distinct places, share of one method, mean distance of its points to their own centre."""
    w = Window.partitionBy(post)
    far = F.hypot(F.col("x") - F.avg("x").over(w), F.col("y") - F.avg("y").over(w))
    return mentions.withColumn("_d", far).groupBy(post).agg(F.count("*").alias("mentions"), F.count_distinct(F.col(place)).alias("places"), F.avg((F.col(method) == exact).cast("double")).alias("exact_share"), F.avg("_d").alias("spread"))
