import random

import pytest
from pyspark.sql import functions as F

from blockrisk.functions import geometry as G
from blockrisk.operators import spatial as S
from tests.conftest import rows

SQUARE = [[(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]]
L_SHAPE = [[(4, 0), (8, 0), (8, 2), (6, 2), (6, 4), (4, 4), (4, 0)]]
HOLED = [[(0, 4), (4, 4), (4, 8), (0, 8), (0, 4)], [(1, 5), (1, 7), (3, 7), (3, 5), (1, 5)]]
TRIANGLE = [[(4, 4), (8, 4), (4, 8)]]  # left open
TINY = [[(100, 100), (100.25, 100), (100.25, 100.25), (100, 100.25), (100, 100)]]
TWO_PARTS = [[(20, 0), (22, 0), (22, 2), (20, 2), (20, 0)], [(24, 0), (26, 0), (26, 2), (24, 2), (24, 0)]]
SHAPES = {"square": SQUARE, "ell": L_SHAPE, "holed": HOLED, "triangle": TRIANGLE, "tiny": TINY, "two": TWO_PARTS}


def polygons(spark, shapes):
    data = [(k, [[{"x": float(x), "y": float(y)} for x, y in r] for r in rings]) for k, rings in shapes.items()]
    return spark.createDataFrame(data, f"GISJOIN string, rings {G.RINGS}")


def points(spark, data):
    return spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(data)], "id int, lon double, lat double")


CASES = {
    (1, 1): "square", (4, 1): None, (0, 0): None, (5, 3): "ell", (7, 3): None, (6, 3): None,
    (0.5, 6): "holed", (2, 6): None, (1, 6): None, (5, 5): "triangle", (6, 6): None, (7, 7): None,
    (100.1, 100.1): "tiny", (21, 1): "two", (23, 1): None, (25, 1): "two", (500, 500): None,
}


@pytest.mark.parametrize("strategy", ["auto", "broadcast", "shuffle"])
def test_strictly_inside(spark, strategy):
    located = S.points_in_polygons(points(spark, CASES), polygons(spark, SHAPES), strategy=strategy)
    expected = sorted((i, k) for i, k in enumerate(CASES.values()) if k)
    assert rows(located, "id", "GISJOIN") == expected


def test_left_variants_keep_misses(spark):
    pts, polys = points(spark, CASES), polygons(spark, SHAPES)
    located = S.locate_points(pts, polys, "id")
    assert {r["id"]: r["GISJOIN"] for r in located.collect()} == dict(enumerate(CASES.values()))
    empty = polygons(spark, {"far": [[(900, 900), (901, 900), (901, 901), (900, 900)]]})
    assert rows(S.polygons_with_points(pts, empty), "GISJOIN", "id") == [("far", None)]


def test_null_coordinates_and_empty_polygons(spark):
    pts = spark.createDataFrame([(1, None, 1.0)], "id int, lon double, lat double")
    assert S.points_in_polygons(pts, polygons(spark, SHAPES)).count() == 0
    assert S.points_in_polygons(points(spark, CASES), polygons(spark, {})).count() == 0


def test_hot_cell_is_salted_and_stays_whole(spark):
    crowd = [(1.0, 1.0)] * 3000 + [(0.5 + i / 7000, 1.5) for i in range(3000)] + [(5.0, 3.0)] * 10
    located = S.points_in_polygons(points(spark, crowd), polygons(spark, SHAPES), strategy="shuffle")
    assert rows(located.groupBy("GISJOIN").count()) == [("ell", 10), ("square", 6000)]


def reference_inside(rings, x, y):
    inside = False
    for ring in rings:
        closed = ring if ring[0] == ring[-1] else [*ring, ring[0]]
        for (x1, y1), (x2, y2) in zip(closed, closed[1:]):
            if (x2 - x1) * (y - y1) == (y2 - y1) * (x - x1) and min(x1, x2) <= x <= max(x1, x2) and min(y1, y2) <= y <= max(y1, y2):
                return False
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                inside = not inside
    return inside


@pytest.mark.parametrize("seed", [1, 2])
def test_random_stars_match_brute_force(spark, seed):
    rng = random.Random(seed)
    shapes = {}
    for k in range(30):
        cx, cy, size = rng.randint(-40, 40), rng.randint(-40, 40), rng.choice([1, 2, 6, 25])
        directions = [(1, 0), (1, 1), (0, 1), (-1, 1), (-1, 0), (-1, -1), (0, -1), (1, -1)]
        ring = [(cx + dx * rng.randint(1, 4) * size / 4, cy + dy * rng.randint(1, 4) * size / 4) for dx, dy in directions]
        shapes[f"p{k}"] = [[*ring, ring[0]]]
    pts = [(rng.randint(-200, 200) / 4, rng.randint(-200, 200) / 4) for _ in range(800)]
    expected = sorted(
        (i, k) for i, (x, y) in enumerate(pts) for k, rings in shapes.items() if reference_inside(rings, x, y)
    )
    for strategy in ("broadcast", "shuffle"):
        located = S.points_in_polygons(points(spark, pts), polygons(spark, shapes), strategy=strategy)
        assert rows(located, "id", "GISJOIN") == expected


def test_intersects_counts_touching_and_containment(spark):
    left = polygons(spark, SHAPES)
    right = polygons(spark, {
        "corner": [[(-2, -2), (0, -2), (0, 0), (-2, 0), (-2, -2)]],
        "in_hole": [[(1.5, 5.5), (2.5, 5.5), (2.5, 6.5), (1.5, 6.5), (1.5, 5.5)]],
        "in_square": [[(1, 1), (2, 1), (2, 2), (1, 2), (1, 1)]],
        "around": [[(-50, -50), (50, -50), (50, 50), (-50, 50), (-50, -50)]],
        "second_part": [[(25, 1), (25.5, 1), (25.5, 1.5), (25, 1.5), (25, 1)]],
        "nothing": [[(60, 60), (61, 60), (61, 61), (60, 61), (60, 60)]],
    }).withColumnRenamed("GISJOIN", "TRACT")
    pairs = S.polygons_intersect(left, right, "GISJOIN", "TRACT")
    assert rows(pairs) == sorted(
        [("square", "corner"), ("square", "in_square"), ("two", "second_part")]
        + [(k, "around") for k in ("square", "ell", "holed", "triangle", "two")]
    )
    kept = S.polygons_intersect(left, right, "GISJOIN", "TRACT", how="left")
    assert ("tiny", None) in rows(kept)


def test_centroid_of_holes_and_orientation(spark):
    reverse = {"cw": [list(reversed(SQUARE[0]))], "holed": HOLED, "offset": [
        [(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)], [(0.5, 0.5), (1.5, 0.5), (1.5, 1.5), (0.5, 1.5), (0.5, 0.5)]]}
    x, y = map(F.expr, G.centroid("rings"))
    got = {r[0]: (round(r[1], 9), round(r[2], 9)) for r in polygons(spark, reverse).select("GISJOIN", x, y).collect()}
    shifted = round((2 * 16 - 1 * 1) / 15, 9)
    assert got == {"cw": (2, 2), "holed": (2, 6), "offset": (shifted, shifted)}


def test_albers_against_known_corner_and_round_trip(spark):
    df = spark.createDataFrame([(0.0, 0.0)], "x double, y double")
    lon, lat = G.from_albers(F.col("x"), F.col("y"))
    got = df.select(lon, lat).first()
    assert abs(got[0] + 96.0) < 1e-9 and abs(got[1] - 37.5) < 1e-9
    grid = spark.range(0, 400).select(
        (F.lit(-125.0) + F.col("id") % 20 * 3).alias("lon"), (F.lit(24.0) + F.floor(F.col("id") / 20) * 1.3).alias("lat")
    )
    x, y = G.to_albers(F.col("lon"), F.col("lat"))
    flat = grid.select("lon", "lat", x.alias("x"), y.alias("y"))
    lon, lat = G.from_albers(F.col("x"), F.col("y"))
    worst = flat.select(F.max(F.abs(lon - F.col("lon"))), F.max(F.abs(lat - F.col("lat")))).first()
    assert max(worst) < 1e-9


def test_snyder_worked_example(spark):
    """Published numerical example on the Clarke 1866 ellipsoid, to the tenth of a metre that is printed."""
    clarke = {"lat0": 23.0, "lon0": -96.0, "lat1": 29.5, "lat2": 45.5, "a": 6378206.4, "f": 1 - (1 - 0.00676866) ** 0.5}
    df = spark.createDataFrame([(-75.0, 35.0, 1885472.7, 1535925.0)], "lon double, lat double, x double, y double")
    forward, back = G.to_albers(F.col("lon"), F.col("lat"), clarke), G.from_albers(F.col("x"), F.col("y"), clarke)
    x, y, lon, lat = df.select(*forward, *back).first()
    assert abs(x - 1885472.7) < 0.06 and abs(y - 1535925.0) < 0.06
    assert abs(lon + 75.0) < 1e-6 and abs(lat - 35.0) < 1e-6


@pytest.mark.parametrize("scale", [2.0 ** -40, 2.0 ** 60])
def test_very_small_and_very_large_coordinates(spark, scale):
    shapes = {k: [[(x * scale, y * scale) for x, y in ring] for ring in rings] for k, rings in SHAPES.items()}
    pts = [(x * scale, y * scale) for x, y in CASES]
    located = S.points_in_polygons(points(spark, pts), polygons(spark, shapes))
    assert rows(located, "id", "GISJOIN") == sorted((i, k) for i, k in enumerate(CASES.values()) if k)


def star(rng, cx, cy, size, corners):
    """A ring around a centre whose corners lie on quarter units, so that all arithmetic is exact."""
    directions = [(1, 0), (2, 1), (1, 1), (1, 2), (0, 1), (-1, 2), (-1, 1), (-2, 1), (-1, 0), (-2, -1), (-1, -1), (-1, -2), (0, -1), (1, -2), (1, -1), (2, -1)]
    ring = [(cx + dx * rng.randint(1, 4) * size / 4, cy + dy * rng.randint(1, 4) * size / 4) for dx, dy in directions[:: 16 // corners]]
    return [*ring, ring[0]]


@pytest.mark.parametrize("strategy,most", [("broadcast", 3), ("shuffle", 6)])
def test_split_cells_match_brute_force(spark, strategy, most):
    rng = random.Random(most)
    shapes = {f"p{k}": [star(rng, rng.randint(-20, 20), rng.randint(-20, 20), rng.choice([1, 4, 16]), 16)] for k in range(12)}
    shapes["holed"] = [star(rng, 0, 0, 32, 8), [(1, 1), (3, 1), (3, 3), (1, 3), (1, 1)]]
    pts = [(rng.randint(-160, 160) / 4, rng.randint(-160, 160) / 4) for _ in range(600)]
    pts += [corner for rings in shapes.values() for ring in rings for corner in ring]
    cover = S.PolygonCover.build(polygons(spark, shapes), edges_per_cell=most)
    assert len(cover.levels) > 3
    located = cover.locate(points(spark, pts), strategy=strategy)
    expected = sorted((i, k) for i, (x, y) in enumerate(pts) for k, rings in shapes.items() if reference_inside(rings, x, y))
    assert rows(located, "id", "GISJOIN") == expected


def test_cover_rows_of_a_large_shape_keep_few_edges(spark):
    top = [(float(x), 10.0 + (x * 7919) % 50) for x in range(20_000)]
    shapes = polygons(spark, {"skyline": [[*top, (19_999.0, 0.0), (0.0, 0.0)]]})
    cover = S.PolygonCover.build(shapes)
    most, n = cover.rows.agg(F.max(F.size("_edges")), F.count("*")).first()
    assert most <= S.EDGES_PER_CELL and n < 20_000
    pts = [(x + 0.5, 10.0 + (x * 31) % 60) for x in range(0, 19_999, 7)]
    inside = [i for i, (x, y) in enumerate(pts) if 0 < y < (top[int(x)][1] + top[int(x) + 1][1]) / 2]
    assert [r[0] for r in rows(cover.locate(points(spark, pts)), "id")] == inside


def reference_meet(a, b):
    edges = lambda rings: [e for r in rings for e in zip(r, r[1:]) if e[0] != e[1]]
    side = lambda p, q, c: (q[0] - p[0]) * (c[1] - p[1]) - (q[1] - p[1]) * (c[0] - p[0])
    sign = lambda v: (v > 0) - (v < 0)

    def touch(e, f):
        (p, q), (c, d) = e, f
        boxes = all(min(s[0][k], s[1][k]) <= max(t[0][k], t[1][k]) for k in (0, 1) for s, t in ((e, f), (f, e)))
        return boxes and sign(side(c, d, p)) * sign(side(c, d, q)) <= 0 and sign(side(p, q, c)) * sign(side(p, q, d)) <= 0

    return (
        any(touch(e, f) for e in edges(a) for f in edges(b))
        or any(reference_inside(b, *r[0]) for r in a) or any(reference_inside(a, *r[0]) for r in b)
    )


def test_intersects_of_mixed_sizes_match_brute_force(spark):
    rng, per_key = random.Random(5), 20
    left = {f"l{k}": [star(rng, rng.randint(-30, 30), rng.randint(-30, 30), rng.choice([0.5, 1, 2]), 8)] for k in range(60)}
    right = {f"r{k}": [star(rng, rng.randint(-20, 20), rng.randint(-20, 20), rng.choice([1, 8, 30]), 16)] for k in range(6)}
    right["frame"] = [[(-30, -30), (30, -30), (30, 30), (-30, 30), (-30, -30)], [(-9, -9), (9, -9), (9, 9), (-9, 9), (-9, -9)]]
    pairs = S.polygons_intersect(polygons(spark, left), polygons(spark, right).withColumnRenamed("GISJOIN", "TRACT"), "GISJOIN", "TRACT", cells_per_key=per_key)
    assert rows(pairs) == sorted((a, b) for a, x in left.items() for b, y in right.items() if reference_meet(x, y))


def test_crowded_cells_of_large_shapes_are_split(spark):
    small = {f"s{x}_{y}": [[(x, y), (x + 0.5, y), (x + 0.5, y + 0.5), (x, y + 0.5), (x, y)]] for x in range(0, 32) for y in range(0, 32)}
    large = {"half": [[(-1, -1), (40, -1), (-1, 40), (-1, -1)]]}
    cells = [S._outline(S.PolygonCover.build(polygons(spark, s))) for s in (large, small)]
    refined = S._refined(*cells, 20)
    under = S._on_grids(cells[1].select("_level", "_cx", "_cy"), S._levels(refined), finer=True).groupBy("_grid", "_cx", "_cy").count()
    keys = refined.select(F.col("_level").alias("_grid"), "_cx", "_cy").distinct()
    assert under.join(keys, ["_grid", "_cx", "_cy"]).agg(F.max("count")).first()[0] <= 20
    assert S._refined(cells[1], cells[0], 20) is cells[1]
    whole = S.polygons_intersect(polygons(spark, small), polygons(spark, large).withColumnRenamed("GISJOIN", "TRACT"), "GISJOIN", "TRACT", cells_per_key=20)
    assert whole.count() == sum(reference_meet(r, large["half"]) for r in small.values())
