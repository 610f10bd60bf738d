"""Spatial joins and the block and block-year tables of every source."""

from __future__ import annotations

from pyspark.sql import functions as F

from blockrisk.functions import fields as C
from blockrisk.functions import geometry as G
from blockrisk.operators import aggregates as A
from blockrisk.operators import panel as P
from blockrisk.operators import spatial as S
from blockrisk.plans import features
from blockrisk.session import scratch_path, spread
from blockrisk.sources import census, events, files, property
from blockrisk.workload import tables as T
from blockrisk.workload.registry import query

SINCE = "1995-06-01"
FIRST, LAST = T.FIRST_YEAR, T.LAST_YEAR
PREDICT = 2000

FIRES = events.FIRE_COLUMNS
FIRES_KIND = "Structure_fire i, Vehicle_fire i, External_fire i"


def src(name: str) -> str:
    return f"({T.table_sql(name)})"


# --- prepared points as SQL: px, py, "Year" and measures ---


def _flag(codes: list[str]) -> str:
    return f"CAST(regexp_matches(situation, '{'|'.join(codes)}') AS INT)"


_ANY = "|".join(code for codes in C.FIRE_CLASSES.values() for code in codes)

POINTS_SQL = {
    "fires": f"""
        SELECT {T.point_columns_sql('"Location"')}, year("Incident Date") AS "Year",
               {', '.join(f'{_flag(codes)} AS "{n}"' for n, codes in C.FIRE_CLASSES.items())}
        FROM (SELECT *, "Primary Situation" AS situation FROM {src('fires')})
        WHERE "Location" IS NOT NULL AND "Incident Date" >= TIMESTAMP '{SINCE}'
          AND regexp_matches(situation, '{_ANY}')""",
    "violations": f"""
        SELECT {T.point_columns_sql('"Location"')}, year("Violation Date") AS "Year",
               1 AS "Nviolations"
        FROM {src('violations')}
        WHERE "Location" IS NOT NULL AND "Violation Date" > TIMESTAMP '{SINCE}'""",
    "inspections": f"""
        SELECT {T.point_columns_sql('"Location"')}, year("Inspection Start Date") AS "Year",
               CASE WHEN "Inspection Type Description" = 'complaint inspection' THEN 1 ELSE 0 END
                 AS "Was complaint", 1 AS "Inspection Number"
        FROM {src('inspections')}
        WHERE "Location" IS NOT NULL AND "Inspection End Date" IS NOT NULL
          AND "Inspection Start Date" >= TIMESTAMP '{SINCE}'""",
    "crimes": f"""
        SELECT {T.point_columns_sql('"Location"')}, year("Date") AS "Year",
               CASE WHEN "Category" = 'ARSON' THEN 1 ELSE 0 END AS "CrimeIsArson",
               CASE WHEN "Category" = 'ARSON' THEN 0 ELSE 1 END AS "CrimeIsOther"
        FROM {src('crimes')}
        WHERE "Date" > TIMESTAMP '{SINCE}'
          AND NOT regexp_matches("Category", '{'|'.join(C.EXCLUDED_CRIMES)}')""",
}
MEASURES = {
    "fires": FIRES,
    "violations": ["Nviolations"],
    "inspections": ["Was complaint", "Inspection Number"],
    "crimes": ["CrimeIsArson", "CrimeIsOther"],
}
PREPARE = {
    "fires": events.prepare_fires,
    "violations": events.prepare_violations,
    "inspections": events.prepare_inspections,
    "crimes": events.prepare_crimes,
}


def kinds(names: list[str]) -> str:
    return ", ".join(f"{n} i" for n in names)


def _quoted(names: list[str], prefix: str = "") -> str:
    return ", ".join(f'{prefix}"{n}"' for n in names)


def _sums(names: list[str]) -> str:
    return ", ".join(f'sum("{n}") AS "{n}"' for n in names)


def ctes(*names: str) -> str:
    """``edges``, the block list and, per source, points, located rows and block-year sums."""
    parts = [f"edges AS ({T.edges_sql()})", f'blocks AS (SELECT "GISJOIN" FROM {src("census_blocks")})']
    for n in names:
        keep = ["Year", *MEASURES[n]]
        parts += [
            f"{n}_p AS ({POINTS_SQL[n]})",
            f"{n}_l AS ({T.contains_sql(f'{n}_p', _quoted(keep, f'{n}_p.'))})",
            f'{n}_y AS (SELECT "GISJOIN", "Year", {_sums(MEASURES[n])} FROM {n}_l GROUP BY 1, 2)',
        ]
    return "WITH " + ", ".join(parts)


def points(spark, d, name):
    return PREPARE[name](T.logical(spark, d, name), SINCE)


def cover(spark, d):
    return S.PolygonCover.build(T.blocks(spark, d))


# --- spatial operators ---


@query("pip_inner", "GISJOIN s, n i", f"""
    {ctes('inspections')} SELECT "GISJOIN", count(*) AS n FROM inspections_l GROUP BY 1""")
def _(spark, d):
    located = S.points_in_polygons(points(spark, d, "inspections"), T.blocks(spark, d))
    return A.count_per(located, ["GISJOIN"], "n")


@query("pip_shuffled", "GISJOIN s, n i", f"""
    {ctes('violations')} SELECT "GISJOIN", count(*) AS n FROM violations_l GROUP BY 1""")
def _(spark, d):
    located = S.points_in_polygons(
        points(spark, d, "violations"), T.blocks(spark, d), strategy="shuffle"
    )
    return A.count_per(located, ["GISJOIN"], "n")


@query("pip_left", "GISJOIN s, n i", f"""
    {ctes('fires')} SELECT b."GISJOIN", count(l."Year") AS n
    FROM blocks b LEFT JOIN fires_l l ON l."GISJOIN" = b."GISJOIN" GROUP BY 1""")
def _(spark, d):
    joined = S.polygons_with_points(points(spark, d, "fires"), T.blocks(spark, d))
    return A.count_per(joined, ["GISJOIN"], "n", P.YEAR)


@query("pip_holes", "GISJOIN s, n i", f"""
    WITH edges AS (SELECT * FROM ({T.edges_sql()}) WHERE block IN
        (SELECT block FROM ({T.edges_sql()}) GROUP BY 1 HAVING count(*) = 8)),
      p AS (SELECT x / 1e6 + 0.0001 AS px, y / 1e6 + 0.0001 AS py FROM {src('census_blocks')}
            UNION ALL SELECT x / 1e6 + 0.0014, y / 1e6 + 0.0014 FROM {src('census_blocks')}
            UNION ALL SELECT x / 1e6, y / 1e6 + 0.0007 FROM {src('census_blocks')})
    SELECT "GISJOIN", count(*) AS n FROM ({T.contains_sql('p', 'p.px')}) GROUP BY 1""")
def _(spark, d):
    """A corner, the hole's middle and a border point of every block, against blocks with a hole."""
    holed = T.blocks(spark, d).filter(F.size("rings") == 2)
    base = T.logical(spark, d, "census_blocks")
    spots = F.array(*[
        F.struct((F.col("x") / F.lit(1e6) + dx).alias("lon"), (F.col("y") / F.lit(1e6) + dy).alias("lat"))
        for dx, dy in ((0.0001, 0.0001), (0.0014, 0.0014), (0.0, 0.0007))
    ])
    located = S.points_in_polygons(base.select(F.inline(spots)), holed)
    return A.count_per(located, ["GISJOIN"], "n")


_SITES = f"""
    WITH edges AS ({T.edges_sql()}),
      sites_p AS (SELECT event_id, lon AS px, lat AS py FROM {src('sites')}),
      hits AS ({T.contains_sql('sites_p', 'sites_p.event_id')})"""


@query("locate_points", "event_id i, GISJOIN s", f"""
    {_SITES} SELECT s.event_id, h."GISJOIN" FROM sites_p s LEFT JOIN hits h ON h.event_id = s.event_id""")
def _(spark, d):
    sites = T.logical(spark, d, "sites").select("event_id", "lon", "lat")
    return S.locate_points(sites, T.blocks(spark, d), "event_id").select("event_id", "GISJOIN")


_TRACT_EDGES = f"""
    SELECT t."TRACT" AS tract, (t.x + s.ax * {T.QUARTER}) / 1e6 AS x1, (t.y + s.ay * {T.QUARTER}) / 1e6 AS y1,
           (t.x + s.bx * {T.QUARTER}) / 1e6 AS x2, (t.y + s.b_y * {T.QUARTER}) / 1e6 AS y2
    FROM {src('tracts')} t,
      (VALUES (0, 0, 16, 0), (16, 0, 16, 16), (16, 16, 0, 16), (0, 16, 0, 0)) s(ax, ay, bx, b_y)"""


def _side(a: str, b: str, c: str, dd: str, px: str, py: str) -> str:
    return f"sign(({c} - {a}) * ({py} - {b}) - ({dd} - {b}) * ({px} - {a}))"


# Every edge pair tested for contact; a tract is never inside a block, and a block
# strictly inside a tract is caught by its first vertex lying in the tract's box.
_MEET = f"""
    edges AS ({T.edges_sql()}), tedges AS ({_TRACT_EDGES}),
    bbox AS (SELECT block, min(x1) AS xlo, max(x1) AS xhi, min(y1) AS ylo, max(y1) AS yhi
             FROM edges GROUP BY 1),
    tbox AS (SELECT tract, min(x1) AS xlo, max(x1) AS xhi, min(y1) AS ylo, max(y1) AS yhi
             FROM tedges GROUP BY 1),
    near AS (SELECT b.block, t.tract, b.xlo > t.xlo AND b.xhi < t.xhi AND b.ylo > t.ylo AND b.yhi < t.yhi AS within
             FROM bbox b JOIN tbox t ON b.xlo <= t.xhi AND b.xhi >= t.xlo AND b.ylo <= t.yhi AND b.yhi >= t.ylo),
    meet AS (SELECT block, tract FROM near WHERE within
             UNION
             SELECT n.block, n.tract FROM near n JOIN edges e ON e.block = n.block
             JOIN tedges f ON f.tract = n.tract
             WHERE least(e.x1, e.x2) <= greatest(f.x1, f.x2) AND least(f.x1, f.x2) <= greatest(e.x1, e.x2)
               AND least(e.y1, e.y2) <= greatest(f.y1, f.y2) AND least(f.y1, f.y2) <= greatest(e.y1, e.y2)
               AND {_side('f.x1', 'f.y1', 'f.x2', 'f.y2', 'e.x1', 'e.y1')}
                 * {_side('f.x1', 'f.y1', 'f.x2', 'f.y2', 'e.x2', 'e.y2')} <= 0
               AND {_side('e.x1', 'e.y1', 'e.x2', 'e.y2', 'f.x1', 'f.y1')}
                 * {_side('e.x1', 'e.y1', 'e.x2', 'e.y2', 'f.x2', 'f.y2')} <= 0)"""


@query("polygons_intersect", "GISJOIN s, TRACT s", f"""
    WITH {_MEET} SELECT block AS "GISJOIN", tract AS "TRACT" FROM meet""")
def _(spark, d):
    return S.polygons_intersect(T.blocks(spark, d), T.tracts(spark, d), "GISJOIN", "TRACT")


#: Orders to a skyline: a shape whose upper side has a vertex per line item, several ten thousand in all.
_SKYLINE = 8192


@query("pip_many_edges", "shape i, n i, total i, edges i", f"""
    WITH tops AS (
        SELECT CAST(floor(l_orderkey / {_SKYLINE}) AS BIGINT) AS shape, CAST((l_orderkey % {_SKYLINE}) * 8 + l_linenumber AS DOUBLE) AS x, 1 + max(l_quantity) AS h FROM lineitem GROUP BY l_orderkey, l_linenumber),
      sides AS (SELECT shape, x AS x1, 100 * shape + h AS y1, lead(x) OVER w AS x2, 100 * shape + lead(h) OVER w AS y2 FROM tops WINDOW w AS (PARTITION BY shape ORDER BY x)),
      p AS (SELECT o_orderkey, CAST(floor(o_orderkey / {_SKYLINE}) AS BIGINT) AS at, (o_orderkey % {_SKYLINE}) * 8 + o_custkey % 7 + 0.5 AS px,
                   100 * CAST(floor(o_orderkey / {_SKYLINE}) AS BIGINT) + o_custkey % 60 + 0.5 AS py FROM orders),
      found AS (SELECT s.shape, p.o_orderkey FROM p ASOF JOIN sides s ON p.at = s.shape AND p.px >= s.x1
                WHERE p.px < s.x2 AND (p.py - s.y1) * (s.x2 - s.x1) < (s.y2 - s.y1) * (p.px - s.x1))
    SELECT shape, count(*) AS n, sum(o_orderkey) AS total, 1 AS edges FROM found GROUP BY 1""")
def _(spark, d):
    """Points in shapes of tens of thousands of vertices; ``edges`` tells whether all cover rows keep to the bound."""
    shape = F.floor(F.col("l_orderkey") / _SKYLINE)
    vertex = F.struct(((F.col("l_orderkey") % _SKYLINE) * 8 + F.col("l_linenumber")).cast("double").alias("x"), (100 * shape + 1 + F.col("l_quantity")).alias("y"))
    lines = T.read(spark, d, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").alias("l_quantity"))
    tops = lines.groupBy(shape.alias("GISJOIN")).agg(F.array_sort(F.collect_list(vertex)).alias("top"))
    foot = "named_struct('x', {}, 'y', cast(100 * GISJOIN AS double))"
    shapes = tops.selectExpr("GISJOIN", f"array(concat(top, array({foot.format('element_at(top, -1).x')}, {foot.format('top[0].x')}, top[0]))) AS rings")
    covered = S.PolygonCover.build(shapes)
    base = F.floor(F.col("o_orderkey") / _SKYLINE)
    spots = T.read(spark, d, "orders").select(
        "o_orderkey", ((F.col("o_orderkey") % _SKYLINE) * 8 + F.col("o_custkey") % 7 + 0.5).alias("lon"), (100 * base + F.col("o_custkey") % 60 + 0.5).alias("lat")
    )
    bound = covered.rows.agg((F.max(F.size("_edges")) <= S.EDGES_PER_CELL).cast("int")).scalar()
    located = covered.locate(spots).groupBy(F.col("GISJOIN").alias("shape"))
    return located.agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("total")).withColumn("edges", bound)


# A region, one for every fifth customer: a diamond around the middle of all its blocks, about as
# large as the whole table, hence far larger than a block.
_REGIONS = f"""
    SELECT 'R' || CAST(c_custkey % 5 AS VARCHAR) AS region, min(x) AS xlo, max(x) + {T.CELL} AS xhi, min(y) AS ylo, max(y) + {T.CELL} AS yhi
    FROM (SELECT c_custkey, {T._x('c_custkey', '0')} AS x, {T._y('c_custkey', '0')} AS y FROM customer) GROUP BY 1"""
_DIAMOND = [("xlo", "(ylo + yhi) / 2"), ("(xlo + xhi) / 2", "ylo"), ("xhi", "(ylo + yhi) / 2"), ("(xlo + xhi) / 2", "yhi")]


@query("polygons_intersect_mixed", "GISJOIN s, region s", f"""
    WITH edges AS ({T.edges_sql()}), regions AS (
        SELECT region, CAST(floor(xlo) AS DOUBLE) AS xlo, CAST(xhi AS DOUBLE) AS xhi, CAST(ylo AS DOUBLE) AS ylo, CAST(yhi AS DOUBLE) AS yhi FROM ({_REGIONS})),
      corners AS (
        {' UNION ALL '.join(f"SELECT region, {n} AS place, {x} / 1e6 AS x, {y} / 1e6 AS y FROM regions" for n, (x, y) in enumerate(_DIAMOND))}),
      outlines AS (SELECT a.region, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2 FROM corners a JOIN corners b ON b.region = a.region AND b.place = (a.place + 1) % 4),
      holds AS (  -- a diamond is convex: a vertex lies in it if it lies to one side of all its edges
        SELECT e.block, f.region FROM edges e JOIN outlines f ON true GROUP BY e.block, f.region, e.x1, e.y1
        HAVING min({_side('f.x1', 'f.y1', 'f.x2', 'f.y2', 'e.x1', 'e.y1')}) >= 0),
      crosses AS (
        SELECT e.block, f.region FROM edges e JOIN outlines f
          ON least(e.x1, e.x2) <= greatest(f.x1, f.x2) AND least(f.x1, f.x2) <= greatest(e.x1, e.x2)
         AND least(e.y1, e.y2) <= greatest(f.y1, f.y2) AND least(f.y1, f.y2) <= greatest(e.y1, e.y2)
        WHERE {_side('f.x1', 'f.y1', 'f.x2', 'f.y2', 'e.x1', 'e.y1')} * {_side('f.x1', 'f.y1', 'f.x2', 'f.y2', 'e.x2', 'e.y2')} <= 0
          AND {_side('e.x1', 'e.y1', 'e.x2', 'e.y2', 'f.x1', 'f.y1')} * {_side('e.x1', 'e.y1', 'e.x2', 'e.y2', 'f.x2', 'f.y2')} <= 0)
    SELECT block AS "GISJOIN", region FROM holds UNION SELECT block, region FROM crosses""")
def _(spark, d):
    """Blocks against a handful of shapes as large as the city."""
    place = T.read(spark, d, "customer").selectExpr("concat('R', c_custkey % 5) AS region", f"{T._x('c_custkey', '0')} AS x", f"{T._y('c_custkey', '0')} AS y")
    bounds = place.groupBy("region").agg(
        F.min("x").cast("double").alias("xlo"), (F.max("x") + T.CELL).cast("double").alias("xhi"),
        F.min("y").cast("double").alias("ylo"), (F.max("y") + T.CELL).cast("double").alias("yhi"),
    )
    ring = ", ".join(f"named_struct('x', {x} / 1e6D, 'y', {y} / 1e6D)" for x, y in [*_DIAMOND, _DIAMOND[0]])
    return S.polygons_intersect(T.blocks(spark, d), bounds.selectExpr("region", f"array(array({ring})) AS rings"), "GISJOIN", "region", cells_per_key=64)


@query("tract_to_block", "GISJOIN s, JOIE001 m, JTIE001 m, J4TM001 f", f"""
    WITH {_MEET}, local AS (SELECT * FROM {src('tracts')} WHERE "COUNTY" = 'San Francisco County'),
      pairs AS (SELECT b."GISJOIN", m.tract AS "TRACT" FROM {src('census_blocks')} b
                LEFT JOIN (SELECT * FROM meet WHERE tract IN (SELECT "TRACT" FROM local)) m
                  ON m.block = b."GISJOIN")
    SELECT p."GISJOIN", l."JOIE001", l."JTIE001", l."J4TM001"
    FROM pairs p FULL JOIN local l ON l."TRACT" = p."TRACT" """)
def _(spark, d):
    tracts = T.tracts(spark, d)
    return census.tracts_to_blocks(T.blocks(spark, d), tracts, tracts, tracts)


# Tracts moved a little, so that no border of theirs coincides with one of a block: contact within
# the rounding of a reprojection would be undecided.
_EAST, _NORTH = 0.000333, 0.000217
_MOVED_MEET = _MEET.replace(_TRACT_EDGES, f"SELECT tract, x1 + {_EAST} AS x1, y1 + {_NORTH} AS y1, x2 + {_EAST} AS x2, y2 + {_NORTH} AS y2 FROM ({_TRACT_EDGES}) t")


@query("tract_to_block_projected", "GISJOIN s, JOIE001 m, JTIE001 m, J4TM001 f", f"""
    WITH {_MOVED_MEET}, local AS (SELECT * FROM {src('tracts')} WHERE "COUNTY" = 'San Francisco County'),
      boxed AS (SELECT "TRACT" FROM local WHERE x / 1e6 + 0.0056 > -122.53 AND x / 1e6 + 0.0056 < -122.35 AND y / 1e6 + 0.0056 > 37.7 AND y / 1e6 + 0.0056 < 37.84),
      pairs AS (SELECT b."GISJOIN", m.tract AS "TRACT" FROM {src('census_blocks')} b
                LEFT JOIN (SELECT * FROM meet WHERE tract IN (SELECT "TRACT" FROM boxed)) m ON m.block = b."GISJOIN")
    SELECT p."GISJOIN", l."JOIE001", l."JTIE001", l."J4TM001"
    FROM pairs p FULL JOIN local l ON l."TRACT" = p."TRACT" """)
def _(spark, d):
    """Tracts arrive in the conic projection with the interior point of each; those outside the city box meet no block."""
    def project(p):
        x, y = G.to_albers(p["x"] + _EAST, p["y"] + _NORTH)
        return F.struct(x.alias("x"), y.alias("y"))

    tracts = T.tracts(spark, d)
    inner = [(F.col("rings")[0][0][axis] + 0.0056).cast("string").alias(name) for axis, name in (("x", "INTPTLON10"), ("y", "INTPTLAT10"))]
    shapes = tracts.select("*", *inner).withColumn("rings", F.transform("rings", lambda r: F.transform(r, project)))
    return census.tracts_to_blocks(T.blocks(spark, d), shapes, tracts, tracts, box=C.CITY_BOX, projected=True)


@query("centroid", "block_num s, lon f, lat f", f"""
    SELECT block_num, (x + x2) / 2 AS lon, (y + y2) / 2 AS lat FROM {src('landuse')}""")
def _(spark, d):
    x, y = map(F.expr, G.centroid("rings"))
    return spread(T.parcels(spark, d).select("block_num", "rings")).select("block_num", x.alias("lon"), y.alias("lat"))


def _two_parts(spark, d):
    """Parcels with a second part of half their side, ten sides to the east."""
    second = "transform(rings[0], p -> named_struct('x', (p.x - x) / 2 + x + 10 * (x2 - x), 'y', (p.y - y) / 2 + y))"
    corners = T.logical(spark, d, "landuse").selectExpr("block_num", "x", "y", "x2", "y2")
    joined = T.parcels(spark, d).select("block_num", "rings").join(corners, "block_num")
    return spread(joined, "block_num", "rings").withColumn("rings", F.expr(f"concat(rings, array({second}))"))


@query("centroid_multipart", "block_num s, lon f, lat f", f"""
    SELECT block_num, (4 * (x + x2) / 2 + x + 10.25 * (x2 - x)) / 5 AS lon, (4 * (y + y2) / 2 + y + 0.25 * (y2 - y)) / 5 AS lat
    FROM {src('landuse')}""")
def _(spark, d):
    x, y = map(F.expr, G.centroid("rings"))
    return _two_parts(spark, d).select("block_num", x.alias("lon"), y.alias("lat"))


@query("geojson_multipart", "block_num s, kind s, parts i, xmin f, xmax f, ymax f", f"""
    SELECT block_num, 'MultiPolygon' AS kind, 2 AS parts, x AS xmin, x + 10.5 * (x2 - x) AS xmax, greatest(y, y2) AS ymax
    FROM {src('landuse')}""")
def _(spark, d):
    path = scratch_path(spark, "geojson-parts")
    files.write_geojson(_two_parts(spark, d), path, ["block_num"])
    raw = spark.read.text(path).select(F.get_json_object("value", "$.properties.block_num").alias("block_num"), F.get_json_object("value", "$.geometry.type").alias("kind"))
    back = files.read_geojson(spark, path, "block_num string")
    bounds = G.bounds_of("rings")
    return raw.join(back, "block_num").selectExpr("block_num", "kind", "size(rings) AS parts", f"{bounds['xmin']} AS xmin", f"{bounds['xmax']} AS xmax", f"{bounds['ymax']} AS ymax")


@query("pip_hot_cell", "GISJOIN s, n i", f"""
    {ctes('violations')}, hot AS (
        SELECT v.px, v.py, v."Year" + r.i AS "Year" FROM violations_p v CROSS JOIN range(1000) r(i)
        WHERE r.i = 0 OR v.px = (SELECT min(px) FROM violations_p)),
      found AS ({T.contains_sql('hot', 'hot."Year"')})
    SELECT "GISJOIN", count(*) AS n FROM found GROUP BY 1""")
def _(spark, d):
    """One place with most of the points, joined by shuffle with a salt per hundred of them."""
    base = points(spark, d, "violations")
    copies = F.when(F.col("lon") == base.agg(F.min("lon")).scalar(), 999).otherwise(0)
    crowded = base.withColumn("copy", F.explode(F.sequence(F.lit(0), copies)))
    located = cover(spark, d).locate(crowded, strategy="shuffle", points_per_salt=100)
    return A.count_per(located, ["GISJOIN"], "n")


@query("locate_points_repeated_key", "k i, lon f, GISJOIN s", f"""
    {_SITES} SELECT 1 AS k, s.px AS lon, h."GISJOIN" FROM sites_p s LEFT JOIN hits h ON h.event_id = s.event_id""")
def _(spark, d):
    sites = T.logical(spark, d, "sites").select(F.lit(1).alias("k"), "lon", "lat")
    return S.locate_points(sites, T.blocks(spark, d), "k").select("k", "lon", "GISJOIN")


# --- blocks and spine ---

_CITY = f"""
    SELECT b.* FROM {src('census_blocks')} b
    WHERE b."GISJOIN" IN (SELECT "GISJOIN" FROM {src('census_population')}
                          WHERE "COUNTY" = 'San Francisco County')
      AND CAST("INTPTLON10" AS DOUBLE) > -122.53 AND CAST("INTPTLON10" AS DOUBLE) < -122.35
      AND CAST("INTPTLAT10" AS DOUBLE) > 37.7 AND CAST("INTPTLAT10" AS DOUBLE) < 37.84"""


def _vertex_sum(rings):
    flat = F.flatten(F.transform(rings, lambda r: F.transform(r, lambda p: p["x"] + p["y"])))
    return F.aggregate(flat, F.lit(0.0), lambda a, v: a + v)


@query("city_blocks", "GISJOIN s, vertices m", f"""
    WITH e AS ({T.edges_sql()}),
      rings AS (SELECT block, sum(x1 + y1) AS open_sum FROM e GROUP BY 1),
      again AS (SELECT c."GISJOIN", (c.x + CASE WHEN c.shape = 3 THEN {T.QUARTER} ELSE 0 END) / 1e6
                         + (c.y + CASE WHEN c.shape = 3 THEN {T.QUARTER} ELSE 0 END) / 1e6
                         + CASE WHEN c.shape = 3 THEN (c.x + c.y) / 1e6 ELSE 0 END AS closing
                FROM {src('census_blocks')} c)
    SELECT c."GISJOIN", r.open_sum + a.closing AS vertices FROM ({_CITY}) c
    JOIN rings r ON r.block = c."GISJOIN" JOIN again a ON a."GISJOIN" = c."GISJOIN" """)
def _(spark, d):
    """Block shapes arrive in the conic projection and leave in degrees."""
    def project(p):
        x, y = G.to_albers(p["x"], p["y"])
        return F.struct(x.alias("x"), y.alias("y"))

    shapes = T.blocks(spark, d).withColumn(
        "rings", F.transform("rings", lambda r: F.transform(r, project))
    )
    city = census.city_blocks(shapes, T.logical(spark, d, "census_population"), projected=True)
    return city.select("GISJOIN", _vertex_sum(F.col("rings")).alias("vertices"))


@query("block_years", "GISYEARJOIN s, Year i, LAT f, LON f, AREA f", f"""
    SELECT c."GISJOIN" || CAST(y.y AS VARCHAR) AS "GISYEARJOIN", y.y AS "Year",
           CAST("INTPTLAT10" AS DOUBLE) AS "LAT", CAST("INTPTLON10" AS DOUBLE) AS "LON",
           CAST("ALAND10" AS DOUBLE) AS "AREA"
    FROM ({_CITY}) c, generate_series(2007, 2018) y(y)""")
def _(spark, d):
    city = census.city_blocks(
        T.blocks(spark, d), T.logical(spark, d, "census_population"),
        extra=["INTPTLAT10", "INTPTLON10", "ALAND10"],
    )
    spine = census.block_years(city)
    return spine.withColumn("GISYEARJOIN", C.block_year_key("GISJOIN", P.YEAR))


# --- event sources ---


@query("fires_block_year", f"GISYEARJOIN s, GISJOIN s, Year i, {FIRES_KIND}", f"""
    {ctes('fires')}
    SELECT b."GISJOIN" || CAST(y."Year" AS VARCHAR) AS "GISYEARJOIN", b."GISJOIN", y."Year",
           {', '.join(f'coalesce(f."{n}", 0) AS "{n}"' for n in FIRES)}
    FROM blocks b CROSS JOIN (SELECT DISTINCT "Year" FROM fires_y) y
    LEFT JOIN fires_y f ON f."GISJOIN" = b."GISJOIN" AND f."Year" = y."Year" """)
def _(spark, d):
    blocks = T.blocks(spark, d)
    dense = events.fires_per_block_year(points(spark, d, "fires"), blocks, S.PolygonCover.build(blocks))
    return dense.withColumn("GISYEARJOIN", C.block_year_key("GISJOIN", P.YEAR))


@query("fires_target", f"GISJOIN s, Year i, {kinds(FIRES)}, {kinds(list(features.TARGETS.values()))}", f"""
    {ctes('fires')}
    SELECT a."GISJOIN", a."Year", {_quoted(FIRES, 'a.')},
           {', '.join(f'b."{n}" AS "{t}"' for n, t in features.TARGETS.items())}
    FROM fires_y a LEFT JOIN fires_y b ON b."GISJOIN" = a."GISJOIN" AND b."Year" = a."Year" + 1""")
def _(spark, d):
    counts = events.per_block_year(points(spark, d, "fires"), cover(spark, d))
    return events.fires_with_target(counts, features.TARGETS)


def _register_block_year(name: str, key: str):
    measures = MEASURES[name]

    @query(key, f"GISJOIN s, Year i, {kinds(measures)}", f"{ctes(name)} SELECT * FROM {name}_y")
    def _(spark, d):
        return events.per_block_year(points(spark, d, name), cover(spark, d))


for _name, _key in (
    ("violations", "violations_block_year"),
    ("inspections", "inspections_block_year"),
    ("crimes", "crimes_block_year"),
):
    _register_block_year(_name, _key)


def _register_block(name: str, key: str):
    measures = MEASURES[name]
    held = ", ".join(f'coalesce(sum(l."{n}") FILTER (l."Year" < {PREDICT}), 0) AS "{n}"' for n in measures)

    @query(key, f"GISJOIN s, {kinds(measures)}", f"""
        {ctes(name)} SELECT b."GISJOIN", {held}
        FROM blocks b LEFT JOIN {name}_l l ON l."GISJOIN" = b."GISJOIN" GROUP BY 1""")
    def _(spark, d):
        return events.per_block(points(spark, d, name), T.blocks(spark, d), cover(spark, d), PREDICT)


for _name, _key in (
    ("violations", "violations_block"), ("inspections", "inspections_block"), ("crimes", "crimes_block"),
):
    _register_block(_name, _key)

_SIDES = [f"{n}_{side}" for side in ("train", "holdout") for n in FIRES]


@query("fires_train_holdout", f"GISJOIN s, {kinds(_SIDES)}", f"""
    {ctes('fires')} SELECT b."GISJOIN",
      {', '.join(f'coalesce(sum(l."{n}") FILTER (l."Year" < {PREDICT}), 0) AS "{n}_train"' for n in FIRES)},
      {', '.join(f'coalesce(sum(l."{n}") FILTER (l."Year" = {PREDICT}), 0) AS "{n}_holdout"' for n in FIRES)}
    FROM blocks b LEFT JOIN fires_l l ON l."GISJOIN" = b."GISJOIN" GROUP BY 1""")
def _(spark, d):
    return events.per_block(
        points(spark, d, "fires"), T.blocks(spark, d), cover(spark, d), PREDICT, holdout=True
    )


# --- property, land use, census ---

_MEANS_SQL = ", ".join(f'avg("{c}") AS "{c}"' for c in property.MEANS)


def _share_sql(column: str, groups: dict[str, list[str]]) -> str:
    def one(name, codes):
        listed = ", ".join(f"'{c}'" for c in codes)
        return f'count(*) FILTER ("{column}" IN ({listed})) / CAST(count(*) AS DOUBLE) AS "{name}"'

    return ", ".join(one(n, c) for n, c in groups.items())


_USE_SQL = _share_sql("Use Code", {c: [c] for c in property.USE_CODES})
_TYPES = {c: [c] for c in property.TYPE_CODES}
_TYPE_SQL = _share_sql("Construction Type", _TYPES | {"S": property.MERGED_TYPES})
_TYPE_SQL_ALL = _share_sql("Construction Type", _TYPES | {"S": [*property.MERGED_TYPES, "?"]})
SHARES = [*property.USE_CODES, *property.TYPE_CODES, "S"]
SHARE_KINDS = ", ".join(f"{c} f" for c in SHARES)
MEAN_KINDS = ", ".join(f"{c} a" for c in property.MEANS)

PROPERTY_SQL = f"""
    property_p AS (SELECT *, "Closed Roll Year" + 1 AS "Year", {T.point_columns_sql('the_geom')}
                   FROM {src('property')} WHERE the_geom IS NOT NULL AND "Use Code" IS NOT NULL),
    property_l AS ({T.contains_sql('property_p', 'property_p.*')}),
    property_1 AS (SELECT * FROM property_l WHERE "Year Property Built" BETWEEN 1890 AND 2018),
    property_2 AS (SELECT * FROM property_1 WHERE "Assessed Land Value" <
                   (SELECT quantile_cont("Assessed Land Value", 0.95) FROM property_1)),
    property_3 AS (SELECT * FROM property_2 WHERE "Lot Area" > 0 AND "Lot Area" <
                   (SELECT quantile_cont("Lot Area", 0.95) FROM property_2)),
    property_y AS (SELECT "GISJOIN", "Year", {_MEANS_SQL}, {_USE_SQL}, {_TYPE_SQL}
                   FROM property_3 GROUP BY 1, 2)"""


@query("property_block_year", f"GISJOIN s, Year i, {MEAN_KINDS}, {SHARE_KINDS}",
       f"{ctes()}, {PROPERTY_SQL} SELECT * FROM property_y")
def _(spark, d):
    return property.property_per_block_year(T.logical(spark, d, "property"), cover(spark, d))


_BLOCK_MEANS = [c for c in property.MEANS if c != "Number of Units"]
PROPERTY_BLOCK_SQL = f"""
    roll_p AS (SELECT *, {T.point_columns_sql('the_geom')} FROM {src('property')}
               WHERE the_geom IS NOT NULL AND "Use Code" IS NOT NULL
                 AND "Year Property Built" <= 2019
                 AND "Closed Roll Year" >= 1995 AND "Closed Roll Year" < {PREDICT}),
    roll_l AS ({T.contains_sql('roll_p', 'roll_p.*')}),
    roll_b AS (SELECT "GISJOIN", sum("Number of Units") AS "Number of Units",
                      {', '.join(f'avg("{c}") AS "{c}"' for c in _BLOCK_MEANS)},
                      {_USE_SQL}, {_TYPE_SQL_ALL} FROM roll_l GROUP BY 1),
    roll_d AS (SELECT b."GISJOIN", r."Number of Units", {_quoted(_BLOCK_MEANS, 'r.')},
                      {', '.join(f'coalesce(r."{c}", 0) AS "{c}"' for c in SHARES)}
               FROM blocks b LEFT JOIN roll_b r ON r."GISJOIN" = b."GISJOIN"),
    roll AS (SELECT *, CASE WHEN {' + '.join(f'"{c}"' for c in property.USE_CODES)} = 0
                            THEN 1 ELSE 0 END AS "UnkownUseType",
                       CASE WHEN {' + '.join(f'"{c}"' for c in [*property.TYPE_CODES, 'S'])} = 0
                            THEN 1 ELSE 0 END AS "UnkownStructureType" FROM roll_d)"""
ROLL_KINDS = (
    "Number of Units m, " + ", ".join(f"{c} a" for c in _BLOCK_MEANS)
    + f", {SHARE_KINDS}, UnkownUseType i, UnkownStructureType i"
)


@query("property_block", f"GISJOIN s, {ROLL_KINDS}", f"{ctes()}, {PROPERTY_BLOCK_SQL} SELECT * FROM roll")
def _(spark, d):
    return property.property_per_block(
        T.logical(spark, d, "property"), T.blocks(spark, d), cover(spark, d), PREDICT, 1995
    )


LANDUSE_SQL = f"""
    parcel_p AS (SELECT (x + x2) / 2 AS px, (y + y2) / 2 AS py, yrbuilt, resunits
                 FROM {src('landuse')} WHERE yrbuilt BETWEEN 1850 AND 2018),
    parcel_l AS ({T.contains_sql('parcel_p', 'parcel_p.*')}),
    parcel AS (SELECT "GISJOIN", min(yrbuilt) AS minyr, max(yrbuilt) AS maxyr,
                      stddev_samp(yrbuilt) AS sdyr, count(resunits) AS n_parcels_with_units,
                      count(*) AS n_parcels FROM parcel_l GROUP BY 1)"""


@query("landuse_block", "GISJOIN s, minyr i, maxyr i, sdyr f, n_parcels_with_units i, n_parcels i",
       f"{ctes()}, {LANDUSE_SQL} SELECT * FROM parcel")
def _(spark, d):
    return property.landuse_per_block(T.parcels(spark, d), cover(spark, d))


CENSUS_COLUMNS = [*census.POPULATION, *census.TENURE, "Urban"]
CENSUS_SQL = f"""
    SELECT p."GISJOIN", {_quoted(census.POPULATION, 'p.')}, {_quoted(census.TENURE, 't.')},
           CASE WHEN p."URBRURALA" = 'U' THEN 1 ELSE 0 END AS "Urban"
    FROM (SELECT * FROM {src('census_population')} WHERE "COUNTY" = 'San Francisco County') p
    LEFT JOIN (SELECT * FROM {src('census_tenure')} WHERE "COUNTY" = 'San Francisco County') t
      ON t."GISJOIN" = p."GISJOIN" """


@query("census_block", f"GISJOIN s, {kinds(CENSUS_COLUMNS)}", CENSUS_SQL)
def _(spark, d):
    return census.census_per_block(
        T.logical(spark, d, "census_population"), T.logical(spark, d, "census_tenure")
    )


@query("census_block_year", f"GISYEARJOIN s, {kinds(CENSUS_COLUMNS)}", f"""
    SELECT c."GISJOIN" || CAST(y.y AS VARCHAR) AS "GISYEARJOIN", {_quoted(CENSUS_COLUMNS, 'c.')}
    FROM ({CENSUS_SQL}) c, generate_series(2007, 2018) y(y)""")
def _(spark, d):
    years = census.census_per_block_year(
        T.logical(spark, d, "census_population"), T.logical(spark, d, "census_tenure")
    )
    return years.withColumn("GISYEARJOIN", C.block_year_key("GISJOIN", P.YEAR))


# --- assembled tables ---


def raw_tables(spark, d) -> features.RawTables:
    def table(name):
        return T.logical(spark, d, name)

    return features.RawTables(
        blocks=T.blocks(spark, d), fires=table("fires"), violations=table("violations"),
        inspections=table("inspections"), crimes=table("crimes"), property=table("property"),
        parcels=T.parcels(spark, d), population=table("census_population"),
        tenure=table("census_tenure"),
    )


COUNTS = [m for name in ("violations", "inspections", "crimes", "fires") for m in MEASURES[name]]
TARGET_NAMES = list(features.TARGETS.values())
LANDUSE_COLUMNS = ["minyr", "maxyr", "sdyr", "n_parcels_with_units"]
FEATURE_KINDS = (
    f"GISJOIN s, Year i, LAT f, LON f, AREA f, {kinds(COUNTS)}, {MEAN_KINDS}, {SHARE_KINDS}, "
    f"UnkownUseType i, {kinds(CENSUS_COLUMNS)}, minyr i, maxyr i, sdyr f, n_parcels_with_units i, "
    f"{kinds(TARGET_NAMES)}"
)
FEATURE_SQL = f"""
    {ctes('fires', 'violations', 'inspections', 'crimes')}, {PROPERTY_SQL}, {LANDUSE_SQL},
    people AS ({CENSUS_SQL}),
    spine AS (SELECT b."GISJOIN", y.y AS "Year", CAST("INTPTLAT10" AS DOUBLE) AS "LAT",
                     CAST("INTPTLON10" AS DOUBLE) AS "LON", CAST("ALAND10" AS DOUBLE) AS "AREA"
              FROM {src('census_blocks')} b, generate_series({FIRST}, {LAST}) y(y))
    SELECT s.*,
      {', '.join(f'coalesce(c{i}."{m}", 0) AS "{m}"' for i, n in enumerate(MEASURES) for m in MEASURES[n])},
      {_quoted([*property.MEANS, *SHARES], 'r.')},
      CASE WHEN r."GISJOIN" IS NULL THEN 1 ELSE 0 END AS "UnkownUseType",
      {_quoted(CENSUS_COLUMNS, 'p.')}, {_quoted(LANDUSE_COLUMNS, 'u.')},
      {', '.join(f'CASE WHEN s."Year" + 1 <= {LAST} THEN coalesce(t."{n}", 0) END AS "{t}"'
                 for n, t in features.TARGETS.items())}
    FROM spine s
    {' '.join(f'LEFT JOIN {n}_y c{i} ON c{i}."GISJOIN" = s."GISJOIN" AND c{i}."Year" = s."Year"'
              for i, n in enumerate(MEASURES))}
    LEFT JOIN fires_y t ON t."GISJOIN" = s."GISJOIN" AND t."Year" = s."Year" + 1
    LEFT JOIN property_y r ON r."GISJOIN" = s."GISJOIN" AND r."Year" = s."Year"
    LEFT JOIN people p ON p."GISJOIN" = s."GISJOIN"
    LEFT JOIN parcel u ON u."GISJOIN" = s."GISJOIN" """


@query("feature_table", FEATURE_KINDS, FEATURE_SQL)
def _(spark, d):
    return features.yearly_feature_table(
        raw_tables(spark, d), FIRST, LAST, SINCE, last_complete_year=LAST
    )


CITY_FEATURE_SQL = FEATURE_SQL.replace(
    f"edges AS ({T.edges_sql()})", f'edges AS (SELECT * FROM ({T.edges_sql()}) z WHERE block IN (SELECT "GISJOIN" FROM ({_CITY}) c))'
).replace(f"FROM {src('census_blocks')} b, generate_series", f"FROM ({_CITY}) b, generate_series")


@query("feature_table_city", FEATURE_KINDS, CITY_FEATURE_SQL)
def _(spark, d):
    """The feature table of the city: blocks of the county whose interior point lies in the box."""
    return features.yearly_feature_table(
        raw_tables(spark, d), FIRST, LAST, SINCE, last_complete_year=LAST, box=C.CITY_BOX
    )


@query("legacy_table", f"GISJOIN s, {kinds(COUNTS)}, {kinds(CENSUS_COLUMNS)}, {ROLL_KINDS}, rings i", f"""
    {ctes('fires', 'violations', 'inspections', 'crimes')}, {PROPERTY_BLOCK_SQL},
    people AS ({CENSUS_SQL}),
    {', '.join(f'''{n}_b AS (SELECT b."GISJOIN", {', '.join(
        f'coalesce(sum(l."{m}") FILTER (l."Year" < {PREDICT}), 0) AS "{m}"' for m in MEASURES[n])}
        FROM blocks b LEFT JOIN {n}_l l ON l."GISJOIN" = b."GISJOIN" GROUP BY 1)''' for n in MEASURES)},
    whole AS (SELECT b."GISJOIN", {_quoted(COUNTS)}, {_quoted(CENSUS_COLUMNS)}
              FROM fires_b b JOIN violations_b USING ("GISJOIN") JOIN inspections_b USING ("GISJOIN")
              JOIN crimes_b USING ("GISJOIN") JOIN people USING ("GISJOIN")
              WHERE {' AND '.join(f'"{c}" IS NOT NULL' for c in census.TENURE)})
    SELECT roll.*, {_quoted(COUNTS)}, {_quoted(CENSUS_COLUMNS)},
           CASE WHEN s.shape = 3 THEN 2 ELSE 1 END AS rings
    FROM roll LEFT JOIN whole USING ("GISJOIN")
    JOIN {src('census_blocks')} s USING ("GISJOIN")""")
def _(spark, d):
    polygons = T.blocks(spark, d).select("GISJOIN", F.size("rings").alias("rings"))
    return features.block_feature_table(
        raw_tables(spark, d), PREDICT, SINCE, 1995, polygons=polygons
    )


@query("entry_panel", f"GISJOIN s, Year i, {kinds(FIRES)}, {kinds(TARGET_NAMES)}", f"""
    {ctes('fires')}
    SELECT b."GISJOIN", y.y AS "Year", {', '.join(f'coalesce(f."{n}", 0) AS "{n}"' for n in FIRES)},
      {', '.join(f'CASE WHEN y.y + 1 <= {LAST} THEN coalesce(t."{n}", 0) END AS "{t}"'
                 for n, t in features.TARGETS.items())}
    FROM blocks b CROSS JOIN generate_series({FIRST}, {LAST}) y(y)
    LEFT JOIN fires_y f ON f."GISJOIN" = b."GISJOIN" AND f."Year" = y.y
    LEFT JOIN fires_y t ON t."GISJOIN" = b."GISJOIN" AND t."Year" = y.y + 1""")
def _(spark, d):
    counts = events.per_block_year(points(spark, d, "fires"), cover(spark, d))
    spine = P.year_spine(T.blocks(spark, d).select("GISJOIN"), FIRST, LAST)
    return P.join_counts_and_targets(spine, counts, features.TARGETS, LAST)
