"""The given tables seen as municipal data.

Every logical table is one list of SQL expressions over one given table, in words
Spark and DuckDB share, so both sides read exactly the same rows. Coordinates are
integers in millionths of a degree until the last step. Blocks, one per customer,
lie on a grid 64 cells wide; shapes rotate through square, L, triangle and a
square with a hole. The grid starts west of the city box, so its first column is
outside the city, and grows north with the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


CELL = 2800
QUARTER = CELL // 4
ACROSS = 64
WEST, SOUTH = -122532500, 37700000

FIRST_YEAR, LAST_YEAR = 1995, 2001

# Rings in quarter cells, by customer key modulo 4; the first ring is the outer one.
SHAPES = [
    [[(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]],
    [[(0, 0), (4, 0), (4, 2), (2, 2), (2, 4), (0, 4), (0, 0)]],
    [[(0, 0), (4, 0), (0, 4), (0, 0)]],
    [
        [(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)],
        [(1, 1), (1, 3), (3, 3), (3, 1), (1, 1)],
    ],
]
TRACT = [[(0, 0), (16, 0), (16, 16), (0, 16), (0, 0)]]

USE_CODES = ["COMH", "COMM", "COMO", "COMR", "GOVT", "IND", "MISC", "MRES", "SRES"]
TYPE_CODES = ["A", "B", "C", "D", "1", "?", "BRI", "F", "R", "REI", "ROW", "S", "STE", "WOO"]


def _x(index: str, offset: str) -> str:
    return f"({WEST} + (({index}) % {ACROSS}) * {CELL} + ({offset}))"


def _y(index: str, offset: str) -> str:
    return f"({SOUTH} + CAST(floor(({index}) / {ACROSS}) AS BIGINT) * {CELL} + ({offset}))"


def _point_text(x: str, y: str) -> str:
    return f"'(' || CAST({y} / 1e6 AS STRING) || ', ' || CAST({x} / 1e6 AS STRING) || ')'"


def _pick(values: list[str], index: str) -> str:
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"(CASE ({index}) % {len(values)} {whens} END)"


_FIRE_X = _x("o_custkey", "(o_orderkey * 977) % 2801")
_FIRE_Y = _y("o_custkey", "(o_orderkey * 1409) % 2801")
_VIOL_X = _x("o_custkey * 3 % 1600", "(o_orderkey * 613) % 2801")
_VIOL_Y = _y("o_custkey * 3 % 1600", "(o_orderkey * 1777) % 2801")
_INSP_X = _x("l_partkey", "(l_orderkey * 31 + l_linenumber * 997) % 2801")
_INSP_Y = _y("l_partkey", "(l_orderkey * 83 + l_linenumber * 1201) % 2801")
_CRIME_X = _x("l_suppkey * 15 + l_linenumber", "(l_orderkey * 59) % 2801")
_CRIME_Y = _y("l_suppkey * 15 + l_linenumber", "(l_orderkey * 101) % 2801")
_PROP_X = _x("l_partkey * 2 % 1900", "(l_orderkey * 43 + l_linenumber * 7) % 2801")
_PROP_Y = _y("l_partkey * 2 % 1900", "(l_orderkey * 67 + l_linenumber * 11) % 2801")
_SITE_X = _x("user_id", "(event_id * 7919) % 2801")
_SITE_Y = _y("user_id", "(event_id * 4729) % 2801")
PARCEL_INDEX = "CAST(floor(p_partkey / 2) AS BIGINT) + (p_partkey % 2) * (p_partkey % 7)"
PARCEL_X = _x(PARCEL_INDEX, "100 + (p_partkey * 37) % 2300")
PARCEL_Y = _y(PARCEL_INDEX, "100 + (p_partkey * 53) % 2300")
PARCEL_SIDE = 200

_BLOCK_ID = "'G06' || lpad(CAST(c_custkey AS STRING), 9, '0')"
_COUNTY = "CASE WHEN c_nationkey % 6 = 0 THEN 'Alameda County' ELSE 'San Francisco County' END"
_BALANCE = "CAST(floor(abs(c_acctbal)) AS BIGINT)"

POPULATION_COLUMNS = [f"H7X00{i}" for i in range(1, 9)] + [f"H8C00{i}" for i in range(1, 10)]
TENURE_COLUMNS = ["IFC001", "IFF001", "IFF002", "IFF003", "IFF004"]

# logical table -> (given table, {column: expression})
TABLES: dict[str, tuple[str, dict[str, str]]] = {
    "fires": (
        "orders",
        {
            "Incident Date": "o_orderdate",
            "Location": f"CASE WHEN o_orderkey % 29 <> 0 THEN {_point_text(_FIRE_X, _FIRE_Y)} END",
            "Primary Situation": (
                "CASE WHEN o_orderkey % 31 = 0 THEN NULL "
                "WHEN o_orderkey % 13 = 0 THEN '111 building / 130 vehicle' "
                "WHEN o_orderkey % 11 = 0 THEN '9' || CAST(100 + (o_orderkey * 31) % 80 AS STRING) "
                "ELSE CAST(100 + (o_orderkey * 31) % 80 AS STRING) || ' - ' || o_orderpriority END"
            ),
            "o_orderkey": "o_orderkey",
        },
    ),
    "violations": (
        "orders",
        {
            "Violation Date": "o_orderdate",
            "Location": f"CASE WHEN o_orderkey % 23 <> 0 THEN {_point_text(_VIOL_X, _VIOL_Y)} END",
        },
    ),
    "inspections": (
        "lineitem",
        {
            "Inspection Number": (
                "CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)"
            ),
            "Inspection Type Description": (
                "CASE l_returnflag WHEN 'R' THEN 'complaint inspection' "
                "WHEN 'A' THEN 'routine inspection' END"
            ),
            "Inspection Start Date": "l_shipdate",
            "Inspection End Date": (
                "CASE WHEN (l_orderkey + l_linenumber) % 17 <> 0 THEN l_shipdate END"
            ),
            "Location": _point_text(_INSP_X, _INSP_Y),
        },
    ),
    "crimes": (
        "lineitem",
        {
            "Date": "l_shipdate",
            "Location": _point_text(_CRIME_X, _CRIME_Y),
            "Category": _pick(
                ["ARSON", "ASSAULT", "NON-CRIMINAL", "LARCENY/THEFT", "SECONDARY CODES",
                 "VANDALISM", "RECOVERED VEHICLE", "ROBBERY", "WARRANTS"],
                "l_orderkey + l_linenumber",
            ),
        },
    ),
    "property": (
        "lineitem",
        {
            "Closed Roll Year": "CAST(year(l_shipdate) AS INT) - 1",
            "Assessed Land Value": "l_extendedprice",
            "Number of Units": "l_quantity",
            "Year Property Built": "CAST(1880 + (l_partkey * 13 + l_linenumber) % 150 AS INT)",
            "Use Code": (
                f"CASE WHEN l_orderkey % 37 <> 0 THEN {_pick(USE_CODES, 'l_suppkey + l_linenumber')}"
                " END"
            ),
            "Construction Type": _pick(TYPE_CODES, "l_orderkey + l_partkey"),
            "the_geom": f"CASE WHEN l_orderkey % 41 <> 0 THEN {_point_text(_PROP_X, _PROP_Y)} END",
            "Lot Area": "l_quantity * (l_tax * 100) * 25 + l_discount * 100",
        },
    ),
    "landuse": (
        "part",
        {
            "block_num": "CAST(p_partkey AS STRING)",
            "landuse": "p_type",
            "resunits": "CASE WHEN p_partkey % 5 <> 0 THEN p_size END",
            "retail": "p_size * 3",
            "yrbuilt": "1840 + p_size * 4",
            "x": f"{PARCEL_X} / 1e6",
            "y": f"{PARCEL_Y} / 1e6",
            "x2": f"({PARCEL_X} + {PARCEL_SIDE}) / 1e6",
            "y2": f"({PARCEL_Y} + {PARCEL_SIDE}) / 1e6",
        },
    ),
    "census_blocks": (
        "customer",
        {
            "GISJOIN": _BLOCK_ID,
            "shape": "c_custkey % 4",
            "x": _x("c_custkey", "0"),
            "y": _y("c_custkey", "0"),
            "INTPTLAT10": f"'+' || CAST({_y('c_custkey', '700')} / 1e6 AS STRING)",
            "INTPTLON10": f"CAST({_x('c_custkey', '700')} / 1e6 AS STRING)",
            "ALAND10": "CAST(20000 + c_custkey % 977 AS STRING)",
        },
    ),
    "census_population": (
        "customer",
        {
            "GISJOIN": _BLOCK_ID,
            "COUNTY": _COUNTY,
            "URBRURALA": "CASE WHEN c_mktsegment = 'MACHINERY' THEN 'R' ELSE 'U' END",
            **{
                c: f"CAST(({_BALANCE} + c_custkey * {7 * i + 3}) % {50 + 11 * i} AS BIGINT)"
                for i, c in enumerate(POPULATION_COLUMNS)
            },
        },
    ),
    "census_tenure": (
        "customer",
        {
            "GISJOIN": (
                "CASE WHEN c_custkey % 19 = 0 THEN 'X' || CAST(c_custkey AS STRING) "
                f"ELSE {_BLOCK_ID} END"
            ),
            "COUNTY": _COUNTY,
            **{
                c: f"CAST(({_BALANCE} + c_custkey * {5 * i + 2}) % {40 + 7 * i} AS BIGINT)"
                for i, c in enumerate(TENURE_COLUMNS)
            },
        },
    ),
    "tracts": (
        "supplier",
        {
            "TRACT": "'T' || lpad(CAST(s_suppkey AS STRING), 7, '0')",
            "x": f"({WEST} + (s_suppkey % 16) * {4 * CELL})",
            "y": f"({SOUTH} + CAST(floor(s_suppkey / 16) AS BIGINT) * {4 * CELL})",
            "COUNTY": (
                "CASE WHEN s_nationkey % 9 = 0 THEN 'Alameda County' "
                "ELSE 'San Francisco County' END"
            ),
            "JOIE001": "CASE WHEN s_suppkey % 8 <> 0 THEN s_acctbal END",
            "JTIE001": "s_acctbal * 2",
            "J4TM001": "abs(s_acctbal) / 10000",
        },
    ),
    "sites": (
        "events",
        {
            "event_id": "event_id",
            "address": (
                "CAST(user_id AS STRING) || CASE WHEN event_id % 3 = 0 "
                "THEN ' Main St San Francisco' ELSE ' Main St' END"
            ),
            "event_type": "event_type",
            "lon": f"CASE WHEN event_id % 53 <> 0 THEN {_SITE_X} / 1e6 END",
            "lat": f"{_SITE_Y} / 1e6",
        },
    ),
}


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def logical(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A logical table without its geometry."""
    source, columns = TABLES[name]
    return read(spark, folder, source).selectExpr(*[f"{e} AS `{c}`" for c, e in columns.items()])


def table_sql(name: str) -> str:
    """The same table as a DuckDB select."""
    source, columns = TABLES[name]
    body = ", ".join(f'{e} AS "{c}"' for c, e in columns.items())
    return f"SELECT {body} FROM {source}"


def _rings(shape: list[list[tuple[int, int]]]) -> str:
    def vertex(qx: int, qy: int) -> str:
        return (
            f"named_struct('x', (x + {qx * QUARTER}) / 1e6, 'y', (y + {qy * QUARTER}) / 1e6)"
        )

    rings = ["array(" + ", ".join(vertex(*v) for v in ring) + ")" for ring in shape]
    return "array(" + ", ".join(rings) + ")"


def blocks(spark: SparkSession, folder: str) -> DataFrame:
    """Census blocks with rings in degrees."""
    whens = " ".join(f"WHEN {i} THEN {_rings(shape)}" for i, shape in enumerate(SHAPES))
    raw = logical(spark, folder, "census_blocks")
    return raw.withColumn("rings", F.expr(f"CASE shape {whens} END")).drop("shape", "x", "y")


def tracts(spark: SparkSession, folder: str) -> DataFrame:
    raw = logical(spark, folder, "tracts")
    return raw.withColumn("rings", F.expr(_rings(TRACT))).drop("x", "y")


def parcels(spark: SparkSession, folder: str) -> DataFrame:
    """Land-use parcels as small closed squares."""
    corners = [("x", "y"), ("x2", "y"), ("x2", "y2"), ("x", "y2"), ("x", "y")]
    ring = F.array(*[F.struct(F.col(a).alias("x"), F.col(b).alias("y")) for a, b in corners])
    raw = logical(spark, folder, "landuse")
    return raw.withColumn("rings", F.array(ring)).drop("x", "y", "x2", "y2")


# --- the DuckDB twins of the geometry ---


def edges_sql() -> str:
    """One row per block edge, in degrees."""
    rows = []
    for shape, rings in enumerate(SHAPES):
        for ring in rings:
            for (ax, ay), (bx, by) in zip(ring, ring[1:]):
                rows.append(f"({shape}, {ax}, {ay}, {bx}, {by})")
    return f"""
        SELECT b."GISJOIN" AS block,
               (b.x + s.qx1 * {QUARTER}) / 1e6 AS x1, (b.y + s.qy1 * {QUARTER}) / 1e6 AS y1,
               (b.x + s.qx2 * {QUARTER}) / 1e6 AS x2, (b.y + s.qy2 * {QUARTER}) / 1e6 AS y2
        FROM ({table_sql('census_blocks')}) b
        JOIN (VALUES {', '.join(rows)}) s(shape, qx1, qy1, qx2, qy2) ON s.shape = b.shape"""


def contains_sql(points: str, columns: str) -> str:
    """Rows of ``points`` (with px, py) strictly inside a block, by edge counting."""
    return f"""
        SELECT {columns}, h.block AS "GISJOIN"
        FROM {points} JOIN (
            SELECT q.px, q.py, e.block
            FROM (SELECT DISTINCT px, py FROM {points}) q
            JOIN (SELECT block, min(x1) AS xlo, max(x1) AS xhi, min(y1) AS ylo, max(y1) AS yhi
                  FROM edges GROUP BY block) bb
              ON q.px BETWEEN bb.xlo AND bb.xhi AND q.py BETWEEN bb.ylo AND bb.yhi
            JOIN edges e ON e.block = bb.block
            GROUP BY q.px, q.py, e.block
            HAVING sum(CASE WHEN (e.y1 > q.py) <> (e.y2 > q.py)
                             AND q.px < (e.x2 - e.x1) * (q.py - e.y1) / (e.y2 - e.y1) + e.x1
                            THEN 1 ELSE 0 END) % 2 = 1
               AND sum(CASE WHEN (e.x2 - e.x1) * (q.py - e.y1) = (e.y2 - e.y1) * (q.px - e.x1)
                             AND q.px BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2)
                             AND q.py BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2)
                            THEN 1 ELSE 0 END) = 0
        ) h ON h.px = {points}.px AND h.py = {points}.py"""


def point_columns_sql(text: str) -> str:
    """px, py out of ``(lat, lon)`` text."""
    return (
        f"TRY_CAST(split_part(rtrim(ltrim({text}, '('), ')'), ',', 2) AS DOUBLE) AS px, "
        f"TRY_CAST(split_part(rtrim(ltrim({text}, '('), ')'), ',', 1) AS DOUBLE) AS py"
    )
