"""Planar geometry on ``rings ARRAY<ARRAY<STRUCT<x,y>>>`` columns.

All rings of one shape, outer ones and holes alike, go into a single edge array:
the parity of ray crossings then gives holes and several parts their meaning.

Higher-order functions read best as SQL text, so the builders here take and give
text; arguments are column names or expressions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

POINT = "struct<x:double,y:double>"
RINGS = f"array<array<{POINT}>>"
EDGES = "array<struct<x1:double,y1:double,x2:double,y2:double>>"


def ring_edges(ring: str) -> str:
    """Vertices paired with their successors, the last with the first."""
    following = (
        f"concat(slice({ring}, 2, greatest(size({ring}) - 1, 0)), slice({ring}, 1, 1))"
    )
    return (
        f"zip_with({ring}, {following}, (p, q) -> "
        "named_struct('x1', p.x, 'y1', p.y, 'x2', q.x, 'y2', q.y))"
    )


def edges_of(rings: str) -> str:
    """Edges of all rings; a closed ring's repeated vertex gives an edge of no length, left out."""
    edges = f"flatten(transform({rings}, r -> {ring_edges('r')}))"
    return f"filter({edges}, e -> e.x1 <> e.x2 or e.y1 <> e.y2)"


def bounds_of(rings: str) -> dict[str, str]:
    def all_of(axis: str) -> str:
        return f"flatten(transform({rings}, r -> transform(r, p -> p.{axis})))"

    return {
        "xmin": f"array_min({all_of('x')})",
        "xmax": f"array_max({all_of('x')})",
        "ymin": f"array_min({all_of('y')})",
        "ymax": f"array_max({all_of('y')})",
    }


def ring_starts(rings: str) -> str:
    return f"transform({rings}, r -> element_at(r, 1))"


def odd_crossings(edges: str, px: str, py: str, e: str = "e") -> str:
    """Ray-cast parity; says nothing reliable about points on an edge."""
    x_at = f"coalesce(try_divide(({e}.x2 - {e}.x1) * ({py} - {e}.y1), {e}.y2 - {e}.y1), 0D) + {e}.x1"
    crossed = f"(({e}.y1 > {py}) <> ({e}.y2 > {py})) and {px} < {x_at}"
    return f"(size(filter({edges}, {e} -> {crossed})) % 2 = 1)"


def on_boundary(edges: str, px: str, py: str) -> str:
    return (
        f"exists({edges}, e -> (e.x2 - e.x1) * ({py} - e.y1) = (e.y2 - e.y1) * ({px} - e.x1) "
        f"and {px} between least(e.x1, e.x2) and greatest(e.x1, e.x2) "
        f"and {py} between least(e.y1, e.y2) and greatest(e.y1, e.y2))"
    )


def strictly_inside(edges: str, px: str, py: str) -> str:
    return f"({odd_crossings(edges, px, py)} and not {on_boundary(edges, px, py)})"


def _side(s: str, p: str) -> str:
    """Side of the segment ``s`` on which a vertex such as ``a.x1, a.y1`` lies."""
    shape, end = p
    px, py = f"{shape}.x{end}", f"{shape}.y{end}"
    return (
        f"signum(({s}.x2 - {s}.x1) * ({py} - {s}.y1) - ({s}.y2 - {s}.y1) * ({px} - {s}.x1))"
    )


def segments_meet() -> str:
    """Crossing or touching segments ``a`` and ``b``, collinear overlap included."""
    boxes = " and ".join(
        f"least({s}.{v}1, {s}.{v}2) <= greatest({t}.{v}1, {t}.{v}2)"
        for v in "xy" for s, t in ("ab", "ba")
    )
    return (
        f"({boxes} and {_side('b', 'a1')} * {_side('b', 'a2')} <= 0 "
        f"and {_side('a', 'b1')} * {_side('a', 'b2')} <= 0)"
    )


def shapes_meet(edges_a: str, edges_b: str, starts_a: str, starts_b: str) -> str:
    """Closed shapes share a point: edges meet, or one holds a ring start of the other."""
    return (
        f"(exists({edges_a}, a -> exists({edges_b}, b -> {segments_meet()})) "
        f"or exists({starts_a}, p -> {odd_crossings(edges_b, 'p.x', 'p.y')}) "
        f"or exists({starts_b}, p -> {odd_crossings(edges_a, 'p.x', 'p.y')}))"
    )


def ring_within(ring: str, other: str) -> str:
    """Whether ``ring`` lies in ``other``, for rings that do not cross: one of its vertices does."""
    # the edges go through an array of one, so that they are built once and not for every vertex
    inside = f"exists({ring}, __v -> {strictly_inside('__w', '__v.x', '__v.y')})"
    return f"exists(transform(array({ring_edges(other)}), __w -> {inside}), __b -> __b)"


def ring_depths(rings: str) -> str:
    """For each ring the number of rings around it: even for outer rings of a part, odd for holes."""
    around = f"filter({rings}, (__o, __j) -> __j <> __i and {ring_within('__r', '__o')})"
    return f"transform({rings}, (__r, __i) -> if(size({rings}) = 1, 0, size({around})))"


def parts_of(rings: str, depths: str) -> str:
    """Rings as parts: every outer ring followed by its holes."""
    holes = (
        f"filter({rings}, (__h, __k) -> {depths}[__k] = {depths}[__n] + 1 and {ring_within('__h', f'{rings}[__n]')})"
    )
    outer = f"filter(sequence(0, size({rings}) - 1), __n -> {depths}[__n] % 2 = 0)"
    return f"if(size({rings}) = 0, array(), transform({outer}, __n -> concat(array({rings}[__n]), {holes})))"


def centroid(rings: str) -> tuple[str, str]:
    """Area centroid of all parts minus their holes, by shoelace sums.

    A ring counts as a hole if an odd number of rings lie around it.

    Sums run relative to the first vertex: with coordinates near (-122, 37) and
    parcels of some metres, absolute products would lose most digits. Rings are
    weighted by absolute area, so orientation does not matter.
    """
    ox, oy = f"{rings}[0][0].x", f"{rings}[0][0].y"
    x1, y1, x2, y2 = f"(__e.x1 - {ox})", f"(__e.y1 - {oy})", f"(__e.x2 - {ox})", f"(__e.y2 - {oy})"
    cross = f"({x1} * {y2} - {x2} * {y1})"
    moments = (
        f"aggregate({ring_edges('__r')}, named_struct('a', 0D, 'mx', 0D, 'my', 0D), (__s, __e) -> "
        f"named_struct('a', __s.a + {cross}, 'mx', __s.mx + ({x1} + {x2}) * {cross}, "
        f"'my', __s.my + ({y1} + {y2}) * {cross}))"
    )
    signed = (
        f"zip_with(transform({rings}, __r -> {moments}), {ring_depths(rings)}, (__m, __d) -> "
        "named_struct('m', __m, 'sign', signum(__m.a) * if(__d % 2 = 0, 1D, -1D)))"
    )

    def total(name: str) -> str:
        return f"aggregate(__g, 0D, (__t, __k) -> __t + __k.sign * __k.m.{name})"

    def along(origin: str, name: str) -> str:
        return f"{origin} + transform(array({signed}), __g -> try_divide({total(name)}, 3 * {total('a')}))[0]"

    return along(ox, "mx"), along(oy, "my")


# --- conic equal-area projection used by the census shapes (NAD83 / GRS80) ---

# Ellipsoid and the contiguous-US Albers parameters. Other projections give their own
# ``a`` and ``f`` beside the parallels and the origin.
GRS80_A = 6378137.0
GRS80_F = 1 / 298.257222101
ALBERS_US = {"lat0": 37.5, "lon0": -96.0, "lat1": 29.5, "lat2": 45.5}


def albers_constants(
    lat0: float, lon0: float, lat1: float, lat2: float, a: float = GRS80_A, f: float = GRS80_F
) -> dict[str, float]:
    e2 = f * (2 - f)
    e = math.sqrt(e2)

    def q(phi: float) -> float:
        s = math.sin(phi)
        return (1 - e2) * (s / (1 - e2 * s * s) - math.log((1 - e * s) / (1 + e * s)) / (2 * e))

    def m(phi: float) -> float:
        s = math.sin(phi)
        return math.cos(phi) / math.sqrt(1 - e2 * s * s)

    p0, p1, p2 = (math.radians(v) for v in (lat0, lat1, lat2))
    n = (m(p1) ** 2 - m(p2) ** 2) / (q(p2) - q(p1))
    c = m(p1) ** 2 + n * q(p1)
    return {
        "n": n,
        "c": c,
        "rho0": a * math.sqrt(c - n * q(p0)) / n,
        "lon0": math.radians(lon0),
        "a": a,
        "e2": e2,
        "e": e,
    }


def from_albers(
    x: Column, y: Column, params: dict[str, float] = ALBERS_US
) -> tuple[Column, Column]:
    """Metres on the conic projection to (lon, lat) in degrees.

    The latitude starts from the authalic one and takes three corrector steps
    (Snyder 1987, eq. 3-16), which leaves less than 1e-10 degrees.
    """
    k = albers_constants(**params)
    e, e2 = k["e"], k["e2"]
    dy = F.lit(k["rho0"]) - y
    rho = F.sqrt(x * x + dy * dy)
    theta = F.atan2(x * math.copysign(1.0, k["n"]), dy * math.copysign(1.0, k["n"]))
    q = (F.lit(k["c"]) - rho * rho * (k["n"] / k["a"]) ** 2) / k["n"]

    def correct(phi: Column, _step: Column) -> Column:
        s = F.sin(phi)
        w = F.lit(1.0) - s * s * e2
        gap = (
            q / (1 - e2)
            - s / w
            + F.log((F.lit(1.0) - s * e) / (F.lit(1.0) + s * e)) / (2 * e)
        )
        return phi + w * w / (F.cos(phi) * 2.0) * gap

    start = F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), q / 2.0)))
    phi = F.aggregate(F.array(*[F.lit(i) for i in range(3)]), start, correct)
    return F.degrees(F.lit(k["lon0"]) + theta / k["n"]), F.degrees(phi)


def to_albers(
    lon: Column, lat: Column, params: dict[str, float] = ALBERS_US
) -> tuple[Column, Column]:
    """(lon, lat) in degrees to metres on the conic projection."""
    k = albers_constants(**params)
    e, e2 = k["e"], k["e2"]
    s = F.sin(F.radians(lat))
    q = (s / (F.lit(1.0) - s * s * e2)
         - F.log((F.lit(1.0) - s * e) / (F.lit(1.0) + s * e)) / (2 * e)) * (1 - e2)
    rho = F.sqrt(F.lit(k["c"]) - q * k["n"]) * (k["a"] / k["n"])
    theta = (F.radians(lon) - k["lon0"]) * k["n"]
    return rho * F.sin(theta), F.lit(k["rho0"]) - rho * F.cos(theta)


def reproject_rings(rings: Column, params: dict[str, float] = ALBERS_US) -> Column:
    def vertex(p: Column) -> Column:
        lon, lat = from_albers(p["x"], p["y"], params)
        return F.struct(lon.alias("x"), lat.alias("y"))

    return F.transform(rings, lambda r: F.transform(r, vertex))


# --- text forms ---


def rings_from_text(text: Column) -> Column:
    """``POLYGON ((x y, ...), (...))`` or ``MULTIPOLYGON (((...)))`` to rings."""
    body = F.regexp_extract(text, r"^\s*(?:MULTI)?POLYGON\s*\(+(.*?)\)+\s*$", 1)
    rings = F.split(body, r"\)+\s*,\s*\(+")

    def vertex(pair: Column) -> Column:
        xy = F.split(F.trim(pair), r"\s+")
        return F.struct(
            F.get(xy, F.lit(0)).try_cast("double").alias("x"),
            F.get(xy, F.lit(1)).try_cast("double").alias("y"),
        )

    return F.transform(rings, lambda r: F.transform(F.split(r, ","), vertex))


def text_from_rings(rings: Column) -> Column:
    def ring(r: Column) -> Column:
        pairs = F.transform(
            r, lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string"))
        )
        return F.concat(F.lit("("), F.array_join(pairs, ", "), F.lit(")"))

    return F.concat(F.lit("POLYGON ("), F.array_join(F.transform(rings, ring), ", "), F.lit(")"))


def rings_from_coordinates(coordinates: Column) -> Column:
    """GeoJSON polygon coordinates ``[[[x, y], ...], ...]`` to rings."""
    return F.transform(
        coordinates,
        lambda r: F.transform(
            r, lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y"))
        ),
    )


def coordinates_from_rings(rings: Column) -> Column:
    return F.transform(rings, lambda r: F.transform(r, lambda p: F.array(p["x"], p["y"])))
