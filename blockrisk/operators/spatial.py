"""Point-in-polygon and polygon-intersects joins as grid-cell equi-joins.

Every polygon is covered by square cells whose side is a power of four near its
own extent, so no polygon needs more than 25 cells however much extents differ.
A point is looked up once per cell size in use. Powers of two scale a double
without rounding, hence point and cover agree exactly on the cell.

A cover row carries only the edges that can matter to points of its cell, and
cells wholly inside the polygon carry none: their points need no test at all. Of
the edges to the right of a cell, which a ray from it may cross, only the heights
are kept at which their chains end, so a row's list grows with the edges in the
cell and not with the polygon; cells that still hold many are split in sixteen.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockrisk.functions import geometry as G
from blockrisk.session import spread, stored

BROADCAST_BYTES = 256 << 20
#: A cell with more points than this is dealt over as many tasks as it fills.
POINTS_PER_SALT = 1 << 18

#: A cover cell with more edges than this is split, again and again up to so many times: edges
#: that meet in one vertex stay together however small the cells.
EDGES_PER_CELL, MOST_SPLITS = 128, 6
#: A cell that meets more cells of a finer table than this is split for the join with it.
CELLS_PER_KEY = 4096

_SMALLEST_EXTENT = 1e-12
#: Beyond all coordinates; edges placed there stand for chains of edges to the right of a cell.
_FAR = "1e300D"


def shape_columns(
    polygons: DataFrame, key: str, rings: str, carry: Sequence[str] = ()
) -> DataFrame:
    """Key, edges, bounds and grid level with its cell side; shapes without edges drop out."""
    r = f"`{rings}`"
    shaped = polygons.selectExpr(
        f"`{key}`",
        *[f"`{c}`" for c in carry],
        f"{G.edges_of(r)} AS _edges",
        f"{G.ring_starts(r)} AS _starts",
        *[f"{text} AS _{name}" for name, text in G.bounds_of(r).items()],
    ).filter("size(_edges) > 0")
    extent = f"greatest(_xmax - _xmin, _ymax - _ymin, {_SMALLEST_EXTENT}D)"
    leveled = shaped.selectExpr("*", f"2 * cast(ceil((ceil(log2({extent})) - 2) / 2) AS int) AS _level")
    return leveled.selectExpr("*", "pow(2D, _level) AS _cell")


def _index(value: str, cell: str) -> str:
    return f"cast(floor({value} / {cell}) AS bigint)"


def _span(axis: str, cell: str) -> str:
    return f"sequence({_index(f'_{axis}min', cell)}, {_index(f'_{axis}max', cell)})"


def _cut(xs: str, ys: str, cell: str) -> str:
    """Cells of the given columns and rows with the edges of ``_edges`` that touch them and those that stand for the rest.

    An edge wholly to the right is crossed by a ray at a height between its ends. Two edges that share
    an end cancel there, hence a chain of them counts by the heights of its two ends: each becomes an
    edge from below everything up to that height, and ends above the cell one edge of all heights.
    """
    left, right, low, high = f"cx * {cell}", f"(cx + 1) * {cell}", f"cy * {cell}", f"(cy + 1) * {cell}"
    band = f"greatest(e.y1, e.y2) >= {low} and least(e.y1, e.y2) <= {high}"
    near = f"filter(_edges, e -> {band} and greatest(e.x1, e.x2) >= {left} and least(e.x1, e.x2) <= {right})"
    beyond = f"filter(_edges, e -> {band} and least(e.x1, e.x2) > {right})"
    ends = f"filter(flatten(transform({beyond}, e -> array(e.y1, e.y2))), v -> v > {low})"
    ordered = f"array_sort(transform({ends}, v -> if(v > {high}, {_FAR}, v)))"
    odd = (
        f"aggregate({ordered}, cast(array() AS array<double>), (kept, v) -> "
        "if(get(kept, size(kept) - 1) <=> v, slice(kept, 1, size(kept) - 1), concat(kept, array(v))))"
    )
    stand_in = f"transform({odd}, v -> named_struct('x1', {_FAR}, 'y1', -{_FAR}, 'x2', {_FAR}, 'y2', v))"
    return (
        f"flatten(transform({xs}, cx -> transform({ys}, cy -> "
        f"named_struct('_cx', cx, '_cy', cy, '_near', {near}, '_beyond', {stand_in}))))"
    )


def _covered(cells: DataFrame, kept: Sequence[str]) -> DataFrame:
    """Cover rows of cut cells: cells outside the polygon drop out, cells wholly inside lose their edges."""
    middle = G.odd_crossings("_all", "(_cx + 0.5D) * _cell", "(_cy + 0.5D) * _cell")
    judged = cells.selectExpr("*", "size(_near) = 0 AS _whole", "concat(_near, _beyond) AS _all")
    return judged.filter(f"not _whole or {middle}").selectExpr(
        *kept, "_level", "_cx", "_cy", "_xmin", "_xmax", "_ymin", "_ymax", "_whole",
        f"if(_whole, cast(array() AS {G.EDGES}), _all) AS _edges",
    )


def _split(rows: DataFrame, kept: Sequence[str]) -> DataFrame:
    """Every cover row as the sixteen cells in its own."""
    cut = _cut("sequence(4 * _gx, 4 * _gx + 3)", "sequence(4 * _gy, 4 * _gy + 3)", "_cell")
    halved = rows.selectExpr(
        *kept, "_edges", "_level - 2 AS _level", "pow(2D, _level - 2) AS _cell", "_cx AS _gx", "_cy AS _gy", "_xmin", "_xmax", "_ymin", "_ymax"
    )
    return _covered(halved.selectExpr(*kept, "_level", "_cell", "_xmin", "_xmax", "_ymin", "_ymax", f"inline({cut})"), kept)


def _evened(rows: DataFrame, kept: Sequence[str], most: int) -> DataFrame:
    """Cover rows split until none holds more than ``most`` edges, or splitting no longer parts them."""
    done, rest = [], rows
    for _ in range(MOST_SPLITS):
        rest = stored(rest, "cover")
        crowded = rest.filter(f"size(_edges) > {most}")
        if crowded.isEmpty():
            break
        done.append(rest.filter(f"size(_edges) <= {most}"))
        rest = _split(crowded, kept)
    for part in done:
        rest = rest.unionByName(part)
    return rest


@dataclass
class PolygonCover:
    """Grid cover of a polygon table, with what is needed to choose the join."""

    rows: DataFrame
    key: str
    levels: list[int]
    size_bytes: int
    carry: tuple[str, ...] = ()

    @classmethod
    def build(
        cls,
        polygons: DataFrame,
        key: str = "GISJOIN",
        rings: str = "rings",
        carry: Sequence[str] = (),
        edges_per_cell: int = EDGES_PER_CELL,
    ) -> PolygonCover:
        """``carry`` names polygon columns that located points receive beside the key."""
        kept = [f"`{c}`" for c in (key, *carry)]
        shapes = shape_columns(spread(polygons, key), key, rings, carry)
        cells = f"size({_span('x', '_cell')}) * size({_span('y', '_cell')})"
        # One row about the polygon side alone: distinct levels (a few dozen at most) and size,
        # from above: fixed columns, an edge of four doubles in an array, carried values as JSON.
        carried = "".join(f" + coalesce(octet_length(to_json(struct(`{c}`))), 0) + 32" for c in (key, *carry))
        stats = shapes.selectExpr(
            "collect_set(_level) AS levels",
            f"sum(bigint({cells}) * (192{carried} + size(_edges) * 56)) AS bytes", "max(size(_edges)) AS most",
        ).first()
        # Edges are cut to the cell before the rows fan out, so each list is built once.
        cut = _cut(_span("x", "_cell"), _span("y", "_cell"), "_cell")
        rows = _covered(shapes.selectExpr(*kept, "_level", "_cell", "_xmin", "_xmax", "_ymin", "_ymax", f"inline({cut})"), kept)
        if (stats["most"] or 0) > edges_per_cell:
            rows = _evened(rows, kept, edges_per_cell)
            stats = rows.selectExpr("collect_set(_level) AS levels", f"sum(192{carried} + size(_edges) * 40) AS bytes").first()
        return cls(rows, key, sorted(stats["levels"] or []), stats["bytes"] or 0, tuple(carry))

    def locate(
        self,
        points: DataFrame,
        x: str = "lon",
        y: str = "lat",
        strategy: str = "auto",
        broadcast_bytes: int = BROADCAST_BYTES,
        points_per_salt: int = POINTS_PER_SALT,
    ) -> DataFrame:
        """Points strictly inside a polygon, with the polygon key; inner join."""
        if not self.levels:
            return points.join(self.rows.select(self.key, *self.carry), F.lit(False))
        if strategy == "auto":
            strategy = "broadcast" if self.size_bytes <= broadcast_bytes else "shuffle"
        if strategy == "shuffle" and len(self.levels) > 1:
            # Every level takes a copy of a point: only its number and place go there.
            numbered = stored(points.withColumn("_point", F.monotonically_increasing_id()), "points")
            places = numbered.selectExpr("_point", f"`{x}` AS _px", f"`{y}` AS _py")
            found = self._hits(places, "_px", "_py", strategy, points_per_salt).select("_point", self.key, *self.carry)
            return numbered.join(found, "_point").select(*points.columns, self.key, *self.carry)
        return self._hits(points, x, y, strategy, points_per_salt).select(*points.columns, self.key, *self.carry)

    def _hits(self, points: DataFrame, x: str, y: str, strategy: str, points_per_salt: int) -> DataFrame:
        # Points go through a generator even with one level: filters that the join implies
        # on cell and coordinates then stop there, and text is parsed once, not per filter.
        cells = ", ".join(
            f"named_struct('_level', {level}, '_cx', {_index(f'`{x}`', f'{2.0 ** level}D')}, "
            f"'_cy', {_index(f'`{y}`', f'{2.0 ** level}D')}, '__px', `{x}`, '__py', `{y}`)"
            for level in self.levels
        )
        keyed = points.selectExpr("*", f"inline(array({cells}))")
        on = ["_level", "_cx", "_cy"]
        if strategy == "broadcast":
            joined = keyed.join(F.broadcast(self.rows), on)
        else:
            joined = _salted_join(keyed, self.rows, on, F.xxhash64(*[c for c in keyed.columns if c not in ("_level", "_cx", "_cy")]), points_per_salt)
        # In this order: the box test compiles and spares most rows the edge loops.
        return joined.filter(
            "__px > _xmin and __px < _xmax and __py > _ymin and __py < _ymax "
            f"and (_whole or {G.strictly_inside('_edges', '__px', '__py')})"
        )

    def locate_all(self, points: DataFrame, x: str = "lon", y: str = "lat", broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
        """Every point with the keys of the polygons that strictly contain it, or one row of nulls.

        A cell's shapes are one array, so a join per grid level keeps one row per point, whatever
        keys the points have; the hits of all levels are tested and spread out at the end.
        """
        kept = (self.key, *self.carry)
        shape = ["_xmin", "_xmax", "_ymin", "_ymax", "_whole", "_edges"]
        cells = self.rows.groupBy("_level", "_cx", "_cy").agg(F.collect_list(F.struct(*kept, *shape)).alias("_shapes"))
        found, hits = points.selectExpr("*", f"`{x}` AS _px", f"`{y}` AS _py"), []
        inside = (
            "_px > __s._xmin and _px < __s._xmax and _py > __s._ymin and _py < __s._ymax "
            f"and (__s._whole or {G.strictly_inside('__s._edges', '_px', '_py')})"
        )
        fields = ", ".join(f"'{c}', __s.`{c}`" for c in kept)
        for number, level in enumerate(self.levels):
            side = cells.filter(F.col("_level") == level).select("_cx", "_cy", F.col("_shapes").alias(f"_shapes{number}"))
            if self.size_bytes <= broadcast_bytes:
                side = F.broadcast(side)
            placed = found.selectExpr("*", f"{_index('_px', f'{2.0 ** level}D')} AS _cx", f"{_index('_py', f'{2.0 ** level}D')} AS _cy")
            found = placed.join(side, ["_cx", "_cy"], "left").drop("_cx", "_cy")
            hits.append(f"transform(filter(coalesce(_shapes{number}, array()), __s -> {inside}), __s -> named_struct({fields}))")
        if not hits:
            nothing = self.rows.select(*kept).schema
            return points.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in nothing])
        spread = found.selectExpr(*[f"`{c}`" for c in points.columns], f"explode_outer(concat({', '.join(hits)})) AS _hit")
        return spread.select(*[F.col(f"`{c}`") for c in points.columns], *[F.col(f"_hit.`{c}`").alias(c) for c in kept])


def _salted_join(points: DataFrame, cover: DataFrame, on: list[str], spread: Column, points_per_salt: int) -> DataFrame:
    """Shuffled join in which a crowded cell is dealt over several tasks.

    A cell gets one salt for each ``points_per_salt`` of its points; its cover rows
    are copied once per salt. All other cells keep salt 0.
    """
    counts = points.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    crowded = counts.filter(F.col("_n") > points_per_salt).select(
        *on, F.ceil(F.col("_n") / points_per_salt).cast("int").alias("_salts")
    )
    salts = F.coalesce("_salts", F.lit(1))
    salted_points = points.join(crowded, on, "left").withColumn("_salt", F.pmod(spread, salts).cast("int"))
    salted_cover = cover.join(crowded, on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    return salted_points.drop("_salts").join(salted_cover.drop("_salts"), [*on, "_salt"])


def points_in_polygons(
    points: DataFrame,
    polygons: DataFrame,
    key: str = "GISJOIN",
    rings: str = "rings",
    x: str = "lon",
    y: str = "lat",
    strategy: str = "auto",
) -> DataFrame:
    """Inner join of points to the polygons that strictly contain them."""
    return PolygonCover.build(polygons, key, rings).locate(points, x, y, strategy)


def polygons_with_points(
    points: DataFrame, polygons: DataFrame, key: str = "GISJOIN", **kwargs: str
) -> DataFrame:
    """Every polygon key, with its points or one row of nulls.

    Keys without points are appended rather than outer-joined: a join would bring
    all points of a crowded polygon to one task, a distinct folds them before it
    shuffles.
    """
    located = points_in_polygons(points, polygons, key, **kwargs).select(key, *points.columns)
    located = stored(located, "located")  # read twice: whole, and for its keys alone
    empty = polygons.select(key).join(located.select(key).distinct(), key, "left_anti")
    return located.unionByName(empty, allowMissingColumns=True)


def locate_points(
    points: DataFrame, polygons: DataFrame, point_key: str | None = None, key: str = "GISJOIN", rings: str = "rings",
    x: str = "lon", y: str = "lat",
) -> DataFrame:
    """Every point row, with its polygon key or null when no polygon contains it.

    Rows are told apart by themselves: ``point_key`` may repeat, or be left out.
    """
    return PolygonCover.build(polygons, key, rings).locate_all(points, x, y)


def _outline(cover: PolygonCover) -> DataFrame:
    """The cover's cells with edges in them, without those that stand for edges elsewhere."""
    cells = cover.rows.filter("not _whole").select(F.col(f"`{cover.key}`").alias("_key"), "_level", "_cx", "_cy", "_edges")
    return stored(cells.withColumn("_edges", F.expr(f"filter(_edges, e -> e.x1 < {_FAR})")), "outline")


def _levels(cells: DataFrame) -> list[int]:
    """Distinct levels: a few dozen at most, whatever the number of cells."""
    return sorted(r["_level"] for r in cells.select("_level").distinct().collect())


def _on_grids(cells: DataFrame, grids: Sequence[int], finer: bool = False) -> DataFrame:
    """Cells under the keys of their own and all coarser cells (coarser ones alone, if ``finer``) on the given grids."""
    above = f"explode(filter(array({', '.join(map(str, grids))}), g -> g {'>' if finer else '>='} _level)) AS _grid"
    return cells.selectExpr("*", above).selectExpr(
        *[c for c in cells.columns if c not in ("_cx", "_cy")], "_grid",
        "shiftright(_cx, _grid - _level) AS _cx", "shiftright(_cy, _grid - _level) AS _cy",
    )


def _refined(cells: DataFrame, others: DataFrame, most: int) -> DataFrame:
    """``cells`` with those split, down to the finest level of the others, that more than ``most`` finer ones lie in."""
    finest = (_levels(others) or [0])[0]
    for _ in range(MOST_SPLITS):
        coarse = [g for g in _levels(cells) if g > finest]
        if not coarse:
            break
        keys = ["_level", "_cx", "_cy"]
        under = _on_grids(others.select(*keys), coarse, finer=True).groupBy("_grid", "_cx", "_cy").agg(F.count(F.lit(1)).alias("_n"))
        crowded = stored(under.filter(F.col("_n") > most).select(F.col("_grid").alias("_level"), "_cx", "_cy"), "crowded")
        parts = stored(cells.join(crowded, keys, "left_semi"), "crowded-cells")
        if parts.isEmpty():
            break
        # Only edges count here: a part without any has nothing to meet.
        boxed = parts.selectExpr("*", "0D AS _xmin", "0D AS _xmax", "0D AS _ymin", "0D AS _ymax")
        smaller = _split(boxed, ["_key"]).filter("not _whole").select(*cells.columns)
        smaller = smaller.withColumn("_edges", F.expr(f"filter(_edges, e -> e.x1 < {_FAR})"))
        cells = stored(cells.join(crowded, keys, "left_anti").unionByName(smaller), "outline")
    return cells


def _edge_meetings(left: DataFrame, right: DataFrame, cells_per_key: int) -> DataFrame:
    """Key pairs, perhaps repeated, of outlines of which an edge meets one of the other's."""
    left, right = _refined(left, right, cells_per_key), _refined(right, left, cells_per_key)
    grids = sorted({*_levels(left), *_levels(right)})
    if not grids:
        return left.select(F.col("_key").alias("_l")).limit(0).join(right.select(F.col("_key").alias("_r")).limit(0), how="inner")
    names = {"_key": "key", "_level": "level", "_edges": "edges"}
    sides = [
        _on_grids(side, grids).select("_grid", "_cx", "_cy", *(F.col(old).alias(f"_{mark}{new}") for old, new in names.items()))
        for mark, side in (("l", left), ("r", right))
    ]
    met = f"exists(_ledges, a -> exists(_redges, b -> {G.segments_meet()}))"
    joined = _salted_join(sides[0], sides[1], ["_grid", "_cx", "_cy"], F.xxhash64("_lkey", "_llevel", "_ledges"), cells_per_key)
    # Of two cells one of which lies in the other, the pair meets under the key of the larger.
    return joined.filter(f"_grid = greatest(_llevel, _rlevel) and {met}").select(F.col("_lkey").alias("_l"), F.col("_rkey").alias("_r"))


def polygons_intersect(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    rings: str = "rings",
    how: str = "inner",
    cells_per_key: int = CELLS_PER_KEY,
) -> DataFrame:
    """Distinct key pairs of closed polygons that share at least a boundary point.

    Two shapes meet if an edge of one meets an edge of the other, or if one holds
    the start of a ring of the other. Edges are compared cell by cell: both sides'
    covers have few edges to a cell, and a cell of a large shape that many cells of
    small ones lie in is split towards their size, which drops all of them that its
    edges do not come near. Starts are located as points.
    """
    sides = {side: PolygonCover.build(table.select(key, rings), key, rings) for side, table, key in (("l", left, left_key), ("r", right, right_key))}
    covers = {side: PolygonCover(stored(c.rows, "cover"), c.key, c.levels, c.size_bytes) for side, c in sides.items()}

    def starts(table: DataFrame, key: str, name: str) -> DataFrame:
        return table.selectExpr(f"`{key}` AS {name}", f"inline({G.ring_starts(f'`{rings}`')})")

    def holds(side: str, points: DataFrame) -> DataFrame:
        key = covers[side].key
        return covers[side].locate(points, "x", "y").withColumnRenamed(key, f"_{side}").select("_l", "_r")

    pairs = _edge_meetings(_outline(covers["l"]), _outline(covers["r"]), cells_per_key)
    pairs = pairs.unionByName(holds("r", starts(left, left_key, "_l"))).unionByName(holds("l", starts(right, right_key, "_r")))
    pairs = pairs.distinct().select(F.col("_l").alias(left_key), F.col("_r").alias(right_key))
    if how == "left":
        return left.select(left_key).join(pairs, left_key, "left")
    return pairs
