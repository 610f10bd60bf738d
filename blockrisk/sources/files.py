"""Scans and sinks: CSV, polygon tables, GeoJSON lines, scoring sets, stored results."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blockrisk.functions import geometry as G
from blockrisk.session import stored

# Raw columns the engine touches; everything else in the files is skipped at the scan.
FIRE_SCHEMA = "`Incident Date` string, `Location` string, `Primary Situation` string"
VIOLATION_SCHEMA = "`Violation Date` string, `Location` string"
INSPECTION_SCHEMA = (
    "`Inspection Number` string, `Inspection Type Description` string, "
    "`Inspection Start Date` string, `Inspection End Date` string, `Location` string"
)
CRIME_SCHEMA = "`Date` string, `Location` string, `Category` string"
PROPERTY_SCHEMA = (
    "`Closed Roll Year` int, `Assessed Land Value` double, `Number of Units` double, "
    "`Year Property Built` int, `Use Code` string, `Construction Type` string, "
    "`the_geom` string, `Lot Area` double"
)


def read_csv(
    spark: SparkSession,
    path: str,
    columns: str | T.StructType,
    encoding: str = "UTF-8",
    multi_line: bool = True,
) -> DataFrame:
    """CSV with a header; columns are found by name, in whatever order the file has.

    Records may hold line breaks inside quotes; a file is then one task's work. For files
    known to have none, ``multi_line=False`` lets Spark split them.
    """
    schema = columns if isinstance(columns, T.StructType) else T.StructType.fromDDL(columns)
    raw = (
        spark.read.option("header", True).option("escape", '"').option("encoding", encoding)
        .option("multiLine", multi_line).csv(path)
    )
    missing = [f.name for f in schema.fields if f.name not in raw.columns]
    if missing:
        raise ValueError(f"{path}: no columns {missing}")
    return raw.select(
        *[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def read_split_csv(spark: SparkSession, path: str, columns: str | T.StructType) -> DataFrame:
    """CSV in UTF-8 with a header whose records may hold line breaks, each file read by as many tasks as it has splits.

    A line break ends a record if an even number of quotes lie before it in the file. Lines are read
    split by split and numbered; the quotes of a split, one row each, give the parity in which the
    next one starts, and the record that is open there. A window per split then finds where its
    records begin, and lines meet again by record. A quote inside a field is written twice, as
    ``write_csv`` does, so it leaves the parity as it is; fields hold quotes only within quotes.
    """
    schema = columns if isinstance(columns, T.StructType) else T.StructType.fromDDL(columns)
    header = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path).columns
    missing = [f.name for f in schema.fields if f.name not in header]
    if missing:
        raise ValueError(f"{path}: no columns {missing}")
    text = spark.read.option("lineSep", "\n").text(path)
    lines = stored(text.select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("line"),
        (F.length("value") - F.length(F.translate("value", '"', ""))).alias("quotes"),
    ), "csv-lines")
    # One row per split of a file.
    order = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = lines.groupBy("file", "split").agg(F.sum("quotes").alias("quotes")).select("file", "split", F.coalesce(F.sum("quotes").over(order), F.lit(0)).alias("before"))
    within = Window.partitionBy("file", "split").orderBy("line")
    earlier = F.coalesce(F.sum("quotes").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    begins = lines.join(splits, ["file", "split"]).withColumn("begins", (F.col("before") + earlier) % 2 == 0)
    begins = begins.withColumn("own", F.last(F.when(F.col("begins"), F.struct("split", "line")), True).over(within.rowsBetween(Window.unboundedPreceding, 0)))
    begins = stored(begins.select("file", "split", "line", "value", "own"), "csv-records")
    # The record open where a split starts: the last one begun in any split before it.
    lasts = begins.groupBy("file", "split").agg(F.max("own").alias("last")).select("file", "split", F.max("last").over(order).alias("open"))
    owned = begins.join(lasts, ["file", "split"]).withColumn("record", F.coalesce("own", "open"))
    pieces = owned.groupBy("file", "record").agg(F.array_sort(F.collect_list(F.struct("split", "line", "value"))).alias("pieces"))
    heads = begins.groupBy("file").agg(F.min("own").alias("record"))
    records = pieces.join(heads, ["file", "record"], "left_anti").select(F.rtrim(F.array_join(F.col("pieces.value"), "\n"), F.lit("\r")).alias("text")).filter("text <> ''")
    parsed = records.select(F.from_csv("text", _ddl(header), {"escape": '"', "maxCharsPerColumn": "-1"}).alias("r"))
    return parsed.select(*[F.col("r").getField(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields])


def _ddl(names: Sequence[str]) -> str:
    return ", ".join(f"`{name.replace('`', '``')}` string" for name in names)


def write_csv(df: DataFrame, path: str, encoding: str = "UTF-8") -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').option(
        "encoding", encoding
    ).csv(path)


def read_polygons(spark: SparkSession, path: str) -> DataFrame:
    """Polygon table stored as Parquet with a ``rings`` column."""
    return spark.read.parquet(path)


def write_polygons(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


# Bounds that a polygon store keeps beside every shape.
BOUNDS = ("_xmin", "_xmax", "_ymin", "_ymax")
#: Bits per axis of the curve that a store is ordered by, and shapes to a file.
_CURVE_BITS, SHAPES_PER_FILE = 16, 1 << 18


def _spread_bits(value: str) -> str:
    """The low 16 bits of a whole number, with a free bit after each."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        value = f"(({value} | shiftleft({value}, {shift})) & {mask}L)"
    return value


def write_polygon_store(df: DataFrame, path: str, rings: str = "rings", files: int | None = None) -> None:
    """Polygons with their bounds, in the order of a space-filling curve, so that readers of a box skip most row groups.

    The curve interleaves the bits of the middle of each shape's bounds within those of the table;
    shapes without vertices come first, and are in no box.
    """
    bounds = G.bounds_of(f"`{rings}`")
    boxed = df.selectExpr("*", *[f"{bounds[name[1:]]} AS {name}" for name in BOUNDS])
    # One row about the whole table.
    whole = boxed.selectExpr(*[f"{name[-3:]}({name}) AS {name}" for name in BOUNDS], "count(1) AS n").first()
    steps = (1 << _CURVE_BITS) - 1

    def place(axis: str) -> str:
        low, high = whole[f"_{axis}min"], whole[f"_{axis}max"]
        if low is None or not high > low:
            return "0L"
        return f"cast(greatest(0D, least({steps}D, {steps} * ((_{axis}min / 2 + _{axis}max / 2 - ({low!r}D)) / ({high - low!r}D)))) AS bigint)"

    placed = boxed.selectExpr("*", f"{place('x')} AS _cx", f"{place('y')} AS _cy")
    curve = placed.selectExpr("*", f"{_spread_bits('_cx')} | shiftleft({_spread_bits('_cy')}, 1) AS _curve").drop("_cx", "_cy")
    count = files or max(1, -(-whole["n"] // SHAPES_PER_FILE))
    curve.repartitionByRange(count, "_curve").sortWithinPartitions("_curve").drop("_curve").write.mode("overwrite").parquet(path)


def read_polygon_store(spark: SparkSession, path: str, box: tuple[float, float, float, float] | None = None) -> DataFrame:
    """Polygons of a store; with a box (west, east, south, north) those whose bounds meet it, by filters that reach the scan."""
    shapes = spark.read.parquet(path)
    if box is not None:
        west, east, south, north = box
        shapes = shapes.filter((F.col("_xmin") <= east) & (F.col("_xmax") >= west) & (F.col("_ymin") <= north) & (F.col("_ymax") >= south))
    return shapes.drop(*BOUNDS)


def read_geojson(spark: SparkSession, path: str, properties: str) -> DataFrame:
    """GeoJSON features, one per line; ``properties`` is their DDL.

    Polygons keep their rings; the parts of a multipolygon share one ring list.
    """
    coordinates = "array<array<array<double>>>"
    schema = f"type string, properties struct<{properties}>, geometry struct<type: string, coordinates: string>"
    features = spark.read.schema(schema).json(path)
    text = F.col("geometry.coordinates")
    single = F.from_json(text, coordinates)
    several = F.flatten(F.from_json(text, f"array<{coordinates}>"))
    chosen = F.when(F.col("geometry.type") == "MultiPolygon", several).otherwise(single)
    return features.select("properties.*", G.rings_from_coordinates(chosen).alias("rings"))


def geojson_features(df: DataFrame, properties: Sequence[str], rings: str = "rings") -> DataFrame:
    """One JSON feature per row in a ``value`` column: a Polygon, or a MultiPolygon where there are several parts."""
    parted = df.withColumn("_depths", F.expr(G.ring_depths(f"`{rings}`"))).withColumn("_parts", F.expr(G.parts_of(f"`{rings}`", "_depths")))

    def feature(kind: str, coordinates: Column) -> Column:
        geometry = F.struct(F.lit(kind).alias("type"), coordinates.alias("coordinates"))
        return F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(*properties).alias("properties"), geometry.alias("geometry")))

    single = feature("Polygon", G.coordinates_from_rings(F.get("_parts", F.lit(0))))
    several = feature("MultiPolygon", F.transform("_parts", G.coordinates_from_rings))
    return parted.select(F.when(F.size("_parts") > 1, several).otherwise(single).alias("value"))


def write_geojson(df: DataFrame, path: str, properties: Sequence[str], rings: str = "rings") -> None:
    geojson_features(df, properties, rings).write.mode("overwrite").text(path)


def read_polygon_text(
    spark: SparkSession, path: str, key: str = "GISJOIN", text: str = "geometry"
) -> DataFrame:
    """CSV with polygons as ``POLYGON ((x y, ...))`` text."""
    raw = read_csv(spark, path, f"`{key}` string, `{text}` string")
    return raw.select(key, G.rings_from_text(F.col(text)).alias("rings"))


def read_or_build(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The stored table at ``path``, built and stored first when there is none."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
    build().write.parquet(path)
    return spark.read.parquet(path)


def write_scoring_set(df: DataFrame, path: str, year: str = "target_year") -> None:
    """Rows to score, one folder per year to predict."""
    df.write.mode("overwrite").partitionBy(year).parquet(path)


def read_scoring_set(spark: SparkSession, path: str, target_year: int, year: str = "target_year") -> DataFrame:
    return spark.read.parquet(path).filter(F.col(year) == target_year)


def timestamp_column(df: DataFrame, name: str, parse: Callable[[Column], Column]) -> Column:
    """A date column as it is, or parsed when the file gives text."""
    c = F.col(f"`{name}`")
    return parse(c) if isinstance(df.schema[name].dataType, T.StringType) else c
