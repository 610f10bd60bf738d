"""Field cleaning, filters, flags, scans and sinks over the given tables."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from blockrisk.functions import fields as C
from blockrisk.functions import geometry as G
from blockrisk.operators import aggregates as A
from blockrisk.operators.ranking import below_quantile, quantiles
from blockrisk.session import scratch_path
from blockrisk.sources import artefacts, census, files
from blockrisk.workload import tables as T
from blockrisk.workload.registry import query


def src(name: str) -> str:
    return f"({T.table_sql(name)})"


@query("parse_point", "Location s, lon f, lat f", f"""
    SELECT "Location", px AS lon, py AS lat
    FROM (SELECT "Location", {T.point_columns_sql('"Location"')} FROM {src('fires')})""")
def _(spark, d):
    lon, lat = C.parse_point("Location")
    return T.logical(spark, d, "fires").select("Location", lon.alias("lon"), lat.alias("lat"))


@query("parse_timestamp_year", "year i, day i, n i", """
    SELECT year(o_orderdate) AS year, day(o_orderdate) AS day, count(*) AS n
    FROM orders GROUP BY 1, 2""")
def _(spark, d):
    patterns = {0: "yyyy-MM-dd HH:mm:ss", 1: "MM/dd/yyyy hh:mm:ss a", 2: "yyyy-MM-dd"}
    text = F.date_format("o_orderdate", patterns[0])
    for i in (1, 2):
        text = F.when(F.col("o_orderkey") % 3 == i, F.date_format("o_orderdate", patterns[i])).otherwise(text)
    when = C.parse_timestamp("text")
    return (
        T.read(spark, d, "orders").select(text.alias("text"))
        .groupBy(F.year(when).alias("year"), F.day(when).alias("day"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query("block_year_key", "key s, block s, year i, n i", """
    SELECT 'G' || CAST(o_custkey AS VARCHAR) || CAST(year(o_orderdate) AS VARCHAR) AS key,
           'G' || CAST(o_custkey AS VARCHAR) AS block, year(o_orderdate) AS year, count(*) AS n
    FROM orders GROUP BY ALL""")
def _(spark, d):
    block = F.concat(F.lit("G"), F.col("o_custkey").cast("string"))
    key = C.block_year_key(block, F.year("o_orderdate"))
    counts = T.read(spark, d, "orders").groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select(
        "key", C.block_of_key("key").alias("block"), C.year_of_key("key").alias("year"), "n"
    )


@query("shift_key", "key s, n i", """
    SELECT CAST(o_custkey AS VARCHAR) || CAST(year(o_orderdate) - 1 AS VARCHAR) AS key, count(*) AS n
    FROM orders GROUP BY 1""")
def _(spark, d):
    key = C.block_year_key("o_custkey", F.year("o_orderdate"))
    shifted = T.read(spark, d, "orders").select(C.shift_block_year_key(key).alias("key"))
    return A.count_per(shifted, ["key"], "n")


@query("roll_year", "Year i, n i", f"""
    SELECT "Closed Roll Year" + 1 AS "Year", count(*) AS n FROM {src('property')} GROUP BY 1""")
def _(spark, d):
    year = C.representing_year("`Closed Roll Year`")
    return A.count_per(T.logical(spark, d, "property").select(year.alias("Year")), ["Year"], "n")


@query("address_normalise", "address s, n i", f"""
    SELECT CASE WHEN contains(address, 'San Francisco') THEN address
                ELSE address || ' San Francisco' END AS address, count(*) AS n
    FROM {src('sites')} GROUP BY 1""")
def _(spark, d):
    sites = T.logical(spark, d, "sites").select(C.normalise_address("address").alias("address"))
    return A.count_per(sites, ["address"], "n")


@query("display_score", "o_orderkey i, shown s", """
    SELECT o_orderkey, printf('%.1f', CAST((o_orderkey * 37) % 101 AS DOUBLE) / 10) AS shown FROM orders""")
def _(spark, d):
    score = (F.col("o_orderkey") * 37) % 101 / 10
    return T.read(spark, d, "orders").select("o_orderkey", C.display_score(score).alias("shown"))


@query("date_bound", "since_n i, after_n i", """
    SELECT count(*) FILTER (o_orderdate >= TIMESTAMP '1997-01-01') AS since_n,
           count(*) FILTER (o_orderdate > TIMESTAMP '1997-01-01') AS after_n FROM orders""")
def _(spark, d):
    return T.read(spark, d, "orders").agg(
        F.count_if(C.since("o_orderdate", "1997-01-01")).alias("since_n"),
        F.count_if(C.since("o_orderdate", "1997-01-01", inclusive=False)).alias("after_n"),
    )


@query("drop_null_subset", "n i", f"""
    SELECT count(*) AS n FROM {src('property')}
    WHERE the_geom IS NOT NULL AND "Closed Roll Year" IS NOT NULL""")
def _(spark, d):
    kept = T.logical(spark, d, "property").na.drop(subset=["the_geom", "Closed Roll Year"])
    return kept.agg(F.count(F.lit(1)).alias("n"))


@query("drop_any_null", "Use Code s, n i", f"""
    SELECT "Use Code", count(*) AS n FROM {src('property')}
    WHERE the_geom IS NOT NULL AND "Use Code" IS NOT NULL GROUP BY 1""")
def _(spark, d):
    return A.count_per(T.logical(spark, d, "property").na.drop("any"), ["Use Code"], "n")


_CLASS_SQL = {
    name: f"CASE WHEN regexp_matches(\"Primary Situation\", '{'|'.join(codes)}') THEN 1 ELSE 0 END"
    for name, codes in C.FIRE_CLASSES.items()
}
_ANY_CODE = "|".join(code for codes in C.FIRE_CLASSES.values() for code in codes)


@query("regex_classes", "o_orderkey i, Structure_fire i, Vehicle_fire i, External_fire i", f"""
    SELECT o_orderkey, {', '.join(f'{e} AS "{n}"' for n, e in _CLASS_SQL.items())}
    FROM {src('fires')} WHERE regexp_matches("Primary Situation", '{_ANY_CODE}')""")
def _(spark, d):
    situation = F.col("`Primary Situation`")
    flags = C.class_flags(situation, C.FIRE_CLASSES)
    return (
        T.logical(spark, d, "fires").filter(C.matches_any(situation, _ANY_CODE.split("|")))
        .select("o_orderkey", *[f.alias(n) for n, f in flags.items()])
    )


@query("regex_anchored", "hits i", f"""
    SELECT count(*) FILTER (regexp_matches("Primary Situation", '^(?:111|112)')) AS hits
    FROM {src('fires')}""")
def _(spark, d):
    hit = C.matches_any("`Primary Situation`", ["111", "112"], anchored=True)
    return T.logical(spark, d, "fires").agg(F.count_if(hit).alias("hits"))


@query("regex_exclude", "Category s, n i", f"""
    SELECT "Category", count(*) AS n FROM {src('crimes')}
    WHERE NOT regexp_matches("Category", '{'|'.join(C.EXCLUDED_CRIMES)}') GROUP BY 1""")
def _(spark, d):
    kept = T.logical(spark, d, "crimes").filter(~C.matches_any("Category", C.EXCLUDED_CRIMES))
    return A.count_per(kept, ["Category"], "n")


@query("equality_flags", "arson i, other i, complaint i", f"""
    SELECT a.arson, a.other, b.complaint FROM
      (SELECT count(*) FILTER ("Category" = 'ARSON') AS arson,
              count(*) FILTER ("Category" <> 'ARSON') AS other FROM {src('crimes')}) a,
      (SELECT count(*) FILTER ("Inspection Type Description" = 'complaint inspection') AS complaint
       FROM {src('inspections')}) b""")
def _(spark, d):
    complaint = T.logical(spark, d, "inspections").agg(
        F.sum(C.equals_flag("`Inspection Type Description`", "complaint inspection")).alias("c")
    )
    return T.logical(spark, d, "crimes").agg(
        F.sum(C.equals_flag("Category", "ARSON")).alias("arson"),
        F.sum(C.differs_flag("Category", "ARSON")).alias("other"),
    ).select("arson", "other", complaint.scalar().alias("complaint"))


@query("range_filter", "built i, sized i", f"""
    SELECT count(*) FILTER ("Year Property Built" BETWEEN 1890 AND 2018) AS built,
           count(*) FILTER ("Lot Area" > 0) AS sized FROM {src('property')}""")
def _(spark, d):
    return T.logical(spark, d, "property").agg(
        F.count_if(F.col("Year Property Built").between(1890, 2018)).alias("built"),
        F.count_if(F.col("Lot Area") > 0).alias("sized"),
    )


@query("below_percentile_chain", "n i, max_value m, max_area m", f"""
    WITH r AS (SELECT "Assessed Land Value" AS v, "Lot Area" AS a FROM {src('property')}),
         s AS (SELECT * FROM r WHERE v < (SELECT quantile_cont(v, 0.95) FROM r)),
         u AS (SELECT * FROM s WHERE a < (SELECT quantile_cont(a, 0.95) FROM s))
    SELECT count(*) AS n, max(v) AS max_value, max(a) AS max_area FROM u""")
def _(spark, d):
    rows = T.logical(spark, d, "property").select("Assessed Land Value", "Lot Area")
    cheap = below_quantile(rows, "Assessed Land Value", 0.95)
    return below_quantile(cheap, "Lot Area", 0.95).agg(
        F.count(F.lit(1)).alias("n"),
        F.max("Assessed Land Value").alias("max_value"), F.max("Lot Area").alias("max_area"),
    )


@query("quantile", "q95 m, q50 m, q05 m", """
    SELECT quantile_cont(l_extendedprice, 0.95) AS q95, quantile_cont(l_extendedprice, 0.5) AS q50,
           quantile_cont(l_extendedprice, 0.05) AS q05 FROM lineitem""")
def _(spark, d):
    rows = T.read(spark, d, "lineitem").select("l_extendedprice")
    return quantiles(rows, "l_extendedprice", {"q95": 0.95, "q50": 0.5, "q05": 0.05})


@query("bbox_filter", "inside i, n i", f"""
    SELECT CASE WHEN lon > -122.53 AND lon < -122.35 AND lat > 37.7 AND lat < 37.84
                THEN 1 ELSE 0 END AS inside, count(*) AS n FROM {src('sites')} GROUP BY 1""")
def _(spark, d):
    flags = T.logical(spark, d, "sites").select(C.in_city_box("lon", "lat").alias("inside"))
    return A.count_per(flags, ["inside"], "n")


@query("county_filter", "URBRURALA s, n i", f"""
    SELECT "URBRURALA", count(*) AS n FROM {src('census_population')}
    WHERE "COUNTY" = 'San Francisco County' GROUP BY 1""")
def _(spark, d):
    return A.count_per(census.in_county(T.logical(spark, d, "census_population")), ["URBRURALA"], "n")


@query("year_slice", "before i, during i", """
    SELECT count(*) FILTER (year(o_orderdate) < 2000) AS before,
           count(*) FILTER (year(o_orderdate) = 2000) AS during FROM orders""")
def _(spark, d):
    early = C.before_year("o_orderdate", 2000)
    return T.read(spark, d, "orders").filter(C.before_year("o_orderdate", 2001)).agg(
        F.count_if(early).alias("before"), F.count_if(~early).alias("during")
    )


@query("roll_year_bound", "Closed Roll Year i, n i", f"""
    SELECT "Closed Roll Year", count(*) AS n FROM {src('property')}
    WHERE "Closed Roll Year" >= 1997 GROUP BY 1""")
def _(spark, d):
    kept = T.logical(spark, d, "property").filter(F.col("Closed Roll Year") >= 1997)
    return A.count_per(kept, ["Closed Roll Year"], "n")


@query("invalidate", "rows i, valid i, mean f", f"""
    SELECT count(*) AS rows, count(v) AS valid, avg(v) AS mean FROM
      (SELECT CASE WHEN "Year Property Built" <= 2019 THEN "Year Property Built" END AS v
       FROM {src('property')})""")
def _(spark, d):
    kept = T.logical(spark, d, "property").select(
        C.keep_up_to("`Year Property Built`", 2019).alias("v")
    )
    return kept.agg(F.count(F.lit(1)).alias("rows"), F.count("v").alias("valid"), F.avg("v").alias("mean"))


@query("binarise", "o_orderkey i, label i, hit i", f"""
    SELECT o_orderkey, CASE WHEN o_orderkey % 29 >= 1 THEN 1 ELSE 0 END AS label,
           CASE WHEN "Primary Situation" IS NOT NULL AND o_orderkey % 7 > 0 THEN 1 ELSE 0 END AS hit
    FROM {src('fires')}""")
def _(spark, d):
    count = F.when(F.col("`Primary Situation`").isNotNull(), F.col("o_orderkey") % 7)
    return T.logical(spark, d, "fires").select(
        "o_orderkey", C.at_least_one(F.col("o_orderkey") % 29).alias("label"),
        C.above_zero(count).alias("hit"),
    )


@query("row_sum_flag", "GISJOIN s, total i, unknown i", f"""
    SELECT "GISJOIN", coalesce("IFF001", 0) + coalesce("IFF002", 0) AS total,
           CASE WHEN coalesce("IFF001", 0) + coalesce("IFF002", 0) = 0 THEN 1 ELSE 0 END AS unknown
    FROM {src('census_tenure')}""")
def _(spark, d):
    columns = ["IFF001", "IFF002"]
    return T.logical(spark, d, "census_tenure").select(
        "GISJOIN", C.row_sum(columns).alias("total"), C.zero_sum_flag(columns).alias("unknown")
    )


@query("cast_numeric", "n i, bad i, total m", f"""
    SELECT count(*) AS n, count(*) FILTER (TRY_CAST(address AS DOUBLE) IS NULL) AS bad,
           sum(TRY_CAST(split_part(address, ' ', 1) AS DOUBLE)) AS total FROM {src('sites')}""")
def _(spark, d):
    a = F.col("address")
    return T.logical(spark, d, "sites").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(a.try_cast("double").isNull()).alias("bad"),
        F.sum(F.split_part(a, F.lit(" "), F.lit(1)).try_cast("double")).alias("total"),
    )


@query("project_drop_rename", "key s, year i, kept i", f"""
    SELECT "GISJOIN" AS key, 2010 AS year, "H7X001" AS kept FROM {src('census_population')}""")
def _(spark, d):
    table = T.logical(spark, d, "census_population").drop(*census.SENSITIVE, "COUNTY")
    return table.withColumnsRenamed({"GISJOIN": "key", "H7X001": "kept"}).select(
        "key", F.lit(2010).alias("year"), "kept"
    )


@query("one_hot", "GISJOIN s, Urban i, seg i", f"""
    SELECT p."GISJOIN", CASE WHEN p."URBRURALA" = 'U' THEN 1 ELSE 0 END AS "Urban",
           CASE WHEN p."URBRURALA" = 'U' THEN 1 ELSE 0 END AS seg
    FROM {src('census_population')} p""")
def _(spark, d):
    hot = C.one_hot("URBRURALA", ["U", "R"])
    return T.logical(spark, d, "census_population").select(
        "GISJOIN", C.equals_flag("URBRURALA", "U").alias("Urban"), hot["U"].alias("seg")
    )


# --- scans and sinks ---


@query("csv_scan_sink", "Location s, Primary Situation s, n i", f"""
    SELECT "Location", "Primary Situation", count(*) AS n FROM {src('fires')} GROUP BY 1, 2""")
def _(spark, d):
    path = scratch_path(spark, "fires-csv")
    files.write_csv(T.logical(spark, d, "fires"), path)
    back = files.read_csv(spark, path, files.FIRE_SCHEMA)
    return back.groupBy("Location", "Primary Situation").agg(F.count(F.lit(1)).alias("n"))


@query("csv_line_breaks", "Location s, n i", f"""
    SELECT 'at ' || coalesce("Location", '') || chr(10) || 'SF, "CA"' AS "Location", count(*) AS n FROM {src('fires')} GROUP BY 1""")
def _(spark, d):
    path = scratch_path(spark, "broken-csv")
    wrapped = F.concat(F.lit("at "), F.coalesce("Location", F.lit("")), F.lit('\nSF, "CA"'))
    files.write_csv(T.logical(spark, d, "fires").withColumn("Location", wrapped), path)
    return files.read_csv(spark, path, files.FIRE_SCHEMA).groupBy("Location").agg(F.count(F.lit(1)).alias("n"))


@query("csv_line_breaks_split", "Location s, n i", f"""
    SELECT 'at ' || coalesce("Location", '') || chr(10) || 'SF, "CA"' AS "Location", count(*) AS n FROM {src('fires')} GROUP BY 1""")
def _(spark, d):
    """The same records, read with splits inside files."""
    path = scratch_path(spark, "broken-csv")
    wrapped = F.concat(F.lit("at "), F.coalesce("Location", F.lit("")), F.lit('\nSF, "CA"'))
    files.write_csv(T.logical(spark, d, "fires").withColumn("Location", wrapped), path)
    return files.read_split_csv(spark, path, files.FIRE_SCHEMA).groupBy("Location").agg(F.count(F.lit(1)).alias("n"))


@query("csv_encoding", "name s, n i", """
    SELECT 'café ' || c_mktsegment AS name, count(*) AS n FROM customer GROUP BY 1""")
def _(spark, d):
    path = scratch_path(spark, "latin-csv")
    named = T.read(spark, d, "customer").select(F.concat(F.lit("café "), "c_mktsegment").alias("name"))
    files.write_csv(named, path, encoding="ISO-8859-1")
    return A.count_per(files.read_csv(spark, path, "name string", encoding="ISO-8859-1"), ["name"], "n")


_AREA_SQL = f"""
    SELECT block AS "GISJOIN", abs(sum((x1 + 122.5) * (y2 - 37.7) - (x2 + 122.5) * (y1 - 37.7))) / 2 * 1e6 AS area
    FROM ({T.edges_sql()}) GROUP BY 1"""


def _areas(blocks):
    twice = F.aggregate(
        F.expr(G.edges_of("rings")), F.lit(0.0),
        lambda a, e: a + (e["x1"] + 122.5) * (e["y2"] - 37.7) - (e["x2"] + 122.5) * (e["y1"] - 37.7),
    )
    return blocks.select("GISJOIN", (F.abs(twice) / 2 * 1e6).alias("area"))


@query("polygon_text_scan", "GISJOIN s, area f", _AREA_SQL)
def _(spark, d):
    path = scratch_path(spark, "polygon-text")
    text = T.blocks(spark, d).select("GISJOIN", G.text_from_rings(F.col("rings")).alias("geometry"))
    files.write_csv(text, path)
    return _areas(files.read_polygon_text(spark, path))


@query("polygon_store", "GISJOIN s, area f", _AREA_SQL)
def _(spark, d):
    path = scratch_path(spark, "polygons")
    files.write_polygons(T.blocks(spark, d), path)
    return _areas(files.read_polygons(spark, path))


@query("polygon_store_box", "GISJOIN s, area f", f"""
    {_AREA_SQL} HAVING min(x1) <= {C.CITY_BOX[1]} AND max(x1) >= {C.CITY_BOX[0]} AND min(y1) <= {C.CITY_BOX[3]} AND max(y1) >= {C.CITY_BOX[2]}""")
def _(spark, d):
    """Blocks of the city box out of a store that keeps bounds and the order of a curve."""
    path = scratch_path(spark, "polygon-store")
    files.write_polygon_store(T.blocks(spark, d), path)
    return _areas(files.read_polygon_store(spark, path, C.CITY_BOX))


@query("geojson_layer", "GISJOIN s, area f", _AREA_SQL)
def _(spark, d):
    path = scratch_path(spark, "geojson")
    files.write_geojson(T.blocks(spark, d), path, ["GISJOIN"])
    return _areas(files.read_geojson(spark, path, "GISJOIN string"))


@query("read_or_build", "o_custkey i, n i", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1")
def _(spark, d):
    path = scratch_path(spark, "artifact")
    build = lambda: A.count_per(T.read(spark, d, "orders"), ["o_custkey"], "n")
    files.read_or_build(spark, path, build)
    return files.read_or_build(spark, path, build)


@query("read_or_build_changed", "yr i, urgent i, n i", """
    SELECT CAST(year(o_orderdate) AS BIGINT) AS yr, CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS urgent, count(*) AS n FROM orders GROUP BY 1, 2""")
def _(spark, d):
    """A table by year, built from the orders up to 1999 and refreshed when those of later years arrive in a second file."""
    folder, path = scratch_path(spark, "inputs"), scratch_path(spark, "artefact")
    orders = T.read(spark, d, "orders").select(F.year("o_orderdate").alias("yr"), "o_orderpriority")
    load = lambda files: spark.read.parquet(*files)
    build = lambda rows: rows.groupBy("yr", F.left("o_orderpriority", F.lit(1)).cast("int").alias("urgent")).agg(F.count(F.lit(1)).alias("n"))
    for part in (F.col("yr") < 2000, F.col("yr") >= 2000):
        orders.filter(part).write.mode("append").parquet(folder)
        files = spark.read.parquet(folder).inputFiles()
        table = artefacts.refresh(spark, path, files, load, build, "yr")
    return table


@query("scoring_set", "o_orderkey i", "SELECT o_orderkey FROM orders WHERE year(o_orderdate) = 2000")
def _(spark, d):
    path = scratch_path(spark, "scoring")
    rows = T.read(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("target_year"))
    files.write_scoring_set(rows, path)
    return files.read_scoring_set(spark, path, 2000)


@query("reproject", "o_orderkey i, lon f, lat f", """
    SELECT o_orderkey, -122.5 + (o_orderkey % 9973) / 1e4 AS lon, 37.0 + (o_orderkey * 7 % 9967) / 1e4 AS lat
    FROM orders""")
def _(spark, d):
    key = F.col("o_orderkey")
    lon, lat = F.lit(-122.5) + key % 9973 / F.lit(1e4), F.lit(37.0) + key * 7 % 9967 / F.lit(1e4)
    x, y = G.to_albers(lon, lat)
    flat = T.read(spark, d, "orders").select("o_orderkey", x.alias("x"), y.alias("y"))
    back_lon, back_lat = G.from_albers(F.col("x"), F.col("y"))
    return flat.select("o_orderkey", back_lon.alias("lon"), back_lat.alias("lat"))


def _albers_sql(lon: str, lat: str) -> tuple[str, str]:
    """The conic projection by the power series of the authalic integral, apart from the closed form of the library."""
    f = 1 / 298.257222101
    a, e2 = 6378137.0, f * (2 - f)
    weights = [(1 - e2) * e2**k * (2 * k + 2) / (2 * k + 1) for k in range(10)]
    q = lambda s: sum(w * s ** (2 * k + 1) for k, w in enumerate(weights))
    s0, s1, s2 = (math.sin(math.radians(v)) for v in (37.5, 29.5, 45.5))
    m1, m2 = ((1 - s * s) / (1 - e2 * s * s) for s in (s1, s2))
    n = (m1 - m2) / (q(s2) - q(s1))
    c = m1 + n * q(s1)
    series = " + ".join(f"{w!r} * pow(sin(radians({lat})), {2 * k + 1})" for k, w in enumerate(weights))
    radius = f"({a / n!r} * sqrt({c!r} - {n!r} * ({series})))"
    angle = f"({n!r} * radians({lon} + 96.0))"
    return f"{radius} * sin({angle})", f"{a / n * math.sqrt(c - n * q(s0))!r} - {radius} * cos({angle})"


_PROJECTED = _albers_sql("lon", "lat")


@query("project_forward", "o_orderkey i, x m, y m", f"""
    SELECT o_orderkey, {_PROJECTED[0]} AS x, {_PROJECTED[1]} AS y FROM (
        SELECT o_orderkey, -124.5 + (o_orderkey % 9973) / 2e2 AS lon, 25.0 + (o_orderkey * 7 % 9967) / 4e2 AS lat FROM orders) q""")
def _(spark, d):
    """Degrees to metres over the whole country."""
    key = F.col("o_orderkey")
    x, y = G.to_albers(F.lit(-124.5) + key % 9973 / F.lit(2e2), F.lit(25.0) + key * 7 % 9967 / F.lit(4e2))
    return T.read(spark, d, "orders").select("o_orderkey", x.alias("x"), y.alias("y"))


_LANDUSE = {"block_num": "string", "landuse": "string", "resunits": "int", "retail": "int", "yrbuilt": "int"}


@query("schema_inspection", "place i, name s, type s, non_null i", " UNION ALL ".join(
    f"SELECT {k} AS place, '{name}' AS name, '{kind}' AS type, count(\"{name}\") AS non_null FROM ({T.table_sql('landuse')}) t{k}" for k, (name, kind) in enumerate(_LANDUSE.items())))
def _(spark, d):
    """Columns of the land-use table with their types and numbers of values."""
    return A.column_profile(T.logical(spark, d, "landuse").select(*_LANDUSE))
