"""Every source on a tiny city: two unit blocks side by side and an empty third one."""

import pytest
from pyspark.sql import functions as F

from blockrisk.operators.spatial import PolygonCover
from blockrisk.plans import features
from blockrisk.sources import census, events, property
from tests.conftest import rows
from tests.test_spatial import polygons

A_IN, A_EDGE, B_IN, OUT = "(0.5, 0.5)", "(0.5, 1.0)", "(0.5, 1.5)", "(9, 9)"


def square(x):
    return [[(x, 0), (x + 1, 0), (x + 1, 1), (x, 1), (x, 0)]]


@pytest.fixture(scope="module")
def blocks(spark):
    shapes = polygons(spark, {"a": square(0), "b": square(1), "c": square(2)})
    return shapes.withColumns({
        "INTPTLAT10": F.lit("+37.75"),
        "INTPTLON10": F.when(F.col("GISJOIN") == "c", "-120.0").otherwise("-122.4"),
        "ALAND10": F.lit("10"),
    })


@pytest.fixture(scope="module")
def cover(blocks):
    return PolygonCover.build(blocks)


@pytest.fixture(scope="module")
def fires(spark):
    return spark.createDataFrame([
        ("2007-01-01", A_IN, "111 - building"), ("2006-12-31", A_IN, "111 - building"),
        ("2008-05-05", A_IN, "130 and 111"), ("2008-06-06", B_IN, "9140 odd"),
        ("2008-06-06", A_EDGE, "111"), ("2008-06-06", None, "111"), ("2008-06-06", B_IN, "200"),
        ("2008-06-06", OUT, "112"), ("2008-06-06", B_IN, None),
    ], "`Incident Date` string, Location string, `Primary Situation` string")


def test_fires_are_dense_over_observed_years(spark, blocks, cover, fires):
    got = rows(events.fires_per_block_year(events.prepare_fires(fires), blocks, cover), "GISJOIN", "Year", *events.FIRE_COLUMNS)
    assert got == [
        ("a", 2007, 1, 0, 0), ("a", 2008, 1, 1, 0), ("b", 2007, 0, 0, 0), ("b", 2008, 0, 0, 1),
        ("c", 2007, 0, 0, 0), ("c", 2008, 0, 0, 0),
    ]


def test_fires_train_and_holdout(spark, blocks, cover, fires):
    got = rows(
        events.per_block(events.prepare_fires(fires), blocks, cover, 2008, holdout=True),
        "GISJOIN", "Structure_fire_train", "Structure_fire_holdout", "External_fire_holdout",
    )
    assert got == [("a", 1, 1, 0), ("b", 0, 0, 1), ("c", 0, 0, 0)]


def test_fires_with_target(spark, cover, fires):
    counts = events.per_block_year(events.prepare_fires(fires), cover)
    got = rows(events.fires_with_target(counts, {"Vehicle_fire": "VF_pred"}), "GISJOIN", "Year", "VF_pred")
    assert got == [("a", 2007, 1), ("a", 2008, None), ("b", 2008, None)]


def test_violations_exclude_the_bound(spark, cover):
    raw = spark.createDataFrame(
        [("2007-01-01", A_IN), ("2007-01-02", A_IN), ("2007-01-03", A_IN), ("2008-01-01", None)],
        "`Violation Date` string, Location string",
    )
    assert rows(events.per_block_year(events.prepare_violations(raw), cover)) == [("a", 2007, 2)]


def test_inspections_count_complaints_and_all(spark, cover, blocks):
    raw = spark.createDataFrame([
        ("1", "complaint inspection", "2007-01-01", "2007-02-01", A_IN),
        (None, None, "2007-05-01", "2007-06-01", A_IN),
        ("3", "routine", "2007-05-01", None, A_IN),
        ("4", "routine", "2006-05-01", "2007-01-01", A_IN),
    ], "`Inspection Number` string, `Inspection Type Description` string, `Inspection Start Date` string, "
       "`Inspection End Date` string, Location string")
    points = events.prepare_inspections(raw)
    assert rows(events.per_block_year(points, cover)) == [("a", 2007, 1, 2)]
    assert rows(events.per_block(points, blocks, cover)) == [("a", 1, 2), ("b", 0, 0), ("c", 0, 0)]


def test_crimes_drop_excluded_categories(spark, cover):
    data = [("2007-02-01", B_IN, c) for c in ("ARSON", "THEFT", "NON-CRIMINAL", "SECONDARY CODES", "RECOVERED VEHICLE", None)]
    raw = spark.createDataFrame(data, "Date string, Location string, Category string")
    assert rows(events.per_block_year(events.prepare_crimes(raw), cover)) == [("b", 2007, 1, 1)]


PROPERTY = "`Closed Roll Year` int, `Assessed Land Value` double, `Number of Units` double, `Year Property Built` int, `Use Code` string, `Construction Type` string, the_geom string, `Lot Area` double"


def test_property_shares_and_means(spark, cover):
    good = [(2007, 10.0 + i, 2.0, 1900 + i, "SRES" if i % 2 else "IND", t, A_IN, 5.0 + i)
            for i, t in enumerate(["A", "WOO", "ROW", "B"])]
    bad = [
        (2007, 1e9, 1.0, 1950, "SRES", "A", A_IN, 1.0),   # at or above the value percentile
        (2007, 1.0, 1.0, 1889, "SRES", "A", A_IN, 1.0),   # too old
        (2007, 1.0, 1.0, 2019, "SRES", "A", A_IN, 1.0),   # too new
        (2007, 1.0, 1.0, 1950, None, "A", A_IN, 1.0),     # incomplete
        (2007, 9.0, 1.0, 1950, "SRES", "A", A_IN, 1e6),   # at or above the area percentile
        (2007, 9.0, 1.0, 1950, "SRES", "A", A_IN, 0.0),   # no area
    ]
    raw = spark.createDataFrame(good + bad, PROPERTY)
    got = property.property_per_block_year(raw, cover).first()
    assert (got["GISJOIN"], got["Year"]) == ("a", 2008)
    assert (got["SRES"], got["IND"], got["A"], got["B"], got["S"]) == (0.5, 0.5, 0.25, 0.25, 0.5)
    assert got["Assessed Land Value"] == pytest.approx(11.5)


def test_property_per_block_flags_unknown(spark, blocks, cover):
    raw = spark.createDataFrame([(2007, 10.0, 3.0, 2020, "SRES", "A", A_IN, 1.0), (2008, 20.0, 4.0, 1950, "SRES", "?", B_IN, 1.0), (2012, 20.0, 4.0, 1950, "IND", "A", B_IN, 1.0)], PROPERTY)
    table = property.property_per_block(raw, blocks, cover, year_to_predict=2010)
    got = rows(table, "GISJOIN", "Number of Units", "SRES", "S", "UnkownUseType", "UnkownStructureType")
    assert got == [("a", None, 0.0, 0.0, 1, 1), ("b", 4.0, 1.0, 1.0, 0, 0), ("c", None, 0.0, 0.0, 1, 1)]


def test_landuse_counts_parcels(spark, cover):
    small = lambda x, y: [[(x, y), (x + 0.1, y), (x + 0.1, y + 0.1), (x, y + 0.1), (x, y)]]
    parcels = polygons(spark, {"1": small(0.2, 0.2), "2": small(0.5, 0.5), "3": small(0.7, 0.2), "4": small(1.5, 0.5), "5": small(0.1, 0.1)})
    facts = spark.createDataFrame([("1", 1900, 2), ("2", 1910, None), ("3", 1920, 1), ("4", 2000, 5), ("5", 1849, 9)], "GISJOIN string, yrbuilt int, resunits int")
    joined = parcels.join(facts, "GISJOIN").drop("GISJOIN")
    table = property.landuse_per_block(joined, cover)
    assert rows(table) == [("a", 1900, 1920, 10.0, 2, 3), ("b", 2000, 2000, None, 1, 1)]
    assert rows(property.landuse_per_block(joined, cover, drop_single=True), "GISJOIN") == [("a",)]


@pytest.fixture(scope="module")
def population(spark):
    names = ["GISJOIN", "COUNTY", "URBRURALA", *census.POPULATION]
    data = [(k, county, urban, *range(len(census.POPULATION))) for k, county, urban in (
        ("a", census.COUNTY, "U"), ("b", census.COUNTY, "R"), ("x", "Marin County", "U"), ("c", census.COUNTY, "U"))]
    return spark.createDataFrame(data, names)


@pytest.fixture(scope="module")
def tenure(spark):
    return spark.createDataFrame([("a", census.COUNTY, 1, 2, 3, 4, 5), ("c", census.COUNTY, 1, 2, 3, 4, 5)], ["GISJOIN", "COUNTY", *census.TENURE])


def test_census(spark, population, tenure):
    got = rows(census.census_per_block(population, tenure), "GISJOIN", "IFC001", "Urban")
    assert got == [("a", 1, 1), ("b", None, 0), ("c", 1, 1)]
    assert census.census_per_block_year(population, tenure).count() == 36


def test_city_blocks_need_county_and_box(spark, blocks, population):
    assert rows(census.city_blocks(blocks, population), "GISJOIN") == [("a",), ("b",)]


def test_tracts_reach_every_block_they_touch(spark, blocks):
    tracts = polygons(spark, {"t1": square(0), "t2": square(50)}).withColumnRenamed("GISJOIN", "TRACT").withColumns(
        {"COUNTY": F.lit(census.COUNTY), "JOIE001": F.lit(1.0), "JTIE001": F.lit(2.0), "J4TM001": F.lit(0.5)})
    got = rows(census.tracts_to_blocks(blocks, tracts, tracts, tracts), "GISJOIN", "JOIE001")
    assert got == [(None, 1.0), ("a", 1.0), ("b", 1.0), ("c", None)]


@pytest.fixture(scope="module")
def raw(spark, blocks, fires, population, tenure):
    return features.RawTables(
        blocks=blocks, fires=fires,
        violations=spark.createDataFrame([("2008-01-02", B_IN)], "`Violation Date` string, Location string"),
        inspections=spark.createDataFrame([("1", "complaint inspection", "2008-01-02", "2008-01-03", A_IN)], events_schema()),
        crimes=spark.createDataFrame([("2008-02-01", B_IN, "ARSON")], "Date string, Location string, Category string"),
        property=spark.createDataFrame([(2007, float(i), 1.0, 1950, "SRES", "A", A_IN, float(i)) for i in range(1, 41)], PROPERTY),
        parcels=polygons(spark, {"1": square(5)}).withColumns({"yrbuilt": F.lit(1900), "resunits": F.lit(1)}),
        population=population, tenure=tenure,
    )


def events_schema():
    return ("`Inspection Number` string, `Inspection Type Description` string, `Inspection Start Date` string, "
            "`Inspection End Date` string, Location string")


def test_yearly_feature_table(spark, raw):
    table = features.yearly_feature_table(raw, 2007, 2008, last_complete_year=2008)
    assert len(table.columns) == len(set(table.columns))
    got = {(r["GISJOIN"], r["Year"]): r for r in table.collect()}
    assert len(got) == 6
    a07, a08, b08 = got["a", 2007], got["a", 2008], got["b", 2008]
    assert (a07["Structure_fire"], a07["SF_pred"], a07["VF_pred"]) == (1, 1, 1)
    assert (a08["SF_pred"], a08["Was complaint"], a08["UnkownUseType"]) == (None, 1, 0)
    assert (b08["Nviolations"], b08["CrimeIsArson"], b08["UnkownUseType"]) == (1, 1, 1)
    assert a08["SRES"] == 1.0 and b08["SRES"] is None and a07["LAT"] == 37.75


def test_block_feature_table_is_outer(spark, raw):
    polygons_in = spark.createDataFrame([("a", "P"), ("z", "Q")], "GISJOIN string, geometry string")
    got = {r["GISJOIN"]: r for r in features.block_feature_table(raw, 2009, polygons=polygons_in).collect()}
    assert set(got) == {"a", "b", "c", "z"}
    assert got["a"]["Structure_fire"] == 2 and got["a"]["SRES"] == 1.0
    assert got["b"]["Nviolations"] is None  # no tenure row, so dropped before the outer joins
