"""Census blocks, population, tenure and tract attributes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockrisk.functions import fields as C
from blockrisk.functions import geometry as G
from blockrisk.operators import panel as P
from blockrisk.operators.spatial import polygons_intersect
from blockrisk.session import stored

# County, census columns and the year range of the panel.
COUNTY = "San Francisco County"
POPULATION = [f"H7X00{i}" for i in range(1, 9)] + [f"H8C00{i}" for i in range(1, 10)]
TENURE = ["IFC001", "IFF001", "IFF002", "IFF003", "IFF004"]
SENSITIVE = ["H7X002", "H7X003", "H7X004", "H7X005", "H7X006", "H7X007", "H7X008"]
PANEL_YEARS = (2007, 2018)


def in_county(df: DataFrame, county: str = COUNTY) -> DataFrame:
    return df.filter(F.col("COUNTY") == county)


def city_blocks(
    shapes: DataFrame,
    census: DataFrame,
    county: str = COUNTY,
    box: tuple[float, float, float, float] = C.CITY_BOX,
    projected: bool = False,
    extra: Sequence[str] = (),
) -> DataFrame:
    """Blocks of the county whose interior point is inside the city box.

    ``projected`` marks rings in the conic projection, which become degrees.
    """
    kept = shapes.join(in_county(census, county).select("GISJOIN"), "GISJOIN", "left_semi")
    inside = kept.filter(C.in_city_box("INTPTLON10", "INTPTLAT10", box) == 1)
    rings = G.reproject_rings(F.col("rings")) if projected else F.col("rings")
    return inside.select("GISJOIN", *extra, rings.alias("rings"))


def block_years(
    blocks: DataFrame, first: int = PANEL_YEARS[0], last: int = PANEL_YEARS[1]
) -> DataFrame:
    """Block-year panel with interior point and land area as features."""
    features = blocks.select(
        "GISJOIN",
        F.col("INTPTLAT10").try_cast("double").alias("LAT"),
        F.col("INTPTLON10").try_cast("double").alias("LON"),
        F.col("ALAND10").try_cast("double").alias("AREA"),
    )
    return P.year_spine(features, first, last)


def census_per_block(
    population: DataFrame, tenure: DataFrame, county: str = COUNTY
) -> DataFrame:
    """Population and household counts with tenure beside them and the urban flag."""
    people = in_county(population, county).select("GISJOIN", "URBRURALA", *POPULATION)
    homes = in_county(tenure, county).select("GISJOIN", *TENURE)
    return people.join(homes, "GISJOIN", "left").select(
        "GISJOIN", *POPULATION, *TENURE, C.equals_flag("URBRURALA", "U").alias("Urban")
    )


def census_per_block_year(
    population: DataFrame,
    tenure: DataFrame,
    county: str = COUNTY,
    first: int = PANEL_YEARS[0],
    last: int = PANEL_YEARS[1],
) -> DataFrame:
    return P.year_spine(census_per_block(population, tenure, county), first, last)


def tracts_to_blocks(
    blocks: DataFrame,
    tracts: DataFrame,
    prices: DataFrame,
    gini: DataFrame,
    county: str = COUNTY,
    tract_key: str = "TRACT",
    box: tuple[float, float, float, float] | None = None,
    projected: bool = False,
) -> DataFrame:
    """Tract figures for every block that meets the tract, shared borders included.

    A block meeting several tracts has several rows; a block meeting none has
    nulls, and tracts meeting no block keep their figures without a block. With
    a ``box``, tracts whose interior point is outside it meet no block;
    ``projected`` marks rings in the conic projection, which become degrees.
    """
    prices = in_county(prices, county).select(tract_key, "JOIE001", "JTIE001")
    gini = in_county(gini, county).select(tract_key, "J4TM001")
    inside = tracts if box is None else tracts.filter(C.in_city_box("INTPTLON10", "INTPTLAT10", box) == 1)
    rings = G.reproject_rings(F.col("rings")) if projected else F.col("rings")
    local = inside.select(tract_key, rings.alias("rings")).join(prices.select(tract_key), tract_key, "left_semi")
    pairs = stored(polygons_intersect(blocks, local, "GISJOIN", tract_key), "tract-pairs")
    # Blocks without a tract are appended: as null keys of an outer join they would meet in one task.
    alone = blocks.select("GISJOIN").join(pairs.select("GISJOIN").distinct(), "GISJOIN", "left_anti")
    met = pairs.join(prices, tract_key, "outer").join(gini, tract_key, "outer")
    return met.select("GISJOIN", "JOIE001", "JTIE001", "J4TM001").unionByName(alone, allowMissingColumns=True)
