"""Risk maps, lookups and comparisons with simpler ways to choose blocks."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blockrisk.functions import fields as C
from blockrisk.ml.pipelines import load, save, scored
from blockrisk.ml.split import TARGETS, feature_names, year_split
from blockrisk.operators import panel as P
from blockrisk.operators.aggregates import fill_nulls
from blockrisk.operators.ranking import flag_above_threshold, quantiles, row_numbers, top_k
from blockrisk.operators.spatial import PolygonCover
from blockrisk.session import stored
from blockrisk.sources.files import read_scoring_set, write_scoring_set

# Blocks to flag per fire type.
HIGH_RISK_BLOCKS = {"structure": 290, "external": 560, "vehicle": 180}

# Target column and point flag per fire type.
FIRE_TYPES = {
    "structure": ("SF_pred", "SF"), "vehicle": ("VF_pred", "VF"), "external": ("EF_pred", "EF"),
}

# Quantiles behind the map legend.
LEGEND_QUANTILES = {"b0": 0.0, "b1": 0.5, "b2": 0.75, "b3": 0.85, "b4": 0.9}


def model_for(fire_type: str, year: int) -> tuple[str, int]:
    """Model and scoring set for a request: the 2017 model serves 2017 only."""
    if fire_type not in FIRE_TYPES:
        raise ValueError(f"unknown fire type {fire_type}")
    return f"{fire_type}_{2017 if year == 2017 else 2018}", year


@dataclass(frozen=True)
class ModelRegistry:
    """Saved models by fire type and year of training, and scoring sets by year, under one folder."""

    folder: str

    def model_path(self, name: str) -> str:
        return f"{self.folder}/models/{name}"

    def add_model(self, fire_type: str, year: int, model: PipelineModel) -> None:
        save(model, self.model_path(f"{fire_type}_{year}"))

    def add_scoring_set(self, rows: DataFrame, year: str = "target_year") -> None:
        write_scoring_set(rows, f"{self.folder}/scoring", year)

    def risk(self, spark: SparkSession, fire_type: str, year: int, key: str = "GISJOIN") -> DataFrame:
        """Score and flag of every block for a fire type and year, by the model that serves them."""
        name, target = model_for(fire_type, year)
        rows = read_scoring_set(spark, f"{self.folder}/scoring", target)
        return risk_of_year(rows, load(self.model_path(name)), fire_type, key=key)


def risk_of_requests(requests: DataFrame, registry: ModelRegistry, blocks: DataFrame, key: str = "GISJOIN", box: tuple[float, float, float, float] = C.CITY_BOX) -> DataFrame:
    """Requests (fire_type, year, lon, lat and more) with their block, its score and high-risk flag.

    Requests are located once, whatever they ask for. Every fire type and year asked for, nine at
    most in use, is scored once for all blocks and joined by (type, year, block). Requests
    outside the box drop out; those in no block, or on a border, have nulls.
    """
    spark = requests.sparkSession
    asked = sorted((r["fire_type"], r["year"]) for r in requests.select("fire_type", "year").distinct().collect())
    located = PolygonCover.build(blocks, key).locate_all(requests.filter(C.in_city_box("lon", "lat", box) == 1))
    scores = None
    for fire_type, year in asked:
        one = registry.risk(spark, fire_type, year, key).select(F.lit(fire_type).alias("fire_type"), F.lit(year).alias("year"), key, "score", "highrisk")
        scores = one if scores is None else scores.unionByName(one)
    if scores is None:
        return located.withColumns({"score": F.lit(None).cast("double"), "highrisk": F.lit(None).cast("int")})
    return located.join(scores, ["fire_type", "year", key], "left")


def risk_map(scored: DataFrame, blocks: DataFrame, n: int, key: str = "GISJOIN") -> DataFrame:
    """Geometry, score and high-risk flag per scored block, joined by key."""
    flagged = flag_above_threshold(scored, "score", n)
    return flagged.join(blocks.select(key, "rings"), key)


def with_block_id(risk: DataFrame, key: str = "GISJOIN") -> DataFrame:
    """Consecutive block ids from 0 in key order."""
    return row_numbers(risk, [key], "BLOCKID").withColumn("BLOCKID", F.col("BLOCKID") - 1)


def risk_at_locations(
    locations: DataFrame,
    risk: DataFrame,
    location_key: str,
    key: str = "GISJOIN",
    box: tuple[float, float, float, float] = C.CITY_BOX,
) -> DataFrame:
    """Score and flag of the block around each location inside the city box.

    Locations outside the box drop out; those in no block, or on a border, stay
    with nulls.
    """
    inside = locations.filter(C.in_city_box("lon", "lat", box) == 1)
    cover = PolygonCover.build(risk, key, carry=["score", "highrisk"])
    return cover.locate_all(inside)


def _share(condition: Column) -> Column:
    return F.avg(condition.cast("double"))


def hit_rate_at_n(
    outcomes: DataFrame, n: int, target: str, previous: str, score: str = "score", key: str = "GISJOIN"
) -> DataFrame:
    """Share of selected blocks with an event: by score, by previous count, at random."""
    hit = C.above_zero(target)
    chosen = {
        "model": top_k(outcomes, score, n, key),
        "previous": top_k(outcomes, previous, n, key),
    }
    base = outcomes.agg(_share(hit).alias("random"))
    return base.select(
        *[
            top.agg((F.sum(hit) / F.lit(float(n))).alias("s")).scalar().alias(name)
            for name, top in chosen.items()
        ],
        "random",
    )


def capture_rate_at_n(
    outcomes: DataFrame, n: int, target: str, previous: str, score: str = "score", key: str = "GISJOIN"
) -> DataFrame:
    """Share of all events inside the selected blocks, three ways."""
    chosen = {
        "model": top_k(outcomes, score, n, key),
        "previous": top_k(outcomes, previous, n, key),
    }
    base = outcomes.agg(F.sum(target).alias("_all"), F.count(F.lit(1)).alias("_rows"))
    return base.select(
        *[
            F.try_divide(top.agg(F.sum(target).alias("s")).scalar(), F.col("_all")).alias(name)
            for name, top in chosen.items()
        ],
        F.try_divide(F.lit(float(n)), F.col("_rows")).alias("random"),
    )


def legend_breaks(df: DataFrame, column: str = "score") -> DataFrame:
    """Quantiles rounded to their leading digit, one row per break."""
    q = quantiles(df, column, LEGEND_QUANTILES)
    long = q.select(
        F.posexplode(F.array(*LEGEND_QUANTILES)).alias("break", "value")
    )
    base = F.pow(F.lit(10.0), F.floor(F.log10("value")))
    return long.select(
        "break",
        F.when(F.col("value") > 0, F.bround(F.col("value") / base) * base).otherwise(0.0).alias("value"),
    )


def fire_points(fires: DataFrame, year: int | None = None) -> DataFrame:
    """Located fires with one flag per class, of one year or of all."""
    points = fires if year is None else fires.filter(F.col(P.YEAR) == year)
    return points.select(
        P.YEAR, F.col("lat").alias("Lat"), F.col("lon").alias("Lon"),
        F.col("External_fire").alias("EF"), F.col("Structure_fire").alias("SF"),
        F.col("Vehicle_fire").alias("VF"),
    )


def fire_overlay(fires: DataFrame, fire_type: str, year: int) -> DataFrame:
    """Points of one fire type and year to lay over its map."""
    flag = FIRE_TYPES[fire_type][1]
    return fire_points(fires, year).filter(F.col(flag) == 1).select("Lat", "Lon")


def feature_map(
    features: DataFrame, shapes: DataFrame, feature: str, year: int,
    shape_key: str = "GISYEARJOI", feature_key: str = "GISYEARJOIN",
) -> DataFrame:
    """One feature of one year beside the geometry, whose key has a shortened name."""
    values = features.filter(F.col(P.YEAR) == year).select(feature_key, feature)
    return P.join_renamed(shapes, values, shape_key, feature_key, "inner")


def risk_of_year(
    table: DataFrame, model: PipelineModel, fire_type: str, n: int | None = None, key: str = "GISJOIN"
) -> DataFrame:
    """Score and high-risk flag of every block in a scoring set, for a fire type's model."""
    if fire_type not in FIRE_TYPES:
        raise ValueError(f"unknown fire type {fire_type}")
    scores = scored(model, table, [key])
    return flag_above_threshold(scores, "score", HIGH_RISK_BLOCKS[fire_type] if n is None else n)


def risk_lifecycle(
    table: DataFrame, fire_type: str, year: int, pipeline_of: Callable[[list[str]], Pipeline], key: str = "GISJOIN"
) -> tuple[DataFrame, DataFrame]:
    """From a yearly feature table to the year's risk: (rows with their split, scored and flagged blocks).

    Means for nulls come from the training years; the model learns from those alone.
    """
    rows = year_split(table, FIRE_TYPES[fire_type][0], year)
    filled = stored(fill_nulls(rows, {}, keep=["label", *TARGETS]), "risk-rows")
    names = feature_names(filled, without=[P.YEAR])
    model = pipeline_of(names).fit(filled.filter(F.col("split") == "train"))
    return filled, risk_of_year(filled.filter(F.col("split") == "future"), model, fire_type, key=key)
