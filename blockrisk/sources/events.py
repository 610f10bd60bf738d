"""Dated point sources: fires, violations, inspections and crimes.

``prepare_*`` turns a raw table into ``lon, lat, Year`` and measures; the other
functions locate those points and aggregate. A source is read once per result:
several measures share one aggregation.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockrisk.functions import fields as C
from blockrisk.operators import aggregates as A
from blockrisk.operators import panel as P
from blockrisk.operators.spatial import PolygonCover
from blockrisk.session import stored
from blockrisk.sources.files import timestamp_column

FIRE_COLUMNS = list(C.FIRE_CLASSES)
COMPLAINT = "complaint inspection"
ARSON = "ARSON"
SINCE = "2007-01-01"


def _points(df: DataFrame, location: str, date: str, since: str, inclusive: bool) -> DataFrame:
    lon, lat = C.parse_point(f"`{location}`")
    when = timestamp_column(df, date, C.parse_timestamp)
    return (
        df.filter(F.col(f"`{location}`").isNotNull())
        .withColumn("_when", when)
        .filter(C.since("_when", since, inclusive))
        .withColumns({"lon": lon, "lat": lat, P.YEAR: F.year("_when")})
    )


def prepare_fires(
    raw: DataFrame,
    since: str = SINCE,
    classes: Mapping[str, Sequence[str]] = C.FIRE_CLASSES,
    anchored: bool = False,
) -> DataFrame:
    """Located fires of the given classes; one row may carry several class flags."""
    situation = F.col("`Primary Situation`")
    every = [code for codes in classes.values() for code in codes]
    wanted = raw.filter(C.matches_any(situation, every, anchored))
    flags = C.class_flags(situation, classes, anchored)
    return _points(wanted, "Location", "Incident Date", since, True).select(
        "lon", "lat", P.YEAR, *[f.alias(n) for n, f in flags.items()]
    )


def prepare_violations(raw: DataFrame, since: str = SINCE) -> DataFrame:
    return _points(raw, "Location", "Violation Date", since, False).select(
        "lon", "lat", P.YEAR, F.lit(1).alias("Nviolations")
    )


def prepare_inspections(raw: DataFrame, since: str = SINCE) -> DataFrame:
    dated = raw.na.drop(subset=["Inspection Start Date", "Inspection End Date"])
    kind = C.equals_flag("`Inspection Type Description`", COMPLAINT)
    return _points(dated, "Location", "Inspection Start Date", since, True).select(
        "lon", "lat", P.YEAR, kind.alias("Was complaint"), F.lit(1).alias("Inspection Number")
    )


def prepare_crimes(
    raw: DataFrame, since: str = SINCE, excluded: Sequence[str] = C.EXCLUDED_CRIMES
) -> DataFrame:
    kept = raw.na.drop(subset=["Date", "Category"]).filter(~C.matches_any("Category", excluded))
    return _points(kept, "Location", "Date", since, False).select(
        "lon", "lat", P.YEAR,
        C.equals_flag("Category", ARSON).alias("CrimeIsArson"),
        C.differs_flag("Category", ARSON).alias("CrimeIsOther"),
    )


def measures_of(points: DataFrame) -> list[str]:
    return [c for c in points.columns if c not in ("lon", "lat", P.YEAR)]


def per_block_year(points: DataFrame, cover: PolygonCover) -> DataFrame:
    """Sums of the measures per block and year that has events."""
    return A.sum_per(cover.locate(points), [cover.key, P.YEAR], measures_of(points))


def fires_per_block_year(points: DataFrame, blocks: DataFrame, cover: PolygonCover) -> DataFrame:
    """Dense over all blocks and the years with any fire, zeros filled."""
    counts = stored(per_block_year(points, cover), "block-years")  # for the years and for the counts
    spine = P.observed_year_spine(blocks.select(cover.key), counts)
    return P.left_fill(spine, counts, [cover.key, P.YEAR])


def fires_with_target(fires: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Fires of a block-year beside those of the year after, where that year is present."""
    return P.pair_with_next_year(fires, names).na.drop(subset=list(names))


def per_block(
    points: DataFrame,
    blocks: DataFrame,
    cover: PolygonCover,
    year_to_predict: int | None = None,
    holdout: bool = False,
) -> DataFrame:
    """Sums per block, every block present.

    With a year to predict, sums run over the years before it, and ``holdout``
    adds those of the year itself; without one, over all years.
    """
    measures = measures_of(points)
    located = cover.locate(points)
    if year_to_predict is None:
        sums = A.sum_per(located, [cover.key], measures)
    elif holdout:
        sums = A.train_holdout(
            located, [cover.key], P.YEAR, year_to_predict, {m: F.col(m) for m in measures}
        )
    else:
        sums = A.sum_per(located.filter(F.col(P.YEAR) < year_to_predict), [cover.key], measures)
    return P.left_fill(blocks.select(cover.key), sums, [cover.key])


def stack(sources: Sequence[DataFrame]) -> DataFrame:
    """Several prepared sources as one point table, foreign measures reading 0.

    Locating and aggregating the stack costs one spatial join and one shuffle
    instead of one per source.
    """
    names = [m for s in sources for m in measures_of(s)]
    stacked = None
    for s in sources:
        aligned = s.select(
            "lon", "lat", P.YEAR,
            *[(F.col(m) if m in s.columns else F.lit(0)).cast("int").alias(m) for m in names],
        )
        stacked = aligned if stacked is None else stacked.unionByName(aligned)
    return stacked
