"""Cleaning of raw fields: points, dates, keys, flags and ranges."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

# The open city box (lon low, lon high, lat low, lat high).
CITY_BOX = (-122.53, -122.35, 37.7, 37.84)

# Incident codes per fire class.
FIRE_CLASSES = {
    "Structure_fire": ["111", "112"],
    "Vehicle_fire": ["130", "131", "132", "137", "138"],
    "External_fire": [
        "140", "141", "142", "143", "151", "152", "153", "154", "155", "160",
        "161", "162", "164", "170", "173",
    ],
}

# Crime categories that are not counted.
EXCLUDED_CRIMES = ["NON-CRIMINAL", "SECONDARY CODES", "RECOVERED VEHICLE"]

# Text forms of a date seen in the municipal exports.
DATE_FORMATS = (
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss[.SSS]",
    "yyyy-MM-dd",
    "MM/dd/yyyy hh:mm:ss a",
    "MM/dd/yyyy",
)


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_point(text: Column | str) -> tuple[Column, Column]:
    """``"(lat, lon)"`` to ``(lon, lat)``; text that is no number gives null."""
    first = F.split_part(col(text), F.lit(","), F.lit(1))
    second = F.split_part(col(text), F.lit(","), F.lit(2))
    lat = F.substr(first, F.lit(2)).try_cast("double")
    lon = F.left(second, F.length(second) - 1).try_cast("double")
    return lon, lat


def parse_timestamp(text: Column | str, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """First format that fits; null when none does."""
    return F.coalesce(*[F.try_to_timestamp(col(text), F.lit(f)) for f in formats])


def block_year_key(block: Column | str, year: Column | str) -> Column:
    return F.concat(col(block).cast("string"), col(year).cast("int").cast("string"))


def shift_block_year_key(key: Column | str, years: int = -1) -> Column:
    """Move the four-digit year at the end of the key."""
    k = col(key)
    return F.concat(
        F.left(k, F.length(k) - 4), (F.right(k, F.lit(4)).cast("int") + years).cast("string")
    )


def block_of_key(key: Column | str) -> Column:
    return F.left(col(key), F.length(col(key)) - 4)


def year_of_key(key: Column | str) -> Column:
    return F.right(col(key), F.lit(4)).cast("int")


def representing_year(roll_year: Column | str) -> Column:
    """A roll year describes the calendar year after it."""
    return (col(roll_year).cast("int") + 1).cast("int")


def normalise_address(address: Column | str, city: str = "San Francisco") -> Column:
    a = col(address)
    return F.when(a.contains(city), a).otherwise(F.concat(a, F.lit(" " + city)))


def since(date: Column | str, bound: str, inclusive: bool = True) -> Column:
    limit = F.to_timestamp(F.lit(bound))
    return col(date) >= limit if inclusive else col(date) > limit


def matches_any(text: Column | str, codes: Iterable[str], anchored: bool = False) -> Column:
    """Codes anywhere in the text, as the original rule does, or only at its start."""
    pattern = "|".join(codes)
    return col(text).rlike(f"^(?:{pattern})" if anchored else pattern)


def class_flags(
    text: Column | str, classes: Mapping[str, Sequence[str]], anchored: bool = False
) -> dict[str, Column]:
    """One 0/1 flag per class; a row may carry several."""
    return {name: matches_any(text, codes, anchored).cast("int") for name, codes in classes.items()}


def equals_flag(c: Column | str, value: str) -> Column:
    """1 where equal; null compares as different."""
    return F.coalesce((col(c) == F.lit(value)).cast("int"), F.lit(0))


def differs_flag(c: Column | str, value: str) -> Column:
    return F.lit(1) - equals_flag(c, value)


def in_city_box(
    lon: Column | str, lat: Column | str, box: tuple[float, float, float, float] = CITY_BOX
) -> Column:
    """1 strictly inside the box; values that are no number give 0."""
    x, y = col(lon).try_cast("double"), col(lat).try_cast("double")
    inside = (x > box[0]) & (x < box[1]) & (y > box[2]) & (y < box[3])
    return F.coalesce(inside.cast("int"), F.lit(0))


def keep_up_to(c: Column | str, highest: float) -> Column:
    """Null for values above ``highest``."""
    return F.when(col(c) <= highest, col(c))


def at_least_one(c: Column | str) -> Column:
    """Model label: 1 from one upwards, null counts as 0."""
    return F.when(col(c) >= 1, 1).otherwise(0)


def above_zero(c: Column | str) -> Column:
    return F.when(col(c) > 0, 1).otherwise(0)


def row_sum(columns: Sequence[Column | str]) -> Column:
    """Sum across columns that skips nulls."""
    return reduce(add, [F.coalesce(col(c), F.lit(0)) for c in columns])


def zero_sum_flag(columns: Sequence[Column | str]) -> Column:
    return F.when(row_sum(columns) == 0, 1).otherwise(0)


def one_hot(c: Column | str, values: Sequence[str], prefix: str = "") -> dict[str, Column]:
    """0/1 columns for the sorted values, the first dropped; null gives all zeros."""
    return {f"{prefix}{v}": equals_flag(c, v) for v in sorted(values)[1:]}


def score_of(probability: Column | str) -> Column:
    """Probability to the 0-10 risk scale."""
    return F.lit(10.0) * col(probability)


def display_score(score: Column | str, digits: int = 1) -> Column:
    return F.format_number(col(score), digits)


def before_year(column: str, year: int) -> Column:
    """Dates before a year as one comparison with its first day, which reaches the scan."""
    return F.col(column) < F.to_date(F.lit(f"{year:04d}-01-01"))
