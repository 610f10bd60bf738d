"""Block-by-year panels: spines, keyed merges, next-year targets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK, YEAR = "GISJOIN", "Year"


def year_spine(blocks: DataFrame, first: int, last: int, year: str = YEAR) -> DataFrame:
    """One row per block and calendar year."""
    return blocks.withColumn(year, F.explode(F.sequence(F.lit(first), F.lit(last))))


def observed_year_spine(blocks: DataFrame, events: DataFrame, year: str = YEAR) -> DataFrame:
    """One row per block and year that occurs among the events; calendar years are few."""
    years = events.agg(F.array_sort(F.collect_set(F.col(year).cast("int"))).alias("_y")).scalar()
    return blocks.withColumn("_years", years).withColumn(year, F.explode("_years")).drop("_years")


def left_fill(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    fill: Sequence[str] | None = None,
) -> DataFrame:
    """Left join whose misses read 0 in the right side's columns, or in those named."""
    on = list(on)
    columns = [c for c in right.columns if c not in on] if fill is None else list(fill)
    return left.join(right, on, "left").na.fill(0, columns)


def outer_merge(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    return left.join(right, list(on), "outer")


def inner_merge(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    return left.join(right, list(on), "inner")


def natural_join(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    """Join on every column name the two sides share."""
    shared = [c for c in left.columns if c in right.columns]
    if not shared:
        raise ValueError("no shared columns")
    return left.join(right, shared, how)


def join_renamed(
    left: DataFrame, right: DataFrame, left_on: str, right_on: str, how: str = "left"
) -> DataFrame:
    """Join keys of different names; the left name stays."""
    return left.join(right.withColumnRenamed(right_on, left_on), left_on, how)


def semi_join(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key is in the list."""
    return df.join(keys.select(on), on, "left_semi")


def shift_to_target(
    counts: DataFrame,
    names: Mapping[str, str],
    keys: Sequence[str] = (BLOCK, YEAR),
) -> DataFrame:
    """Counts of a year, keyed by the year before and renamed as targets."""
    block, year = keys
    return counts.select(
        block, (F.col(year) - 1).alias(year), *[F.col(c).alias(t) for c, t in names.items()]
    )


def pair_with_next_year(
    counts: DataFrame,
    names: Mapping[str, str],
    keys: Sequence[str] = (BLOCK, YEAR),
) -> DataFrame:
    """Counts of a year and, as targets, those of the year after in one row per key.

    Each row goes out under its own year and the year before, and rows of a key
    are folded: ``counts``, with whatever spatial join is under it, runs once,
    where a self-join would run it twice. Keys present only through the year
    after have null counts.
    """
    block, year = keys
    measures = [c for c in counts.columns if c not in keys]
    kind = {c: counts.schema[c].dataType.simpleString() for c in measures}
    year_kind = counts.schema[year].dataType.simpleString()

    def named(year_text: str, own: bool) -> str:
        fields = [f"'{year}', cast({year_text} AS {year_kind})"]
        for c in measures:
            fields.append(f"'{c}', " + (f"`{c}`" if own else f"cast(null AS {kind[c]})"))
        for c, t in names.items():
            fields.append(f"'{t}', " + (f"cast(null AS {kind[c]})" if own else f"`{c}`"))
        return f"named_struct({', '.join(fields)})"

    rows = f"inline(array({named(f'`{year}`', True)}, {named(f'`{year}` - 1', False)}))"
    folded = [*measures, *names.values()]
    return counts.selectExpr(f"`{block}`", rows).groupBy(block, year).agg(
        *[F.expr(f"max(`{c}`) AS `{c}`") for c in folded]
    )


def join_counts_and_targets(
    spine: DataFrame,
    counts: DataFrame,
    names: Mapping[str, str],
    last_complete_year: int | None = None,
    keys: Sequence[str] = (BLOCK, YEAR),
) -> DataFrame:
    """Counts, zeros filled, and next-year targets beside each row of the spine.

    With ``last_complete_year`` the next year counts as observed up to there: a
    miss then means no event (0), and later years stay null.
    """
    paired = pair_with_next_year(counts, names, keys)
    measures = [c for c in counts.columns if c not in keys]
    joined = left_fill(spine, paired, keys, fill=measures)
    if last_complete_year is None:
        return joined
    known = F.col(keys[1]) + 1 <= last_complete_year
    return joined.withColumns(
        {t: F.when(known, F.coalesce(F.col(t), F.lit(0))) for t in names.values()}
    )


def join_chain(
    spine: DataFrame,
    tables: Sequence[tuple[DataFrame, bool]],
    on: Sequence[str] = (BLOCK, YEAR),
) -> DataFrame:
    """Left joins of per-key tables onto the spine; True marks tables whose misses mean 0."""
    for table, zero in tables:
        spine = left_fill(spine, table, on) if zero else spine.join(table, list(on), "left")
    return spine
