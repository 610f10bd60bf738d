"""Global order without a global window.

A window with no partition, or one partitioned by a two-valued label, runs in one task. Here the
rows are dealt into ranges of their keys; each range is a window partition of its own, and the
range totals, one row per range, carry the sums over.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blockrisk.session import stored

#: Ranges are as many as shuffle partitions, or more where one would get more rows than this.
ROWS_PER_RANGE = 1 << 20


def _range_count(df: DataFrame) -> int:
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(partitions, -(-df.count() // ROWS_PER_RANGE))


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    values: Mapping[str, Column],
    ranges: int | None = None,
) -> DataFrame:
    """Adds ``<name>_before`` (sum over smaller keys) and ``<name>_total``.

    ``keys`` must identify rows: aggregate per key first, which also collapses a
    key shared by a large part of the input. The rows are stored twice: as given,
    to count and sample them for the cuts, and under their range, so that totals
    and sums read one and the same dealing.
    """
    keys = list(keys)
    given = stored(df.withColumns({f"_v_{name}": c for name, c in values.items()}), "ranked")
    ranges = ranges or _range_count(given)
    dealt = given.repartitionByRange(ranges, *keys).withColumn("_range", F.spark_partition_id())
    ranged = stored(dealt, "ranges")
    sums = ranged.groupBy("_range").agg(*[F.sum(f"_v_{n}").alias(f"_s_{n}") for n in values])
    # Windows over one row per range.
    smaller = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        "_range",
        *[F.coalesce(F.sum(f"_s_{n}").over(smaller), F.col(f"_s_{n}") * 0).alias(f"_o_{n}") for n in values],
        *[F.sum(f"_s_{n}").over(Window.partitionBy()).alias(f"{n}_total") for n in values],
    )
    # Dealt by range of the range's number: no two ranges meet in one task while another has none.
    joined = ranged.join(offsets, "_range").repartitionByRange(ranges, "_range")
    window = Window.partitionBy("_range").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    return joined.select(
        *[F.col(f"`{c}`") for c in df.columns],
        *[(F.col(f"_o_{n}") + F.coalesce(F.sum(f"_v_{n}").over(window), F.col(f"_o_{n}") * 0)).alias(f"{n}_before") for n in values],
        *[f"{n}_total" for n in values],
    )


def row_numbers(df: DataFrame, keys: Sequence[str], name: str = "row_number") -> DataFrame:
    """1-based position in key order over the whole table; keys identify rows."""
    ranked = running_totals(df, keys, {"_row": F.lit(1).cast("long")})
    return ranked.withColumn(name, F.col("_row_before") + 1).drop("_row_before", "_row_total")


#: Error of the sketch that brackets a quantile: one row in so many.
SKETCH = 10_000
#: A bracket of no more rows than this is read in full; a larger one is narrowed again.
BRACKET_ROWS = 50_000


def quantiles(df: DataFrame, column: str, probabilities: Mapping[str, float], sketch: int = SKETCH, most: int = BRACKET_ROWS) -> DataFrame:
    """One row of exact quantiles with linear interpolation; nulls and NaN are left out.

    A mergeable sketch, one small state per task, brackets the rank asked for; rows below and inside
    the bracket are counted, and what is inside is bracketed again until few rows are left, whose
    values are read. Each step is a map-side aggregate behind a range filter that reaches the scan: no row is
    sorted, stored or sent.
    """
    present = df.select(F.col(column).cast("double").alias("_value")).filter("_value is not null and not isnan(_value)")
    names, schema = list(probabilities), ", ".join(f"`{name}` double" for name in probabilities)
    # one row about the whole column
    n, low, high = present.agg(F.count(F.lit(1)), F.min("_value"), F.max("_value")).first()
    found: dict[float, float] = {}
    for q in {float(q) for q in probabilities.values()} if n else ():
        position = (n - 1) * q
        rank = math.floor(position)
        values = _values_from(present, n, rank, low, high, sketch, most)
        found[q] = values[0] if position == rank else values[0] + (values[1] - values[0]) * (position - rank)
    return df.sparkSession.createDataFrame([tuple(found.get(float(probabilities[name])) for name in names)], schema)


def _values_from(present: DataFrame, n: int, rank: int, low: float, high: float, sketch: int, most: int) -> list[float | None]:
    """The values at ``rank``, from 0, and at the rank after it, of ``n`` rows within [low, high]."""
    value, below, inside = F.col("_value"), 0, n
    while inside > most and low < high:
        # the sketch may be off by a row in ``sketch`` to either side; twice that is asked for
        shares = [min(1.0, max(0.0, (rank - below) / inside + d)) for d in (-2.0 / sketch, 2.0 / sketch)]
        near, far = present.filter(value.between(low, high)).agg(F.percentile_approx("_value", shares, sketch)).first()[0]
        if (near, far) == (low, high):  # too few distinct values for the sketch to part: halved by size
            far = low + (high - low) / 2
            if not low <= far < high:
                break
        less, between, under, over = present.agg(
            F.count_if(value < near), F.count_if(value.between(near, far)), F.max(F.when(value < near, value)), F.min(F.when(value > far, value)),
        ).first()
        if rank < less:
            high, inside = under, less - below
        elif rank < less + between:
            low, high, below, inside = near, far, less, between
        else:
            low, below, inside = over, less + between, below + inside - less - between
    counts = present.filter(value.between(low, high)).groupBy("_value").agg(F.count(F.lit(1)).alias("n")).orderBy("_value").collect()
    found: list[float | None] = []
    for wanted in (rank, rank + 1):
        upto = below
        for row in counts:
            upto += row["n"]
            if upto > wanted:
                found.append(row["_value"])
                break
    if len(found) < 2:  # the next value lies beyond the bracket, if there is one
        found.append(present.filter(value > high).agg(F.min("_value")).first()[0])
    return found


def below_quantile(df: DataFrame, column: str, probability: float) -> DataFrame:
    """Rows strictly below the quantile of their own column.

    The quantile, one number, is computed first: as a literal it reaches the scan,
    and a chain of such filters does not nest one plan inside the next.
    """
    limit = quantiles(df, column, {"q": probability}).first()["q"]
    return df.filter(F.col(column) < F.lit(limit))


def top_k(df: DataFrame, by: str, n: int, *tie_break: str) -> DataFrame:
    """The n largest, ties settled by the given columns."""
    return df.orderBy(F.col(by).desc(), *[F.col(t).asc() for t in tie_break]).limit(n)


def marginal_row(df: DataFrame, by: str, n: int, tie_break: str) -> DataFrame:
    """Last row of the top n: the least risky one still selected."""
    return top_k(df, by, n, tie_break).orderBy(F.col(by).asc(), F.col(tie_break).desc()).limit(1)


def nth_largest_threshold(df: DataFrame, by: str, n: int, name: str = "threshold") -> DataFrame:
    """The (n+1)-th largest value as one row; null when there are no more than n rows."""
    largest = df.select(by).filter(F.col(by).isNotNull()).orderBy(F.col(by).desc()).limit(n + 1)
    return largest.agg(
        F.when(F.count(F.lit(1)) == n + 1, F.min(by)).alias(name)
    )


def flag_above_threshold(df: DataFrame, by: str, n: int, name: str = "highrisk") -> DataFrame:
    """1 strictly above the (n+1)-th largest value; everything when rows are no more than n."""
    limit = nth_largest_threshold(df, by, n).scalar()
    flagged = df.withColumn("_limit", limit)
    return flagged.withColumn(
        name,
        F.when(F.col(by).isNull(), 0)
        .when(F.col("_limit").isNull(), 1)
        .otherwise((F.col(by) > F.col("_limit")).cast("int")),
    ).drop("_limit")


def histogram(
    df: DataFrame, column: str, bins: int = 100, by: Sequence[str] = ()
) -> DataFrame:
    """Equal-width bins over [min, max] of the whole column, the last one closed.

    With ``by`` the groups share the edges. Bins without rows are kept with 0.
    """
    by = list(by)
    present = df.select(*by, F.col(column).cast("double").alias("_x")).filter(
        F.col("_x").isNotNull()
    )
    edges = present.agg(
        F.struct(F.min("_x").alias("low"), F.max("_x").alias("high")).alias("_e")
    ).scalar()
    width = (F.col("_e.high") - F.col("_e.low")) / bins
    placed = present.withColumn("_e", edges).withColumn(
        "bin",
        F.when(width == 0, 0).otherwise(
            F.least(F.floor((F.col("_x") - F.col("_e.low")) / width), F.lit(bins - 1))
        ).cast("int"),
    )
    counts = placed.groupBy(*by, "bin").agg(
        F.count(F.lit(1)).alias("n"), F.first("_e").alias("_e")
    )
    groups = counts.groupBy(*by).agg(F.first("_e").alias("_e"))
    spine = groups.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    filled = spine.join(counts.drop("_e"), [*by, "bin"], "left")
    return filled.select(
        *by,
        "bin",
        (F.col("_e.low") + F.col("bin") * width).alias("low"),
        F.when(F.col("bin") == bins - 1, F.col("_e.high"))
        .otherwise(F.col("_e.low") + (F.col("bin") + 1) * width).alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )
