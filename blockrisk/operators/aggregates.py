"""Grouped counts, shares, profiles and the null policy."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def keyed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with every key present; a null key belongs to no group."""
    return df.na.drop(subset=list(keys))


def count_per(df: DataFrame, keys: Sequence[str], name: str, column: str | None = None) -> DataFrame:
    counted = F.count(F.lit(1) if column is None else F.col(column))
    return keyed(df, keys).groupBy(*keys).agg(counted.alias(name))


def sum_per(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return keyed(df, keys).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in columns])


def mean_per(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    return keyed(df, keys).groupBy(*keys).agg(*[F.avg(c).alias(c) for c in columns])


def share_columns(
    code: str, values: Sequence[str], merged: Mapping[str, Sequence[str]] | None = None
) -> list[Column]:
    """Aggregates giving each code's share of a group's coded rows, in one pass.

    ``merged`` maps a result name to the codes summed under it; those codes get no
    column of their own.
    """
    merged = dict(merged or {})
    taken = {v for codes in merged.values() for v in codes}
    groups = {v: [v] for v in values if v not in taken} | merged

    def share(name: str, codes: Sequence[str]) -> Column:
        listed = ", ".join("'" + c.replace("\\", "\\\\").replace("'", "\\'") + "'" for c in codes)
        return F.expr(f"try_divide(double(count_if(`{code}` IN ({listed}))), count(`{code}`)) AS `{name}`")

    return [share(name, codes) for name, codes in groups.items()]


def pivot_shares(
    df: DataFrame,
    keys: Sequence[str],
    code: str,
    values: Sequence[str],
    merged: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Share of each code per group; rows without a code do not count."""
    coded = keyed(df, [*keys, code])
    return coded.groupBy(*keys).agg(*share_columns(code, values, merged))


def spread_stats(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Min, max, sample deviation and count; a single row has a null deviation."""
    c = F.col(column)
    return keyed(df, keys).groupBy(*keys).agg(
        F.min(c).alias("min"), F.max(c).alias("max"),
        F.stddev_samp(c).alias("sd"), F.count(c).alias("n"),
    )


def train_holdout(
    df: DataFrame, keys: Sequence[str], year: str, predict: int, measures: Mapping[str, Column]
) -> DataFrame:
    """Sums before the year to predict and in it, side by side, in one pass."""
    before, during = F.col(year) < predict, F.col(year) == predict
    return keyed(df, keys).groupBy(*keys).agg(
        *[F.sum(F.when(before, m).otherwise(0)).alias(f"{n}_train") for n, m in measures.items()],
        *[F.sum(F.when(during, m).otherwise(0)).alias(f"{n}_holdout") for n, m in measures.items()],
    )


def null_profile(df: DataFrame) -> DataFrame:
    """Null count of every column, one row."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def count_profile(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Non-null count of every other column per group."""
    others = [c for c in df.columns if c not in keys]
    return keyed(df, keys).groupBy(*keys).agg(*[F.count(c).alias(c) for c in others])


def yearly_sums(df: DataFrame, year: str, columns: Sequence[str], cut_last: bool = True) -> DataFrame:
    """Sum per year, without the last year, which is not complete."""
    sums = sum_per(df, [year], columns)
    if not cut_last:
        return sums
    return sums.filter(F.col(year) < df.agg(F.max(year).alias("_last")).scalar())


def mean_of_yearly_sums(df: DataFrame, year: str, columns: Sequence[str]) -> DataFrame:
    return yearly_sums(df, year, columns).agg(*[F.avg(c).alias(c) for c in columns])


def describe_yearly(df: DataFrame, year: str, columns: Sequence[str]) -> DataFrame:
    """Count, mean, deviation and quartiles of the yearly sums, one row per column.

    Percentiles see one row per year, so the built-in aggregate is enough.
    """
    long = yearly_sums(df, year, columns).select(
        F.inline(
            F.array(*[
                F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v"))
                for c in columns
            ])
        )
    )
    return long.groupBy("column").agg(
        F.count("v").alias("count"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
        F.min("v").alias("min"),
        F.percentile("v", F.lit(0.25)).alias("q25"),
        F.percentile("v", F.lit(0.5)).alias("q50"),
        F.percentile("v", F.lit(0.75)).alias("q75"),
        F.max("v").alias("max"),
    )


def column_profile(df: DataFrame) -> DataFrame:
    """place, name, type and number of values of every column, by one aggregate over the table."""
    fields = df.schema.fields
    counted = [F.struct(
        F.lit(k).alias("place"), F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type"), F.count(F.col(f"`{f.name}`")).alias("non_null"),
    ) for k, f in enumerate(fields)]
    return df.agg(F.array(*counted).alias("_columns")).select(F.inline("_columns"))


def numeric_columns(df: DataFrame, without: Sequence[str] = ()) -> list[str]:
    return [
        f.name for f in df.schema.fields
        if isinstance(f.dataType, T.NumericType) and f.name not in without
    ]


def fill_nulls(
    df: DataFrame,
    constants: Mapping[str, float],
    keep: Sequence[str] = (),
    fit_on: Column | None = None,
) -> DataFrame:
    """Constants for the named columns, then the column mean for every other number.

    Means come from the rows of ``fit_on``, as a one-row subquery; without it from the
    training rows where there is a ``split`` column, else from all rows. Columns in ``keep``, such as targets, are left alone.
    """
    filled = df.na.fill({c: v for c, v in constants.items() if c in df.columns})
    averaged = [c for c in numeric_columns(df, without=keep) if c not in constants]
    if not averaged:
        return filled
    if fit_on is None and "split" in df.columns:
        fit_on = F.col("split") == "train"
    base = filled if fit_on is None else filled.filter(fit_on)
    means = base.agg(F.struct(*[F.avg(c).alias(c) for c in averaged]).alias("_m")).scalar()
    return filled.withColumn("_means", means).select(
        *[
            F.coalesce(F.col(c).cast("double"), F.col("_means")[c]).alias(c)
            if c in averaged else F.col(c)
            for c in df.columns
        ]
    )
