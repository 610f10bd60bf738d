"""Splits by year, by hash and into stratified folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockrisk.functions import fields as C
from blockrisk.operators import aggregates as A
from blockrisk.operators.ranking import running_totals

TARGETS = ["SF_pred", "VF_pred", "EF_pred"]


def year_split(
    df: DataFrame, target: str, holdout_year: int, year: str = "Year"
) -> DataFrame:
    """``split`` (train, holdout, future) and the 0/1 ``label`` beside every row.

    ``holdout_year`` itself is scored for the future, the year before is held out
    and all earlier years train. Later years belong to none and drop out.
    """
    y = F.col(year)
    split = (
        F.when(y == holdout_year, "future")
        .when(y == holdout_year - 1, "holdout")
        .when(y < holdout_year - 1, "train")
    )
    return df.withColumn("split", split).filter(F.col("split").isNotNull()).withColumn(
        "label", C.at_least_one(target)
    )


def feature_names(df: DataFrame, without: Sequence[str] = ()) -> list[str]:
    """Numeric columns that are neither targets, label nor named here."""
    return A.numeric_columns(df, without=[*TARGETS, "label", "fold", "weight", "even", *without])


def hash_split(df: DataFrame, key: str, test_share: float = 0.3) -> DataFrame:
    """``is_test`` from the key's digest: the same rows on every run and every layout."""
    limit = format(int(test_share * 16**8), "08x")
    digest = F.left(F.md5(F.col(key).cast("string")), F.lit(8))
    return df.withColumn("is_test", (digest < limit).cast("int"))


def random_split(df: DataFrame, test_share: float = 0.3, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    train, test = df.randomSplit([1 - test_share, test_share], seed)
    return train, test


def stratified_folds(
    df: DataFrame, key: str, label: str = "label", folds: int = 5, name: str = "fold"
) -> DataFrame:
    """Consecutive blocks of each label in key order, the first ones a row longer.

    Row numbers within a label come from one running total over (label, key), so
    a label with most of the rows is still spread over many tasks.
    """
    ranked = running_totals(
        df.withColumn(label, F.col(label).cast("int")), [label, key],
        {"_row": F.lit(1).cast("long")},
    )
    # One row per label value.
    sizes = df.groupBy(F.col(label).cast("int").alias(label)).agg(F.count(F.lit(1)).alias("_size"))
    starts = sizes.agg(F.collect_list(F.struct(label, "_size")).alias("_sizes")).scalar()
    placed = ranked.withColumn("_sizes", starts).withColumn(
        "_size", F.filter("_sizes", lambda s: s[label] == F.col(label))[0]["_size"]
    ).withColumn(
        "_first",
        F.aggregate(
            F.filter("_sizes", lambda s: s[label] < F.col(label)),
            F.lit(0).cast("long"), lambda acc, s: acc + s["_size"],
        ),
    )
    row = F.col("_row_before") - F.col("_first")
    base, extra = F.floor(F.col("_size") / folds), F.col("_size") % folds
    long_rows = extra * (base + 1)
    fold = F.when(row < long_rows, F.floor(row / (base + 1))).otherwise(
        extra + F.floor(F.try_divide(row - long_rows, base))
    )
    return placed.select(*df.columns, fold.cast("int").alias(name))


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weight per label: rows / (labels * rows of the label)."""
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    whole = sizes.agg(F.struct(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k")).alias("t")).scalar()
    return sizes.withColumn("_t", whole).select(
        label, "n", (F.col("_t.n") / (F.col("_t.k") * F.col("n"))).alias("weight")
    )


def with_class_weights(df: DataFrame, label: str = "label", name: str = "weight") -> DataFrame:
    """The balanced weight beside every row, and an ``even`` one; the table joined has a row per label."""
    weights = class_weights(df, label).select(label, F.col("weight").alias(name))
    return df.join(F.broadcast(weights), label, "left").withColumn("even", F.lit(1.0))
