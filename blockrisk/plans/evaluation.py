"""Curves and metrics of scored, labelled rows.

Curves start from one row per distinct score, so a score shared by many rows
costs one row, and order comes from range-wise running totals.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blockrisk.operators.ranking import histogram, running_totals


def _by_score(df: DataFrame, score: str, label: str) -> DataFrame:
    # A row without a score is in no curve; as a null it would rank below all others.
    counts = df.filter(F.col(score).isNotNull()).groupBy(F.col(score).alias("threshold")).agg(
        F.sum(F.col(label).cast("long")).alias("pos"),
        F.sum(1 - F.col(label).cast("long")).alias("neg"),
    )
    ranked = running_totals(counts, ["threshold"], {"p": F.col("pos"), "n": F.col("neg")})
    return ranked.select(
        "threshold", "pos", "neg",
        (F.col("p_total") - F.col("p_before")).alias("tp"),
        (F.col("n_total") - F.col("n_before")).alias("fp"),
        F.col("p_total").alias("positives"),
        F.col("n_total").alias("negatives"),
    )


def _roc_points(ranked: DataFrame, df: DataFrame, score: str) -> DataFrame:
    points = ranked.select(
        "threshold",
        F.try_divide("fp", "negatives").alias("fpr"),
        F.try_divide("tp", "positives").alias("tpr"),
    )
    start = df.agg((F.max(score) + 1).alias("threshold")).select(
        "threshold", F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return points.unionByName(start)


def _area(ranked: DataFrame) -> DataFrame:
    above = F.col("tp") - F.col("pos")
    pairs = F.sum(F.col("neg") * (above + F.col("pos") / 2))
    return ranked.agg(
        F.try_divide(pairs, F.max("positives").cast("double") * F.max("negatives")).alias("auc")
    )


def roc_curve(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """(threshold, fpr, tpr) per distinct score, and the start at (0, 0)."""
    return _roc_points(_by_score(df, score, label), df, score)


def roc_auc(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Area under the ROC curve as one row; ties count half."""
    return _area(_by_score(df, score, label))


def precision_recall_curve(
    df: DataFrame, score: str = "score", label: str = "label"
) -> DataFrame:
    """(threshold, precision, recall) down to the score that first reaches full recall.

    The end point (1, 0) has no threshold; the lowest threshold gives the base rate.
    """
    points = _by_score(df, score, label).filter(
        (F.col("tp") < F.col("positives")) | (F.col("pos") > 0)
    ).select(
        "threshold",
        F.try_divide("tp", F.col("tp") + F.col("fp")).alias("precision"),
        F.try_divide("tp", "positives").alias("recall"),
    )
    end = df.sparkSession.range(1).select(
        F.lit(None).cast(points.schema["threshold"].dataType).alias("threshold"),
        F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"),
    )
    return points.unionByName(end)


def threshold_metrics(
    df: DataFrame, score: str = "score", label: str = "label", threshold: float = 0.5
) -> DataFrame:
    """Recall, precision and F1 of the class predicted above the threshold."""
    hit, true = F.col(score) > threshold, F.col(label) == 1
    counts = df.agg(
        F.count_if(hit & true).alias("tp"),
        F.count_if(hit & ~true).alias("fp"),
        F.count_if(~hit & true).alias("fn"),
    )

    def ratio(top, bottom):
        return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))

    return counts.select(
        ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
        ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"),
    )


def compare_models(scored: Mapping[str, DataFrame], score: str = "score", label: str = "label") -> DataFrame:
    """ROC curves and areas of several models in one table; each model's scores are ranked once."""
    result = None
    for name, df in scored.items():
        ranked = _by_score(df, score, label)
        curve = _roc_points(ranked, df, score).select(F.lit(name).alias("model"), "*").withColumn(
            "auc", _area(ranked).scalar()
        )
        result = curve if result is None else result.unionByName(curve)
    return result


def compare_distributions(
    df: DataFrame, score: str, by: list[str], bins: int = 100
) -> DataFrame:
    """Score histograms of several years or fire types on shared edges."""
    return histogram(df, score, bins, by)
