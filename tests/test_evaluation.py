import random

import pytest
from pyspark.sql import functions as F

from blockrisk.plans import evaluation, risk
from tests.conftest import rows
from tests.test_spatial import SHAPES, points, polygons


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(5)
    data = [(f"k{i}", round(rng.random(), 2), int(rng.random() < 0.3)) for i in range(600)]
    return spark.createDataFrame(data, "GISJOIN string, score double, label int")


def rank_auc(data):
    pos = [s for s, y in data if y == 1]
    neg = [s for s, y in data if y == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_area_by_rank_sum_and_by_curve(spark, scored):
    data = [(r["score"], r["label"]) for r in scored.collect()]
    area = evaluation.roc_auc(scored).first()[0]
    assert area == pytest.approx(rank_auc(data))
    curve = sorted((r["fpr"], r["tpr"]) for r in evaluation.roc_curve(scored).collect())
    trapezoid = sum((x2 - x1) * (y1 + y2) / 2 for (x1, y1), (x2, y2) in zip(curve, curve[1:]))
    assert trapezoid == pytest.approx(area)
    assert curve[0] == (0, 0) and curve[-1] == (1, 1)


def test_precision_recall_ends(spark):
    df = spark.createDataFrame([(0.9, 1), (0.8, 0), (0.7, 1), (0.1, 0)], "score double, label int")
    got = rows(evaluation.precision_recall_curve(df), "threshold", "precision", "recall")
    assert got == [(None, 1.0, 0.0), (0.7, pytest.approx(2 / 3), 1.0), (0.8, 0.5, 0.5), (0.9, 1.0, 0.5)]


def test_metrics(spark):
    df = spark.createDataFrame([(0.9, 1), (0.6, 0), (0.5, 1), (0.1, 0)], "score double, label int")
    assert tuple(evaluation.threshold_metrics(df).first()) == (0.5, 0.5, 0.5)
    none = spark.createDataFrame([(0.1, 0)], "score double, label int")
    assert tuple(evaluation.threshold_metrics(none).first()) == (0.0, 0.0, 0.0)


def test_compare_models(spark, scored):
    both = evaluation.compare_models({"a": scored, "b": scored.withColumn("score", 1 - F.col("score"))})
    areas = {r["model"]: r["auc"] for r in both.select("model", "auc").distinct().collect()}
    assert areas["a"] + areas["b"] == pytest.approx(1.0)


def test_rates_at_n(spark):
    df = spark.createDataFrame(
        [("a", 9.0, 0, 3), ("b", 8.0, 5, 0), ("c", 1.0, 4, 1), ("d", 0.5, 0, 0)],
        "GISJOIN string, score double, previous int, target int",
    )
    assert tuple(risk.hit_rate_at_n(df, 2, "target", "previous").first()) == (0.5, 0.5, 0.5)
    assert tuple(risk.capture_rate_at_n(df, 2, "target", "previous").first()) == (0.75, 0.25, 0.5)


def test_risk_map_and_locations(spark):
    blocks = polygons(spark, SHAPES)
    scores = spark.createDataFrame([("square", 9.0), ("ell", 5.0), ("holed", 5.0), ("gone", 1.0)], "GISJOIN string, score double")
    table = risk.risk_map(scores, blocks, 1)
    assert rows(table, "GISJOIN", "highrisk") == [("ell", 0), ("holed", 0), ("square", 1)]
    sites = points(spark, [(1, 1), (0, 0), (2, 6), (50, 50), (5, 3)])
    got = rows(risk.risk_at_locations(sites, table, "id", box=(-1, 10, -1, 10)), "id", "score", "highrisk")
    assert got == [(0, 9.0, 1), (1, None, None), (2, None, None), (4, 5.0, 0)]
    assert rows(risk.with_block_id(table), "GISJOIN", "BLOCKID") == [("ell", 0), ("holed", 1), ("square", 2)]


def test_model_choice():
    assert risk.model_for("external", 2017) == ("external_2017", 2017)
    assert risk.model_for("vehicle", 2019) == ("vehicle_2018", 2019)
    with pytest.raises(ValueError):
        risk.model_for("forest", 2018)


def test_overlay(spark):
    fires = spark.createDataFrame(
        [(1.0, 2.0, 2018, 1, 0, 1), (3.0, 4.0, 2017, 0, 0, 1)],
        "lon double, lat double, Year int, Structure_fire int, Vehicle_fire int, External_fire int",
    )
    assert rows(risk.fire_overlay(fires, "external", 2018)) == [(2.0, 1.0)]
    assert risk.fire_points(fires).columns == ["Year", "Lat", "Lon", "EF", "SF", "VF"]
