"""The model queries run over the grids, sizes and folds of the operators themselves."""

import inspect
import threading

import pytest

from blockrisk.ml import pipelines as ML
from blockrisk.ml import tune
from blockrisk.workload import models
from blockrisk.workload.registry import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


class Stopped(Exception):
    pass


def test_learning_curve_has_all_sizes_and_folds(spark, monkeypatch):
    whole = inspect.signature(tune.learning_curve)

    def curve(*args, **settings):
        asked = whole.bind(*args, **settings)
        asked.apply_defaults()
        assert asked.arguments["fractions"] == whole.parameters["fractions"].default and len(asked.arguments["fractions"]) == 10
        assert asked.arguments["folds"] == 5
        raise Stopped

    monkeypatch.setattr(tune, "learning_curve", curve)
    with pytest.raises(Stopped):
        QUERIES["learning_curve"](spark, FOLDER)


def test_grid_search_takes_every_grid_over_five_folds(spark, monkeypatch):
    sizes = []

    def search(pipeline, grid, train, key, folds=5, parallelism=1):
        sizes.append((len(grid), folds))
        names = [(", ".join(sorted(f"{p.name}={v}" for p, v in g.items())), 0.5, 0.0) for g in grid]
        return None, spark.createDataFrame(names, "parameters string, mean_auc double, std_auc double")

    monkeypatch.setattr(tune, "grid_search", search)
    got = QUERIES["grid_search_results"](spark, FOLDER)
    assert sizes == [(27, 5), (12, 5), (54, 5)]
    assert got.select("parameters").distinct().count() == 93


def test_grid_searches_run_at_the_same_time(spark, monkeypatch):
    """Each waits for the other two, which one after the other never come."""
    met = threading.Barrier(3, timeout=30)

    def search(pipeline, grid, train, key, folds=5, parallelism=1):
        met.wait()
        return None, spark.createDataFrame([(str(len(grid)), 0.5, 0.0)], "parameters string, mean_auc double, std_auc double")

    monkeypatch.setattr(tune, "grid_search", search)
    got = QUERIES["grid_search_results"](spark, FOLDER)
    assert [r["parameters"] for r in got.collect()] == ["27", "12", "54"]


@pytest.mark.parametrize("name, maker, grid", [
    ("rf_scores", "forest_pipeline", ML.FINAL_FOREST_GRID), ("selected_features", "forest_pipeline", ML.FINAL_FOREST_GRID),
    ("feature_importances", "forest_pipeline", ML.FINAL_FOREST_GRID), ("holdout_auc", "forest_pipeline", ML.FINAL_FOREST_GRID),
    ("gbt_scores", "boosted_pipeline", ML.BOOSTED_GRID), ("holdout_auc", "boosted_pipeline", ML.BOOSTED_GRID),
])
def test_models_are_as_large_as_the_grids_ask(spark, monkeypatch, name, maker, grid):
    def stop(features, **settings):
        assert {k: v for k, v in settings.items() if k in grid and v in grid[k]}.keys() == grid.keys() - {"stepSize"}
        raise Stopped

    monkeypatch.setattr(models.ML, maker, stop)
    with pytest.raises(Stopped):
        QUERIES[name](spark, FOLDER)


def test_risk_pipeline_takes_all_blocks(spark, monkeypatch):
    """Neither the table of the query nor that of its SQL is cut to the city."""
    whole = inspect.signature(models.features.yearly_feature_table)

    def table(*args, **settings):
        asked = whole.bind(*args, **settings)
        asked.apply_defaults()
        assert asked.arguments["box"] is None
        raise Stopped

    monkeypatch.setattr(models.features, "yearly_feature_table", table)
    with pytest.raises(Stopped):
        QUERIES["risk_pipeline"](spark, FOLDER)
    assert "INTPTLON10\" AS DOUBLE" not in ORACLES["risk_pipeline"]


def test_rows_to_fit_on_are_dealt_over_the_cores(spark, tmp_path):
    people = spark.range(2000).selectExpr("id AS c_custkey", "double(id % 90) AS c_acctbal", "int(id % 25) AS c_nationkey")
    people.write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(500).selectExpr(
        "id AS o_orderkey", "id * 3 AS o_custkey", "date'1996-03-01' + int(id % 900) AS o_orderdate",
        "'1-URGENT' AS o_orderpriority", "'F' AS o_orderstatus", "double(id) AS o_totalprice",
    ).write.parquet(f"{tmp_path}/orders.parquet")
    sizes = models.model_rows(spark, str(tmp_path)).rdd.glom().map(len).collect()
    assert sum(sizes) == 12_000 and len(sizes) > 1 and max(sizes) < 8_000


@pytest.mark.parametrize("name", ["centroid", "centroid_multipart"])
def test_centroids_are_made_by_many_tasks(spark, tmp_path, name):
    parts = spark.range(3000, numPartitions=1).selectExpr("id AS p_partkey", "'x' AS p_type", "int(id % 50) AS p_size")
    parts.write.parquet(f"{tmp_path}/part.parquet")
    sizes = QUERIES[name](spark, str(tmp_path)).rdd.glom().map(len).collect()
    assert sum(sizes) == 3000 and max(sizes) < 1500
