"""Forests and boosted trees grown on cells, beside Spark's own learner."""

import re

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from blockrisk.ml import pipelines as ML
from blockrisk.ml import trees, tune
from blockrisk.plans.evaluation import roc_auc

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def data(spark):
    base = spark.range(30_000, numPartitions=3).selectExpr(
        "string(id) AS key", "double(hash(id) % 97) AS a", "double(hash(id, 1) % 13) AS b", "(hash(id, 2) % 10007) / 100D AS c",
        "cast(hash(id) % 97 + hash(id, 2) % 10007 / 100D + hash(id, 3) % 60 > 0 AS int) AS label",
    ).withColumn("weight", F.when(F.col("label") == 1, 0.93).otherwise(1.11))
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(base).localCheckpoint()


def splits(model):
    return [re.sub(r"Predict: (\S+)", lambda m: f"Predict: {float(m[1]):.9f}", line) for line in model.toDebugString.split("\n")[1:]]


def test_boosted_trees_are_those_of_sparks_own_learner(spark, data):
    """30,000 rows, so that thresholds come from a sample of them."""
    settings = {"maxIter": 4, "maxDepth": 5, "seed": 3, "weightCol": "weight", "minInstancesPerNode": 5, "stepSize": 0.5}
    own, theirs = trees.Boosting(**settings).fit(data), GBTClassifier(**settings).fit(data)
    assert splits(own) == splits(theirs)
    margin = vector_to_array("rawPrediction")[1]
    both = own.transform(data).select("key", margin.alias("x")).join(theirs.transform(data).select("key", margin.alias("y")), "key")
    assert both.filter(F.abs(F.col("x") - F.col("y")) > 1e-9).isEmpty() and both.count() == 30_000


def test_forest_is_as_large_and_as_good_as_sparks_own(spark, data):
    settings = {"numTrees": 20, "maxDepth": 9, "seed": 3, "weightCol": "weight", "minInstancesPerNode": 10}
    own, theirs = trees.Forest(**settings).fit(data), RandomForestClassifier(**settings).fit(data)
    assert own.getNumTrees == 20 and abs(own.totalNumNodes / theirs.totalNumNodes - 1) < 0.15
    areas = [roc_auc(ML.scored(_Fitted(m), data, ["label"])).first()[0] for m in (own, theirs)]
    assert areas[0] > 0.9 and abs(areas[0] - areas[1]) < 0.005
    assert np.abs(own.featureImportances.toArray() - theirs.featureImportances.toArray()).max() < 0.05
    assert all(t.depth <= 9 for t in own.trees)
    roots = {round(t._call_java("rootNode").impurityStats().count()) for t in own.trees}
    assert len(roots) > 10 and all(27_000 < n < 33_000 for n in roots)


class _Fitted:
    def __init__(self, model):
        self.transform = model.transform


def test_jobs_of_a_forest_do_not_grow_with_its_depth(spark, data):
    def jobs(depth):
        group = f"forest-{depth}"
        spark.sparkContext.setJobGroup(group, group)
        model = ML.forest_pipeline(FEATURES, select=False, seed=1, numTrees=4, maxDepth=depth).fit(data.drop("features"))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert max(t.depth for t in model.stages[-1].trees) > depth - 3
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))

    assert jobs(14) <= jobs(4)


def test_trees_are_not_wrapped_one_by_one(spark, data, monkeypatch):
    def stop(self, tree):
        raise AssertionError("a call to the JVM for every parameter of every tree")

    monkeypatch.setattr(trees.DecisionTreeClassificationModel, "__init__", stop)
    model = trees.Forest(numTrees=3, maxDepth=2, seed=1).fit(data)
    assert tune.prefix_scores(model, [1, 3], data).columns[-2:] == ["score_1", "score_3"]


def grown(cells, seed=5):
    rules = trees.Rules(8, 6, 2, 3, 0.0, 0.0, False)
    return [b.to_pylist() for b in trees.forest_rows(cells, [0, 1], seed, 1.0, [np.arange(7.0)] * 3, rules)]


def test_pieces_and_files_give_the_same_trees(monkeypatch):
    rng = np.random.default_rng(2)
    codes = rng.integers(0, 8, (3000, 3)).astype(np.uint8)
    label = codes[:, 0] + rng.integers(0, 6, 3000) > 6
    cells = trees.Cells(codes, label, np.ones(3000), rng.integers(1, 4, 3000))
    whole = grown(cells)
    monkeypatch.setattr(trees, "IN_MEMORY", 1)
    monkeypatch.setattr(trees, "BINS_AT_ONCE", 64)
    monkeypatch.setattr(trees, "CELLS_AT_ONCE", 700)
    batches = trees.pa.RecordBatch.from_pydict({
        "codes": trees.pa.array([c.tobytes() for c in codes], trees.pa.binary()), "label": label, "weight": cells.weight, "count": cells.count,
    })
    read = trees.Cells.read(iter([batches.slice(0, 1000), batches.slice(1000)]), 3)
    assert isinstance(read.codes, np.memmap) and (read.codes == codes).all() and (read.label == label).all()
    assert grown(read) == whole and len(whole[0]) > 20


def test_rows_that_trees_cannot_tell_apart_are_one_cell(spark, data):
    rows = trees._row_columns(trees.Forest(weightCol="weight"), data.filter("a < 2").unionByName(data.filter("a < 2")))
    cells = trees.cells_of(rows, [np.array([0.0]), np.array([]), np.array([])])
    assert cells.count() <= 4 and cells.agg(F.sum("count")).first()[0] == rows.count()


def test_a_search_makes_the_cells_of_a_fold_once(spark, data, monkeypatch):
    made, whole = [], trees.cells_of
    monkeypatch.setattr(trees, "cells_of", lambda rows, cuts: made.append(1) or whole(rows, cuts))
    pipeline = ML.boosted_pipeline(FEATURES, select=False, seed=1, on_cells=True)
    grid = ML.grid_of(pipeline, {"maxIter": [1, 2], "maxDepth": [1, 3], "minInstancesPerNode": [5, 9]})
    areas = tune.search_areas(pipeline, grid, data.drop("features"), "key", folds=2)
    assert len(made) == 2 and len(areas) == 8 and all(min(a) > 0.7 for a in areas)


def test_what_is_not_built_here_goes_to_sparks_own(spark, data, monkeypatch):
    single = data.filter("label = 1")
    nothing = trees.Forest(numTrees=2, seed=1).fit(data.withColumn("label", F.lit(0)))
    assert nothing.transform(data).filter("prediction != 0").isEmpty()
    assert trees.Forest(numTrees=2, seed=1).fit(single).numClasses == 2
    three = data.withColumn("label", (F.col("a") % 3 + 3) % 3)
    assert trees.Forest(numTrees=2, seed=1).fit(three).numClasses == 3
    monkeypatch.setattr(trees, "BOOSTED_CELLS", 10)
    assert trees.Boosting(maxIter=2, maxDepth=2, seed=1).fit(data).getNumTrees == 2
