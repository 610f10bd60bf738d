import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from blockrisk.ml import pipelines as ML
from blockrisk.ml import split as M
from blockrisk.ml import tune
from blockrisk.ml.select import ImportanceSelector
from blockrisk.plans.evaluation import roc_auc
from tests.conftest import rows

FEATURES = ["signal", "noise1", "noise2"]


@pytest.fixture(scope="module")
def data(spark):
    base = spark.range(400).withColumns({
        "key": F.format_string("k%05d", F.col("id")),
        "signal": (F.col("id") * 37 % 101) / 100.0,
        "noise1": (F.col("id") * 17 % 13) / 13.0,
        "noise2": (F.col("id") * 29 % 7) / 7.0,
    })
    return base.withColumn("label", (F.col("signal") + F.col("noise1") / 10 > 0.6).cast("int"))


def test_forest_selects_the_signal_saves_and_loads(spark, data, tmp_path):
    pipeline = ML.forest_pipeline(FEATURES, seed=1, numTrees=5, maxDepth=3)
    model = pipeline.fit(data)
    assert ML.kept_features(model, FEATURES) == ["signal"]
    assert any(isinstance(s, VectorSlicer) for s in model.stages)
    ML.save(model, str(tmp_path / "model"))
    loaded = ML.load(str(tmp_path / "model"))
    assert isinstance(loaded, PipelineModel)
    assert rows(ML.scored(loaded, data, ["key"])) == rows(ML.scored(model, data, ["key"]))
    assert rows(ML.top_importances(model, FEATURES)) == [("signal", 1.0)]


@pytest.mark.parametrize("make", [
    lambda: ML.logistic_pipeline(FEATURES, rows=400, weight="weight"),
    lambda: ML.logistic_pipeline(FEATURES, rows=400, penalty="l1", select=False),
    lambda: ML.boosted_pipeline(FEATURES, seed=1, maxIter=3, maxDepth=2, select=False),
])
def test_models_rank_the_label(spark, data, make):
    model = make().fit(M.with_class_weights(data))
    scores = ML.scored(model, data, ["label"])
    assert roc_auc(scores).first()[0] > 0.95
    low, high = scores.agg(F.min("score"), F.max("score")).first()
    assert 0 <= low <= high <= 10


def test_grid_search_refits_the_best(spark, data):
    pipeline = ML.forest_pipeline(FEATURES, seed=1, numTrees=3)
    grid = ML.grid_of(pipeline, {"maxDepth": [1, 4]})
    model, table = tune.grid_search(pipeline, grid, data, "key", folds=2)
    found = {r["parameters"]: r["mean_auc"] for r in table.collect()}
    assert set(found) == {"maxDepth=1", "maxDepth=4"} and all(v > 0.9 for v in found.values())
    best = max(found, key=found.get)
    assert best == f"maxDepth={model.stages[-1].getOrDefault('maxDepth')}"


def test_prefixes_of_boosted_trees_equal_their_own_fits(spark, data):
    encoded = tune.encoded_fold(ML.boosted_pipeline(FEATURES, select=False, seed=1), data.withColumn("fold", F.lit(0)), 1, ["key"])
    classifier = ML.boosted_pipeline(FEATURES, select=False, seed=1, maxIter=7, maxDepth=3, stepSize=0.5).getStages()[-1]
    scores = tune.prefix_scores(classifier.fit(encoded), [7, 2, 4], encoded)
    for n in (2, 4, 7):
        own = classifier.copy({classifier.maxIter: n}).fit(encoded).transform(encoded).withColumn("own", F.col("rawPrediction"))
        joined = scores.select("key", f"score_{n}").join(own.select("key", vector_to_array("own")[1].alias("own")), "key")
        assert joined.count() == 400 and joined.filter(F.abs(F.col(f"score_{n}") - F.col("own")) > 1e-9).isEmpty()


def test_boosting_carries_few_rounds_in_its_jobs_and_grows_the_same_trees(spark, data, monkeypatch):
    asked = []
    fit = GBTClassifier._fit

    def fitting(self, dataset):
        asked.append(self.getCheckpointInterval())
        return fit(self, dataset)

    monkeypatch.setattr(GBTClassifier, "_fit", fitting)
    trees, noisy = [], data.withColumn("label", (F.col("id") * 7 % 5 < 2).cast("int"))
    for settings in ({}, {"checkpointInterval": 10}):
        pipeline = ML.boosted_pipeline(FEATURES, seed=1, maxIter=5, maxDepth=3, **settings)
        trees.append(pipeline.fit(noisy).stages[-1].toDebugString.split("\n", 1)[1])
    assert trees[0] == trees[1] and asked == [2, 2, 2, 10]


def test_prefixes_of_a_forest_are_its_first_trees(spark, data):
    encoded = tune.encoded_fold(ML.forest_pipeline(FEATURES, select=False, seed=1), data.withColumn("fold", F.lit(0)), 1, ["key"])
    classifier = ML.forest_pipeline(FEATURES, select=False, seed=1, numTrees=6, maxDepth=4).getStages()[-1]
    model = classifier.fit(encoded)
    scores, total = tune.prefix_scores(model, [1, 3, 6], encoded), None
    for n, tree in enumerate(model.trees, 1):
        one = vector_to_array(F.col("probability"))[1].alias(f"p{n}")
        votes = tree.setFeaturesCol("features").transform(encoded).select("key", one)
        total = votes if total is None else total.join(votes, "key")
    joined = scores.join(total, "key")
    for n in (1, 3, 6):
        mean = sum(F.col(f"p{k}") for k in range(1, n + 1)) / n
        assert joined.filter(F.abs(F.col(f"score_{n}") - mean) > 1e-9).isEmpty()
    whole = model.transform(encoded).select("key", vector_to_array("probability")[1].alias("p"))
    assert scores.join(whole, "key").filter(F.abs(F.col("score_6") - F.col("p")) > 1e-9).isEmpty()


def test_search_fits_a_selector_a_fold_and_a_family_once(spark, data, monkeypatch):
    fits = {"selector": 0, "forest": []}
    select_fit, forest_fit = ImportanceSelector._fit, RandomForestClassifier._fit

    def selecting(self, dataset):
        fits["selector"] += 1
        return select_fit(self, dataset)

    def growing(self, dataset):
        fits["forest"].append(self.getNumTrees())
        return forest_fit(self, dataset)

    monkeypatch.setattr(ImportanceSelector, "_fit", selecting)
    monkeypatch.setattr(RandomForestClassifier, "_fit", growing)
    pipeline = ML.forest_pipeline(FEATURES, seed=1)
    grid = ML.grid_of(pipeline, {"numTrees": [2, 3, 5], "maxDepth": [2, 4]})
    areas = tune.search_areas(pipeline, grid, data, "key", folds=3)
    assert fits["selector"] == 3 and len(areas) == 6 and all(len(a) == 3 and min(a) > 0.5 for a in areas)
    # two families a fold, each of the largest size, beside the selector's own base model
    assert sorted(n for n in fits["forest"] if n == 5) == [5] * 6 and len(fits["forest"]) == 9
    assert [sorted(f.members) for f in tune.families(pipeline, grid)] == [[2, 3, 5]] * 2


def test_grid_translates_c_and_penalty(spark):
    pipeline = ML.logistic_pipeline(FEATURES)
    grid = ML.grid_of(pipeline, ML.LOGISTIC_GRID, rows=10)
    values = sorted({tuple(sorted((p.name, v) for p, v in g.items())) for g in grid})
    assert len(values) == 6 and (("elasticNetParam", 1.0), ("regParam", 0.01)) in values


def test_learning_curve_grows(spark, data):
    pipeline = ML.logistic_pipeline(FEATURES, select=False, rows=400)
    curve = tune.learning_curve(pipeline, data, "key", fractions=(0.2, 1.0), folds=2)
    got = rows(curve, "fraction", "rows")
    assert got == [(0.2, 40), (1.0, 200)]


def test_year_split_and_features(spark):
    df = spark.createDataFrame([(y, 1.0, None, 2) for y in (2016, 2017, 2018, 2019)], "Year int, x double, SF_pred int, VF_pred int")
    split = M.year_split(df, "VF_pred", 2018)
    assert rows(split, "Year", "split", "label") == [(2016, "train", 1), (2017, "holdout", 1), (2018, "future", 1)]
    assert M.feature_names(split) == ["Year", "x"]


def test_weights_balance(spark, data):
    weighted = M.with_class_weights(data).groupBy("label").agg(F.sum("weight").alias("w"))
    assert {round(r["w"], 6) for r in weighted.collect()} == {200.0}


def test_hash_split_is_repeatable(spark, data):
    one, two = M.hash_split(data, "key"), M.hash_split(data.repartition(7), "key")
    assert rows(one, "key", "is_test") == rows(two, "key", "is_test")
    assert 0.2 < one.agg(F.avg("is_test")).first()[0] < 0.4


def test_rows_are_dealt_over_the_tasks_of_a_fit(spark):
    one = spark.range(200_000, numPartitions=1).selectExpr("string(id) AS key")
    sizes = tune.dealt(one, "key", 200_000).rdd.glom().map(len).collect()
    assert sum(sizes) == 200_000 and len(sizes) == 4 and max(sizes) < 100_000
    assert tune.dealt(one, "key", 1000).rdd.getNumPartitions() == 1


def test_areas_of_many_ranges_equal_the_evaluators(spark, monkeypatch):
    monkeypatch.setattr(tune, "ROWS_PER_TASK", 50)
    scored = spark.range(600).selectExpr("id % 2 AS side", "double((id * 37) % 83) AS score", "(id * 11) % 7 < 3 AS label")
    found = tune.side_areas(scored, 600)
    for side in (0, 1):
        one = scored.filter(F.col("side") == side).select("score", F.col("label").cast("double").alias("label"))
        assert abs(found[side] - tune.area_evaluator("score").evaluate(one)) < 1e-12
    for label, area in (("true", 1.0), ("false", 0.0)):
        single = spark.range(9).selectExpr("0L AS side", "double(id) AS score", f"{label} AS label")
        alone = single.select("score", F.col("label").cast("double").alias("label"))
        assert tune.side_areas(single, 9) == {0: area} == {0: tune.area_evaluator("score").evaluate(alone)}


def test_a_fit_of_the_curve_needs_no_evaluation_of_its_own(spark, data, monkeypatch):
    def stop(score="rawPrediction"):
        raise AssertionError("rows are scored and sorted once for both areas")

    monkeypatch.setattr(tune, "area_evaluator", stop)
    curve = tune.learning_curve(ML.logistic_pipeline(FEATURES, select=False, rows=400), data, "key", fractions=(0.2, 1.0), folds=2)
    assert all(r["train_mean"] > 0.9 and r["validation_mean"] > 0.9 for r in curve.collect())
