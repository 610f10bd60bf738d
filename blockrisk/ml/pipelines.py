"""Logistic, forest and boosted pipelines with the grids they are searched over."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockrisk.functions import fields as C
from blockrisk.ml.select import CHECKPOINT_ROUNDS, ImportanceSelector
from blockrisk.ml.trees import Boosting, Forest

# Default grids. Forest and boosted names are Spark ML parameters.
LOGISTIC_GRID = {"C": [0.1, 1.0, 10.0], "penalty": ["l1", "l2"]}
LOGISTIC_SEARCH_GRID = LOGISTIC_GRID | {"class_weight": [None, "balanced"]}
FOREST_GRID = {"numTrees": [10, 20, 30], "maxDepth": [5, 8, 10], "minInstancesPerNode": [50, 60, 80]}
FINAL_FOREST_GRID = {"numTrees": [100, 200], "maxDepth": [8, 15], "minInstancesPerNode": [10, 20, 30]}
BOOSTED_GRID = {
    "maxIter": [10, 20, 30], "stepSize": [0.5, 1.0], "maxDepth": [5, 8, 10],
    "minInstancesPerNode": [5, 10, 50],
}


def _stages(features: Sequence[str], scale: bool, select: str | None, weight: str | None, seed: int):
    stages = [VectorAssembler(inputCols=list(features), outputCol="features")]
    last = "features"
    if scale:
        stages.append(StandardScaler(inputCol=last, outputCol="scaled", withMean=True, withStd=True))
        last = "scaled"
    if select:
        selector = ImportanceSelector(
            featuresCol=last, outputCol="selected", base=select, weightCol=weight or "", seed=seed
        )
        stages.append(selector)
        last = "selected"
    return stages, last


def logistic_pipeline(
    features: Sequence[str], scale: bool = True, select: bool = True, weight: str | None = None,
    C: float = 1.0, penalty: str = "l2", rows: int = 1, seed: int = 0,
) -> Pipeline:
    """``C`` counts summed losses, Spark averages them: regParam is 1 / (C * rows)."""
    stages, last = _stages(features, scale, "logistic" if select else None, weight, seed)
    settings = {"weightCol": weight} if weight else {}
    model = LogisticRegression(
        featuresCol=last, regParam=1.0 / (C * rows), standardization=False,
        elasticNetParam=1.0 if penalty == "l1" else 0.0, **settings,
    )
    return Pipeline(stages=[*stages, model])


def forest_pipeline(
    features: Sequence[str], scale: bool = False, select: bool = True, weight: str | None = None,
    seed: int = 0, **settings: int,
) -> Pipeline:
    stages, last = _stages(features, scale, "forest" if select else None, weight, seed)
    if weight:
        settings["weightCol"] = weight
    # Should Spark's own learner be needed, rows remember their node of each tree: deep trees need not go out with every level's tasks.
    return Pipeline(stages=[*stages, Forest(featuresCol=last, seed=seed, cacheNodeIds=True, **settings)])


def boosted_pipeline(
    features: Sequence[str], scale: bool = False, select: bool = True, weight: str | None = None,
    seed: int = 0, on_cells: bool = False, **settings: float,
) -> Pipeline:
    """``on_cells`` grows Spark's trees in one task: many fits side by side take far less; equal gains may fall otherwise by rounding."""
    stages, last = _stages(features, scale, "boosted" if select else None, weight, seed)
    if weight:
        settings["weightCol"] = weight
    settings = {"checkpointInterval": CHECKPOINT_ROUNDS} | settings
    kind = Boosting if on_cells else GBTClassifier
    return Pipeline(stages=[*stages, kind(featuresCol=last, seed=seed, **settings)])


def grid_of(pipeline: Pipeline, values: Mapping[str, Sequence], rows: int = 1) -> list[dict]:
    """Parameter maps of the pipeline's classifier.

    ``C``, ``penalty`` and ``class_weight`` (None or "balanced") are translated; the last chooses
    between the columns ``even`` and ``weight`` of ``with_class_weights``.
    """
    classifier = pipeline.getStages()[-1]
    grid = ParamGridBuilder()
    for name, options in values.items():
        if name == "C":
            grid = grid.addGrid(classifier.regParam, [1.0 / (c * rows) for c in options])
        elif name == "penalty":
            grid = grid.addGrid(
                classifier.elasticNetParam, [1.0 if p == "l1" else 0.0 for p in options]
            )
        elif name == "class_weight":
            grid = grid.addGrid(classifier.weightCol, ["weight" if o == "balanced" else "even" for o in options])
        else:
            grid = grid.addGrid(classifier.getParam(name), list(options))
    return grid.build()


def scored(model: PipelineModel, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Kept columns, probability, class at 0.5 and the 0-10 score."""
    out = model.transform(df)
    p = vector_to_array("probability")[1]
    return out.select(
        *keep, p.alias("probability"), F.col("prediction").cast("int").alias("prediction"),
        C.score_of(p).alias("score"),
    )


def kept_features(model: PipelineModel, features: Sequence[str]) -> list[str]:
    """Names that passed the selection, in vector order; all without one."""
    for stage in model.stages:
        if isinstance(stage, VectorSlicer):
            return [features[i] for i in stage.getIndices()]
    return list(features)


def importances(model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """Kept features with their importance (or absolute coefficient); a row per feature."""
    classifier = model.stages[-1]
    if hasattr(classifier, "featureImportances"):
        values = classifier.featureImportances.toArray()
    else:
        values = abs(classifier.coefficients.toArray())
    names = kept_features(model, features)
    return SparkSession.active().createDataFrame(
        [(n, float(v)) for n, v in zip(names, values)], "feature string, importance double"
    )


def top_importances(model: PipelineModel, features: Sequence[str], n: int | None = None) -> DataFrame:
    ordered = importances(model, features).orderBy(F.col("importance").desc(), "feature")
    return ordered if n is None else ordered.limit(n)


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
