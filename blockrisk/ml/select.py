"""Feature selection by mean importance, as a stage of a Spark ML pipeline."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import VectorSlicer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable

#: Rounds of boosting after which Spark writes the running margins out. Until then every job carries the trees of all
#: rounds since; at Spark's ten rounds, packing those up costs the driver more than the rounds' own work. Trees are the same.
CHECKPOINT_ROUNDS = 2

BASES = {
    "forest": RandomForestClassifier,
    "boosted": GBTClassifier,
    "logistic": LogisticRegression,
}


class ImportanceSelector(
    Estimator, HasFeaturesCol, HasLabelCol, HasOutputCol,
    DefaultParamsReadable, DefaultParamsWritable,
):
    """Keeps features whose importance, or absolute coefficient, reaches the mean.

    The fitted stage is a plain ``VectorSlicer``: it saves and loads without Python.
    """

    base = Param(Params._dummy(), "base", "model giving importances", TypeConverters.toString)
    weightCol = Param(Params._dummy(), "weightCol", "row weights", TypeConverters.toString)
    seed = Param(Params._dummy(), "seed", "seed of the base model", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", outputCol="selected",
                 base="forest", weightCol="", seed=0):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", outputCol="selected",
                         base="forest", weightCol="", seed=0)
        self._set(**self._input_kwargs)

    def _fit(self, dataset):
        kind = self.getOrDefault(self.base)
        settings = {"featuresCol": self.getFeaturesCol(), "labelCol": self.getLabelCol()}
        if self.getOrDefault(self.weightCol):
            settings["weightCol"] = self.getOrDefault(self.weightCol)
        if kind == "logistic":
            # A ridge of C = 1 over summed losses, on features as they come.
            settings |= {"regParam": 1.0 / max(1, dataset.count()), "standardization": False}
        else:
            settings["seed"] = self.getOrDefault(self.seed)
        if kind == "boosted":
            settings["checkpointInterval"] = CHECKPOINT_ROUNDS
        model = BASES[kind](**settings).fit(dataset)
        if kind == "logistic":
            weights = [abs(w) for w in model.coefficients.toArray()]
        else:
            weights = list(model.featureImportances.toArray())
        mean = sum(weights) / len(weights)
        kept = [i for i, w in enumerate(weights) if w >= mean]
        return VectorSlicer(
            inputCol=self.getFeaturesCol(), outputCol=self.getOutputCol(), indices=kept
        )
