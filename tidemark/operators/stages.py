"""The two-stage classifier and macro F1 as ML stages, for `Pipeline` and `CrossValidator`."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators import evaluate as ev, models


class MacroF1Evaluator(Evaluator, HasLabelCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """Macro F1 over the classes that occur; larger is better."""

    @keyword_only
    def __init__(self, *, labelCol: str = "label", predictionCol: str = "prediction") -> None:  # noqa: N803
        super().__init__()
        self._set(**self._input_kwargs)

    def _evaluate(self, dataset: DataFrame) -> float:
        known = dataset.select(*[F.col(c).cast("long").cast("string").alias(c) for c in (self.getLabelCol(), self.getPredictionCol())])
        return ev.evaluate(known, self.getLabelCol(), self.getPredictionCol()).first()["macro_f1"]

    def isLargerBetter(self) -> bool:  # noqa: N802
        return True


class _TwoStageParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasSeed):
    other = Param(Params._dummy(), "other", "label of the class that stage 1 tells from the rest", TypeConverters.toInt)
    numClasses = Param(Params._dummy(), "numClasses", "labels run from 0 up to this", TypeConverters.toInt)
    rule = Param(Params._dummy(), "rule", "argmax or hard", TypeConverters.toString)
    maxIter = Param(Params._dummy(), "maxIter", "boosting rounds of each tree model", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "depth of each tree", TypeConverters.toInt)
    stepSize = Param(Params._dummy(), "stepSize", "learning rate", TypeConverters.toFloat)

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(other=0, rule="argmax", maxIter=20, maxDepth=6, stepSize=0.05, seed=42)


class TwoStage(Estimator, _TwoStageParams, DefaultParamsReadable, DefaultParamsWritable):
    """Boosted trees that first tell one class from the rest, then the rest apart; see `models.fit_two_stage`."""

    @keyword_only
    def __init__(
        self, *, featuresCol: str = "features", labelCol: str = "label", predictionCol: str = "prediction",  # noqa: N803
        numClasses: int = 2, other: int = 0, rule: str = "argmax", maxIter: int = 20, maxDepth: int = 6,  # noqa: N803
        stepSize: float = 0.05, seed: int = 42,  # noqa: N803
    ) -> None:
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> TwoStageModel:
        trees = {p: self.getOrDefault(p) for p in ("maxIter", "maxDepth", "stepSize", "seed")}
        known = dataset.select(self.getFeaturesCol(), self.getLabelCol())
        inner = models.fit_two_stage(
            known, self.getOrDefault("numClasses"), self.getOrDefault("other"), self.getLabelCol(), self.getFeaturesCol(), **trees
        )
        return self._copyValues(TwoStageModel(inner))


class TwoStageModel(Model, _TwoStageParams, MLWritable, MLReadable):
    """Adds `probability` (array by label) and the predicted label."""

    def __init__(self, inner: PipelineModel | None = None) -> None:
        super().__init__()
        self.inner = inner

    def _transform(self, dataset: DataFrame) -> DataFrame:
        n, other = self.getOrDefault("numClasses"), self.getOrDefault("other")
        names = [str(i) for i in range(n)]
        scored = self.inner.transform(dataset)
        probabilities = vector_to_array("probability")
        hard = self.getOrDefault("rule") == "hard"
        label = models.hard_label(probabilities, names, other) if hard else models.argmax_label(probabilities, names)
        return scored.select(*dataset.columns, probabilities.alias("probability"), label.cast("double").alias(self.getPredictionCol()))

    def copy(self, extra=None) -> TwoStageModel:
        out = super().copy(extra)
        out.inner = self.inner.copy()
        return out

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Writer(MLWriter):
    def __init__(self, instance: TwoStageModel) -> None:
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:  # noqa: N802
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.inner.save(f"{path}/inner")


class _Reader(MLReader):
    def __init__(self, cls) -> None:
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> TwoStageModel:
        spark = SparkSession.getActiveSession()
        found = DefaultParamsReader.loadMetadata(path, spark)
        model = self.cls(PipelineModel.load(f"{path}/inner"))
        model._resetUid(found["uid"])
        DefaultParamsReader.getAndSetParams(model, found)
        return model
