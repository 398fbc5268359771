"""Classifiers: plain fits and cross-validated searches."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from itertools import product

import numpy as np
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LinearSVC, NaiveBayes, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import MinMaxScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendspark.constants import CV_FOLDS, CV_METRIC, CV_PARALLELISM, SEED
from lendspark.functions.measures import millionths
from lendspark.operators import bayes_search, forest_search, margin_search

RANDOM_FOREST = "RandomForest"
LINEAR_SVC = "LinearSVC"
NAIVE_BAYES = "NaiveBayes"

# Parameters to search, addressed as in the estimator; "scaler." ones belong to
# the scaler in front of naive Bayes. These are fixed values.
SEARCH_GRIDS: dict[str, dict[str, Sequence]] = {
    RANDOM_FOREST: {
        "numTrees": [10, 20, 30],
        "maxDepth": [3, 5, 7],
        "minInstancesPerNode": [5, 10, 20],
    },
    LINEAR_SVC: {
        "regParam": [0.001, 0.01, 0.1],
        "tol": [1e-6, 1e-5, 1e-4],
        "aggregationDepth": [2, 4, 8],
    },
    NAIVE_BAYES: {
        "scaler.max": [1.0, 2.0, 5.0],
        "smoothing": [0.5, 1.0, 1.5],
        "thresholds": [[1.0, 1.0], [1.0, 2.0], [2.0, 1.0]],
    },
}


class NegativeClipper(
    Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable
):
    """Vectors with negative entries raised to zero."""

    @keyword_only
    def __init__(self, *, inputCol: str | None = None, outputCol: str | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        entries = vector_to_array(self.getInputCol())
        clipped = F.transform(entries, lambda x: F.greatest(x, F.lit(0.0)))
        return dataset.withColumn(self.getOutputCol(), array_to_vector(clipped))


def _bayes(**params) -> Pipeline:
    # Naive Bayes takes no negative values, hence the scaler. A row to be scored may
    # still lie below everything the scaler was fitted on.
    return Pipeline(
        stages=[
            MinMaxScaler(inputCol="features", outputCol="features_scaled"),
            NegativeClipper(inputCol="features_scaled", outputCol="features_clipped"),
            NaiveBayes(featuresCol="features_clipped", modelType="multinomial", **params),
        ]
    )


def baseline_estimator(family: str) -> Estimator:
    """Classifier of the family with its fixed baseline settings."""
    if family == RANDOM_FOREST:
        return RandomForestClassifier(numTrees=10, maxDepth=3, seed=SEED)
    if family == LINEAR_SVC:
        return LinearSVC(regParam=0.1, maxIter=50)
    if family == NAIVE_BAYES:
        return _bayes(smoothing=1.0)
    raise ValueError(f"Unknown model family: {family}")


def search_estimator(family: str) -> Estimator:
    """Classifier of the family that a search starts from."""
    if family == RANDOM_FOREST:
        return RandomForestClassifier(seed=SEED)
    if family == LINEAR_SVC:
        return LinearSVC()
    if family == NAIVE_BAYES:
        return _bayes()
    raise ValueError(f"Unknown model family: {family}")


def param_maps(estimator: Estimator, grid: Mapping[str, Sequence]) -> list[dict]:
    """Every combination of the grid as parameter maps of ``estimator``."""

    def param(name: str):
        if isinstance(estimator, Pipeline):
            scaler, _, classifier = estimator.getStages()
            owner, _, own_name = name.rpartition(".")
            return (scaler if owner == "scaler" else classifier).getParam(own_name)
        return estimator.getParam(name)

    params = [param(name) for name in grid]
    return [dict(zip(params, values)) for values in product(*grid.values())]


def with_folds(df: DataFrame, folds: int = CV_FOLDS, key: str = "id") -> DataFrame:
    """``df`` with a ``fold`` that all copies of a row share."""
    return df.withColumn("fold", (millionths(F.col(key), SEED) % folds).cast("int"))


@dataclass(frozen=True)
class Search:
    """Settings of a cross-validated search.

    ``group_copies`` keeps the copies that balancing made of a row in one fold.
    Without it they may be in the fitted and the held-out part at once, which
    flatters the scores; that is the default, as it is how the published figures
    came about.
    """

    grid: Mapping[str, Sequence]
    folds: int = CV_FOLDS
    parallelism: int = CV_PARALLELISM
    metric: str = CV_METRIC
    group_copies: bool = False


def tune(family: str, train: DataFrame, search: Search | None = None) -> CrossValidatorModel:
    """Search the whole grid on the training rows alone and refit the best on all of them.

    All combinations of naive Bayes are scored from shared statistics, see
    :mod:`lendspark.operators.bayes_search`; all linear SVC are fitted by the same passes, see
    :mod:`lendspark.operators.margin_search`; and smaller random forests are parts of larger
    ones, see :mod:`lendspark.operators.forest_search`.
    """
    search = search or Search(SEARCH_GRIDS[family])
    estimator = search_estimator(family)
    found = None
    if family == NAIVE_BAYES and set(search.grid) <= bayes_search.KNOWN:
        found = _tune_together(estimator, train, search, _bayes_metrics)
    if family == LINEAR_SVC and set(search.grid) <= margin_search.KNOWN:
        found = _tune_together(estimator, train, search, _margin_metrics)
    if family == RANDOM_FOREST and set(search.grid) <= forest_search.KNOWN:
        found = _tune_together(estimator, train, search, _forest_metrics)
    return found or tune_by_fits(estimator, train, search)


# Rows that one task of a fit is given at most.
TASK_ROWS = 1 << 18


def spread(df: DataFrame, key: str = "id") -> DataFrame:
    """``df`` dealt evenly to all cores, in an order that does not depend on tasks.

    Well compressed rows lie in few files, which few tasks would read.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = cores * max(1, -(-df.count() // (cores * TASK_ROWS)))  # all cores end at once
    return df.repartition(parts, key).sortWithinPartitions(key)


def tune_by_fits(estimator: Estimator, train: DataFrame, search: Search) -> CrossValidatorModel:
    """The search with a fit for every combination and fold."""
    validator = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=param_maps(estimator, search.grid),
        evaluator=BinaryClassificationEvaluator(metricName=search.metric, numBins=0),
        numFolds=search.folds,
        parallelism=search.parallelism,
        seed=SEED,
    )
    if search.group_copies:
        train = with_folds(train, search.folds)
        validator = validator.setFoldCol("fold")
    train = spread(train).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return validator.fit(train)
    finally:
        train.unpersist()


def _tune_together(
    estimator: Estimator, train: DataFrame, search: Search, measured: Callable
) -> CrossValidatorModel | None:
    """The same without a fit per combination; None if a training part lacks a class."""
    maps = param_maps(estimator, search.grid)
    kept = spread(train).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if search.group_copies:
            folded = with_folds(kept, search.folds)
        else:
            folded = bayes_search.random_folds(kept, search.folds, SEED)
        metrics = measured(estimator, maps, folded, search)
        if metrics is None:
            return None
        average = metrics.mean(axis=0)
        best = estimator.fit(kept, maps[int(np.argmax(average))])
    finally:
        kept.unpersist()
    return CrossValidatorModel(best, avgMetrics=average.tolist(), stdMetrics=metrics.std(axis=0).tolist())


def _per_setting(settings: list[tuple], measured: Callable) -> np.ndarray | None:
    """The columns of ``measured`` for the distinct ones of ``settings``, for all of them."""
    distinct = list(dict.fromkeys(settings))
    found = measured(distinct)
    return None if found is None else found[:, [distinct.index(s) for s in settings]]


def _bayes_metrics(estimator: Pipeline, maps: list[dict], folded: DataFrame, search: Search):
    scaler, _, classifier = estimator.getStages()
    settings = [
        (float(m.get(scaler.max, scaler.getMax())), float(m.get(classifier.smoothing, classifier.getSmoothing())))
        for m in maps
    ]
    return _per_setting(
        settings, lambda some: bayes_search.fold_metrics(folded, search.folds, some, search.metric)
    )


def _margin_metrics(estimator: LinearSVC, maps: list[dict], folded: DataFrame, search: Search):
    settings = [
        (float(m.get(estimator.regParam, estimator.getRegParam())), float(m.get(estimator.tol, estimator.getTol())))
        for m in maps
    ]
    limit = estimator.getMaxIter()
    return _per_setting(
        settings, lambda some: margin_search.fold_metrics(folded, search.folds, some, search.metric, limit)
    )


def _forest_metrics(estimator: RandomForestClassifier, maps: list[dict], folded: DataFrame, search: Search):
    params = (estimator.numTrees, estimator.maxDepth, estimator.minInstancesPerNode)
    settings = [tuple(m.get(param, estimator.getOrDefault(param)) for param in params) for m in maps]
    return _per_setting(
        settings, lambda some: forest_search.fold_metrics(folded, search.folds, some, search.metric, estimator)
    )


def describe_params(model: Model) -> str:
    """Settings of a fitted model, sorted; those of a pipeline carry their stage's uid."""
    if isinstance(model, PipelineModel):
        pairs = [
            f"{stage.uid}__{param.name}={value}"
            for stage in model.stages
            for param, value in stage.extractParamMap().items()
        ]
    else:
        pairs = [f"{param.name}={value}" for param, value in model.extractParamMap().items()]
    return "; ".join(sorted(pairs))
