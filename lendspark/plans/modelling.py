"""The flow from prepared rows to evaluated classifiers."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from uuid import uuid4

from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendspark.constants import (
    CATEGORICAL_FEATURES,
    MIN_TRAIN_SHARE,
    NUMERIC_FEATURES,
    SPLIT_CUTOFF,
)
from lendspark.operators import preparation as prep
from lendspark.operators.encoding import encode, vector_width
from lendspark.operators.evaluation import evaluate, join_model_outputs
from lendspark.operators.training import (
    Search,
    baseline_estimator,
    describe_params,
    tune,
)
from lendspark.sources.writers import (
    export_csv,
    save_json_artifact,
    save_model,
    save_predictions,
    write_colocated,
    write_parquet,
)


@dataclass(frozen=True)
class TrainingData:
    """The written datasets of one split."""

    prepared: DataFrame
    train_raw: DataFrame
    test_raw: DataFrame
    train_encoded: DataFrame
    train_balanced: DataFrame
    test_encoded: DataFrame
    feature_count: int

    def label_distribution(self) -> DataFrame:
        return prep.label_distributions(
            {
                "full_prepared_raw": self.prepared,
                "train_raw": self.train_raw,
                "test_raw": self.test_raw,
                "train_encoded_before_balancing": self.train_encoded,
                "train_encoded": self.train_balanced,
                "test_encoded": self.test_encoded,
            }
        )

    def split_summary(self) -> DataFrame:
        return prep.split_summary(
            {
                "train_raw": self.train_raw,
                "test_raw": self.test_raw,
                "train_encoded": self.train_balanced,
                "test_encoded": self.test_encoded,
            },
            self.feature_count,
        )


def build_training_data(
    loans: DataFrame,
    root: str,
    cutoff: str = SPLIT_CUTOFF,
    min_train_share: float = MIN_TRAIN_SHARE,
) -> TrainingData:
    """Prepare, split, impute, encode and balance; each step written under ``root``.

    Later steps and fits read the files, so a lost executor costs a re-read and not
    the whole chain.
    """
    spark = loans.sparkSession

    def stored(df: DataFrame, name: str) -> DataFrame:
        path = f"{root}/{name}"
        write_parquet(df, path)
        return spark.read.parquet(path)

    # Later steps move no rows, so their tasks are as many as the files of this one.
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    prepared = stored(prep.prepare_rows(loans).repartition(parts, "id"), "prepared")
    train, test = prep.temporal_split(prepared, cutoff, min_train_share)
    train_raw, test_raw = stored(train, "train_raw"), stored(test, "test_raw")
    train_filled, test_filled = prep.impute_modes(
        train_raw, test_raw, NUMERIC_FEATURES + CATEGORICAL_FEATURES
    )
    _, train_vectors, test_vectors = encode(train_filled, test_filled)
    train_encoded = stored(train_vectors, "train_encoded")
    return TrainingData(
        prepared=prepared,
        train_raw=train_raw,
        test_raw=test_raw,
        train_encoded=train_encoded,
        train_balanced=stored(prep.balance(train_encoded), "train_balanced"),
        test_encoded=stored(test_vectors, "test_encoded"),
        feature_count=vector_width(train_vectors),
    )


@dataclass(frozen=True)
class Fitted:
    """A model, its stored predictions for the test rows, and its settings in words.

    Metrics, distributions and samples read what is stored; nothing is scored again.
    """

    family: str
    model: Model
    predictions: DataFrame
    params: str = ""
    combinations: int = 0

    def metrics(self, with_params: bool = False) -> DataFrame:
        row = evaluate(self.predictions, self.family)
        return row.withColumn("best_params", F.lit(self.params)) if with_params else row


def _scored(model: Model, data: TrainingData, path: str) -> DataFrame:
    """Predictions of all test rows, written to ``path``."""
    scored = model.transform(data.test_encoded)
    outputs = ("id", "label", "rawPrediction", "probability", "prediction")
    write_parquet(scored.select(*[name for name in outputs if name in scored.columns]), path)
    return scored.sparkSession.read.parquet(path)


def fit_baseline(family: str, data: TrainingData, root: str) -> Fitted:
    model = baseline_estimator(family).fit(data.train_balanced)
    return Fitted(family, model, _scored(model, data, f"{root}/baseline_{family}"))


def fit_tuned(
    family: str, data: TrainingData, root: str, search: Search | None = None
) -> Fitted:
    found = tune(family, data.train_balanced, search)
    model = found.bestModel
    predictions = _scored(model, data, f"{root}/tuned_{family}")
    return Fitted(family, model, predictions, describe_params(model), len(found.avgMetrics))


def save_artifacts(data: TrainingData, fits: Mapping[str, Fitted], root: str) -> None:
    """What a training run leaves: both sides as JSON, and per model its own files.

    The training side is shuffled. Per model there are ``model``, ``predictions`` and
    ``metrics`` below ``root/<family>``.
    """
    save_json_artifact(prep.shuffle_rows(data.train_balanced), f"{root}/train")
    save_json_artifact(data.test_encoded, f"{root}/test")
    for family, fit in fits.items():
        save_model(fit.model, f"{root}/{family}/model")
        save_predictions(fit.predictions, f"{root}/{family}/predictions")
        export_csv(fit.metrics(with_params=bool(fit.params)), f"{root}/{family}/metrics")


def joined_outputs(
    rows: DataFrame, predictions: Mapping[str, DataFrame], root: str, buckets: int = 8
) -> DataFrame:
    """All ``rows`` with the outputs of every model, however many rows there are.

    Rows and predictions are written once in the same buckets by id, below ``root``; the
    joins then read bucket by bucket and shuffle nothing. Tables stay in the catalog, under
    names of their own.
    """
    mark = uuid4().hex

    def placed(df: DataFrame, name: str) -> DataFrame:
        return write_colocated(df, f"joined_{name}_{mark}", f"{root}/{name}", "id", buckets)

    outputs = {prefix: placed(df, f"by_{prefix}") for prefix, df in predictions.items()}
    return join_model_outputs(placed(rows, "rows"), outputs)


def comparison(fits: Mapping[str, Fitted], with_params: bool = False) -> DataFrame:
    """The metrics of several models, one row each."""
    return prep.union_all([fit.metrics(with_params) for fit in fits.values()])
