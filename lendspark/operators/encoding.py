"""Feature vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame

from lendspark.constants import CATEGORICAL_FEATURES, NUMERIC_FEATURES

ENCODED_COLUMNS = ["id", "loan_status", "label", "features"]


def encoding_pipeline(
    categorical: Sequence[str] = tuple(CATEGORICAL_FEATURES),
    numeric: Sequence[str] = tuple(NUMERIC_FEATURES),
) -> Pipeline:
    """One-hot categories followed by the numbers.

    A category not seen in training encodes to all zeros.
    """
    indexed = [f"{name}_idx" for name in categorical]
    encoded = [f"{name}_ohe" for name in categorical]
    return Pipeline(
        stages=[
            StringIndexer(inputCols=list(categorical), outputCols=indexed, handleInvalid="keep"),
            OneHotEncoder(inputCols=indexed, outputCols=encoded),
            VectorAssembler(inputCols=encoded + list(numeric), outputCol="features"),
        ]
    )


def encode(
    train: DataFrame, test: DataFrame, pipeline: Pipeline | None = None
) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """Fit on ``train``; both sides reduced to id, status, label and features."""
    model = (pipeline or encoding_pipeline()).fit(train)
    return (
        model,
        model.transform(train).select(*ENCODED_COLUMNS),
        model.transform(test).select(*ENCODED_COLUMNS),
    )


def vector_width(df: DataFrame, column: str = "features") -> int:
    """Length of an assembled vector, from the column's metadata."""
    return df.schema[column].metadata["ml_attr"]["num_attrs"]
