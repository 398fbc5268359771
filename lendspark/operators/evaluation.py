"""Quality of binary predictions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendspark.constants import CHARGED_OFF, FULLY_PAID
from lendspark.functions.measures import row_count, safe_ratio
from lendspark.operators.preparation import union_all
from lendspark.operators.running import key_ranges, running_totals
from lendspark.session import work_folder


def _confusion_cells(label: str, prediction: str) -> list[Column]:
    actual, guess = F.col(label), F.col(prediction)
    return [
        F.count_if((actual == 1.0) & (guess == 1.0)).alias("tp"),
        F.count_if((actual == 0.0) & (guess == 0.0)).alias("tn"),
        F.count_if((actual == 0.0) & (guess == 1.0)).alias("fp"),
        F.count_if((actual == 1.0) & (guess == 0.0)).alias("fn"),
    ]


def confusion(
    predictions: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """One row of true and false positives and negatives."""
    return predictions.agg(*_confusion_cells(label, prediction))


def threshold_metrics(counts: DataFrame) -> DataFrame:
    """Accuracy, precision, recall and F1 next to the counts of :func:`confusion`."""
    tp, tn, fp, fn = (F.col(name) for name in ("tp", "tn", "fp", "fn"))
    precision = safe_ratio(tp, tp + fp)
    recall = safe_ratio(tp, tp + fn)
    return counts.select(
        safe_ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        safe_ratio(precision * recall * 2.0, precision + recall).alias("f1"),
        "tp",
        "tn",
        "fp",
        "fn",
    )


def _score_counts(predictions: DataFrame, score: str, label: str, *others) -> DataFrame:
    return predictions.groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(label) > 0.5).alias("pos"),
        F.count_if(F.col(label) <= 0.5).alias("neg"),
        *others,
    )


def _score_curve(per_score: DataFrame, path: str, groups: Sequence[str] = ()) -> DataFrame:
    """Counts per score, accumulated from the highest score down within each group."""
    downwards = [F.col("score").desc()]
    ranges = key_ranges(per_score, downwards, path, groups)
    return running_totals(ranges, ["pos", "neg"], downwards, groups)


def _curve_areas(curve: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    total = lambda name: F.coalesce(F.sum(name), F.lit(0))
    totals = curve.groupBy(*groups).agg(total("pos").alias("all_pos"), total("neg").alias("all_neg"))
    pos, neg, tp, fp = (F.col(name) for name in ("pos", "neg", "cum_pos", "cum_neg"))
    all_pos, all_neg = F.col("all_pos"), F.col("all_neg")

    # Twice the area, counted in pairs of a positive and a negative row. Decimals
    # hold it exactly; such a count outgrows 64 bits.
    exact = "decimal(19,0)"
    pairs = F.sum(neg.cast(exact) * (tp * 2 - pos).cast(exact))

    here = tp / (tp + fp)
    earlier = tp - pos + fp - neg
    before = F.when(earlier > 0, (tp - pos) / earlier).otherwise(here)
    steps = F.sum(pos * (here + before) / 2.0)

    # One row, or one per group, of which the callers have few.
    with_totals = (
        curve.join(F.broadcast(totals), list(groups)) if groups else curve.crossJoin(F.broadcast(totals))
    )
    return (
        with_totals.groupBy(*groups)
        .agg(
            F.coalesce(F.max("all_pos"), F.lit(0)).alias("all_pos"),
            F.coalesce(F.max("all_neg"), F.lit(0)).alias("all_neg"),
            pairs.alias("pairs"),
            steps.alias("steps"),
        )
        .select(
            *groups,
            F.when(all_pos == 0, 0.0)
            .when(all_neg == 0, 1.0)
            .otherwise(F.col("pairs").cast("double") / 2.0 / all_pos / all_neg)
            .alias("areaUnderROC"),
            F.when(all_pos == 0, 0.0)
            .otherwise(F.col("steps") / all_pos)
            .alias("areaUnderPR"),
        )
    )


def ranking_areas(
    predictions: DataFrame, score: str = "score", label: str = "label"
) -> DataFrame:
    """One row: areas under the ROC and the precision-recall curve.

    Each distinct score is a threshold; nothing is binned. The points of a curve are
    joined by straight lines, and the precision-recall curve starts level. The row is
    computed at once, so that what it is computed from can be removed.
    """
    with work_folder(predictions.sparkSession, "curve") as path:
        return _at_once(_curve_areas(_score_curve(_score_counts(predictions, score, label), path)))


def _at_once(row: DataFrame) -> DataFrame:
    """A frame of one row with its values in it."""
    return row.sparkSession.createDataFrame(row.collect(), row.schema)


def evaluate(
    predictions: DataFrame, model_name: str, score_col: str = "rawPrediction"
) -> DataFrame:
    """One row of all metrics, from a single pass over the predictions, computed at once.

    Without predictions all of them are zero.

    ``score_col`` is a vector whose second entry ranks the rows. The default is
    the raw score; for naive Bayes that is not normalised and ranks poorly, and
    ``probability`` is the better choice.
    """
    scored = predictions.select(
        "label", "prediction", vector_to_array(score_col)[1].alias("score")
    )
    cells = _confusion_cells("label", "prediction")
    names = ("tp", "tn", "fp", "fn")
    with work_folder(predictions.sparkSession, "curve") as path:
        curve = _score_curve(_score_counts(scored, "score", "label", *cells), path)
        counts = curve.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])
        # Both sides are a single row.
        return _at_once(
            threshold_metrics(counts)
            .crossJoin(F.broadcast(_curve_areas(curve)))
            .select(
                F.lit(model_name).alias("model"),
                "accuracy",
                "precision",
                "recall",
                "f1",
                "areaUnderROC",
                "areaUnderPR",
                *names,
            )
        )


def prediction_distribution(predictions: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per model, true label and predicted label."""
    return union_all(
        [
            df.groupBy("label", "prediction")
            .agg(row_count().alias("count"))
            .select(F.lit(model).alias("model"), "label", "prediction", "count")
            for model, df in predictions.items()
        ]
    )


# What a model says of a row: suffix of the column, what the model must have for it, value.
MODEL_OUTPUTS = (
    ("prediction", "prediction", lambda: F.col("prediction")),
    (
        "predicted_status",
        "prediction",
        lambda: F.when(F.col("prediction") == 1.0, CHARGED_OFF).otherwise(FULLY_PAID),
    ),
    ("probability_charged_off", "probability", lambda: vector_to_array("probability")[1]),
    ("score_charged_off", "rawPrediction", lambda: vector_to_array("rawPrediction")[1]),
)


def _model_outputs(predictions: DataFrame, prefix: str) -> DataFrame:
    return predictions.select(
        "id",
        *[
            value().alias(f"{prefix}_{suffix}")
            for suffix, needs, value in MODEL_OUTPUTS
            if needs in predictions.columns
        ],
    )


def join_model_outputs(sample: DataFrame, predictions: Mapping[str, DataFrame]) -> DataFrame:
    """``sample`` with the outputs of each model for the same id, NULL if it has none.

    The ids of the sample first pick the predictions needed, and so which rows the
    models score at all. Spark broadcasts them when it knows that they are few.
    """
    ids = sample.select("id")
    for prefix, df in predictions.items():
        wanted = _model_outputs(df.join(ids, "id", "left_semi"), prefix)
        sample = sample.join(wanted, "id", "left")
    return sample


def sample_predictions(
    raw_test: DataFrame, predictions: Mapping[str, DataFrame], rows: int = 10
) -> DataFrame:
    """The test rows with the lowest ids, in full, with what each model says of them."""
    lowest = raw_test.orderBy("id").limit(rows)
    renamed = lowest.withColumnsRenamed(
        {old: f"actual_{new}" for old, new in (("loan_status", "status"), ("label", "label"))}
    )
    return join_model_outputs(renamed, predictions)
