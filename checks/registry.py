"""Every operator as a query over the shared test tables.

A query takes the session and the directory of the tables and returns a frame. Dates
are returned as text and long fractions rounded, so that results compare across
engines.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import fixtures as fx
from lendspark.constants import (
    CATEGORICAL_FEATURES,
    LOAN_SCHEMA,
    NUMERIC_FEATURES,
    STAGED_LOAN_SCHEMA,
)
from lendspark.functions.dates import epoch_ms_to_date
from lendspark.functions.measures import row_count
from lendspark.functions.text import (
    clean_numeric,
    clean_text,
    parse_mon_year,
    parse_term,
    to_int,
)
from lendspark.operators import cleaning, evaluation, incremental, preparation, profile, validation
from lendspark.operators.training import (
    LINEAR_SVC,
    NAIVE_BAYES,
    RANDOM_FOREST,
    SEARCH_GRIDS,
    Search,
)
from lendspark.operators.validation import ConstraintViolation
from lendspark.plans import business, modelling, quality
from lendspark.plans.ingest import ingest
from lendspark.plans.modelling import (
    Fitted,
    TrainingData,
    build_training_data,
    comparison,
    fit_baseline,
    fit_tuned,
    save_artifacts,
)
from lendspark.plans.reporting import publish_reports
from lendspark.session import compile_wide_rows, scratch_path
from lendspark.sources import catalog, readers, versions, writers

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

FAMILIES = (RANDOM_FOREST, LINEAR_SVC, NAIVE_BAYES)
PREFIXES = {
    RANDOM_FOREST: "random_forest",
    LINEAR_SVC: "linear_svc",
    NAIVE_BAYES: "naive_bayes",
}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def on_loans(name: str, report: Callable[[DataFrame], DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf_dir: report(fx.loans(spark, sf_dir))


def dates_as_text(df: DataFrame) -> DataFrame:
    dates = [name for name, kind in df.dtypes if kind == "date"]
    return df.withColumns({name: F.col(name).cast("string") for name in dates})


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({name: F.round(name, digits) for name in columns})


# What a step of the flow writes or fits is shared by the queries on later steps.
_SHARED: dict[tuple, object] = {}


def _shared(spark, sf_dir, name, make):
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _SHARED:
        _SHARED[key] = make()
    return _SHARED[key]


def forget_models() -> None:
    """Have the next query fit its models again."""
    for key in [key for key in _SHARED if isinstance(key[2], tuple)]:
        del _SHARED[key]


def write_raw_csv(spark, sf_dir) -> str:
    path = scratch_path(spark, "raw-csv")
    compile_wide_rows(spark)
    fx.loans_raw(spark, sf_dir).write.csv(
        path,
        header=True,
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    return path


def raw_csv(spark, sf_dir) -> DataFrame:
    """The raw loans as a CSV export has them."""
    path = _shared(spark, sf_dir, "raw", lambda: write_raw_csv(spark, sf_dir))
    return readers.read_raw_csv(spark, path)


# --- reports -------------------------------------------------------------------

on_loans("q1_grade", business.default_rate_by_grade)
on_loans("q2_purpose", business.default_rate_by_purpose)
on_loans("q3_issue_year", business.default_rate_by_year)
on_loans("q4_dti", business.default_rate_by_dti)
on_loans("q5_grade_ownership", business.default_rate_by_grade_and_ownership)
on_loans("q6_fico", business.default_rate_by_fico)
on_loans("dq_null_profile", quality.null_report)
on_loans("dq_status_distribution", quality.status_report)
on_loans("dq_binary_target", quality.binary_target_report)
on_loans("dq_categorical_counts", quality.categorical_report)
on_loans(
    "dq_numeric_summary",
    lambda loans: rounded(quality.numeric_report(loans), 6, "avg_value", "stddev_value"),
)
on_loans("dq_numeric_distributions", quality.bucket_report)
on_loans("status_share_crossjoin", profile.status_distribution)


@query
def incremental_counts(spark, sf_dir):
    """Value counts of a table that got a partition after it was first profiled."""
    path, root = scratch_path(spark, "profiled"), scratch_path(spark, "states")
    loans = fx.loans(spark, sf_dir).withColumn("part", F.col("grade"))
    wanted = incremental.Profile(["grade"], CATEGORICAL_FEATURES)
    for condition in ("grade <> 'A'", "grade = 'A'"):
        loans.where(condition).write.mode("append").partitionBy("part").parquet(path)
        incremental.refresh(spark.read.parquet(path), "part", wanted, root)
    return incremental.value_counts(incremental.stored_states(spark, root))


@query
def schema_catalog(spark, sf_dir):
    """Of the stored table, as a reader declares it."""
    path = scratch_path(spark, "catalogued")
    writers.write_parquet(fx.loans(spark, sf_dir), path)
    return profile.column_catalogue(readers.read_parquet(spark, path, LOAN_SCHEMA))


on_loans("record_count", cleaning.record_count)
on_loans("sample_rows", lambda loans: dates_as_text(cleaning.sample_rows(loans)))

# The widest table given, profiled by the same operators.
LINEITEM_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query
def lineitem_numeric_summary(spark, sf_dir):
    lineitem = fx.read_table(spark, sf_dir, "lineitem")
    summary = profile.numeric_summary(lineitem, LINEITEM_NUMBERS)
    return rounded(summary, 8, "avg_value", "stddev_value")


@query
def lineitem_value_counts(spark, sf_dir):
    lineitem = fx.read_table(spark, sf_dir, "lineitem")
    return profile.value_counts(lineitem, ["l_returnflag", "l_linestatus", "l_linenumber"])


# --- cleaning ------------------------------------------------------------------


@query
def clean_loans(spark, sf_dir):
    return dates_as_text(cleaning.clean_loans(raw_csv(spark, sf_dir)))


@query
def clean_report(spark, sf_dir):
    return cleaning.clean_report(raw_csv(spark, sf_dir))


@query
def unreadable_values(spark, sf_dir):
    return cleaning.unreadable_values(raw_csv(spark, sf_dir))


def on_raw(name: str, columns: Callable[[], dict]) -> None:
    """Some typed columns next to the id as it came."""
    QUERIES[name] = lambda spark, sf_dir: dates_as_text(
        raw_csv(spark, sf_dir).select(
            F.col("id").alias("raw_id"),
            *[column.alias(alias) for alias, column in columns().items()],
        )
    )


on_raw("parse_term", lambda: {"term": parse_term(F.col("term"))})
on_raw(
    "parse_mon_year",
    lambda: {c: parse_mon_year(F.col(c)) for c in ("issue_d", "earliest_cr_line")},
)
on_raw(
    "clean_numeric",
    lambda: {c: clean_numeric(F.col(c)) for c in ("int_rate", "revol_util", "annual_inc")},
)
on_raw(
    "to_int",
    lambda: {
        "id": to_int(F.col("id")),
        "delinq_2yrs": to_int(F.col("delinq_2yrs"), "int"),
        "revol_bal": to_int(F.col("revol_bal")),
        # A fraction to cut off, not to round.
        "util_floor": to_int(F.replace(F.col("revol_util"), F.lit("%"), F.lit(""))),
    },
)
on_raw(
    "clean_text",
    lambda: {c: clean_text(F.col(c)) for c in ("grade", "home_ownership", "emp_length")},
)


@query
def epoch_ms_dates(spark, sf_dir):
    staged = fx.loans_staged(spark, sf_dir)
    return dates_as_text(
        staged.select(
            "id",
            epoch_ms_to_date(F.col("issue_d")).alias("issue_d"),
            epoch_ms_to_date(F.col("earliest_cr_line")).alias("earliest_cr_line"),
        )
    )


@query
def restore_dates(spark, sf_dir):
    restored = cleaning.restore_dates(fx.loans_staged(spark, sf_dir))
    return dates_as_text(restored.select(*LOAN_SCHEMA.fieldNames()))


@query
def key_violations(spark, sf_dir):
    return validation.check_key(fx.loans_broken(spark, sf_dir))


@query
def rule_violations(spark, sf_dir):
    return validation.check_rules(fx.loans_broken(spark, sf_dir))


@query
def quarantine(spark, sf_dir):
    _, bad = validation.quarantine(fx.loans_broken(spark, sf_dir))
    return bad.select("id", "violated")


@query
def accepted_rows(spark, sf_dir):
    good, _ = validation.quarantine(fx.loans_broken(spark, sf_dir))
    return good.select("id", "loan_amnt", "term")


# --- sources and sinks ---------------------------------------------------------


@query
def csv_roundtrip(spark, sf_dir):
    return readers.read_raw_csv(spark, write_raw_csv(spark, sf_dir))


@query
def typed_csv_load(spark, sf_dir):
    path = scratch_path(spark, "typed-csv")
    writers.export_csv(fx.loans(spark, sf_dir), path)
    return dates_as_text(readers.load_typed_csv(spark, path, LOAN_SCHEMA))


@query
def snapshot_range(spark, sf_dir):
    path = scratch_path(spark, "snapshot")
    writers.snapshot(fx.loans(spark, sf_dir), path, "id", splits=4)
    return dates_as_text(readers.read_parquet(spark, path, LOAN_SCHEMA))


@query
def parquet_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "parquet")
    writers.write_parquet(fx.loans_staged(spark, sf_dir), path)
    return readers.read_parquet(spark, path, STAGED_LOAN_SCHEMA)


@query
def table_or_path(spark, sf_dir):
    path = scratch_path(spark, "loans-table")
    writers.save_table(fx.loans(spark, sf_dir), "lendspark_loans", path=path)
    return preparation.union_all(
        [
            readers.read_source(spark, source).agg(
                F.lit(kind).alias("source"),
                row_count().alias("total_rows"),
                F.sum("loan_amnt").alias("loan_amnt"),
            )
            for kind, source in (("table", "lendspark_loans"), ("path", path))
        ]
    )


@query
def curated_partitioned(spark, sf_dir):
    path = scratch_path(spark, "curated")
    writers.write_curated(fx.loans(spark, sf_dir), "lendspark_curated", path=path)
    curated = spark.table("lendspark_curated")
    return dates_as_text(curated.select(*LOAN_SCHEMA.fieldNames()))


@query
def published_versions(spark, sf_dir):
    """The curated table after a version was published and two more were refused."""
    root, table = scratch_path(spark, "published"), "lendspark_versions"
    loans = fx.loans(spark, sf_dir)
    versions.publish_curated(loans, table, root)
    for refused in (loans.withColumn("loan_amnt", -F.col("loan_amnt")), loans.union(loans.limit(1))):
        try:
            versions.publish_curated(refused, table, root)
        except ConstraintViolation:
            pass
    return dates_as_text(spark.table(table).select(*LOAN_SCHEMA.fieldNames()))


@query
def orc_publish(spark, sf_dir):
    report = business.default_rate_by_grade(fx.loans(spark, sf_dir))
    path = scratch_path(spark, "orc")
    writers.publish(report, "lendspark_q1_results", business.REPORT_SCHEMAS["q1"], path)
    return spark.table("lendspark_q1_results")


@query
def published_reports(spark, sf_dir):
    """All reports published, and what their tables then hold."""
    root = scratch_path(spark, "reports")
    tables = publish_reports(fx.loans(spark, sf_dir), root, prefix="lendspark_")
    return preparation.union_all(
        [
            spark.table(tables[report]).agg(
                F.lit(report).alias("report"),
                row_count().alias("n_rows"),
                F.sum(count).alias("counted"),
                F.round(F.sum(value), 6).alias("total"),
            )
            for report, (_, count, value) in fx.PUBLISHED.items()
        ]
    )


@query
def ingest_flow(spark, sf_dir):
    """Outcomes as counted by the flow, next to the rows found where they were stored."""
    root = scratch_path(spark, "ingested")
    path = write_raw_csv(spark, sf_dir)
    raw = readers.read_raw_csv(spark, path)
    outcomes = ingest(raw, "lendspark_ingested", f"{root}/rejects", f"{root}/curated")
    kept = spark.table("lendspark_ingested").select(F.lit("kept").alias("reason"), "id", "loan_amnt")
    rejects = readers.read_parquet(spark, f"{root}/rejects").select("reason", "id", "loan_amnt")
    stored = (
        kept.union(rejects)
        .groupBy("reason")
        .agg(
            row_count().alias("stored"),
            F.sum("id").cast("decimal(38,0)").alias("ids"),
            F.sum("loan_amnt").alias("loan_amnt"),
        )
    )
    return outcomes.withColumnRenamed("rows", "counted").join(stored, "reason", "full").withColumn(
        "ids", F.col("ids").cast("bigint")
    )


@query
def enforced_rules(spark, sf_dir):
    """What stops a load of broken rows."""
    try:
        validation.enforce(fx.loans_broken(spark, sf_dir))
        broken = {}
    except validation.ConstraintViolation as violation:
        broken = violation.counts
    return spark.createDataFrame(list(broken.items()), "rule STRING, violations BIGINT")


@query
def csv_export(spark, sf_dir):
    report = business.default_rate_by_grade_and_ownership(fx.loans(spark, sf_dir))
    path = scratch_path(spark, "export")
    writers.export_csv(report, path, order_by=["grade", "home_ownership"])
    return readers.load_typed_csv(spark, path, business.REPORT_SCHEMAS["q5"])


@query
def analyze_stats(spark, sf_dir):
    path = scratch_path(spark, "analyzed")
    writers.save_table(fx.loans(spark, sf_dir), "lendspark_analyzed", path=path)
    catalog.analyze(spark, "lendspark_analyzed")
    counted = catalog.table_statistics(spark, "lendspark_analyzed")["rows"]
    return spark.range(1).select(F.lit(counted).cast("bigint").alias("total_rows"))


# --- preparation ---------------------------------------------------------------


def _split(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    prepared = preparation.prepare_rows(fx.loans(spark, sf_dir))
    return preparation.temporal_split(prepared, fx.FIXTURE_CUTOFF)


def _both_sides(train: DataFrame, test: DataFrame) -> DataFrame:
    return train.withColumn("side", F.lit("train")).unionByName(
        test.withColumn("side", F.lit("test"))
    )


def _rounded_features(df: DataFrame) -> DataFrame:
    return rounded(df, 9, "issue_month_sin", "issue_month_cos")


@query
def datetime_features(spark, sf_dir):
    features = preparation.add_datetime_features(fx.loans(spark, sf_dir))
    return _rounded_features(
        features.select(
            "id",
            "issue_year",
            "issue_month",
            "issue_month_sin",
            "issue_month_cos",
            "credit_history_months",
        )
    )


@query
def prepare_rows(spark, sf_dir):
    return dates_as_text(
        _rounded_features(preparation.prepare_rows(fx.loans(spark, sf_dir)))
    )


@query
def temporal_split(spark, sf_dir):
    return _both_sides(*_split(spark, sf_dir)).select("id", "side")


@query
def mode_fill_map(spark, sf_dir):
    train, _ = _split(spark, sf_dir)
    modes = preparation.column_modes(train, NUMERIC_FEATURES + CATEGORICAL_FEATURES)
    return rounded(modes, 9, "number")


@query
def impute_modes(spark, sf_dir):
    filled = preparation.impute_modes(*_split(spark, sf_dir))
    return dates_as_text(_rounded_features(_both_sides(*filled)))


@query
def balance_train(spark, sf_dir):
    train, _ = _split(spark, sf_dir)
    return preparation.balance(train).groupBy("id", "label").agg(row_count().alias("copies"))


@query
def balance_train_drawn(spark, sf_dir):
    train, _ = _split(spark, sf_dir)
    drawn = preparation.balance(train, with_replacement=True)
    return drawn.groupBy("id", "label").agg(row_count().alias("copies"))


@query
def shuffled_train(spark, sf_dir):
    train, _ = _split(spark, sf_dir)
    balanced = preparation.balance(train, copy_column="copy")
    return preparation.shuffle_rows(balanced, ["id", "copy"]).select("id", "copy", "label")


def training_data(spark, sf_dir) -> TrainingData:
    return _shared(
        spark,
        sf_dir,
        "data",
        lambda: build_training_data(
            fx.loans(spark, sf_dir), scratch_path(spark, "training"), fx.FIXTURE_CUTOFF
        ),
    )


@query
def training_build(spark, sf_dir):
    """All datasets of a training run made anew, for the queries that follow."""
    key = (spark.sparkContext.applicationId, sf_dir, "data")
    _SHARED.pop(key, None)
    return rounded(training_data(spark, sf_dir).label_distribution(), 9, "share")


def baseline(spark, sf_dir, family) -> Fitted:
    return _shared(
        spark,
        sf_dir,
        ("baseline", family),
        lambda: fit_baseline(family, training_data(spark, sf_dir), scratch_path(spark, "fits")),
    )


def tuned(spark, sf_dir, family) -> Fitted:
    """The whole grid of the family; several of its models are fitted at a time."""
    search = Search(SEARCH_GRIDS[family], parallelism=8)
    return _shared(
        spark,
        sf_dir,
        ("tuned", family),
        lambda: fit_tuned(family, training_data(spark, sf_dir), scratch_path(spark, "fits"), search),
    )


def _every(fit, spark, sf_dir) -> dict[str, Fitted]:
    return {family: fit(spark, sf_dir, family) for family in FAMILIES}


@query
def encode_features(spark, sf_dir):
    """Vector length, entries other than zero, their places, and their sum."""
    data = training_data(spark, sf_dir)
    width = F.lit(data.feature_count)
    values = vector_to_array("features")
    places = F.filter(F.sequence(F.lit(0), width - 1), lambda i: F.get("x", i) != 0)
    total = lambda items: F.aggregate(items, F.lit(0.0), lambda a, b: a + b)
    return (
        data.train_encoded.unionByName(data.test_encoded)
        .withColumn("x", values)
        .select(
            "id",
            "label",
            F.size("x").alias("width"),
            F.size(places).alias("nonzero"),
            total(F.transform(places, lambda i: i.cast("double"))).cast("bigint").alias("places"),
            F.round(total(F.col("x")), 4).alias("total"),
        )
    )


@query
def label_distribution(spark, sf_dir):
    return rounded(training_data(spark, sf_dir).label_distribution(), 9, "share")


@query
def split_summary(spark, sf_dir):
    return training_data(spark, sf_dir).split_summary()


@query
def summary_tables(spark, sf_dir):
    """One summary written, registered as an external table, and read by name."""
    root = scratch_path(spark, "summaries")
    data = training_data(spark, sf_dir)
    catalog.publish_dashboard({"label_distribution": data.label_distribution()}, root)
    catalog.create_database(spark, "lendspark_summaries")
    tables = catalog.register_summaries(
        spark, root, "lendspark_summaries", names=["label_distribution"]
    )
    return rounded(spark.table(tables["label_distribution"]), 9, "share")


@query
def json_artifact(spark, sf_dir):
    """Both sides as JSON, read back."""
    root = scratch_path(spark, "json")
    save_artifacts(training_data(spark, sf_dir), {}, root)
    schema = (
        "features STRUCT<type: INT, size: INT, indices: ARRAY<INT>, values: ARRAY<DOUBLE>>,"
        " label DOUBLE"
    )
    nonzero = F.size(F.filter("features.values", lambda x: x != 0))
    sides = [
        spark.read.schema(schema).json(f"{root}/{side}").withColumn("side", F.lit(side))
        for side in ("train", "test")
    ]
    return (
        preparation.union_all(sides)
        .groupBy("side", "label")
        .agg(row_count().alias("total_rows"), F.sum(nonzero).alias("nonzero"))
    )


# --- evaluation ----------------------------------------------------------------


@query
def confusion_counts(spark, sf_dir):
    return evaluation.confusion(fx.scores(spark, sf_dir))


@query
def threshold_metrics(spark, sf_dir):
    counts = evaluation.confusion(fx.scores(spark, sf_dir))
    metrics = evaluation.threshold_metrics(counts)
    return rounded(metrics, 9, "accuracy", "precision", "recall", "f1")


@query
def auc_roc_pr(spark, sf_dir):
    areas = evaluation.ranking_areas(fx.scores(spark, sf_dir))
    return rounded(areas, 9, "areaUnderROC", "areaUnderPR")


@query
def prediction_distribution(spark, sf_dir):
    scores = fx.scores(spark, sf_dir)
    strict = scores.withColumn("prediction", (F.col("score") >= 0.7).cast("double"))
    return evaluation.prediction_distribution({"half": scores, "strict": strict})


# --- models --------------------------------------------------------------------


def consistent(fits: list[Fitted], with_params: bool = False) -> DataFrame:
    """What is the same for whatever a model predicts: how many rows it was measured on,
    and whether its metrics follow from its counts, its areas lie in between, and its
    parameters are told."""
    total = F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")
    near = lambda name, value: F.abs(F.col(name) - value) < 1e-9
    metrics = evaluation.threshold_metrics
    rows = preparation.union_all([fit.metrics(with_params) for fit in fits])
    again = preparation.union_all(
        [
            metrics(evaluation.confusion(fit.predictions)).select(
                F.lit(fit.family).alias("model"),
                *[F.col(name).alias(f"own_{name}") for name in ("accuracy", "precision", "recall", "f1", "tp", "fp")],
                F.lit(fit.combinations).alias("combinations"),
            )
            for fit in fits
        ]
    )
    agrees = (
        (F.col("tp") == F.col("own_tp"))
        & (F.col("fp") == F.col("own_fp"))
        & F.col("areaUnderROC").between(0, 1)
        & F.col("areaUnderPR").between(0, 1)
    )
    for name in ("accuracy", "precision", "recall", "f1"):
        agrees = agrees & near(name, F.col(f"own_{name}"))
    if with_params:
        agrees = agrees & (F.length("best_params") > 0)
    return rows.join(again, "model").select(
        "model",
        total.alias("total_rows"),
        (F.col("tp") + F.col("fn")).alias("positives"),
        agrees.alias("agrees"),
        "combinations",
    )


@query
def baseline_rf(spark, sf_dir):
    return consistent([baseline(spark, sf_dir, RANDOM_FOREST)])


@query
def baseline_svc(spark, sf_dir):
    return consistent([baseline(spark, sf_dir, LINEAR_SVC)])


@query
def baseline_nb(spark, sf_dir):
    metrics = baseline(spark, sf_dir, NAIVE_BAYES).metrics()
    return rounded(
        metrics, 5, "accuracy", "precision", "recall", "f1", "areaUnderROC", "areaUnderPR"
    )


@query
def tuned_rf(spark, sf_dir):
    return consistent([tuned(spark, sf_dir, RANDOM_FOREST)], with_params=True)


@query
def tuned_svc(spark, sf_dir):
    return consistent([tuned(spark, sf_dir, LINEAR_SVC)], with_params=True)


@query
def tuned_nb(spark, sf_dir):
    return consistent([tuned(spark, sf_dir, NAIVE_BAYES)], with_params=True)


@query
def model_comparison(spark, sf_dir):
    return consistent(list(_every(baseline, spark, sf_dir).values()))


@query
def model_prediction_distribution(spark, sf_dir):
    """Rows per model and true label; how they are predicted is the model's affair."""
    fits = _every(tuned, spark, sf_dir)
    counts = evaluation.prediction_distribution(
        {family: fit.predictions for family, fit in fits.items()}
    )
    return counts.groupBy("model", "label").agg(F.sum("count").alias("count"))


@query
def sample_predictions(spark, sf_dir):
    """The sampled rows in full, and whether what the models say of them fits together."""
    fits = _every(tuned, spark, sf_dir)
    sample = evaluation.sample_predictions(
        training_data(spark, sf_dir).test_raw,
        {PREFIXES[family]: fit.predictions for family, fit in fits.items()},
    )
    agrees = F.lit(True)
    for prefix in PREFIXES.values():
        said = F.col(f"{prefix}_predicted_status") == "Charged Off"
        agrees = agrees & (said == (F.col(f"{prefix}_prediction") == 1.0))
    given = [name for name in sample.columns if not name.startswith(tuple(PREFIXES.values()))]
    return dates_as_text(_rounded_features(sample.select(*given, agrees.alias("agrees"))))


@query
def joined_outputs(spark, sf_dir):
    scores = fx.scores(spark, sf_dir)
    return evaluation.join_model_outputs(
        scores.select("id", "label"), {"m": scores.select("id", "prediction")}
    )


@query
def colocated_outputs(spark, sf_dir):
    """Rows joined in place with two models, one of which says nothing of some rows."""
    scores = fx.scores(spark, sf_dir)
    return modelling.joined_outputs(
        scores.select("id", "label"),
        {
            "m": scores.where("label = 1").select("id", "prediction"),
            "other": scores.select("id", (1 - F.col("prediction")).alias("prediction")),
        },
        scratch_path(spark, "colocated"),
    )


@query
def training_artifacts(spark, sf_dir):
    """Per model: rows in its saved predictions, rows in its saved metrics, and rows that
    the saved model, read again, predicts otherwise."""
    root = scratch_path(spark, "artifacts")
    fits = _every(baseline, spark, sf_dir)
    data = training_data(spark, sf_dir)
    save_artifacts(data, fits, root)
    loaders = {NAIVE_BAYES: PipelineModel}
    rows = []
    for family, fit in fits.items():
        model = loaders.get(family, type(fit.model)).load(f"{root}/{family}/model")
        again = model.transform(data.test_encoded).select("id", F.col("prediction").alias("again"))
        changed = fit.predictions.join(again, "id").agg(
            F.lit(family).alias("model"), F.count_if(F.col("prediction") != F.col("again")).alias("changed")
        )
        saved = readers.load_typed_csv(
            spark, f"{root}/{family}/predictions", "label DOUBLE, prediction DOUBLE"
        ).agg(F.lit(family).alias("model"), row_count().alias("stored"))
        metrics = spark.read.csv(f"{root}/{family}/metrics", header=True).select(
            "model", sum((F.col(c).cast("bigint") for c in ("tn", "fp", "fn")), F.col("tp").cast("bigint")).alias("evaluated")
        )
        rows.append(saved.join(metrics, "model").join(changed, "model"))
    return preparation.union_all(rows)


@query
def model_roundtrip(spark, sf_dir):
    """Predictions of a saved and reloaded model against those of the original."""
    fit = baseline(spark, sf_dir, RANDOM_FOREST)
    path = scratch_path(spark, "model")
    writers.save_model(fit.model, path)
    again = RandomForestClassificationModel.load(path)
    test = training_data(spark, sf_dir).test_encoded
    reloaded = again.transform(test).select("id", F.col("prediction").alias("reloaded"))
    return (
        fit.predictions.select("id", "prediction")
        .join(reloaded, "id")
        .agg(
            row_count().alias("total_rows"),
            F.count_if(F.col("prediction") != F.col("reloaded")).alias("changed"),
        )
    )


@query
def saved_predictions(spark, sf_dir):
    path = scratch_path(spark, "predictions")
    writers.save_predictions(fx.scores(spark, sf_dir), path)
    return readers.load_typed_csv(spark, path, "label DOUBLE, prediction DOUBLE")


@query
def dashboard_package(spark, sf_dir):
    """All six summaries published together, and what is exact in each, read by its table."""
    data = training_data(spark, sf_dir)
    tuned_fits = _every(tuned, spark, sf_dir)
    root = scratch_path(spark, "dashboard")
    catalog.publish_dashboard(
        {
            "split_summary": data.split_summary(),
            "feature_info": preparation.feature_info(spark),
            "label_distribution": data.label_distribution(),
            "baseline_evaluation": comparison(_every(baseline, spark, sf_dir)),
            "evaluation": comparison(tuned_fits, with_params=True),
            "prediction_distribution": evaluation.prediction_distribution(
                {family: fit.predictions for family, fit in tuned_fits.items()}
            ),
        },
        root,
    )
    catalog.create_database(spark, "lendspark_dashboard")
    tables = catalog.register_summaries(spark, root, "lendspark_dashboard")
    whole = lambda name: F.col(name).cast("int").cast("string")
    total = F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")
    items = {
        "split_summary": (F.col("dataset"), F.col("rows")),
        "feature_info": (F.col("feature_name"), F.lit(0)),
        "label_distribution": (F.concat("dataset", F.lit(" "), whole("label")), F.col("count")),
        "baseline_evaluation": (F.col("model"), total),
        "evaluation": (F.col("model"), total),
        "prediction_distribution": (F.concat("model", F.lit(" "), whole("label")), F.col("count")),
    }
    return preparation.union_all(
        [
            spark.table(tables[name])
            .groupBy(F.lit(name).alias("summary"), item.alias("item"))
            .agg(F.sum(number).cast("bigint").alias("counted"))
            for name, (item, number) in items.items()
        ]
    )
