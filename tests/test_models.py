import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LinearSVC
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from checks import registry
from lendspark.operators import bayes_search, blocks, evaluation, forest_search, growing, held_out, margin_search, training
from lendspark.operators.training import LINEAR_SVC, NAIVE_BAYES, RANDOM_FOREST, Search
from lendspark.plans import modelling
from lendspark.session import checkpoint_root
from lendspark.sources import writers
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def data(spark):
    return registry.training_data(spark, SMALL)


def scored(spark, n=2000, levels=97, seed=3):
    random.seed(seed)
    rows = []
    for i in range(n):
        label = float(random.random() < 0.3)
        score = (random.randint(0, levels) + 20 * label) / 100
        rows.append((i, label, float(score > 0.5), Vectors.dense(-score, score), score))
    return spark.createDataFrame(rows, ["id", "label", "prediction", "rawPrediction", "score"])


@pytest.mark.parametrize("levels", [3, 97, 10**6])
def test_areas_equal_those_of_the_evaluator(spark, levels):
    df = scored(spark, levels=levels)
    row = evaluation.ranking_areas(df).first()
    for metric in ("areaUnderROC", "areaUnderPR"):
        expected = BinaryClassificationEvaluator(metricName=metric, numBins=0).evaluate(df)
        assert row[metric] == pytest.approx(expected, abs=1e-12)


@pytest.mark.parametrize("label, areas", [(1.0, (1.0, 1.0)), (0.0, (0.0, 0.0))])
def test_areas_of_a_single_class(spark, label, areas):
    df = scored(spark, 50).withColumn("label", F.lit(label))
    assert tuple(evaluation.ranking_areas(df).first()) == areas


def test_evaluate_is_consistent(spark):
    df = scored(spark)
    row = evaluation.evaluate(df, "m").first()
    counts = evaluation.confusion(df).first()
    assert [row[c] for c in ("tp", "tn", "fp", "fn")] == [counts[c] for c in ("tp", "tn", "fp", "fn")]
    assert row["accuracy"] == (row["tp"] + row["tn"]) / 2000
    precision, recall = row["precision"], row["recall"]
    assert row["f1"] == pytest.approx(2 * precision * recall / (precision + recall))
    assert row["areaUnderROC"] == evaluation.ranking_areas(df).first()["areaUnderROC"]


def test_metrics_without_predicted_positives(spark):
    df = scored(spark, 100).withColumn("prediction", F.lit(0.0))
    row = evaluation.threshold_metrics(evaluation.confusion(df)).first()
    assert (row["precision"], row["recall"], row["f1"]) == (0.0, 0.0, 0.0)
    none = evaluation.threshold_metrics(evaluation.confusion(df.limit(0))).first()
    assert (none["accuracy"], none["tp"]) == (0.0, 0)


def test_search_grids_are_complete():
    for family, grid in training.SEARCH_GRIDS.items():
        estimator = training.search_estimator(family)
        maps = training.param_maps(estimator, grid)
        assert len(maps) == 27 and all(len(m) == 3 for m in maps)


def test_thresholds_do_not_change_the_area(data):
    grid = {"thresholds": [[1.0, 1.0], [1.0, 2.0], [2.0, 1.0]]}
    metrics = training.tune(NAIVE_BAYES, data.train_balanced, Search(grid, folds=2)).avgMetrics
    assert metrics == pytest.approx([metrics[0]] * 3, abs=1e-12)


def test_every_combination_is_tried(data):
    found = training.tune(NAIVE_BAYES, data.train_balanced.limit(200), Search(training.SEARCH_GRIDS[NAIVE_BAYES], folds=2))
    assert len(found.avgMetrics) == 27


def test_shared_statistics_score_as_fits_do(data, spark):
    """All 27 averages, by one pass of sums against 81 fits."""
    search = Search(training.SEARCH_GRIDS[NAIVE_BAYES], parallelism=4)
    tracker = spark.sparkContext.statusTracker()
    train = data.train_balanced
    spark.sparkContext.setJobGroup("shared", "shared")
    shared = training.tune(NAIVE_BAYES, train, search)
    jobs = len(tracker.getJobIdsForGroup("shared"))
    spark.sparkContext.setJobGroup("one", "one")
    training.tune(NAIVE_BAYES, train, Search({"smoothing": [1.0]}))
    assert 0 < jobs <= len(tracker.getJobIdsForGroup("one")) + 2
    spark.sparkContext.setJobGroup("fits", "fits")
    fits = training.tune_by_fits(training.search_estimator(NAIVE_BAYES), train, search)
    assert shared.avgMetrics == pytest.approx(fits.avgMetrics, abs=1e-9)
    assert shared.bestModel.stages[-1].getSmoothing() == fits.bestModel.stages[-1].getSmoothing()


def test_margins_of_all_combinations_are_fitted_by_the_same_passes(data, spark):
    """As low a loss as Spark's own fits reach, in far fewer jobs than there are fits."""
    train = training.spread(data.train_balanced).persist()
    folded = bayes_search.random_folds(train, 3, 1).persist()
    settings = [(0.001, 1e-6), (0.1, 1e-6), (0.1, 1e-4)]
    parts = margin_search.training_parts(folded, 3)
    packed = blocks.feature_blocks(folded).persist()
    models = margin_search.fitted(packed, parts, settings, 100)
    for k, (penalty, tol) in enumerate(settings):
        part = folded.where("fold <> 1")
        own = LinearSVC(regParam=penalty, tol=tol).fit(part).summary().objectiveHistory[-1]
        weights = models[1, k]
        sums = margin_search.hinge_sums(packed, models[1, k : k + 1], np.array([1]))[0]
        scaled = np.divide(weights[:-1], parts[1].scale, out=np.zeros(len(weights) - 1), where=parts[1].scale > 0)
        assert parts[1].count == part.count()
        assert sums[-1] / parts[1].count + penalty / 2 * (scaled @ scaled) <= own + 1e-3 * (tol / 1e-6) ** 0.25
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("margins", "margins")
    found = training.tune(LINEAR_SVC, data.train_balanced, Search(training.SEARCH_GRIDS[LINEAR_SVC]))
    # 81 fits of up to a hundred steps each would be thousands.
    assert len(tracker.getJobIdsForGroup("margins")) < 600
    averages = np.array(found.avgMetrics).reshape(3, 3, 3)
    assert (averages == averages[:, :, :1]).all() and (averages > 0.4).all()


def test_smaller_forests_are_parts_of_larger_ones(data, spark):
    rows = data.train_encoded.select("features", F.monotonically_increasing_id().alias("id"), "label").persist()
    x = np.array([row["features"].toArray() for row in rows.orderBy("id").select("features").collect()])
    for depth in (3, 7):
        model = training.search_estimator(RANDOM_FOREST).setNumTrees(8).setMaxDepth(depth).fit(rows)
        grown = forest_search.trees(spark, model)
        raw = [row["rawPrediction"][1] for row in model.transform(rows).orderBy("id").select("rawPrediction").collect()]
        assert sum(tree.shares(x, tree.cut(depth)) for tree in grown) == pytest.approx(np.array(raw), abs=1e-9)
    # The first level needs no draws of later ones: cut trees split as they do whole.
    stumps = [tree.cut(1) for tree in grown]
    assert all(leaf.sum() >= 1 and len(set(tree.shares(x, leaf))) <= 2 for tree, leaf in zip(grown, stumps))
    grid = {"numTrees": [3, 6], "maxDepth": [2, 4], "minInstancesPerNode": [5, 10]}
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("parts", "parts")
    found = training.tune(RANDOM_FOREST, data.train_balanced, Search(grid, folds=2))
    jobs = len(tracker.getJobIdsForGroup("parts"))
    spark.sparkContext.setJobGroup("each", "each")
    each = training.tune_by_fits(training.search_estimator(RANDOM_FOREST), data.train_balanced, Search(grid, folds=2))
    assert jobs < len(tracker.getJobIdsForGroup("each")) / 1.5
    assert len(found.avgMetrics) == 8
    assert np.array(found.avgMetrics) == pytest.approx(np.array(each.avgMetrics), abs=0.05)


def test_training_data_lies_in_files_for_all_tasks(data, spark):
    for frame in (data.prepared, data.train_raw, data.train_balanced, data.test_encoded):
        assert len(frame.inputFiles()) >= spark.sparkContext.defaultParallelism


def test_rows_of_few_files_are_spread(data, spark):
    frame = training.spread(data.train_balanced.coalesce(1))
    assert frame.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert frame.count() == data.train_balanced.count()


def test_a_training_part_without_a_class_is_left_to_fits(data, spark):
    few = data.train_balanced.where("label = 1.0").limit(6)
    from lendspark.operators import bayes_search

    folded = bayes_search.random_folds(few, 3, 1)
    assert bayes_search.fold_metrics(folded, 3, [(1.0, 1.0)], "areaUnderPR") is None


def test_predictions_are_joined_where_they_lie(spark, tmp_path):
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        rows = scored(spark, 3000)
        if "id" not in rows.columns:
            rows = rows.withColumn("id", F.monotonically_increasing_id())
        rows = rows.select("id", "label", "prediction").persist()
        models = {"a": rows.select("id", "prediction"), "b": rows.where("id % 3 = 0").select("id", "prediction")}
        joined = modelling.joined_outputs(rows.select("id", "label"), models, str(tmp_path), buckets=4)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and plan.count("SortMergeJoin") == 4
        found = joined.collect()
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert len(found) == rows.count()
        assert all((r["b_prediction"] is not None) == (r["id"] % 3 == 0) and r["a_prediction"] is not None for r in found)
        rows.unpersist()
    finally:
        spark.conf.set(threshold, before)


def test_metrics_of_no_predictions_are_one_row_of_zeros(spark):
    rows = evaluation.evaluate(scored(spark, 5).limit(0), "none").collect()
    assert [tuple(row) for row in rows] == [("none", *[0.0] * 6, *[0] * 4)]


def test_nothing_is_left_in_the_shared_folder(spark):
    root = Path(checkpoint_root(spark).removeprefix("file:"))
    before = set(root.iterdir())
    evaluation.ranking_areas(scored(spark, 50)).collect()
    evaluation.evaluate(scored(spark, 50), "m").collect()
    assert set(root.iterdir()) == before


@pytest.fixture(autouse=True)
def _context(spark):
    """Estimators need a running session."""


def test_unknown_family():
    with pytest.raises(ValueError):
        training.baseline_estimator("Tree")
    with pytest.raises(ValueError):
        training.search_estimator("Tree")


def test_copies_share_a_fold(data):
    folds = training.with_folds(data.train_balanced, 3)
    per_row = folds.groupBy("id").agg(F.count_distinct("fold").alias("n"))
    assert per_row.where("n > 1").count() == 0
    assert {r["fold"] for r in folds.select("fold").distinct().collect()} == {0, 1, 2}


def test_search_with_grouped_copies(data):
    search = Search({"smoothing": [0.5, 1.0]}, folds=2, group_copies=True)
    model = training.tune(NAIVE_BAYES, data.train_balanced, search)
    assert len(model.avgMetrics) == 2
    assert "__smoothing=" in training.describe_params(model.bestModel)


def test_params_in_words(data):
    model = training.baseline_estimator(RANDOM_FOREST).fit(data.train_balanced)
    pairs = training.describe_params(model).split("; ")
    assert pairs == sorted(pairs) and "numTrees=10" in pairs and "maxDepth=3" in pairs


def test_bayes_scores_rows_below_the_training_range(data):
    model = training.baseline_estimator(NAIVE_BAYES).fit(data.train_balanced)
    far = data.test_encoded.limit(5).withColumn(
        "features", array_to_vector(F.array_repeat(F.lit(-1e9), data.feature_count))
    )
    assert model.transform(far).where("prediction IS NOT NULL").count() == 5


@pytest.mark.parametrize("family", [LINEAR_SVC, NAIVE_BAYES])
def test_saved_model_predicts_the_same(data, tmp_path, family):
    model = training.baseline_estimator(family).fit(data.train_balanced)
    path = str(tmp_path / "model")
    for _ in range(2):
        writers.save_model(model, path)
    loader = PipelineModel if family == NAIVE_BAYES else type(model)
    again = loader.load(path)
    rows = lambda m: [tuple(r) for r in m.transform(data.test_encoded).select("id", "prediction").orderBy("id").collect()]
    assert rows(model) == rows(again)


def test_sample_has_lowest_ids_and_keeps_rows_without_predictions(spark):
    raw = spark.createDataFrame(
        [(i, "Fully Paid", 0.0) for i in range(30, 0, -1)], "id INT, loan_status STRING, label DOUBLE"
    )
    predictions = spark.createDataFrame([(1, 1.0), (2, 0.0), (2, 1.0)], "id INT, prediction DOUBLE")
    rows = evaluation.sample_predictions(raw, {"m": predictions}, 3).orderBy("id", "m_prediction").collect()
    # An id predicted twice shows twice, one without prediction stays.
    assert [(r["id"], r["m_predicted_status"]) for r in rows] == [
        (1, "Charged Off"),
        (2, "Fully Paid"),
        (2, "Charged Off"),
        (3, None),
    ]
    assert rows[0]["actual_status"] == "Fully Paid" and "m_score_charged_off" not in rows[0]


def test_better_than_chance_on_real_structure(data):
    row = evaluation.evaluate(
        training.baseline_estimator(RANDOM_FOREST).fit(data.train_balanced).transform(data.train_encoded), "rf"
    ).first()
    assert row["areaUnderROC"] > 0.6


def test_areas_of_held_out_rows_equal_those_of_the_evaluator(spark, monkeypatch):
    """Scores cut into many ranges, some of one value only, give the same areas."""
    monkeypatch.setattr(held_out, "RANGE_ROWS", 100)
    monkeypatch.setattr(held_out, "BUFFERED_ROWS", 300)
    random.seed(5)
    made = [(i % 3, random.choice([0.0, 0.0, round(random.random(), 2), random.random()]), i) for i in range(3000)]
    rows = [(f, Vectors.dense(x, float(i % 2)), float(random.random() < 0.2 + x / 2)) for f, x, i in made]
    df = spark.createDataFrame(rows, ["fold", "features", "label"])
    packed = blocks.feature_blocks(df.repartition(4))
    scored_by = [lambda x: np.column_stack([x[:, 0], -x[:, 0]])] * 3
    for metric in ("areaUnderROC", "areaUnderPR"):
        found = held_out.held_out_areas(packed, blocks.block_scores(scored_by), 3, 2, 3000, metric)
        for fold in range(3):
            for model, sign in enumerate((1, -1)):
                raw = spark.createDataFrame([(sign * float(v[0]), y) for f, v, y in rows if f == fold], ["score", "label"])
                assert found[fold, model] == pytest.approx(evaluation.ranking_areas(raw).first()[metric], abs=1e-12)


def test_packed_rows_come_back_as_they_were(spark):
    """Copies are counted per fold; no digit is lost, whatever bytes a column takes."""
    random.seed(6)
    rows = []
    for i in range(2000):
        x = Vectors.dense(float(i % 2), random.random(), random.randint(0, 9) / 3, i * 1.0, 1e300 * i)
        rows += [(i, x, float(i % 5 == 0), k % 3) for k in range(1 + i % 4)]
    df = spark.createDataFrame(rows, ["id", "features", "label", "fold"]).coalesce(1)
    taken = blocks.feature_blocks(df).toArrow().to_batches()
    back = [block for block in blocks.unpacked(iter(taken), 3)]
    x, label = (np.concatenate([block[k] for block in back]) for k in (0, 1))
    held = np.concatenate([block[2] for block in back], axis=1)
    assert held.sum() == len(rows) and held.shape[0] == 3 and len(x) < 2010
    again = np.repeat(np.column_stack([x, label]), held.sum(axis=0), axis=0)
    assert (again == np.array([[*row[1], row[2]] for row in rows])).all()


def test_fits_that_differ_in_tolerance_share_their_passes(data, spark, monkeypatch):
    folded = bayes_search.random_folds(training.spread(data.train_balanced).persist(), 2, 1).persist()
    parts = margin_search.training_parts(folded, 2)
    packed = blocks.feature_blocks(folded).persist()
    widths, own = [], margin_search.hinge_sums

    def counted(rows, models, folds):
        widths.append(len(models))
        return own(rows, models, folds)

    monkeypatch.setattr(margin_search, "hinge_sums", counted)
    together = margin_search.fitted(packed, parts, [(0.01, 1e-6), (0.01, 1e-3)], 30)
    assert max(widths) == 2
    for k, tol in enumerate((1e-6, 1e-3)):
        alone = margin_search.fitted(packed, parts, [(0.01, tol)], 30)
        assert together[:, k] == pytest.approx(alone[:, 0], rel=1e-6, abs=1e-9)


def grown_by_hand(bins, label, taken, drawn, depth, least):
    """Splits per node of a tree, each found by counting rows one way after another."""
    splits, at = {}, {(0, 0): np.arange(len(label))}
    gini = lambda y, w: 1 - (np.average(y, weights=w) ** 2 + (1 - np.average(y, weights=w)) ** 2)
    for level in range(depth):
        for place in range(1 << level):
            rows = at.get((level, place))
            if rows is None:
                continue
            best = (0.0, None)
            y, w = label[rows], taken[rows]
            for feature in drawn(level, place):
                for cut in range(bins[feature].max()):
                    left = bins[feature][rows] <= cut
                    if w[left].sum() < least or w[~left].sum() < least:
                        continue
                    parts = sum(gini(y[s], w[s]) * w[s].sum() for s in (left, ~left)) / w.sum()
                    if gini(y, w) - parts > best[0] + 1e-12:
                        best = (gini(y, w) - parts, (feature, cut))
            if best[1] and 0 < np.average(y, weights=w) < 1:
                splits[(level, place)] = best[1]
                left = bins[best[1][0]][rows] <= best[1][1]
                at[(level + 1, 2 * place)], at[(level + 1, 2 * place + 1)] = rows[left], rows[~left]
    return splits


def test_forests_grown_together_split_as_trees_grown_by_hand(spark):
    draw = np.random.default_rng(7)
    x = np.column_stack([draw.integers(0, 2, 1500), draw.integers(0, 40, 1500), draw.random(1500)]).astype(float)
    y = (draw.random(1500) < 0.2 + 0.3 * x[:, 0] + 0.3 * (x[:, 1] > 25)).astype(float)
    rows = [(Vectors.dense(v), float(t), i % 2) for i, (v, t) in enumerate(zip(x.tolist(), y))]
    df = spark.createDataFrame(rows, ["features", "label", "fold"]).repartition(3)
    splits = [growing.split_points(column, 8) for column in x.T]
    assert [len(points) for points in splits] == [1, 7, 7]
    binned = growing.binned_blocks(blocks.feature_blocks(df), splits, 2).persist()
    grown = growing.grow(binned, 2, 3, 4, [5, 100], [len(points) + 1 for points in splits], 11)
    assert sorted({(t.fold, t.number, least) for t in grown for least in t.leasts}) == [
        (fold, number, least) for fold in range(2) for number in range(3) for least in (5, 100)
    ]
    parts = list(growing._binned(iter(binned.toArrow().to_batches()), 2))
    table = growing._poisson_table()
    bins = np.concatenate([part[1] for part in parts], axis=1) // 2
    label = np.concatenate([part[2] for part in parts]).astype(float)
    for tree in grown:
        taken = np.concatenate(
            [growing._bag(table, [11, tree.fold, tree.number, key], held[1 - tree.fold]) for key, _, _, held in parts]
        )
        at = lambda level, place: growing.drawn_features(
            11, growing.replace(tree, open=np.array([place])), level, 3, 2
        )[0]
        for least in tree.leasts:
            expected = grown_by_hand(bins, label, taken, at, 4, least)
            inner = {
                (level, place): (int(tree.feature[(1 << level) - 1 + place]), int(tree.cut[(1 << level) - 1 + place]) // 2)
                for level in range(4)
                for place in range(1 << level)
                if tree.feature[(1 << level) - 1 + place] >= 0
            }
            assert inner == expected
    # Bags take each copy once on average.
    many = growing._bag(table, [1, 2, 3], np.full(100_000, 3))
    assert abs(many.mean() - 3) < 0.03 and abs(many.var() - 3) < 0.06


    # Rows end where a walk down the tree ends, and get the share of what is left of it there.
    settings = [(1, 2, 5), (3, 4, 100), (2, 3, 5)]
    one = parts[0]
    batch = binned.limit(1).toArrow().to_batches()
    for fold, found, _, held in growing.forest_scores(grown, 2, settings)(iter(batch), 1):
        rows = np.flatnonzero(one[3][fold])
        assert len(rows) == len(found) and held.sum() == one[3][fold].sum()
        for column, (number, depth, least) in enumerate(settings):
            own = [t for t in grown if t.fold == fold and least in t.leasts and t.number < number]
            expected = [sum(walked(t, one[1][:, row], depth) for t in own) for row in rows[:200]]
            assert found[:200, column] == pytest.approx(np.array(expected), abs=1e-12)


def walked(tree, bins, depth):
    """The share where a row ends; subtrees whose leaves all vote alike are leaves."""

    def votes(node, level):
        vote = bool(tree.counts[node][1] > tree.counts[node][0])
        if level == depth or tree.feature[node] < 0:
            return {vote}
        return votes(2 * node + 1, level + 1) | votes(2 * node + 2, level + 1)

    node = level = 0
    while len(votes(node, level)) > 1:
        node = 2 * node + 1 + int(bins[tree.feature[node]] > tree.cut[node])
        level += 1
    return tree.counts[node][1] / tree.counts[node].sum()


def test_forests_of_a_search_need_a_pass_per_level(data, spark, monkeypatch):
    monkeypatch.setattr(forest_search, "FEW_ROWS", 0)
    grid = {"numTrees": [2, 4], "maxDepth": [2, 4], "minInstancesPerNode": [5, 10, 20]}
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("levels", "levels")
    found = training.tune(RANDOM_FOREST, data.train_balanced, Search(grid, folds=3))
    jobs = len(tracker.getJobIdsForGroup("levels"))
    spark.sparkContext.setJobGroup("refit", "refit")
    training.search_estimator(RANDOM_FOREST).setNumTrees(4).setMaxDepth(4).fit(data.train_balanced)
    refit = len(tracker.getJobIdsForGroup("refit"))
    # Nine forests by Spark would take more than nine times the jobs of one.
    assert jobs < 5 * refit and len(found.avgMetrics) == 12
    assert all(0.4 < value < 1 for value in found.avgMetrics)


def test_very_deep_forests_are_fitted_by_spark(data, monkeypatch):
    monkeypatch.setattr(forest_search, "FEW_ROWS", 0)
    few = data.train_balanced
    search = Search({"numTrees": [1, 2], "maxDepth": [growing.DEEPEST + 1]}, folds=2)
    assert all(0.3 < value <= 1 for value in training.tune(RANDOM_FOREST, few, search).avgMetrics)
