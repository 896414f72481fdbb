import pytest
from py4j.protocol import Py4JJavaError
from pyspark.ml.classification import DecisionTreeClassificationModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from testbed import catalog
from tests.conftest import DATA
from tests.frames import rows
from upkeep import learning, sinks
from upkeep.fixed import FEATURES, KEYS, LABEL, LABELS, NEGATIVE, POSITIVE
from upkeep.plans import train_and_evaluate

SF = f"{DATA}/sf0.01"


@pytest.fixture(scope="module")
def matrix(spark):
    frame = catalog.matrix(spark, SF).persist()
    yield frame
    frame.unpersist()


@pytest.fixture(scope="module")
def trained(matrix):
    return learning.train(matrix)


def tree_of(model):
    return next(s for s in model.stages if isinstance(s, DecisionTreeClassificationModel))


def predictions(trained):
    return learning.predict(trained.model, trained.validation)


def test_fixed_order_does_not_depend_on_the_majority(spark):
    mostly_positive = spark.createDataFrame(
        [(POSITIVE,)] * 3 + [(NEGATIVE,)], f"{LABEL} string"
    )
    fixed = learning.label_index(mostly_positive, order="fixed")
    assert {r["label"]: r["label_index"] for r in fixed.collect()} == {NEGATIVE: 0.0, POSITIVE: 1.0}
    frequent = learning.label_index(mostly_positive)
    assert {r["label"]: r["label_index"] for r in frequent.collect()} == {
        NEGATIVE: 1.0,
        POSITIVE: 0.0,
    }
    tied = spark.createDataFrame([(POSITIVE,), (NEGATIVE,)], f"{LABEL} string")
    assert list(learning.label_indexer(tied, order="frequencyDesc").labels) == LABELS


def test_predictions_and_verdicts_belong_together(trained):
    found = predictions(trained).select("prediction", "verdict").distinct().collect()
    assert {(r["prediction"], r["verdict"]) for r in found} == {(0.0, NEGATIVE), (1.0, POSITIVE)}


def test_verdict_follows_the_labels_in_any_order(matrix):
    model = learning.train(matrix, label_order="frequencyDesc", maxDepth=2).model
    found = learning.predict(model, matrix).select("indexedLabel", LABEL).distinct().collect()
    index = {r[LABEL]: r["indexedLabel"] for r in found}
    verdicts = learning.predict(model, matrix).select("prediction", "verdict").distinct()
    assert all(index[r["verdict"]] == r["prediction"] for r in verdicts.collect())


def test_same_rows_give_the_same_tree(spark, trained, tmp_path):
    # sf0.1 has more training rows than MLlib looks at without sampling.
    path = str(tmp_path / "matrix")
    catalog.matrix(spark, f"{DATA}/sf0.1").write.parquet(path)
    stored = spark.read.parquet(path)
    trees = [
        tree_of(learning.train(frame, partitions=8).model).toDebugString.split("\n", 1)[1]
        for frame in (stored.coalesce(1), stored.repartition(16))
    ]
    assert trees[0] == trees[1]


def test_saved_model_predicts_alike(trained, tmp_path):
    path = str(tmp_path / "model")
    sinks.write_model(trained.model, path)
    sinks.write_model(trained.model, path)
    loaded = sinks.read_model(path)
    unlabelled = trained.validation.drop(LABEL)
    columns = [*KEYS, *FEATURES, "probability", "prediction", "verdict"]
    before = learning.predict(trained.model, unlabelled).select(*columns)
    assert rows(learning.predict(loaded, unlabelled).select(*columns)) == rows(before)


def test_metrics_equal_the_evaluator(trained):
    found = predictions(trained).persist()
    measured = {(r["metric"], r["label"]): r["value"] for r in learning.metrics(found).collect()}

    def evaluator(**settings):
        measure = MulticlassClassificationEvaluator(labelCol="indexedLabel", **settings)
        return measure.evaluate(found)

    accuracy = evaluator(metricName="accuracy")
    assert measured[("accuracy", None)] == pytest.approx(accuracy)
    assert measured[("test_error", None)] == pytest.approx(1 - accuracy)
    for label in (0.0, 1.0):
        recall = evaluator(metricName="recallByLabel", metricLabel=label)
        assert measured[("recall", label)] == pytest.approx(recall)
    assert len(measured) == 4
    found.unpersist()


def test_golden_metrics(spark):
    counts = catalog.predictions(spark, SF)
    accuracy = {r["metric"]: r["value"] for r in learning.accuracy(counts).collect()}
    recall = {r["label"]: r["recall"] for r in learning.recall_by_label(counts).collect()}
    assert accuracy["accuracy"] == pytest.approx(0.228070, abs=1e-6)
    assert recall == {
        0.0: pytest.approx(0.844828, abs=1e-6),
        1.0: pytest.approx(0.123167, abs=1e-6),
    }


def test_train_and_evaluate(matrix):
    model, measured = train_and_evaluate(matrix, maxDepth=3)
    assert tree_of(model).depth <= 3
    accuracy = measured.filter("metric = 'accuracy'").first()
    assert accuracy["rows"] == 2091 - 1464
    assert 0.5 < accuracy["value"] <= 1


def test_defaults_of_the_tree(trained):
    tree = tree_of(trained.model)
    assert tree.getMaxDepth() == 5
    assert tree.getMaxBins() == 32
    assert tree.getImpurity() == "gini"
    assert tree.getMinInstancesPerNode() == 1
    assert tree.getMinInfoGain() == 0


def test_summary(spark, trained):
    summary = learning.tree_summary(spark, trained.model).collect()
    assert [r["feature"] for r in summary] == FEATURES
    assert sum(r["importance"] for r in summary) == pytest.approx(1)
    assert {(r["depth"], r["nodes"]) for r in summary} == {
        (tree_of(trained.model).depth, tree_of(trained.model).numNodes)
    }


def test_preview_is_the_first_rows_by_key(trained):
    shown = learning.preview(predictions(trained)).collect()
    expected = predictions(trained).orderBy(*KEYS).limit(5).collect()
    assert [tuple(r[k] for k in KEYS) for r in shown] == [
        tuple(r[k] for k in KEYS) for r in expected
    ]


def small_matrix(spark, extra=0):
    """flightcycles has two categories in training rows, others only elsewhere."""
    return spark.range(400).select(
        F.col("id").cast("string").alias("asset_id"),
        F.lit("2024-01-05").cast("date").alias("day"),
        F.col("id").cast("double").alias("average"),
        (F.col("id") * 2).cast("double").alias("flighthours"),
        ((F.col("id") % 2) + extra).cast("double").alias("flightcycles"),
        (F.col("id") / 3).alias("delayedminutes"),
        F.when(F.col("id") % 2 == 0, NEGATIVE).otherwise(POSITIVE).alias(LABEL),
    )


def test_an_unseen_category_still_gets_a_verdict(spark):
    model = learning.train(small_matrix(spark)).model
    unseen = learning.predict(model, small_matrix(spark, extra=7))
    assert unseen.filter("verdict IS NOT NULL").count() == 400


def test_category_map(spark):
    pairs = [(-1.0, 5.0), (0.0, 5.0), (3.0, 9.0), (3.0, 5.0), (0.0, 5.0)]
    frame = spark.createDataFrame(
        [(float(n), *pair) for n, pair in enumerate(pairs)], "a double, b double, c double"
    )
    found = {
        (r["feature"], r["value"]): r["category_index"]
        for r in learning.category_map(frame, ["a", "b", "c"]).collect()
    }
    assert found == {
        ("b", 0.0): 0, ("b", -1.0): 1, ("b", 3.0): 2, ("c", 5.0): 0, ("c", 9.0): 1,
    }


def test_indexers_may_see_all_rows(matrix):
    model = learning.train(matrix, fit_indexers_on="all").model
    assert learning.predict(model, matrix).count() == 2091
    with pytest.raises(ValueError):
        learning.train(matrix, fit_indexers_on="none")


def test_keyless_matrix_is_split_by_chance(matrix):
    keyless = matrix.drop(*KEYS)
    trained = learning.train(keyless, maxDepth=2)
    assert trained.training.count() + trained.validation.count() == 2091
    assert 0.6 < trained.training.count() / 2091 < 0.8


def test_a_missing_feature_fails_the_job(spark):
    broken = small_matrix(spark).withColumn("average", F.lit(None).cast("double"))
    with pytest.raises(Py4JJavaError, match="null"):
        learning.train(broken)
    partly = small_matrix(spark).withColumn(
        "average", F.when(F.col("flighthours") > 100, F.col("average"))
    )
    model = learning.train(partly, incomplete="skip").model
    assert learning.predict(model, partly).count() == partly.dropna().count()
