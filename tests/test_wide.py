"""Columns with more labels than the driver takes."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tests.test_training import rows as payments
from txscore.operators import features
from txscore.operators.forest import score
from txscore.plans.payment_counts import count_values
from txscore.plans.train_models import KEY, TrainingOptions, counted_by, train
from txscore.schemas import MODEL_COLUMNS

LAYOUT = "a string, x double, b string, h string, v array<double>"


def some_rows(spark, rows):
    return spark.createDataFrame(rows, LAYOUT).withColumn("v", array_to_vector("v"))


@pytest.fixture(scope="module")
def fitted_on(spark):
    return some_rows(spark, [
        (f"a{i % 7}" if i % 9 else None, float(i % 4), f"b{i % 3}", f"h{i % 5}", [0.0, float(i)]) for i in range(60)
    ]).cache()


def as_lists(df):
    kept = ["a", "b", "a_indexed", "b_indexed"]
    vectors = [vector_to_array(c).alias(c) for c in ("a_encoded", "b_encoded", "features")]
    return sorted(map(repr, df.select(*kept, *vectors).collect()))


def test_a_table_of_labels_gives_what_a_list_gives(spark, fitted_on):
    ways = {"hash_columns": ("h",), "hash_slots": 16}
    listed = features.fit_preprocessor(fitted_on, **ways)
    stored = features.fit_preprocessor(fitted_on, **ways, driver_labels=3)
    assert [type(s).__name__ for s in stored.stages] == ["FeatureHasher", "LabelSlots"]
    unseen = some_rows(spark, [("new", 1.0, None, "h1", [1.0, 0.0]), ("a1", 0.0, "b2", "h9", [0.0, 0.0])])
    for rows in (fitted_on, unseen):
        assert as_lists(stored.transform(rows)) == as_lists(listed.transform(rows))
    size = listed.transform(fitted_on).schema["features"].metadata["ml_attr"]["num_attrs"]
    assert stored.transform(fitted_on).schema["features"].metadata == {"ml_attr": {"num_attrs": size}}


def test_saved_and_loaded_with_its_labels(fitted_on, tmp_path):
    stored = features.fit_preprocessor(fitted_on, driver_labels=3)
    path = f"{tmp_path}/model"
    stored.write().overwrite().save(path)
    stored.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    assert loaded.stages[-1].getOrDefault("table").startswith(path)
    assert as_lists(loaded.transform(fitted_on)) == as_lists(stored.transform(fitted_on))


@pytest.mark.parametrize("number", [None, float("nan")])
def test_a_missing_number_is_an_error(spark, fitted_on, number):
    stored = features.fit_preprocessor(fitted_on.select("a", "x"), driver_labels=3)
    broken = spark.createDataFrame([("a1", number)], "a string, x double")
    with pytest.raises(Exception, match="no number in column x"):
        stored.transform(broken).select("features").collect()


def test_many_labels_stay_off_the_driver(spark):
    """Before, the list of all labels was fetched, and the vector's schema named every slot."""
    n = 2 * features.DRIVER_LABELS
    rows = spark.range(n).selectExpr("string(id) as s", "double(id) as x")
    model = features.fit_preprocessor(rows)
    assert [type(s).__name__ for s in model.stages] == ["LabelSlots"]
    encoded = model.transform(rows)
    assert encoded.schema["features"].metadata == {"ml_attr": {"num_attrs": n + 1}}
    found = encoded.agg(F.countDistinct("s_indexed"), F.min("s_indexed"), F.max("s_indexed")).first()
    assert tuple(found) == (n, 0.0, n - 1.0)


@pytest.mark.parametrize("counted", [False, True])
def test_training_keeps_many_labels_in_a_table(spark, monkeypatch, counted):
    """Before, every label of a column went through the driver, stored counts or not."""
    history = payments(spark, 600).select(KEY, *MODEL_COLUMNS, "label")
    options = TrainingOptions(trees=3, leave_out=())
    counts = count_values(history.withColumnRenamed("label", "is_fraud"), counted_by(history, options)) if counted else None
    listed = train(history, options, counts)
    monkeypatch.setattr(features, "DRIVER_LABELS", 10)
    stored = train(history, options, counts)
    assert [type(s).__name__ for s in stored.preprocessor.stages] == ["LabelSlots"]
    assert stored.metrics.first()["n_test"] == listed.metrics.first()["n_test"]
    vectors = [vector_to_array("features").alias("v")]
    theirs = listed.preprocessor.transform(history).select(KEY, *vectors)
    assert stored.preprocessor.transform(history).select(KEY, *vectors).exceptAll(theirs).isEmpty()
    assert score(history, stored.preprocessor, stored.forest).count() == 600
