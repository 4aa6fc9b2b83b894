"""Chi-square screening next to MLlib's test and next to plain sums."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import ChiSquareTest
from pyspark.sql import functions as F

from checks.queries import screened_query
from reviewlab.operators import models, screening, trees
from reviewlab.operators.sampling import hash_split


@pytest.fixture(scope="module")
def rows(spark):
    """300 rows of 40 columns in three classes: some columns depend on the class, some vectors are
    dense, one column is full, one empty."""
    rng = np.random.default_rng(7)
    data = []
    for i in range(300):
        kind = i % 3
        values = (rng.random(40) < 0.15) * rng.integers(1, 5, 40).astype(float)
        values[3] = 2.0 if rng.random() < (0.1, 0.5, 0.9)[kind] else 0.0
        values[9] = -1.0 if kind == 1 else 0.0
        values[20], values[21] = 1.0, 0.0
        held = np.flatnonzero(values)
        vector = Vectors.dense(values) if i % 7 == 0 else Vectors.sparse(40, held, values[held])
        data.append((str(i), vector, float(kind + 1)))
    return spark.createDataFrame(data, ["review_id", "features", "rating_category"])


def table_of(rows, least=1):
    entries = screening.vector_entries(rows, "rating_category")
    sizes = screening.class_sizes(rows, "rating_category")
    return {r["column"]: r for r in screening.chi_square(entries, sizes, least).collect()}


def test_values_of_mllib(spark, rows):
    """MLlib tests values as categories, so presence is written as zero or one."""
    found = table_of(rows)
    local = [(r["rating_category"], (r["features"].toArray() != 0) * 1.0) for r in rows.collect()]
    present = spark.createDataFrame([(k, Vectors.dense(v)) for k, v in local], ["label", "features"])
    wanted = ChiSquareTest.test(present, "features", "label").head()
    for column, value in enumerate(wanted["statistics"]):
        if column == 21:
            assert column not in found
        else:
            assert found[column]["chi_square"] == pytest.approx(value, abs=1e-8)
            assert found[column]["degrees"] == (2 if column != 20 else 2)
    assert found[20]["chi_square"] == 0 and found[20]["rows"] == 300


def test_screen_keeps_the_telling_columns(rows):
    screen = screening.fit_screen(rows, most=2)
    assert screen.columns == [3, 9]
    training = hash_split(rows).where("split = 'train'")
    assert screening.fit_screen(training, most=2) == screen
    narrow = screen.apply(rows)
    assert narrow.columns == rows.columns
    for before, after in zip(rows.orderBy("review_id").collect(), narrow.orderBy("review_id").collect()):
        assert list(after["features"].toArray()) == list(before["features"].toArray()[[3, 9]])


def test_few_rows_ties_and_empty(spark, rows):
    assert set(table_of(rows, 10_000)) == set()
    assert screening.fit_screen(rows, min_rows=10_000).columns == []
    assert screening.Screen([]).apply(rows).first()["features"].size == 1
    assert table_of(rows.limit(0)) == {}
    entries = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", None), ("a", 9.0)], "column string, class double")
    classes = spark.createDataFrame([(1.0, 2), (2.0, 2), (None, 5)], "class double, size long")
    table = screening.chi_square(entries, classes, 1)
    assert [r["column"] for r in screening.best_columns(table, 1).collect()] == ["a"]
    assert {r["column"]: r["rows"] for r in table.collect()} == {"a": 1, "b": 1}


def test_too_many_classes(spark):
    classes = spark.range(screening.MAX_CLASSES + 1).select(F.col("id").alias("class"), F.lit(1).alias("size"))
    with pytest.raises(ValueError):
        screening.chi_square(classes.select("class", F.lit(1).alias("column")), classes)


@pytest.mark.parametrize("name", ["DecisionTree", "LinearRegression"])
def test_model_on_screened_columns(spark, rows, small, name):
    predictions, model = models.train_and_score(rows, name, max_columns=2)
    assert model.numFeatures == 2 and predictions.count() == 300
    found = screened_query(name)(spark, small).collect()
    assert sorted(r["split"] for r in found) == ["test", "train"]


@pytest.mark.parametrize("name", ["DecisionTree", "RandomForestRegressor"])
def test_screened_rows_stay_as_narrow_as_their_entries(spark, name, monkeypatch):
    """MLlib's learner would keep each row as a number for every kept column, and its tasks read that
    again at every level; it is given no row of the table."""
    rng = np.random.default_rng(11)
    data = []
    for i in range(240):
        held = np.unique(np.append(rng.integers(3, 200, 20), i % 3))
        data.append((str(i), Vectors.sparse(400, held, np.ones(len(held))), float(i % 3 + 1)))
    rows = spark.createDataFrame(data, ["review_id", "features", "rating_category"])
    kind = type(models.model_spec(name).estimator("target"))
    fit, seen = kind.fit, []
    monkeypatch.setattr(kind, "fit", lambda self, df: (seen.append(df), fit(self, df))[1])
    predictions, model = models.train_and_score(rows, name, max_columns=120)
    assert model.numFeatures == 120 > trees.NARROW
    assert all(r["features"].numNonzeros() == 0 for df in seen for r in df.collect())
    assert predictions.count() == 240
    close = F.abs(F.col("prediction") - F.col("rating_category")) < 0.6
    assert predictions.agg(F.avg(close.cast("int"))).first()[0] > 0.6
