"""The learner for wide sparse vectors next to MLlib's, and what it keeps of the rows."""

import random

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from reviewlab.operators import models, trees

WIDTH = 1000


@pytest.fixture(scope="module")
def sparse(spark):
    rng = random.Random(3)
    rows = []
    for i in range(300):
        label = i % 3
        held = {rng.randrange(60): float(rng.randrange(1, 40)) for _ in range(12)}
        held[61 + label] = float(rng.randrange(1, 3)) if rng.random() < 0.8 else -1.0
        rows.append((str(i), Vectors.sparse(WIDTH, held), float(label + 1)))
    names = "review_id", "features", "rating_category"
    return spark.createDataFrame(rows, names).repartition(3, "review_id").cache()


@pytest.mark.parametrize("name", ["DecisionTree", "DecisionTreeRegressor"])
def test_trees_equal_those_of_mllib(sparse, name):
    estimator = models.model_spec(name).estimator("target")
    training = sparse.select("features", (F.col("rating_category") - 1).alias("target"))
    expected = estimator.fit(training)
    found = trees.fit_trees(estimator, training, name == "DecisionTree")
    assert found.numNodes > 5 and found.numFeatures == WIDTH
    assert found.toDebugString.split("\n")[1:] == expected.toDebugString.split("\n")[1:]


@pytest.mark.parametrize("name", [n for n, spec in models.MODELS.items() if spec.tree])
def test_mllib_is_given_no_row_of_the_table(sparse, name, monkeypatch):
    """Its learner would hold each as a number for every column."""
    kind = type(models.model_spec(name).estimator("target"))
    fit, seen = kind.fit, []
    monkeypatch.setattr(kind, "fit", lambda self, rows: (seen.append(rows), fit(self, rows))[1])
    scored, _ = models.train_and_score(sparse, name)
    assert scored.count() == 300
    assert all(max(r["features"].numNonzeros() for r in df.collect()) == 0 for df in seen)
    close = F.abs(F.col("prediction") - F.col("rating_category")) < 0.6
    assert scored.where("split = 'test'").agg(F.avg(close.cast("int"))).first()[0] > 0.6


def test_rows_are_kept_as_their_entries(spark, sparse):
    rows = trees.entries_of(
        sparse.select(
            F.monotonically_increasing_id().alias("row"),
            F.col("rating_category").alias("target"),
            "features",
        )
    )
    bins = trees.find_bins(rows, 300, WIDTH, 32, 1)
    assert len(bins.columns) == 63 and bins.splits.max() <= 31
    arrays = (WIDTH, bins.columns, bins.thresholds, bins.starts)
    kept = trees.binned(rows, spark.sparkContext.broadcast(arrays)).collect()
    assert len(kept) == 300 and max(len(r["bins"]) for r in kept) <= 13
    assert all(list(r["bins"]) == sorted(r["bins"]) for r in kept)


def test_rows_are_drawn_as_often_as_they_should_be():
    import numpy as np

    times = trees.drawn(np.arange(100_000), 4, 42)
    assert abs(times.mean() - 1) < 0.02 and abs((times == 0).mean() - np.exp(-1)) < 0.01


def test_labels_that_cannot_be_learned_are_refused(sparse):
    wrong = sparse.withColumn("rating_category", F.lit(1.5))
    with pytest.raises(ValueError):
        models.train_and_score(wrong, "DecisionTree")
