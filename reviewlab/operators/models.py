"""The eight estimators by name: training, batch scoring and evaluation."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlab.operators.sampling import cap_rows, hash_split
from reviewlab.operators.screening import screened_features
from reviewlab.operators.trees import fit_trees

SEED = 42
CLASSIFIER, REGRESSOR = "classifier", "regressor"

# Rows of logistic regression are worked on in blocks of so many MB. For each block MLlib adds up a table of all
# columns by classes, so blocks of its usual 1 MB cost more by that table than by their rows.
BLOCK_MB = 16.0

# Memory that a task may take for the counts of a level's nodes in a plain table; above it they
# are sorted.
TREE_MEMORY_MB = 1024


@dataclass(frozen=True)
class ModelSpec:
    """How to build an estimator and how it is scored."""

    kind: str
    build: Callable[..., Estimator]
    seeded: bool = True
    tree: bool = False

    def estimator(
        self, label: str, seed: int = SEED, tree_memory_mb: int = TREE_MEMORY_MB
    ) -> Estimator:
        options = {"seed": seed} if self.seeded else {}
        if self.tree:
            options["maxMemoryInMB"] = tree_memory_mb
        return self.build(featuresCol="features", labelCol=label, **options)


# The model names and their settings; what is not set keeps Spark's default.
MODELS = {
    "NaiveBayes": ModelSpec(CLASSIFIER, lambda **o: NaiveBayes(smoothing=1.0, **o), seeded=False),
    "LogisticRegression": ModelSpec(
        CLASSIFIER,
        lambda **o: LogisticRegression(family="multinomial", maxBlockSizeInMB=BLOCK_MB, **o),
        seeded=False,
    ),
    "DecisionTree": ModelSpec(
        CLASSIFIER, lambda **o: DecisionTreeClassifier(maxDepth=5, **o), tree=True
    ),
    "RandomForest": ModelSpec(
        CLASSIFIER, lambda **o: RandomForestClassifier(numTrees=50, maxDepth=10, **o), tree=True
    ),
    "LinearRegression": ModelSpec(REGRESSOR, LinearRegression, seeded=False),
    "DecisionTreeRegressor": ModelSpec(REGRESSOR, DecisionTreeRegressor, tree=True),
    "RandomForestRegressor": ModelSpec(REGRESSOR, RandomForestRegressor, tree=True),
    "GBTRegressor": ModelSpec(REGRESSOR, lambda **o: GBTRegressor(maxIter=10, **o), tree=True),
}


def model_spec(name: str) -> ModelSpec:
    if name not in MODELS:
        raise ValueError(f"unknown model {name!r}; known: {', '.join(MODELS)}")
    return MODELS[name]


def train_and_score(
    features: DataFrame,
    name: str,
    label: str = "rating_category",
    seed: int = SEED,
    max_fit_rows: int | None = None,
    tree_memory_mb: int = TREE_MEMORY_MB,
    max_columns: int | None = None,
) -> tuple[DataFrame, Model]:
    """Predictions for both splits in one pass, and the model fitted on the training split.

    ``max_columns`` has the columns screened first: the model sees those whose presence depends most
    on the label in the training split (see ``operators.screening``).

    ``max_fit_rows`` bounds the training rows the model is fitted on (a sample by the hash of
    the id); without it all are used. Every row is scored in either case.

    ``features`` is read for the fit and for scoring, so it should be a stored table.
    Classifiers number classes from 0, so they see the category minus one; their predictions
    are moved back to the scale of the label.
    """
    spec = model_spec(name)
    if max_columns is not None:
        features = screened_features(features, label, max_columns)
    offset = 1.0 if spec.kind == CLASSIFIER else 0.0
    rows = hash_split(features).withColumn("target", F.col(label).cast("double") - offset)
    training = rows.where("split = 'train'")
    if max_fit_rows is not None:
        training = cap_rows(training, max_fit_rows)
    estimator = spec.estimator("target", seed, tree_memory_mb)
    training = training.select("features", "target")
    if spec.tree:
        model = fit_trees(estimator, training, spec.kind == CLASSIFIER)
    else:
        model = estimator.fit(training)
    scored = model.transform(rows).withColumn("prediction", F.col("prediction") + offset)
    return scored.drop("target"), model


def accuracy(label: str = "rating_category"):
    return F.avg(F.when(F.col("prediction") == F.col(label), 1.0).otherwise(0.0))


def rmse(label: str = "rating_category"):
    return F.sqrt(F.avg(F.pow(F.col("prediction") - F.col(label), F.lit(2.0))))


def evaluate(predictions: DataFrame, name: str, label: str = "rating_category") -> DataFrame:
    """Accuracy of a classifier or RMSE of a regressor, one row per split, from one pass."""
    metric = ("accuracy", accuracy) if model_spec(name).kind == CLASSIFIER else ("rmse", rmse)
    return predictions.groupBy("split").agg(
        F.lit(name).alias("model"),
        F.lit(metric[0]).alias("metric"),
        metric[1](label).alias("value"),
        F.count(F.lit(1)).alias("rows"),
    )
