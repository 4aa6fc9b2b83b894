"""Train one model by name, score both splits, and evaluate the stored predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reviewlab.operators.models import SEED, evaluate, model_spec, train_and_score
from reviewlab.sinks.writers import write_predictions, write_small_parquet
from reviewlab.sources import tables


def train_model(
    spark: SparkSession,
    base: str,
    name: str,
    label: str = "rating_category",
    seed: int = SEED,
    max_fit_rows: int | None = None,
    max_columns: int | None = None,
) -> None:
    """Write the predictions and the model of ``name`` below ``base``, from ``base``/features.

    ``max_fit_rows`` bounds the rows the model is fitted on, not those that are scored;
    ``max_columns`` has the columns screened first.
    """
    model_spec(name)
    features = tables.read_features(spark, f"{base}/features")
    predictions, model = train_and_score(
        features, name, label, seed, max_fit_rows, max_columns=max_columns
    )
    write_predictions(predictions, base, name)
    model.write().overwrite().save(f"{base}/models/{name}")


def evaluate_model(
    spark: SparkSession, base: str, name: str, label: str = "rating_category"
) -> DataFrame:
    """Score the stored predictions; the table has one row per split."""
    metrics = evaluate(tables.read_predictions(spark, base, name), name, label)
    path = f"{base}/metrics/{name}"
    write_small_parquet(metrics, path)
    return spark.read.schema(metrics.schema).parquet(path)
