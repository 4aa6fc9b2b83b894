"""Raw JSON to raw, flat, cleaned and feature tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from reviewlab.operators.clean import MIN_CHARS, clean_reviews, flatten_reviews
from reviewlab.operators.features import NUM_FEATURES, tfidf_features
from reviewlab.sinks.writers import write_parquet
from reviewlab.sources import landing, tables


def preprocess(
    spark: SparkSession,
    folder: str,
    base: str,
    mode: str = landing.FULL,
    files: Sequence[str] = (),
    layout: str = landing.ARRAY,
    if_exists: str = "reuse",
    min_chars: int = MIN_CHARS,
    num_features: int = NUM_FEATURES,
    fit_on: str = "all",
    drop_empty_tokens: bool = False,
) -> None:
    """Write ``flat``, ``cleaned``, ``features`` and ``tfidf_model`` below ``base``."""
    raw = landing.land_raw(spark, folder, base, mode, files, layout, if_exists)
    write_parquet(flatten_reviews(raw), f"{base}/flat")
    flat = tables.read_flat(spark, f"{base}/flat")
    write_parquet(clean_reviews(flat, min_chars), f"{base}/cleaned")
    cleaned = tables.read_cleaned(spark, f"{base}/cleaned")
    features, model = tfidf_features(cleaned, num_features, drop_empty_tokens, fit_on)
    write_parquet(features, f"{base}/features")
    model.write().overwrite().save(f"{base}/tfidf_model")
