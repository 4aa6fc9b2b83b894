"""Flatten raw reviews and turn them into cleaned, labelled ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlab import schemas
from reviewlab.functions import text

# Fixed value: the least number of characters a cleaned review must have.
MIN_CHARS = 1000


def flatten_reviews(raw: DataFrame) -> DataFrame:
    """The fields of ``review_json`` as top-level columns."""
    return raw.select(
        [F.col("review_json").getField(name).alias(name) for name in schemas.FLAT.names]
    )


def clean_reviews(flat: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """Reviews with a usable rating and at least ``min_chars`` characters left after cleaning.

    The tests run from cheap to dear: null ratings are dropped in the scan, then unusable
    ratings, then texts that are too short even before cleaning (cleaning only deletes), and
    only the rest is cleaned. ``explode`` of a one-element array holds the cleaned text for the
    final length test; as a plain projection Catalyst would push that test below it and run
    the regular expression twice.
    """
    rating = text.parse_rating(F.col("rating"))
    labelled = (
        flat.where(F.col("rating").isNotNull())
        .withColumn("rating", rating)
        .withColumn("rating_category", text.rating_category(F.col("rating")))
        .where(F.col("rating_category").isNotNull())
        .where(F.length("review_detail") >= min_chars)
    )
    others = [name for name in labelled.columns if name != "review_detail"]
    cleaned = labelled.select(
        *others,
        F.explode(F.array(text.strip_punctuation(F.col("review_detail")))).alias("review_detail"),
    )
    return (
        cleaned.where(F.length("review_detail") >= min_chars)
        .withColumn("cleaned_review", F.lower("review_detail"))
        .select(schemas.CLEANED.names)
    )


def rating_category_counts(cleaned: DataFrame) -> DataFrame:
    return cleaned.groupBy("rating_category").agg(F.count(F.lit(1)).alias("reviews"))
