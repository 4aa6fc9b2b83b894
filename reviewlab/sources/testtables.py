"""Adapters that give the test tables the shape of raw reviews and catalogue records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def raw_reviews(documents: DataFrame) -> DataFrame:
    """Every document as a raw review; ids and ratings are derived from the document id."""
    doc = F.col("doc_id")
    rating = F.when(doc % 11 == 10, F.lit(None)).otherwise((1 + doc % 10).cast("string"))
    return documents.select(
        F.struct(
            doc.cast("string").alias("review_id"),
            F.col("source").alias("reviewer"),
            F.concat("lang", F.lit("-"), (doc % 25).cast("string")).alias("movie"),
            rating.alias("rating"),
            F.concat("source", F.lit(" on "), "lang").alias("review_summary"),
            F.lit("2024-01-01").alias("review_date"),
            (doc % 2).alias("spoiler_tag"),
            F.col("text").alias("review_detail"),
            F.array((doc % 7).cast("string"), (doc % 7 + doc % 5).cast("string")).alias(
                "helpful"
            ),
        ).alias("review_json")
    )


def track_records(events: DataFrame) -> DataFrame:
    """Every event as a catalogue record: track, its collection and its artist."""
    collection = F.get_json_object("props", "$.k").cast("bigint")
    return events.select(
        F.col("event_id").alias("track_id"),
        F.concat("event_type", F.lit(" "), F.col("event_id").cast("string")).alias("track_name"),
        F.col("value").alias("track_price"),
        collection.alias("collection_id"),
        F.concat(F.lit("collection "), collection.cast("string")).alias("collection_name"),
        F.col("user_id").alias("artist_id"),
        F.concat(F.lit("artist "), F.col("user_id").cast("string")).alias("artist_name"),
    )
