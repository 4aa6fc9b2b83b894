"""JSON-string records to typed entity tables."""

from __future__ import annotations

from pyspark.sql import SparkSession

from reviewlab.operators import catalogue
from reviewlab.sinks.writers import write_parquet
from reviewlab.sources.tables import read_json_blobs


def build_catalogue(spark: SparkSession, sources: list[str], base: str) -> None:
    """Land the blobs of all sources, then write the track, collection and artist tables."""
    write_parquet(read_json_blobs(spark, sources), f"{base}/blobs")
    records, rejected = catalogue.parse_blobs(spark.read.parquet(f"{base}/blobs"))
    write_parquet(records, f"{base}/records")
    write_parquet(rejected, f"{base}/rejected_blobs")
    records = spark.read.schema(records.schema).parquet(f"{base}/records")
    write_parquet(catalogue.split_tracks(records), f"{base}/tracks")
    write_parquet(catalogue.split_collections(records), f"{base}/collections")
    write_parquet(catalogue.split_artists(records), f"{base}/artists")
