"""Records that arrive as JSON strings: parse them and split them into entity tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlab import schemas

# Key and other columns of each entity table.
TRACKS = ("track_id", ("track_name", "track_price", "collection_id", "artist_id"))
COLLECTIONS = ("collection_id", ("collection_name",))
ARTISTS = ("artist_id", ("artist_name",))

CORRUPT = "_corrupt_record"


def to_json_blobs(records: DataFrame) -> DataFrame:
    """Each row as one JSON string in ``json_blob``."""
    return records.select(F.to_json(F.struct("*")).alias("json_blob"))


def concat_tables(spark: SparkSession, tables: Sequence[DataFrame]) -> DataFrame:
    """All rows of the per-source blob tables, duplicates kept; no table gives an empty one."""
    empty = spark.createDataFrame([], schemas.BLOB)
    return reduce(DataFrame.unionByName, tables) if tables else empty


def parse_blobs(
    blobs: DataFrame, schema: T.StructType = schemas.TRACK_RECORD
) -> tuple[DataFrame, DataFrame]:
    """Typed columns of the well-formed blobs, and the blobs that are not well-formed.

    ``explode`` of one element keeps the test for broken records above the parsed column, so
    that a blob is parsed once.
    """
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    record = F.from_json("json_blob", with_corrupt, {"columnNameOfCorruptRecord": CORRUPT})
    parsed = blobs.select("json_blob", F.explode(F.array(record)).alias("record"))
    bad = F.col("record").isNull() | F.col(f"record.{CORRUPT}").isNotNull()
    good = parsed.where(~bad).select([f"record.{name}" for name in schema.names])
    return good, parsed.where(bad).select("json_blob")


def split_entity(records: DataFrame, key: str, others: Sequence[str]) -> DataFrame:
    """One row per key. Of rows that disagree the least is kept, so runs agree.

    Equal rows are merged first, by hashing and before the shuffle, so the many copies of a
    frequent key are few rows when the least of a struct is taken, which sorts.
    """
    return (
        records.where(F.col(key).isNotNull())
        .select(key, *others)
        .distinct()
        .groupBy(key)
        .agg(F.min(F.struct(*others)).alias("row"))
        .select(key, "row.*")
    )


def split_tracks(records: DataFrame) -> DataFrame:
    return split_entity(records, *TRACKS)


def split_collections(records: DataFrame) -> DataFrame:
    return split_entity(records, *COLLECTIONS)


def split_artists(records: DataFrame) -> DataFrame:
    return split_entity(records, *ARTISTS)
