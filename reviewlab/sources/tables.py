"""Readers of stage tables and reports, each with its explicit schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from reviewlab import schemas

# Header line, quotes doubled inside quotes, a null that differs from "", and white
# space that stays as it is.
CSV_OPTIONS = {
    "header": "true",
    "escape": '"',
    "nullValue": "\\N",
    "lineSep": "\n",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

# Reports may hold line breaks inside quotes.
CSV_READ_OPTIONS = {**CSV_OPTIONS, "multiLine": "true", "mode": "DROPMALFORMED"}


def spread(scan: DataFrame, key: str) -> DataFrame:
    """The rows of a scan over all cores, where the files give fewer partitions than that.

    One file with one row group is one task, however many cores wait. A large table has far
    more partitions than there are cores and is returned as it is, without a shuffle. ``key``
    must have many values; rows go by its hash, so a lost task is repeated identically.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= cores:
        return scan
    return scan.repartition(cores, key)


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.RAW).parquet(path)


def read_flat(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.FLAT).parquet(path)


def read_cleaned(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.CLEANED).parquet(path)


def read_analysed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.ANALYSED).parquet(path)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.FEATURES).parquet(path)


def read_predictions(spark: SparkSession, base: str, model: str) -> DataFrame:
    """Both splits of one model's predictions; ``split`` comes from the folder names.

    The columns of PREDICTIONS are read; what a classifier adds to them is left in the files.
    """
    return spark.read.schema(schemas.PREDICTIONS).parquet(predictions_path(base, model))


def predictions_path(base: str, model: str) -> str:
    return f"{base}/predictions/{model}"


def read_csv_report(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A folder of CSV files with a header line; lines that do not fit the schema are skipped.

    A file with line breaks inside its texts cannot be split, so each is one task; reports are
    written in as many files as they have partitions.
    """
    return spark.read.schema(schema).options(**CSV_READ_OPTIONS).csv(path)


def read_json_blobs(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Text files with one JSON object per line as ``json_blob``."""
    lines = spark.read.text(paths)
    return lines.select(lines["value"].alias("json_blob")).where("trim(json_blob) <> ''")
