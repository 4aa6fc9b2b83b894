"""Writers. Stage tables keep their partitions; only reports of a known size go to one file."""

from __future__ import annotations

from pyspark.sql import DataFrame

from reviewlab.sources.tables import CSV_OPTIONS, predictions_path


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_predictions(predictions: DataFrame, base: str, model: str) -> None:
    """One folder per model with a sub-folder for each split."""
    path = predictions_path(base, model)
    predictions.write.mode("overwrite").partitionBy("split").parquet(path)


def write_small_parquet(df: DataFrame, path: str) -> None:
    """A report of a known small size as one parquet file."""
    _one_partition(df).write.mode("overwrite").parquet(path)


def write_csv_report(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with a header line. ``single_file`` is for reports of a known small size.

    Per-movie and per-reviewer reports grow with the data; sorted ones are written as files in
    sort order.
    """
    out = _one_partition(df) if single_file else df
    out.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def write_text_report(df: DataFrame, path: str) -> None:
    """A small report of one string column as one text file."""
    _one_partition(df).write.mode("overwrite").text(path)


def _one_partition(df: DataFrame) -> DataFrame:
    """The rows in one partition, in the order of a single sorted or limited input partition.

    ``coalesce`` fits where the last stage is small. It would also run that stage in one task,
    so an aggregation of large input must end in its own stage before it (sort, limit, top-k).
    """
    return df.coalesce(1)
