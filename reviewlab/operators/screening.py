"""Chi-square screening of sparse columns before a model is fitted on them.

Most of 2^18 hashed columns are empty or hold a word or two that tell nothing of the class, and a tree
learner looks at each of them in every node. Screening counts, for every column, how many training rows of
each class hold it, in one aggregation over the entries that are there, and keeps the columns whose
presence depends most on the class.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import VectorSlicer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlab.operators.sampling import hash_split
from reviewlab.session import materialize

#: Columns that are kept, and rows that must hold a column, unless the caller says otherwise. Up to 4,096
#: columns linear regression would solve normal equations, a matrix of columns by columns.
MAX_COLUMNS = 5_000
MIN_ROWS = 5
#: A label with more different values is no class.
MAX_CLASSES = 1_000


def vector_entries(rows: DataFrame, label: str, column: str = "features") -> DataFrame:
    """``column, class`` for every entry of a row's vector that is not zero, sparse or dense."""
    parts = F.unwrap_udt(column)
    places = F.coalesce(
        parts["indices"], F.sequence(F.lit(0), F.greatest(F.size(parts["values"]) - 1, F.lit(0)))
    )
    entries = F.filter(
        F.arrays_zip(places.alias("column"), parts["values"].alias("value")),
        lambda e: e["value"] != 0,
    )
    return rows.select(F.col(label).alias("class"), F.explode(entries["column"]).alias("column"))


def chi_square(entries: DataFrame, classes: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """``column, rows, chi_square, degrees`` of every column held by ``min_rows`` rows or more.

    ``entries`` has one row ``column, class`` for each column that a row holds, and ``classes`` one
    ``class, size`` for each class (at most MAX_CLASSES, as they are broadcast). Presence and absence against
    classes make a table of two by as many; the sum over its cells comes down to the rows that
    hold the column. Rows without a class count nowhere. Counting starts before the shuffle, so a
    column that every row holds travels as one row per class and task.
    """
    if classes.limit(MAX_CLASSES + 1).count() > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes")
    total = F.sum("size").over(Window.partitionBy())
    shares = classes.where("class is not null and size > 0").select(
        "class", "size", total.alias("total"), F.count("*").over(Window.partitionBy()).alias("k")
    )
    held = entries.groupBy("column", "class").agg(F.count(F.lit(1)).alias("n"))
    held = held.join(F.broadcast(shares), "class")
    # Over classes, (n - rows p)^2 / (rows p) + (n - rows p)^2 / (size - rows p) with p = size / total
    # is (sum of n^2 / p - rows^2) / rows, times total / (total - rows).
    n, rows, of = F.col("n").cast("double"), F.col("rows"), F.col("total")
    per_column = held.groupBy("column").agg(
        F.sum("n").alias("rows"),
        F.sum(n * n * of / F.col("size")).alias("weighted"),
        F.max("total").alias("total"),
        F.max("k").alias("k"),
    )
    value = (F.col("weighted") - rows * rows.cast("double")) / rows * of / (of - rows)
    spread = F.when(rows < of, F.greatest(value, F.lit(0.0))).otherwise(0.0)
    # Rounded, as the order of a sum would else decide between columns with equal counts.
    return per_column.where(rows >= min_rows).select(
        "column", "rows", F.round(spread, 9).alias("chi_square"), (F.col("k") - 1).alias("degrees")
    )


def best_columns(table: DataFrame, most: int = MAX_COLUMNS) -> DataFrame:
    """The ``most`` columns with the largest chi-square; ties go to the smaller column."""
    return table.orderBy(F.desc("chi_square"), F.asc("column")).limit(most)


def class_sizes(rows: DataFrame, label: str) -> DataFrame:
    return rows.groupBy(F.col(label).alias("class")).agg(F.count(F.lit(1)).alias("size"))


@dataclass(frozen=True)
class Screen:
    """The columns of a vector that are kept, in rising order."""

    columns: list[int]

    def apply(self, rows: DataFrame, column: str = "features") -> DataFrame:
        """The rows with the narrower vector in the same column; without one kept, the first stays,
        as models need a column."""
        slicer = VectorSlicer(inputCol=column, outputCol="screened", indices=self.columns or [0])
        names = [F.col("screened").alias(c) if c == column else F.col(f"`{c}`") for c in rows.columns]
        return slicer.transform(rows).select(*names)


def fit_screen(
    features: DataFrame,
    label: str = "rating_category",
    most: int = MAX_COLUMNS,
    min_rows: int = MIN_ROWS,
    column: str = "features",
) -> Screen:
    """Choose columns on the training split alone, so that the test rows stay unseen.

    ``features`` (review_id, the vector, the label) is read twice and should be a stored table. At most
    ``most`` numbers come to the driver.
    """
    training = hash_split(features).where("split = 'train'")
    table = chi_square(
        vector_entries(training, label, column), class_sizes(training, label), min_rows
    )
    kept = best_columns(table, most).select("column").collect()
    return Screen(sorted(row["column"] for row in kept))


def screened_features(
    features: DataFrame, label: str = "rating_category", most: int = MAX_COLUMNS
) -> DataFrame:
    """The features with the kept columns only, stored, as models read them many times."""
    return materialize(fit_screen(features, label, most).apply(features), "screened-features")


def word_entries(rows: DataFrame, words: Column, label: str) -> DataFrame:
    """``column, class`` for every different word of a row: words stand for columns."""
    return rows.select(
        F.col(label).alias("class"), F.explode(F.array_distinct(words)).alias("column")
    )
