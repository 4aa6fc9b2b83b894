"""Aggregate reports over cleaned or analysed reviews."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlab.operators.group_quantiles import exact_group_quantiles
from reviewlab.operators.quantiles import exact_quantiles

# Bins of the rating histogram, whisker length in interquartile ranges, rows of a
# head report, and the columns of the correlation table.
HISTOGRAM_BINS = 20
WHISKER = 1.5
HEAD_ROWS = 20
CORRELATED = ("rating", "flesch_score", "sentiment_score")


def avg_rating_per_movie(cleaned: DataFrame) -> DataFrame:
    """Mean rating of each movie, best first."""
    means = cleaned.groupBy("movie").agg(F.avg("rating").alias("avg_rating"))
    return means.orderBy(F.desc("avg_rating"), "movie")


def reviewer_stats(reviews: DataFrame) -> DataFrame:
    """Count and mean rating per reviewer in one shuffle, with the mean sentiment if scored.

    A caller that selects one of the columns pays for that one only.
    """
    aggregates = [
        F.count("cleaned_review").alias("total_reviews"),
        F.avg("rating").alias("avg_rating"),
    ]
    if "sentiment_score" in reviews.columns:
        aggregates.append(F.avg("sentiment_score").alias("avg_sentiment"))
    return reviews.groupBy("reviewer").agg(*aggregates)


def head_by_key(table: DataFrame, key: str, n: int = HEAD_ROWS) -> DataFrame:
    return table.orderBy(key).limit(n)


def correlation(reviews: DataFrame, x: str = "review_length", y: str = "rating") -> DataFrame:
    """Pearson correlation over the rows that have both values."""
    return reviews.select(F.corr(x, y).alias("correlation"))


def correlation_matrix(
    reviews: DataFrame, columns: tuple[str, ...] = CORRELATED
) -> DataFrame:
    """Pearson correlation of every pair of columns as rows ``x, y, r``, from one pass."""
    pairs = list(combinations_with_replacement(columns, 2))
    row = reviews.agg(
        *[
            F.corr(F.col(x).cast("double"), F.col(y).cast("double")).alias(f"{x}/{y}")
            for x, y in pairs
        ]
    )
    cells = [
        F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"), F.col(f"`{a}/{b}`").alias("r"))
        for a, b in pairs
        for x, y in dict.fromkeys([(a, b), (b, a)])
    ]
    return row.select(F.inline(F.array(*cells)))


def long_review_count(reviews: DataFrame, min_length: int = 1000) -> DataFrame:
    return reviews.agg(F.count_if(F.col("review_length") >= min_length).alias("long_reviews"))


def histogram(
    reviews: DataFrame, column: str = "rating", bins: int = HISTOGRAM_BINS
) -> DataFrame:
    """Counts in equal-width bins from the least to the greatest value, empty bins included.

    The last bin is closed on the right. Values are counted first; the bounds come from that
    small table, whose shuffle Spark computes once and reuses.
    """
    value = F.col(column).cast("double").alias("value")
    counts = (
        reviews.select(value)
        .where(F.col("value").isNotNull() & ~F.isnan("value"))
        .groupBy("value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    lowest, highest = F.min("value").alias("lo"), F.max("value").alias("hi")
    bounds = counts.select(F.struct(lowest, highest, F.sum("n").alias("n"))).scalar()
    # A single value gets a range of one around it.
    lo, hi = F.col("bounds.lo"), F.col("bounds.hi")
    start = F.when(lo == hi, lo - 0.5).otherwise(lo)
    width = F.when(lo == hi, F.lit(1.0)).otherwise(hi - lo) / bins
    bin_of = F.least(F.lit(bins - 1), F.floor((F.col("value") - start) / width))
    filled = (
        counts.withColumn("bounds", bounds)
        .groupBy(bin_of.cast("bigint").alias("id"))
        .agg(F.sum("n").alias("filled"))
    )
    return (
        reviews.sparkSession.range(bins)
        .join(filled, "id", "left")
        .withColumn("bounds", bounds)
        .select(
            F.col("id").cast("int").alias("bin"),
            (start + F.col("id") * width).alias("bin_start"),
            (start + (F.col("id") + 1) * width).alias("bin_end"),
            F.coalesce("filled", F.lit(0)).alias("reviews"),
        )
    )


def box_summary(values: DataFrame, column: str = "flesch_score") -> DataFrame:
    """Quartiles, whiskers and outliers of a column, all exact.

    ``values`` is read several times, so it should be a stored table.
    """
    quartiles = exact_quantiles(values, column, (0.25, 0.5, 0.75))
    q1, median, q3 = (float("nan") if q is None else q for q in quartiles)
    value = F.col(column).cast("double")
    low_fence, high_fence = q1 - WHISKER * (q3 - q1), q3 + WHISKER * (q3 - q1)
    inside = value.between(low_fence, high_fence)
    # A quartile lies between two values, so the box may reach beyond the last value inside.
    return values.where(value.isNotNull()).agg(
        F.count(F.lit(1)).alias("n"),
        F.lit(q1).alias("q1"),
        F.lit(median).alias("median"),
        F.lit(q3).alias("q3"),
        F.least(F.min(F.when(inside, value)), F.lit(q1)).alias("whisker_low"),
        F.greatest(F.max(F.when(inside, value)), F.lit(q3)).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )


def group_boxes(values: DataFrame, group: str, column: str) -> DataFrame:
    """``box_summary`` of the column for every value of ``group``, all exact, with the group's name.

    Nulls and NaN are left out. ``values`` is read several times, so it should be a stored table.
    """
    found = exact_group_quantiles(values, group, column, (0.25, 0.5, 0.75))
    boxes = found.select(
        F.col("group").alias("of"),
        *[F.get("quantiles", F.lit(i)).alias(name) for i, name in enumerate(("q1", "median", "q3"))],
    )
    value = F.col(column).cast("double")
    given = values.select(F.col(group).alias("group"), value.alias("v"))
    given = given.where(F.col("v").isNotNull() & ~F.isnan("v"))
    reach = WHISKER * (F.col("q3") - F.col("q1"))
    inside = F.col("v").between(F.col("q1") - reach, F.col("q3") + reach)
    return (
        given.join(boxes, F.col("group").eqNullSafe(F.col("of")))
        .groupBy(F.col("group").alias(group), "q1", "median", "q3")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.least(F.min(F.when(inside, F.col("v"))), F.col("q1")).alias("whisker_low"),
            F.greatest(F.max(F.when(inside, F.col("v"))), F.col("q3")).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
    )


def binned_scatter(
    reviews: DataFrame,
    x: str = "sentiment_score",
    y: str = "rating",
    width: float = 0.05,
) -> DataFrame:
    """Points of a scatter plot counted by x-bin and y."""
    bin_x = F.floor(F.col(x).cast("double") / width).alias("bin_x")
    return (
        reviews.where(F.col(x).isNotNull() & F.col(y).isNotNull())
        .groupBy(bin_x, F.col(y).alias(y))
        .agg(F.count(F.lit(1)).alias("reviews"))
    )
