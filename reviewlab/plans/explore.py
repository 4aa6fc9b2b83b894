"""Topics, clusters and reports from the cleaned table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlab.functions.lexicon import LEXICON
from reviewlab.operators import clusters, reports, topics, words
from reviewlab.operators.scores import analyse_reviews, with_length
from reviewlab.sinks.writers import (
    write_csv_report,
    write_parquet,
    write_small_parquet,
    write_text_report,
)
from reviewlab.sources import tables

# Words that the topics are built from, unless the caller bounds them otherwise (2^18).
VOCABULARY_SIZE = 1 << 18


def explore(
    spark: SparkSession,
    base: str,
    lexicon: Mapping[str, float] | DataFrame = LEXICON,
    vocabulary_size: int = VOCABULARY_SIZE,
) -> None:
    """All exploratory results below ``base``/reports, from ``base``/cleaned."""
    topic_report(spark, base, vocabulary_size)
    cluster_report(spark, base)
    ad_hoc_reports(spark, base, lexicon)


def topic_report(spark: SparkSession, base: str, vocabulary_size: int = VOCABULARY_SIZE) -> None:
    """Topics over the most frequent words; what the bound leaves out is written beside them."""
    cleaned = tables.read_cleaned(spark, f"{base}/cleaned")
    found, terms = topics.fit_topics(cleaned, vocabulary_size)
    write_small_parquet(found, f"{base}/reports/topics")
    missing = words.left_out(terms, vocabulary_size)
    write_csv_report(missing, f"{base}/reports/topic_words_left_out", single_file=True)
    lines = topics.topic_lines(topics.topic_terms(found, terms))
    write_text_report(lines, f"{base}/reports/topic_lines")


def cluster_report(spark: SparkSession, base: str) -> None:
    cleaned = with_length(tables.read_cleaned(spark, f"{base}/cleaned"))
    reviews = cleaned.select("review_id", "review_length", "rating")
    predictions, model = clusters.fit_clusters(reviews)
    centers = clusters.cluster_centers(reviews, model)
    write_small_parquet(centers, f"{base}/reports/cluster_centers")
    sizes = clusters.cluster_sizes(predictions).orderBy("prediction")
    write_csv_report(sizes, f"{base}/reports/cluster_sizes", single_file=True)


def ad_hoc_reports(
    spark: SparkSession, base: str, lexicon: Mapping[str, float] | DataFrame = LEXICON
) -> None:
    """The scored table is written once; every score report is an aggregate of it."""
    out = f"{base}/reports"
    cleaned = tables.read_cleaned(spark, f"{base}/cleaned")
    write_parquet(analyse_reviews(cleaned, lexicon), f"{base}/analysed")
    analysed = tables.read_analysed(spark, f"{base}/analysed")

    top = words.top_words(cleaned)
    write_csv_report(top, f"{out}/top_words", single_file=True)
    real = words.top_words(cleaned, without=words.NO_WORDS)
    write_csv_report(words.word_share(real), f"{out}/word_share", single_file=True)

    write_csv_report(reports.avg_rating_per_movie(analysed), f"{out}/avg_rating_per_movie")
    write_parquet(reports.reviewer_stats(analysed), f"{out}/reviewer_stats")
    stats = spark.read.parquet(f"{out}/reviewer_stats")
    for column in ("total_reviews", "avg_rating", "avg_sentiment"):
        name = "review_count" if column == "total_reviews" else column
        write_csv_report(stats.select("reviewer", column), f"{out}/{name}_per_reviewer")

    write_csv_report(reports.correlation(analysed), f"{out}/correlation", single_file=True)
    matrix = reports.correlation_matrix(analysed)
    write_csv_report(matrix, f"{out}/correlation_matrix", single_file=True)
    histogram = reports.histogram(analysed).orderBy("bin")
    write_csv_report(histogram, f"{out}/rating_histogram", single_file=True)
    box = reports.box_summary(analysed)
    write_csv_report(box, f"{out}/flesch_box", single_file=True)
    write_csv_report(reports.binned_scatter(analysed), f"{out}/sentiment_rating_bins")
    count = reports.long_review_count(analysed).select(F.col("long_reviews"))
    write_csv_report(count, f"{out}/long_review_count", single_file=True)
