"""Readability, sentiment and length as columns of the review table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlab.functions import text
from reviewlab.functions.lexicon import LEXICON
from reviewlab.operators.words import document_frequencies, join_by_word, term_frequencies
from reviewlab.session import materialize

# Lexicons up to this many words, and this many polarities (one condition each), are written
# into the plan; larger ones are joined.
MAX_INLINE_WORDS = 5_000
MAX_INLINE_POLARITIES = 50


def with_flesch(cleaned: DataFrame, column: str = "review_detail") -> DataFrame:
    return cleaned.withColumn("flesch_score", text.flesch_reading_ease(F.col(column)))


def with_sentiment(
    cleaned: DataFrame,
    lexicon: Mapping[str, float] | DataFrame = LEXICON,
    max_inline_words: int = MAX_INLINE_WORDS,
) -> DataFrame:
    """Add ``sentiment_score``, the mean polarity of the review's lexicon words.

    ``lexicon`` is a mapping or a table ``word, polarity`` (the mean counts where a word is
    listed twice; words without a polarity are in no lexicon). Only its size decides how it is
    applied; the score is the same.
    """
    if not isinstance(lexicon, DataFrame):
        entries = [(w, float(p)) for w, p in lexicon.items() if w is not None and p is not None]
        lexicon = dict(entries)
        if not _fits_inline(lexicon, max_inline_words):
            schema = "word string, polarity double"
            return _sentiment_by_join(cleaned, cleaned.sparkSession.createDataFrame(entries, schema))
    else:
        table = lexicon.where(F.col("word").isNotNull() & F.col("polarity").isNotNull())
        table = table.groupBy("word").agg(F.avg("polarity").alias("polarity"))
        head = table.limit(max_inline_words + 1).collect()
        lexicon = {row["word"]: row["polarity"] for row in head}
        if not _fits_inline(lexicon, max_inline_words):
            return _sentiment_by_join(cleaned, table)
    words = text.cleaned_tokens(F.col("cleaned_review"))
    return cleaned.withColumn("sentiment_score", text.mean_polarity(words, lexicon))


def _fits_inline(lexicon: Mapping[str, float], max_words: int) -> bool:
    return len(lexicon) <= max_words and len(set(lexicon.values())) <= MAX_INLINE_POLARITIES


def _sentiment_by_join(cleaned: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Score by joining counted words with the lexicon, for lexicons of any size.

    The hash of the text is part of the key, so two texts that share an id keep their own
    scores. ``cleaned`` is read several times, so it should be a stored table.
    """
    key = ["review_id", "text_hash"]
    # Only columns that the caller goes on to use are shuffled, texts not for their own sake.
    keyed = cleaned.withColumns(
        {"text_hash": F.xxhash64("cleaned_review"), "has_text": F.col("cleaned_review").isNotNull()}
    )
    terms = term_frequencies(keyed.select(*key, "cleaned_review"), drop_stop_words=False)
    used = lexicon.join(document_frequencies(cleaned, drop_stop_words=False), "word")
    scores = (
        join_by_word(terms, materialize(used, "lexicon"), cleaned.count())
        .groupBy(*key)
        .agg((F.sum(F.col("tf") * F.col("polarity")) / F.sum("tf")).alias("mean"))
        .select(
            F.col("review_id").alias("scored_id"), F.col("text_hash").alias("scored_hash"), "mean"
        )
    )
    same_review = keyed["review_id"].eqNullSafe(scores["scored_id"]) & (
        keyed["text_hash"] == scores["scored_hash"]
    )
    score = F.when(F.col("has_text"), F.coalesce("mean", F.lit(0.0))).cast("float")
    return (
        keyed.join(scores, same_review, "left")
        .withColumn("sentiment_score", score)
        .drop("text_hash", "has_text", "scored_id", "scored_hash", "mean")
    )


def with_length(cleaned: DataFrame) -> DataFrame:
    return cleaned.withColumn("review_length", F.length("cleaned_review"))


def analyse_reviews(
    cleaned: DataFrame, lexicon: Mapping[str, float] | DataFrame = LEXICON
) -> DataFrame:
    """Cleaned reviews with all three scores; rows without a length or rating are dropped."""
    scored = with_length(with_sentiment(with_flesch(cleaned), lexicon))
    return scored.na.drop(subset=["review_length", "rating"])
