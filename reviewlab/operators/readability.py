"""Reading ease by the syllables of every distinct word, each looked up in the patterns once."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlab.functions import text
from reviewlab.functions.syllables import Trie, patterns
from reviewlab.operators.words import document_frequencies, join_by_word
from reviewlab.session import materialize


def word_syllables(words: DataFrame) -> DataFrame:
    """``words`` (a table with one row per word) with the number of ``syllables`` of each."""
    made = patterns()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(made)
        for batch in batches:
            words = batch.column("word").to_pylist()
            numbers = [None if word is None else trie.syllables(word) for word in words]
            columns = [*batch.columns, pa.array(numbers, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "syllables"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in words.schema.fields)
    return words.mapInArrow(count, f"{schema}, syllables int")


def spoken_words(column: Column) -> Column:
    """The words of a text, lower-case letters and digits, joined by blanks.

    The class lists its characters for the reason that ``text.strip_punctuation`` gives.
    """
    return F.trim(F.regexp_replace(F.lower(column), f"[^{text.WORD_CHARACTERS}]+", " "))


def word_table(spoken: DataFrame) -> DataFrame:
    """``word, df, syllables`` of all words of ``cleaned_review``, stored."""
    found = document_frequencies(spoken, drop_stop_words=False).where("word <> ''")
    return materialize(word_syllables(found), "word-syllables")


def with_reading_ease(reviews: DataFrame, column: str = "review_detail") -> DataFrame:
    """Add ``reading_ease`` from words, sentence ends and syllables; null without a word.

    The patterns are applied to the word table only, one row per distinct word, which is joined
    back with the words of each review: frequent words by broadcast, so no task gets
    all the rows of one word. ``reviews`` is read several times, so it should be a stored table. The hash
    of the text is part of the key, so two texts that share an id keep their own scores. Every row is
    counted by itself and equal ones are dropped as numbers, so no text is sorted or shuffled for that.
    """
    key = ["review_id", "text_hash"]
    spoken = reviews.select(
        F.monotonically_increasing_id().alias("row"),
        "review_id",
        F.xxhash64(column).alias("text_hash"),
        spoken_words(F.col(column)).alias("cleaned_review"),
    ).where("cleaned_review <> ''")
    spoken = materialize(spoken, "spoken-words")
    each = spoken.select("row", F.explode(F.split("cleaned_review", " ")).alias("word"))
    joined = join_by_word(each, word_table(spoken.select("cleaned_review")), spoken.count(), False)
    counted = joined.groupBy("row").agg(
        F.count(F.lit(1)).alias("n_words"), F.sum("syllables").alias("n_syllables")
    )
    counted = counted.join(spoken.select("row", *key), "row").dropDuplicates(key)
    counted = counted.select(
        F.col("review_id").alias("counted_id"),
        F.col("text_hash").alias("counted_hash"),
        "n_words",
        "n_syllables",
    )
    ends = F.regexp_count(F.col(column), F.lit(text.SENTENCE_PATTERN))
    score = (
        F.lit(text.FLESCH_BASE)
        - F.lit(text.FLESCH_PER_SENTENCE) * F.col("n_words") / F.greatest(ends, F.lit(1))
        - F.lit(text.FLESCH_PER_WORD) * F.col("n_syllables") / F.col("n_words")
    )
    same = F.col("review_id").eqNullSafe(F.col("counted_id")) & (
        F.xxhash64(column) == F.col("counted_hash")
    )
    joined = reviews.join(counted, same, "left").withColumn("reading_ease", score.cast("float"))
    return joined.drop("counted_id", "counted_hash", "n_words", "n_syllables")
