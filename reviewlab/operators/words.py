"""Word tables: tokens, counts, shares and the relational TF-IDF."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewlab.functions import text
from reviewlab.session import materialize

# Rows of the frequent-word report, and words that its shares leave out.
TOP_WORDS = 20
NO_WORDS = ("", "nan")

# Words in a frequent-item sketch at first and at most, and sketches after the first merge.
TRACKED_WORDS = 1 << 14
MAX_TRACKED_WORDS = 1 << 18
SKETCH_GROUPS = 256

# Bounds of a word table that may be broadcast.
MAX_BROADCAST_WORDS = 500_000
MAX_BROADCAST_CHARS = 16_000_000


def with_tokens(cleaned: DataFrame, drop_empty_tokens: bool = False) -> DataFrame:
    """Add ``words`` (all tokens) and ``filtered`` (without stop words)."""
    words = text.cleaned_tokens(F.col("cleaned_review"))
    out = cleaned.withColumn("words", words)
    filtered = text.content_words(F.col("words"))
    if drop_empty_tokens:
        filtered = F.array_remove(filtered, "")
    return out.withColumn("filtered", filtered)


def word_counts(cleaned: DataFrame, drop_empty_tokens: bool = False) -> DataFrame:
    """Occurrences of each content word.

    Stop words are dropped after ``explode``, where the test is compiled code; counting starts
    before the shuffle, so a word that makes up a third of the text travels as one row per task.
    """
    return _content_words(cleaned, drop_empty_tokens).groupBy("word").count()


def _content_words(cleaned: DataFrame, drop_empty_tokens: bool) -> DataFrame:
    exploded = cleaned.select(
        F.explode(text.cleaned_tokens(F.col("cleaned_review"))).alias("word")
    ).where(text.is_content_word(F.col("word")))
    return exploded.where(F.col("word") != "") if drop_empty_tokens else exploded


def top_words(
    cleaned: DataFrame, n: int = TOP_WORDS, without: Sequence[str] = ()
) -> DataFrame:
    """The ``n`` most frequent words besides ``without``; ties go to the word that sorts first."""
    counts = word_counts(cleaned, "" in without)
    if without:
        counts = counts.where(~F.col("word").isin(list(without)))
    return counts.orderBy(F.desc("count"), "word").limit(n)


def frequent_words(
    cleaned: DataFrame, n: int = TOP_WORDS, without: Sequence[str] = (), tracked: int = TRACKED_WORDS
) -> DataFrame:
    """The same rows as ``top_words``, without a shuffle of the whole vocabulary.

    Each task keeps a frequent-item sketch of ``tracked`` words. The sketches are merged in two
    steps; they tell every count up to ``sketch_error``. Words that may be among the first ``n`` are
    counted exactly in a second pass over ``cleaned``, which should be a stored table. Where the
    error leaves it open whether a word outside the sketch belongs to them, the sketch is made four
    times larger; if the largest does not settle it either, all words are counted.
    """
    if n <= 0:
        return top_words(cleaned, 0, without)
    exploded = _content_words(cleaned, "" in without)
    if without:
        exploded = exploded.where(~F.col("word").isin(list(without)))
    while True:
        candidates = _frequent_candidates(exploded, n, tracked)
        if candidates is not None:
            break
        if tracked >= MAX_TRACKED_WORDS:
            return top_words(cleaned, n, without)
        tracked = min(4 * tracked, MAX_TRACKED_WORDS)
    counts = exploded.where(F.col("word").isin(candidates)).groupBy("word").count()
    return counts.orderBy(F.desc("count"), "word").limit(n)


def sketch_error(occurrences: int, tracked: int) -> int:
    """By how much a sketch's count can be off, either way.

    Spark's sketch has a table of the power of two in which ``tracked`` words fill three quarters
    at most; its error is 3.5 times the occurrences through the size of that table.
    """
    table = 1 << max(3, math.ceil(math.log2(tracked / 0.75)))
    return math.ceil(3.5 * occurrences / table)


def _frequent_candidates(exploded: DataFrame, n: int, tracked: int) -> list[str] | None:
    """Words that may be among the ``n`` most frequent; None if the sketch does not tell.

    A word that the sketch does not return occurs at most twice the error. So if the n-th
    greatest count is certainly above that, the words that can reach it are all in the list,
    which holds fewer than ``tracked`` words.
    """
    group = F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS))
    sketches = exploded.groupBy(group.alias("part")).agg(
        F.expr(f"approx_top_k_accumulate(word, {tracked})").alias("sketch"),
        F.count(F.lit(1)).alias("occurrences"),
    )
    sketches = materialize(sketches, "word-sketches")
    if sketches.isEmpty():  # there is nothing to merge, which Spark takes for an error
        return []
    merged = sketches.agg(
        F.expr("approx_top_k_combine(sketch)").alias("sketch"), F.sum("occurrences").alias("n")
    )
    row = merged.select(F.expr(f"approx_top_k_estimate(sketch, {tracked})").alias("top"), "n").first()
    error = sketch_error(row["n"], tracked)
    estimates = sorted((entry["count"] for entry in row["top"]), reverse=True)
    if len(estimates) < n or estimates[n - 1] - error <= 2 * error:
        return None
    least = estimates[n - 1] - 2 * error
    return [entry["item"] for entry in row["top"] if entry["count"] >= least]


def word_share(top: DataFrame) -> DataFrame:
    """Share of each word in a top-words report, leaving out the empty word and ``nan``.

    A report made ``without`` NO_WORDS keeps its length. The window has no partition key: its
    input is the report, a fixed number of rows.
    """
    kept = top.where(F.col("word").isNotNull() & ~F.col("word").isin(list(NO_WORDS)))
    total = F.sum("count").over(Window.partitionBy())
    return kept.withColumn("share", F.col("count") / total).orderBy(F.desc("count"), "word")


def vocabulary(cleaned: DataFrame, size: int | None = None) -> DataFrame:
    """All words with their index 0, 1, ... by falling count, then by the word itself.

    ``size`` keeps the first so many; ``left_out`` says what that drops. Words are sorted in
    ranges; each range numbers its own and adds the sizes of the ranges before it, so no task
    sees the whole table.
    """
    counts = word_counts(cleaned).select("word", "count", (-F.col("count")).alias("rank"))
    ordered = counts.repartitionByRange("rank", "word")
    ordered = materialize(ordered.withColumn("part", F.spark_partition_id()), "word-counts")
    inside = Window.partitionBy("part").orderBy("rank", "word")
    numbered = ordered.withColumn("place", F.row_number().over(inside) - 1)
    # One row per range.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ordered.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    terms = numbered.join(sizes, "part").select(
        (F.col("offset") + F.col("place")).alias("term"), "word", "count"
    )
    return terms if size is None else terms.where(F.col("term") < size)


def left_out(terms: DataFrame, size: int) -> DataFrame:
    """What a vocabulary of ``size`` words leaves out of all ``terms``: words and occurrences."""
    return terms.where(F.col("term") >= size).agg(
        F.count(F.lit(1)).alias("words"),
        F.coalesce(F.sum("count"), F.lit(0)).alias("occurrences"),
    )


def term_frequencies(cleaned: DataFrame, drop_stop_words: bool = True) -> DataFrame:
    """``word, tf`` of each review next to its other columns, counted inside each row.

    All words of a review sit in one row, so sorting them there and measuring the runs of
    equal words gives the counts without shuffling a row per (review, word).
    """
    words = text.cleaned_tokens(F.col("cleaned_review"))
    if drop_stop_words:
        words = text.content_words(words)
    others = [F.col(name) for name in cleaned.columns if name != "cleaned_review"]
    runs = (
        cleaned.select(*others, F.sort_array(words).alias("words"))
        .where(F.size("words") > 0)
        .withColumn(
            "heads",
            F.filter(
                F.sequence(F.lit(0), F.size("words") - 1),
                lambda i: (i == 0)
                | (F.get(F.col("words"), i) != F.get(F.col("words"), i - 1)),
            ),
        )
    )
    counted = F.transform(
        "heads",
        lambda head, k: F.struct(
            F.get(F.col("words"), head).alias("word"),
            (F.coalesce(F.get(F.col("heads"), k + 1), F.size("words")) - head).alias("tf"),
        ),
    )
    return runs.select(*others, F.inline(counted))


def document_frequencies(cleaned: DataFrame, drop_stop_words: bool = True) -> DataFrame:
    """``word, df``: in how many reviews each word occurs."""
    words = F.array_distinct(text.cleaned_tokens(F.col("cleaned_review")))
    exploded = cleaned.select(F.explode(words).alias("word"))
    if drop_stop_words:
        exploded = exploded.where(text.is_content_word(F.col("word")))
    return exploded.groupBy("word").agg(F.count(F.lit(1)).alias("df"))


def join_by_word(
    terms: DataFrame, table: DataFrame, reviews: int, store_terms: bool = True
) -> DataFrame:
    """Join ``terms`` (many rows per word) with a stored ``table`` of one row per word and df.

    A table within MAX_BROADCAST_WORDS and MAX_BROADCAST_CHARS is broadcast whole. Beyond that
    the words found in at least one of a thousand reviews are: they make up most rows of
    ``terms`` and would be the heavy keys of a shuffle. ``terms`` is shuffled for the rare
    words only. Where too many words are that frequent, the bar is raised until they fit. Both parts
    read ``terms``, which are stored for that unless it costs less to make them twice.
    """
    if _fits_broadcast(table):
        return terms.join(F.broadcast(table), "word")
    least = max(1, reviews // 1000)
    while not _fits_broadcast(table.where(F.col("df") >= least)):
        least *= 2
    if store_terms:
        terms = materialize(terms, "terms")
    is_frequent = F.col("df") >= least
    frequent, rare = table.where(is_frequent), table.where(~is_frequent)
    rare_terms = terms.join(F.broadcast(frequent.select("word")), "word", "left_anti")
    return terms.join(F.broadcast(frequent), "word").unionByName(rare_terms.join(rare, "word"))


def _fits_broadcast(table: DataFrame) -> bool:
    words, characters = table.agg(F.count("word"), F.sum(F.length("word"))).first()
    return words <= MAX_BROADCAST_WORDS and (characters or 0) <= MAX_BROADCAST_CHARS


def tfidf_terms(cleaned: DataFrame) -> DataFrame:
    """``review_id, word, tf, df, tfidf`` with idf ln((N+1)/(df+1)).

    ``cleaned`` is read several times, so it should be a stored table.
    """
    reviews = cleaned.count()
    weights = materialize(document_frequencies(cleaned), "document-frequencies")
    idf = F.log(F.lit(reviews + 1) / (F.col("df") + 1))
    terms = term_frequencies(cleaned.select("review_id", "cleaned_review"))
    return join_by_word(terms, weights, reviews).select(
        "review_id", "word", "tf", "df", (F.col("tf") * idf).alias("tfidf")
    )
