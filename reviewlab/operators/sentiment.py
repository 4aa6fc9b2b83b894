"""Sentiment from the reviews themselves: a lexicon learned from ratings, and phrases with negation."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlab.functions import text
from reviewlab.functions.lexicon import LEXICON, NEGATIONS, PHRASES

#: Rating categories whose words are set against each other.
POSITIVE, NEGATIVE = 3.0, 1.0
#: Weight of the prior, in words: how much evidence a word needs to leave its share of all words.
PRIOR_WORDS = 500.0
#: Words of the lexicon differ this surely, in standard deviations, and occur this often.
MIN_Z, MIN_COUNT = 1.96, 5

#: Words before a phrase in which a negation turns it round, and what is left of its strength.
NEGATION_REACH, NEGATED = 3, -0.5
#: An automaton of more phrases than this is not sent to the tasks.
MAX_PHRASES = 200_000


def rated_word_counts(cleaned: DataFrame) -> DataFrame:
    """``word, positive, negative``: occurrences in reviews of the best and of the worst category.

    One aggregation for both, begun before the shuffle; stop words and empty words count nowhere.
    """
    word = F.explode(text.cleaned_tokens(F.col("cleaned_review")))
    tokens = cleaned.where(F.col("rating_category").isin(POSITIVE, NEGATIVE)).select(
        (F.col("rating_category") == POSITIVE).alias("good"), word.alias("word")
    )
    tokens = tokens.where(text.is_content_word(F.col("word")) & (F.col("word") != ""))
    return tokens.groupBy("word").agg(
        F.count_if("good").alias("positive"), F.count_if(~F.col("good")).alias("negative")
    )


def log_odds(counts: DataFrame, prior_words: float = PRIOR_WORDS) -> DataFrame:
    """``counts`` with ``log_odds`` and ``z``: how much likelier a word is in good reviews.

    Both classes start from a Dirichlet prior of ``prior_words`` words dealt like all words are, so
    a rare word needs more than a lucky review or two, and a word of one class alone has finite odds.
    ``counts`` is read twice and should be a stored table; two sums come to the driver.
    """
    sums = counts.agg(F.sum("positive"), F.sum("negative")).first()
    good, bad = (float(n or 0) for n in sums)
    share = (F.col("positive") + F.col("negative")) / max(good + bad, 1.0)
    y, n = F.col("positive") + prior_words * share, F.col("negative") + prior_words * share
    odds = F.log(y / (good + prior_words - y)) - F.log(n / (bad + prior_words - n))
    return counts.withColumn("log_odds", odds).withColumn("z", odds / F.sqrt(1 / y + 1 / n))


def learned_lexicon(
    counts: DataFrame,
    prior_words: float = PRIOR_WORDS,
    min_z: float = MIN_Z,
    min_count: int = MIN_COUNT,
) -> DataFrame:
    """``word, positive, negative, z, polarity`` of the words that tell good from bad reviews.

    The polarity lies between -1 and 1 and grows with the odds; ``scores.with_sentiment`` takes the
    table as its lexicon.
    """
    told = log_odds(counts, prior_words).where(
        (F.abs("z") >= min_z) & (F.col("positive") + F.col("negative") >= min_count)
    )
    polarity = F.round(F.col("log_odds") / (1 + F.abs("log_odds")), 6)
    return told.select("word", "positive", "negative", "z", polarity.alias("polarity"))


def automaton_of(phrases: Mapping[str, float]):
    """Aho-Corasick automaton over phrases between blanks."""
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for phrase, polarity in phrases.items():
        words = phrase.split()
        automaton.add_word(f" {' '.join(words)} ", (len(words), float(polarity)))
    automaton.make_automaton()
    return automaton


def found_phrases(words: list[str], automaton) -> list[tuple[int, int, float]]:
    """(first word, words, polarity) of the phrases in a text from left to right: where some
    overlap, the one that begins first, and the longest of those."""
    line = f" {' '.join(words)} "
    # The blank before each word, by its place in the line.
    starts, at = {}, 0
    for number, word in enumerate(words):
        starts[at] = number
        at += len(word) + 1
    matches: dict[int, tuple[int, float]] = {}
    for end, (length, polarity) in automaton.iter(line):
        last = starts.get(end, len(words)) - 1
        first = last - length + 1
        if first not in matches or matches[first][0] < length:
            matches[first] = (length, polarity)
    out, free = [], 0
    for first in sorted(matches):
        if first >= free:
            length, polarity = matches[first]
            out.append((first, length, polarity))
            free = first + length
    return out


def phrase_polarities(
    words: list[str], automaton, negations: frozenset[str]
) -> tuple[list[float], int]:
    """Polarities of a text's phrases, and how many a negation turned round. A word inside a
    phrase negates nothing; a phrase between the negation and the next phrase takes it up."""
    polarities, turned, free = [], 0, 0
    for first, length, polarity in found_phrases(words, automaton):
        before = words[max(free, first - NEGATION_REACH) : first]
        if sum(word in negations for word in before) % 2:
            polarity *= NEGATED
            turned += 1
        polarities.append(polarity)
        free = first + length
    return polarities, turned


def with_phrase_sentiment(
    cleaned: DataFrame,
    phrases: Mapping[str, float] | None = None,
    negations: Sequence[str] = NEGATIONS,
) -> DataFrame:
    """Add ``phrase_sentiment`` (mean polarity of the phrases found, 0 without any), ``phrases`` and
    ``negated`` (their numbers).

    ``phrases`` (single words too) may be at most MAX_PHRASES. Texts are those of ``cleaned_review``;
    a null one has null results. Tasks read whole texts in one pass, without a shuffle.
    """
    phrases = {**LEXICON, **PHRASES} if phrases is None else dict(phrases)
    if len(phrases) > MAX_PHRASES:
        raise ValueError(f"more than {MAX_PHRASES} phrases")
    shared = cleaned.sparkSession.sparkContext.broadcast(phrases)
    negative = frozenset(negations)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = automaton_of(shared.value)
        for batch in batches:
            rows: tuple[list, list, list] = ([], [], [])
            for line in batch.column("text").to_pylist():
                result = (None, None, None)
                if line is not None:
                    found, turned = phrase_polarities(line.split(), automaton, negative)
                    mean = sum(found) / len(found) if found else 0.0
                    result = (mean, len(found), turned)
                for column, value in zip(rows, result):
                    column.append(value)
            kinds = (pa.float64(), pa.int32(), pa.int32())
            columns = [pa.array(c, kind) for c, kind in zip(rows, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("row"), *columns], names)

    # Columns of the result replace those of the same name.
    names = ["row", "phrase_sentiment", "phrases", "negated"]
    others = [c for c in cleaned.columns if c not in names[1:]]
    row = F.struct(*[F.col(f"`{c}`") for c in others]).alias("row")
    packed = cleaned.select(row, F.col("cleaned_review").alias("text"))
    schema = packed.select("row").schema.add("phrase_sentiment", T.DoubleType())
    schema = schema.add("phrases", T.IntegerType()).add("negated", T.IntegerType())
    return packed.mapInArrow(score, schema).select("row.*", *names[1:])
