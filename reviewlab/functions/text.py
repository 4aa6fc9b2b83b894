"""Text expressions: cleaning, tokens, readability and polarity.

All are built-in expressions that run inside the JVM; no Python runs per row.
"""

from __future__ import annotations

import string
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from reviewlab.functions.stopwords import STOP_WORDS

# The characters cleaning keeps (ASCII letters, digits, the blank), the rating
# bounds of the categories, and the constants and patterns of the reading-ease score.
KEPT_CHARACTERS = string.ascii_letters + string.digits + " "
CATEGORY_BOUNDS = ((6.66, 3.0), (3.33, 2.0), (0.0, 1.0))
FLESCH_BASE, FLESCH_PER_SENTENCE, FLESCH_PER_WORD = 206.835, 1.015, 84.6
WORD_CHARACTERS = string.ascii_lowercase + string.digits
WORD_PATTERN = f"[{WORD_CHARACTERS}]+"
SENTENCE_PATTERN = "[.!?]+"
SYLLABLE_PATTERN = "[aeiouy]+"

# Characters the regular expression \s matches in Java.
WHITESPACE = " \t\n\u000b\f\r"


def strip_punctuation(text: Column) -> Column:
    """Delete every character but ASCII letters, digits and the blank.

    The class lists its characters one by one because Java turns such a class into a bit
    table; the same class written with ranges ran four to six times slower on the test texts.
    """
    return F.regexp_replace(text, f"[^{KEPT_CHARACTERS}]+", "")


def parse_rating(rating: Column) -> Column:
    """Rating as a 32-bit float; what is not a number becomes null instead of an error."""
    return rating.try_cast("float")


def rating_category(rating: Column) -> Column:
    """Class 3, 2 or 1 of a rating; null for a missing, negative or NaN one.

    The bounds are doubles, so a 32-bit 3.33 (a little below the bound) stays in class 1.
    NaN needs its own test because SQL orders it above every number.
    """
    category = F.when(F.isnan(rating), F.lit(None))
    for bound, label in CATEGORY_BOUNDS:
        category = category.when(rating >= F.lit(bound), F.lit(label))
    return category.cast("float")


def tokens(text: Column) -> Column:
    """Lower-cased text split at each single whitespace character.

    Runs of whitespace give empty tokens, trailing ones give none, empty text gives one empty
    token and blank text gives no token.
    """
    trimmed = F.rtrim(text, F.lit(WHITESPACE))
    return _tokens(text, trimmed, F.split(F.lower(trimmed), r"\s"))


def cleaned_tokens(text: Column) -> Column:
    """The same for cleaned text, which is lower-case and has no whitespace but blanks.

    Splitting at one plain character needs no regular expression.
    """
    trimmed = F.rtrim(text)
    return _tokens(text, trimmed, F.split(trimmed, " "))


def _tokens(text: Column, trimmed: Column, parts: Column) -> Column:
    only_blanks = (text != "") & (trimmed == "")
    return F.when(only_blanks, F.array().cast("array<string>")).otherwise(parts)


def is_content_word(word: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """Whether a lower-case word is no stop word."""
    return ~word.isin(list(stop_words))


def content_words(words: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """The array without its stop words."""
    return F.filter(words, lambda word: is_content_word(word, stop_words))


def flesch_reading_ease(text: Column) -> Column:
    """Reading ease from counted words, sentences and vowel groups; null without a word."""
    lowered = F.lower(text)
    words = F.regexp_count(lowered, F.lit(WORD_PATTERN))
    sentences = F.greatest(F.regexp_count(lowered, F.lit(SENTENCE_PATTERN)), F.lit(1))
    syllables = F.greatest(F.regexp_count(lowered, F.lit(SYLLABLE_PATTERN)), words)
    # Not inside a condition: there Spark would not share the repeated counts.
    score = (
        F.lit(FLESCH_BASE)
        - F.lit(FLESCH_PER_SENTENCE) * words / sentences
        - F.lit(FLESCH_PER_WORD) * syllables / F.nullif(words, F.lit(0))
    )
    return score.cast("float")


def mean_polarity(words: Column, lexicon: Mapping[str, float]) -> Column:
    """Mean polarity of the words found in a small lexicon, 0 when none is found.

    The lexicon becomes set-membership tests, one hash lookup for a word without polarity, so
    scoring neither joins nor shuffles. Larger lexicons go through a join instead
    (``operators.scores.with_sentiment``).
    """
    by_polarity: dict[float, list[str]] = {}
    for word, polarity in lexicon.items():
        by_polarity.setdefault(float(polarity), []).append(word)

    def polarity_of(word: Column) -> Column:
        chosen = F.lit(None).cast("double")
        for polarity, members in by_polarity.items():
            chosen = F.when(word.isin(members), F.lit(polarity)).otherwise(chosen)
        return chosen

    found = F.filter(words, lambda word: word.isin(list(lexicon)))
    mean = F.aggregate(
        found,
        F.struct(F.lit(0.0).alias("total"), F.lit(0).alias("n")),
        lambda acc, word: F.struct(
            (acc["total"] + polarity_of(word)).alias("total"), (acc["n"] + 1).alias("n")
        ),
        lambda acc: F.when(acc["n"] == 0, 0.0).otherwise(acc["total"] / acc["n"]),
    )
    return mean.cast("float")


def split_bucket(key: Column) -> Column:
    """A number 0..99 that depends on the key alone, so it survives any re-partitioning."""
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint") % 100
