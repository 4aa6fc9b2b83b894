"""The learned lexicon next to its formula, and phrases next to a search word by word."""

import math
import random

import pytest

from reviewlab.functions.lexicon import LEXICON, NEGATIONS, PHRASES
from reviewlab.operators import scores, sentiment

COLUMNS = "review_id string, cleaned_review string, rating_category float"


def test_learned_words(spark):
    rows = [(str(i), "great plot the common", 3.0) for i in range(30)]
    rows += [(str(i), "awful plot the common", 1.0) for i in range(30)]
    rows += [("a", "middling plot", 2.0), ("b", None, 3.0), ("c", "", 1.0), ("d", "lucky", 3.0), ("e", "x", None)]
    counts = sentiment.rated_word_counts(spark.createDataFrame(rows, COLUMNS))
    found = {r["word"]: r for r in sentiment.learned_lexicon(counts).collect()}
    assert set(found) == {"great", "awful"}
    assert found["great"]["polarity"] > 0.2 and found["awful"]["polarity"] < -0.2
    good, bad = 91, 90
    share = 30 / (good + bad)
    y, n = 30 + 500 * share, 500 * share
    odds = math.log(y / (good + 500 - y)) - math.log(n / (bad + 500 - n))
    assert found["great"]["z"] == pytest.approx(odds / math.sqrt(1 / y + 1 / n))
    assert found["great"]["polarity"] == round(odds / (1 + odds), 6)


def test_learned_words_score_reviews(spark):
    rows = [(str(i), "great plot" if i % 2 else "awful plot", 3.0 if i % 2 else 1.0) for i in range(60)]
    reviews = spark.createDataFrame(rows, COLUMNS)
    lexicon = sentiment.learned_lexicon(sentiment.rated_word_counts(reviews)).select("word", "polarity")
    scored = scores.with_sentiment(reviews, lexicon).collect()
    assert all((r["sentiment_score"] > 0) == (r["rating_category"] == 3.0) for r in scored)


def test_no_reviews(spark):
    empty = spark.createDataFrame([], COLUMNS)
    assert sentiment.learned_lexicon(sentiment.rated_word_counts(empty)).count() == 0
    assert sentiment.with_phrase_sentiment(empty).columns[-3:] == ["phrase_sentiment", "phrases", "negated"]
    assert sentiment.with_phrase_sentiment(empty).count() == 0


def search(words, phrases):
    """Every place is looked at from left to right; the longest phrase there is taken."""
    found, place, free = [], 0, 0
    lengths = sorted({len(p.split()) for p in phrases}, reverse=True)
    while place < len(words):
        for length in lengths:
            phrase = " ".join(words[place : place + length])
            if place + length <= len(words) and phrase in phrases:
                before = words[max(free, place - 3) : place]
                odd = sum(w in NEGATIONS for w in before) % 2
                found.append(phrases[phrase] * (-0.5 if odd else 1))
                place += length
                free = place
                break
        else:
            place += 1
    return found


def test_phrases_of_random_texts(spark):
    rng = random.Random(2)
    phrases = {"a b": 0.5, "b": -1.0, "b c d": 0.25, "c": 1.0, "not c": 0.75, "d e a b": -0.5, "bb": 0.125}
    texts = [" ".join(rng.choices(["a", "b", "c", "d", "e", "not", "never", "bb", ""], k=rng.randrange(25))) for _ in range(400)]
    frame = spark.createDataFrame([(str(i), t, i) for i, t in enumerate(texts)], "review_id string, cleaned_review string, phrases int")
    rows = sentiment.with_phrase_sentiment(frame, phrases).collect()
    assert len(rows) == len(texts) and rows[0].asDict().keys() == {"review_id", "cleaned_review", "phrase_sentiment", "phrases", "negated"}
    for row in rows:
        want = search(row["cleaned_review"].split(), phrases)
        assert row["phrases"] == len(want)
        assert row["phrase_sentiment"] == pytest.approx(sum(want) / len(want) if want else 0.0)


@pytest.mark.parametrize(
    "line, score, negated",
    [
        ("a good film", 0.5, 0), ("not a good film", -0.25, 1), ("it is not not good", 0.5, 0),
        ("not bad", 0.25, 0), ("never a waste of time", 0.375, 1), ("not at all that very good", 0.5, 0),
        ("goodness", 0.0, 0), ("", 0.0, 0), ("so bad", -1.0, 0), (None, None, None),
    ],
)
def test_negation(spark, line, score, negated):
    frame = spark.createDataFrame([("1", line)], "review_id string, cleaned_review string")
    row = sentiment.with_phrase_sentiment(frame).first()
    assert (row["phrase_sentiment"], row["negated"]) == (score, negated)


def test_too_many_phrases(spark, monkeypatch):
    monkeypatch.setattr(sentiment, "MAX_PHRASES", 3)
    with pytest.raises(ValueError):
        sentiment.with_phrase_sentiment(spark.createDataFrame([], COLUMNS))


def test_long_text_takes_one_pass():
    words = "not good at all one of the best waste of".split() * 50_000
    automaton = sentiment.automaton_of({**LEXICON, **PHRASES})
    found, turned = sentiment.phrase_polarities(words, automaton, frozenset(NEGATIONS))
    assert len(found) == 150_000 and turned == 50_000
