import pytest
from pyspark.sql import functions as F

from reviewlab.functions import text
from reviewlab.functions.lexicon import LEXICON
from reviewlab.operators import scores


def reviews(spark, rows):
    return spark.createDataFrame(rows, "review_id string, cleaned_review string")


@pytest.mark.parametrize(
    "source, words, sentences, syllables",
    [
        ("The cat sat.", 3, 1, 3),
        ("One two. Three! Four?!", 4, 3, 5),
        ("beautiful day", 2, 1, 4),
        ("rhythm 12 bcd", 3, 1, 3),
        ("no end", 2, 1, 2),
    ],
)
def test_flesch(spark, source, words, sentences, syllables):
    expected = 206.835 - 1.015 * words / sentences - 84.6 * syllables / words
    got = spark.range(1).select(text.flesch_reading_ease(F.lit(source))).first()[0]
    assert got == pytest.approx(expected, rel=1e-6)


def test_flesch_without_words_is_null(spark):
    df = spark.createDataFrame([("",), ("...",), (None,), ("é",)], "t string")
    assert [r[0] for r in df.select(text.flesch_reading_ease(F.col("t"))).collect()] == [None] * 4


def test_polarity_is_a_mean_over_matches_with_multiplicity(spark):
    df = reviews(
        spark, [("a", "good good awful film"), ("b", "no match"), ("c", None), ("d", "")]
    )
    got = {r["review_id"]: r["sentiment_score"] for r in scores.with_sentiment(df).collect()}
    assert got == {"a": 0.0, "b": 0.0, "c": None, "d": 0.0}
    df = reviews(spark, [("a", "best film stupid best")])
    assert scores.with_sentiment(df).first()["sentiment_score"] == pytest.approx(1.25 / 3)


def test_inline_and_joined_lexicons_agree(spark):
    rows = [
        ("a", "good bad excellent plot"),
        ("b", "the worst film"),
        ("c", "neutral"),
        ("same", "good"),
        ("same", "awful"),
        ("twice", "fine"),
        ("twice", "fine"),
        (None, "superb"),
        ("null text", None),
    ]
    df = reviews(spark, rows)
    table = spark.createDataFrame(list(LEXICON.items()), "word string, polarity double")
    # A word that is listed twice counts with its mean polarity.
    table = table.union(spark.createDataFrame([("plot", 1.0), ("plot", 0.0)], table.schema))

    def key(row):
        return (row[0] or "", row[1] or "", row[2] or 0)

    inline = sorted(scores.with_sentiment(df, table).collect(), key=key)
    joined = sorted(scores.with_sentiment(df, table, max_inline_words=3).collect(), key=key)
    assert inline == joined
    assert len(joined) == len(rows)
    found = {(r[0], r[1]): r[2] for r in joined}
    assert found["same", "good"] == 0.5 and found["same", "awful"] == -1.0
    assert found["a", "good bad excellent plot"] == pytest.approx(0.375)


@pytest.mark.parametrize("size", [3, 40, 1000])
def test_any_number_of_polarities(spark, size):
    lexicon = {f"w{i}": i / size for i in range(size)} | {"unrated": None}
    df = reviews(spark, [("a", "w0 w1 w2 unrated"), ("b", "unrated")])
    table = spark.createDataFrame(list(lexicon.items()), "word string, polarity double")
    for given in (lexicon, table):
        found = {r[0]: r[2] for r in scores.with_sentiment(df, given).collect()}
        assert found["a"] == pytest.approx(1 / size) and found["b"] == 0


def test_inline_scoring_needs_no_shuffle(spark):
    plan = scores.with_sentiment(reviews(spark, [("a", "good")]))
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


def test_lexicon_polarities_are_quarters():
    assert all((p * 4).is_integer() and -1 <= p <= 1 for p in LEXICON.values())


def test_analysed_rows_have_length_and_rating(spark):
    df = spark.createDataFrame(
        [("a", "Good.", "good", 5.0), ("b", "x", "x", None), ("c", None, None, 1.0)],
        "review_id string, review_detail string, cleaned_review string, rating float",
    )
    rows = scores.analyse_reviews(df).collect()
    assert [(r["review_id"], r["review_length"], r["sentiment_score"]) for r in rows] == [
        ("a", 4, 0.5)
    ]
