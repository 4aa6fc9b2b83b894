import math
import random
from collections import Counter

import pytest
from pyspark.ml.feature import StopWordsRemover, Tokenizer
from pyspark.sql import functions as F

from reviewlab.functions import text
from reviewlab.functions.stopwords import STOP_WORDS
from reviewlab.operators import words
from reviewlab.operators.features import tokenizer_stage

TEXTS = [
    "",
    " ",
    "   ",
    "a film",
    " leading and  double blanks ",
    "trailing   ",
    "the the the",
    "dont stop",
    "x" * 50 + " y",
    "nan nan the good",
]


def table(spark, texts):
    rows = [(str(i), t) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "review_id string, cleaned_review string")


def random_texts(n=60, seed=7):
    rng = random.Random(seed)
    vocabulary = ["the", "a", "film", "good", "bad", "", "plot", "of", "hot"]
    return [" ".join(rng.choices(vocabulary, k=rng.randint(0, 30))) for _ in range(n)]


def content(texts):
    """The kept tokens of each text, by plain Python."""
    out = []
    for t in texts:
        trimmed = t.rstrip(" ")
        tokens = [] if not trimmed and t else trimmed.split(" ")
        out.append([w for w in tokens if w not in STOP_WORDS])
    return out


def test_stop_words_are_the_default_list(spark):
    assert STOP_WORDS == StopWordsRemover.loadDefaultStopWords("english")


@pytest.mark.parametrize(
    "split, texts",
    [
        (text.cleaned_tokens, TEXTS),
        (text.tokens, TEXTS + ["Tab\tand\nline", "\t\n ", "MiXed Case\r\n", "The a\u000bb\f"]),
    ],
)
def test_tokens_equal_the_ml_stages(spark, split, texts):
    df = table(spark, texts)
    ml = StopWordsRemover(inputCol="words", outputCol="filtered").transform(
        Tokenizer(inputCol="cleaned_review", outputCol="words").transform(df)
    )
    own = df.withColumn("words", split(F.col("cleaned_review"))).withColumn(
        "filtered", text.content_words(F.col("words"))
    )
    assert sorted(own.collect()) == sorted(ml.collect())
    if split is text.cleaned_tokens:
        assert sorted(tokenizer_stage().transform(df).collect()) == sorted(ml.collect())


def test_null_text_has_null_tokens(spark):
    df = spark.createDataFrame([(None,)], "t string")
    assert df.select(text.tokens(F.col("t"))).first()[0] is None
    assert df.select(text.cleaned_tokens(F.col("t"))).first()[0] is None


def test_word_counts_and_top_words(spark):
    texts = TEXTS + random_texts()
    expected = Counter(w for ws in content(texts) for w in ws)
    df = table(spark, texts)
    assert {r["word"]: r["count"] for r in words.word_counts(df).collect()} == expected
    top = [(r["word"], r["count"]) for r in words.top_words(df, 4).collect()]
    assert top == sorted(expected.items(), key=lambda x: (-x[1], x[0]))[:4]
    without = {r["word"] for r in words.word_counts(df, drop_empty_tokens=True).collect()}
    assert without == set(expected) - {""}


def test_shares_of_as_many_words_as_asked_for(spark):
    df = table(spark, ["w1 w1 w1  w2 w2 nan nan nan w3", "  w4"])
    top = words.top_words(df, 3, without=words.NO_WORDS)
    assert [r["word"] for r in words.word_share(top).collect()] == ["w1", "w2", "w3"]


def test_word_share_leaves_out_empty_and_nan(spark):
    top = spark.createDataFrame(
        [("a", 6), ("", 100), ("nan", 9), (None, 5), ("b", 2)], "word string, count long"
    )
    rows = [(r["word"], r["share"]) for r in words.word_share(top).collect()]
    assert rows == [("a", 0.75), ("b", 0.25)]


def test_term_and_document_frequencies_by_brute_force(spark):
    texts = TEXTS + random_texts()
    kept = content(texts)
    tf = {(str(i), w): n for i, ws in enumerate(kept) for w, n in Counter(ws).items()}
    df = Counter(w for ws in kept for w in set(ws))
    rows = words.tfidf_terms(table(spark, texts)).collect()
    assert {(r["review_id"], r["word"]): r["tf"] for r in rows} == tf
    for r in rows:
        assert r["df"] == df[r["word"]]
        idf = math.log((len(texts) + 1) / (r["df"] + 1))
        assert r["tfidf"] == pytest.approx(r["tf"] * idf, abs=1e-12)


@pytest.mark.parametrize("limit", [0, 1, 4, 10_000])
def test_frequent_and_rare_words_together_are_all_words(spark, monkeypatch, limit):
    """However many words may be broadcast, the joined rows are the same."""
    monkeypatch.setattr(words, "MAX_BROADCAST_WORDS", limit)
    df = table(spark, TEXTS + random_texts())
    terms = words.term_frequencies(df)
    weights = words.document_frequencies(df).cache()
    joined = words.join_by_word(terms, weights, df.count())
    expected = terms.join(weights, "word")
    assert sorted(joined.select(expected.columns).collect()) == sorted(expected.collect())


def test_long_words_count_against_the_broadcast(spark, monkeypatch):
    monkeypatch.setattr(words, "MAX_BROADCAST_CHARS", 40)
    df = table(spark, ["x" * 50 + " y", "y z"])
    weights = words.document_frequencies(df).cache()
    joined = words.join_by_word(words.term_frequencies(df), weights, 2)
    assert sorted((r["word"][0], r["df"]) for r in joined.collect()) == [
        ("x", 1),
        ("y", 2),
        ("y", 2),
        ("z", 1),
    ]


@pytest.mark.parametrize("size", [3, 10, 100, 5000, None])
def test_vocabulary_equals_a_full_sort(spark, size):
    rng = random.Random(3)
    texts = [" ".join(f"w{int(rng.paretovariate(0.35))}" for _ in range(60)) for _ in range(40)]
    counts = Counter(w for t in texts for w in t.split(" "))
    expected = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:size]
    rows = words.vocabulary(table(spark, texts), size).collect()
    assert [(r["word"], r["count"]) for r in sorted(rows, key=lambda r: r["term"])] == expected
    assert sorted(r["term"] for r in rows) == list(range(len(expected)))


def test_what_a_vocabulary_leaves_out(spark):
    terms = words.vocabulary(table(spark, ["w1 w1 w1 w2 w2 w3 w4"]))
    assert tuple(words.left_out(terms, 2).first()) == (2, 2)
    assert tuple(words.left_out(terms, 9).first()) == (0, 0)


def test_term_frequencies_need_no_shuffle(spark):
    plan = words.term_frequencies(table(spark, TEXTS))
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def skewed(spark):
    """30,000 words, of which one is a third; many words occur once."""
    draw = random.Random(11)
    drawn = ["film0" if draw.random() < 0.33 else f"w{int(draw.paretovariate(0.35))}" for _ in range(30_000)]
    texts = [" ".join(drawn[i : i + 100]) for i in range(0, len(drawn), 100)]
    return table(spark, [*texts, "", None, "the the"]).repartition(7)


def test_frequent_words_are_the_top_words(skewed):
    for n, tracked in ((1, 200), (5, 200), (5, 8), (20, 1 << 14)):
        found = [tuple(r) for r in words.frequent_words(skewed, n, tracked=tracked).collect()]
        assert found == [tuple(r) for r in words.top_words(skewed, n).collect()], (n, tracked)
    assert words.frequent_words(skewed, 0).count() == 0


def test_frequent_words_settles_by_the_sketch(skewed):
    exploded = words._content_words(skewed, False)
    distinct = words.word_counts(skewed).count()
    candidates = words._frequent_candidates(exploded, 5, 1000)
    assert distinct > 1500 and 5 <= len(candidates) < 100
    assert words._frequent_candidates(exploded, 5, 8) is None


def test_the_sketch_keeps_its_bound(skewed):
    """Counts are off by the error at most; words that are not returned occur at most twice that."""
    exact = {r["word"]: r["count"] for r in words.word_counts(skewed).collect()}
    total = sum(exact.values())
    for tracked in (16, 100, 500):
        error = words.sketch_error(total, tracked)
        exploded = words._content_words(skewed, False).repartition(9)
        top = exploded.groupBy(F.spark_partition_id().alias("part")).agg(
            F.expr(f"approx_top_k_accumulate(word, {tracked})").alias("sketch")
        )
        top = top.agg(F.expr("approx_top_k_combine(sketch)").alias("sketch"))
        top = top.select(F.inline(F.expr(f"approx_top_k_estimate(sketch, {tracked})"))).collect()
        estimates = {r["item"]: r["count"] for r in top}
        assert all(abs(count - exact[word]) <= error for word, count in estimates.items())
        assert all(count <= 2 * error for word, count in exact.items() if word not in estimates)


def test_frequent_words_of_small_tables(spark):
    for texts in ([], ["", None], ["b a b", "a c"], ["the the"]):
        df = table(spark, texts)
        for without in ((), words.NO_WORDS):
            found = words.frequent_words(df, 3, without).collect()
            assert found == words.top_words(df, 3, without).collect()
