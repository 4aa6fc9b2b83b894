import math
import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reviewlab.llm import quality


def repeated_words(text):
    words = [w for w in re.split("[ \t-\r]+", text or "") if w]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    counts = Counter(windows)
    return len({p for i, w in enumerate(windows) if counts[w] > 1 for p in range(i, i + 8)})


@settings(max_examples=5, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), max_size=60), min_size=1, max_size=20))
def test_repeated_words(spark, texts):
    texts = [" ".join(words) for words in texts]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["row"]["doc_id"]: r["n_repeat_words"] for r in quality.measure(docs).collect()}
    assert found == {i: repeated_words(t) for i, t in enumerate(texts)}


def test_long_repeats_are_counted(spark):
    text = " ".join(["a", "b", "c"] * 5000 + ["end"])
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert quality.measure(docs).first()["n_repeat_words"] == 15_000


def test_binomial_tail(spark):
    for n, k, p in ((1000, 0, 0.01), (1000, 3, 0.01), (50_000, 400, 0.01), (5, 5, 0.2)):
        exact = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(min(k, 40) + 1))
        row = spark.range(1).select(
            quality.log_binomial_cdf(F.lit(n).cast("long"), F.lit(k).cast("long"), p).alias("x")
        )
        found = row.first()["x"]
        if k <= 40:
            assert math.isclose(math.exp(found), exact, rel_tol=1e-6)
        else:
            assert -20 < found < 0


def test_certified_cutoffs_keep_good_documents(spark):
    rows = [("en", i % 10 > 0, 50 if i % 10 == 0 else i % 3) for i in range(20_000)]
    labelled = spark.createDataFrame(rows, "stratum string, good boolean, symbols int")
    labelled = labelled.select("*", *[F.lit(0).alias(r) for r in quality.RULES[1:]])
    best = quality.certify(labelled).collect()
    assert [(r["rule"], r["cutoff"], r["n_false"], r["n_caught"]) for r in best] == [
        ("symbols", 50, 0, 2000)
    ]
    assert quality.certify(labelled.limit(100)).count() == 0


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (2, None)], "doc_id long, quality int")
    judged = quality.verdicts(odd_docs, labels)
    assert judged.count() == odd_docs.count()
    assert not judged.where("row.doc_id = 3").first()["kept"]
    kept = quality.keep_good(odd_docs, labels)
    assert kept.columns == odd_docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {8}
    assert quality.verdicts(no_docs, labels.limit(0)).count() == 0
