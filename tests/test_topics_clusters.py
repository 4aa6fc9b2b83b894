import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.clustering import LDA
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from reviewlab.operators import clusters, topics


def test_clusters(spark):
    rows = [(str(i), 1000 + 4000 * (i % 5) + i, float(1 + 2 * (i % 5))) for i in range(200)]
    df = spark.createDataFrame(rows, "review_id string, review_length int, rating float")
    predictions, model = clusters.fit_clusters(df)
    sizes = {r["prediction"]: r["count"] for r in clusters.cluster_sizes(predictions).collect()}
    assert sum(sizes.values()) == 200 and set(sizes) == set(range(5))
    centers = clusters.cluster_centers(predictions, model).collect()
    assert [r["cluster"] for r in centers] == list(range(5))
    assert all(len(r["cluster_center"]) == 2 for r in centers)
    again = clusters.cluster_sizes(clusters.fit_clusters(df)[0]).collect()
    assert {r["prediction"]: r["count"] for r in again} == sizes


@pytest.fixture(scope="module")
def corpus(spark):
    themes = ["ship sea storm sailor", "laugh joke comic stage", "ghost dark house scream"]
    rows = [(str(i), " ".join([themes[i % 3]] * 5 + [f"extra{i % 7}"])) for i in range(60)]
    return spark.createDataFrame(rows, "review_id string, cleaned_review string")


def test_topics(spark, corpus):
    found, terms = topics.fit_topics(corpus, 1000, k=4, iterations=5)
    rows = found.collect()
    assert [f.simpleString() for f in found.schema] == [
        "topic:int",
        "termIndices:array<int>",
        "termWeights:array<double>",
    ]
    assert len(rows) == 4 and all(len(r["termIndices"]) == 10 for r in rows)
    names = {r["term"]: r["word"] for r in terms.collect()}
    spelled = topics.topic_terms(found, terms)
    for r in rows:
        words = spelled.where(F.col("topic") == r["topic"]).orderBy("rank").collect()
        assert [w["word"] for w in words] == [names[i] for i in r["termIndices"]]
        assert [w["weight"] for w in words] == r["termWeights"]
    lines = [r["TopicDetails"] for r in topics.topic_lines(spelled).collect()]
    first = rows[0]
    expected = "Topic 0: " + " ".join(
        f"{names[i]}({w})" for i, w in zip(first["termIndices"], first["termWeights"])
    )
    assert lines[0] == expected and len(lines) == 4


def test_topics_are_repeatable(spark, corpus):
    runs = [topics.fit_topics(corpus, 1000, k=3, iterations=3)[0].collect() for _ in range(2)]
    assert runs[0] == runs[1]


def test_weighted_clusters_rest_for_all_reviews(spark):
    """One step over all reviews moves no center, though the fit saw distinct points only."""
    rows = [(str(i), 1000 + 37 * (i * i % 101), float(1 + i % 10)) for i in range(3000)]
    rows += [("odd", None, 3.0), ("odd", 1500, None)]
    df = spark.createDataFrame(rows, "review_id string, review_length int, rating float")
    points = clusters.weighted_points(df)
    assert points.agg(F.sum("weight")).first()[0] == 3000 and points.count() < 1000
    predictions, model = clusters.fit_weighted_clusters(df)
    assert predictions.count() == 3000
    assert predictions.columns == [*df.columns, "scaledFeatures", "prediction"]
    for cluster, center in enumerate(model.clusterCenters()):
        own = [r["scaledFeatures"] for r in predictions.where(F.col("prediction") == cluster).collect()]
        assert own
        means = [sum(v[i] for v in own) / len(own) for i in range(2)]
        assert means == pytest.approx(center.tolist(), abs=1e-6)


def test_weighted_clusters_of_a_constant_column(spark):
    rows = [(str(i), 1000 + i % 7, 5.0) for i in range(70)]
    df = spark.createDataFrame(rows, "review_id string, review_length int, rating float")
    predictions, _ = clusters.fit_weighted_clusters(df, k=3)
    assert predictions.select("prediction").distinct().count() == 3


def sparse_reviews(n: int, width: int):
    rng = np.random.default_rng(3)
    for i in range(n):
        ids = rng.choice(width, 3 + i % 9, replace=False)
        yield np.sort(ids).tolist(), rng.integers(1, 30, len(ids)).astype(float).tolist()


def plain_weights(factors, ids, amounts, alpha):
    """MLlib's steps, one review at a time. Returns the weights and the number of steps."""
    gamma, steps = np.ones(len(alpha)), 0
    while True:
        share = np.exp(topics.expectation(gamma))
        last, steps = gamma, steps + 1
        gamma = share * (factors[ids].T @ (amounts / (factors[ids] @ share + 1e-100))) + alpha
        if abs(gamma - last).mean() <= topics.TOLERANCE:
            return gamma, steps


def test_digamma():
    assert topics.digamma(np.array([1.0, 0.5, 10.0])) == pytest.approx(
        [-0.5772156649015329, -1.9635100260214235, 2.251752589066721], abs=1e-10
    )
    assert topics.trigamma(np.array([1.0, 0.5])) == pytest.approx([np.pi**2 / 6, np.pi**2 / 2], abs=1e-8)


def test_topic_weights_are_those_of_plain_steps_in_far_fewer():
    rng = np.random.default_rng(5)
    start = rng.gamma(100.0, 0.01, (4, 200))
    factors = np.exp(topics.expectation(start)).T.copy()
    alpha, calls = np.full(4, 0.25), []
    reviews = list(sparse_reviews(40, 200))
    lists = [pa.array(part) for part in zip(*reviews)]
    batch = pa.RecordBatch.from_arrays(lists, ["columns", "amounts"])
    plain = {tuple(i): plain_weights(factors, np.array(i), np.array(a), alpha) for i, a in reviews}
    seen, expectation = 0, topics.expectation
    for ids, amounts in topics.blocks_of(batch):
        weights = factors[ids].transpose(0, 2, 1).copy()
        topics.expectation = lambda gamma: calls.append(len(gamma)) or expectation(gamma)
        try:
            found = topics.review_weights(weights, amounts, alpha)
        finally:
            topics.expectation = expectation
        for i, a, gamma in zip(ids, amounts, found):
            want, _ = plain[tuple(i[a > 0].tolist())]
            assert gamma.sum() == pytest.approx(a.sum() + 1.0)
            assert np.abs(gamma - want).sum() < 0.05 * want.sum()
            seen += 1
    assert seen == 40 and sum(calls) < sum(steps for _, steps in plain.values()) / 3


def test_every_review_is_read_once_in_an_iteration(spark):
    rows = [*sparse_reviews(30, 50), ([], []), ([3], [0.0])]
    entries = spark.createDataFrame(rows, "columns array<int>, amounts array<double>").repartition(4)
    factors = np.full((50, 3), 0.1)
    shared = spark.sparkContext.broadcast((factors, np.full(3, 1 / 3)))
    term, n, sums = topics.summed(entries, shared, 3)
    assert n.sum() == 30
    want = np.zeros(50)
    for ids, amounts in rows[:30]:
        want[ids] += amounts
    assert sums[term >= 0].sum(axis=1) == pytest.approx(want[term[term >= 0]], abs=1e-5)
    assert set(term) == {-1, *np.flatnonzero(want)}


def test_topics_are_close_to_those_of_mllib(spark):
    rows = list(sparse_reviews(300, 20))
    entries = spark.createDataFrame(rows, "columns array<int>, amounts array<double>").coalesce(2)
    lda = LDA(k=2, maxIter=5, seed=7, subsamplingRate=1.0)
    got = topics.learned_topics(entries, lda, 20)
    vectors = [(Vectors.sparse(20, ids, amounts),) for ids, amounts in rows]
    want = lda.fit(spark.createDataFrame(vectors, ["features"])).topicsMatrix().toArray()
    assert np.abs(got / got.sum(axis=0) - want / want.sum(axis=0)).sum(axis=0).max() < 0.2
