import random

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from reviewlab import schemas
from reviewlab.operators import features, models, sampling
from reviewlab.plans.modeling import evaluate_model, train_model
from reviewlab.sinks.writers import write_parquet


@pytest.fixture(scope="module")
def learnable(spark, tmp_path_factory):
    """A feature table in which the class can be read off the vector, with some noise."""
    rng = random.Random(5)
    rows = []
    for i in range(400):
        category = rng.choice([1, 2, 3])
        values = [rng.random() * 2 for _ in range(6)]
        values[category] += 4
        rows.append((str(i), Vectors.dense(values), float(category)))
    base = str(tmp_path_factory.mktemp("models"))
    write_parquet(spark.createDataFrame(rows, schemas.FEATURES), f"{base}/features")
    return base


@pytest.mark.parametrize("name", list(models.MODELS))
def test_every_model_learns_and_is_evaluated(spark, learnable, name):
    train_model(spark, learnable, name)
    metrics = {r["split"]: r for r in evaluate_model(spark, learnable, name).collect()}
    assert set(metrics) == {"train", "test"}
    assert sum(r["rows"] for r in metrics.values()) == 400
    kind = models.model_spec(name).kind
    if kind == models.CLASSIFIER:
        assert metrics["test"]["metric"] == "accuracy" and metrics["test"]["value"] > 0.8
        evaluator = MulticlassClassificationEvaluator(
            labelCol="rating_category", metricName="accuracy"
        )
    else:
        assert metrics["test"]["metric"] == "rmse" and metrics["test"]["value"] < 0.5
        evaluator = RegressionEvaluator(labelCol="rating_category", metricName="rmse")
    predictions = spark.read.parquet(f"{learnable}/predictions/{name}")
    columns = {"review_id", "features", "rating_category", "prediction", "split"}
    assert columns <= set(predictions.columns)
    if kind == models.CLASSIFIER:
        assert {"rawPrediction", "probability"} <= set(predictions.columns)
        seen = {r[0] for r in predictions.select("prediction").distinct().collect()}
        assert seen == {1.0, 2.0, 3.0}
    for split, row in metrics.items():
        part = predictions.where(F.col("split") == split)
        assert row["value"] == pytest.approx(evaluator.evaluate(part), abs=1e-9)


def test_training_is_repeatable(spark, learnable):
    table = spark.read.schema(schemas.FEATURES).parquet(f"{learnable}/features")
    runs = [
        sorted(
            models.train_and_score(df, "RandomForest")[0]
            .select("review_id", "prediction")
            .collect()
        )
        for df in (table, table)
    ]
    assert runs[0] == runs[1]


def test_unknown_model(spark, learnable):
    with pytest.raises(ValueError, match="unknown model 'Perceptron'"):
        train_model(spark, learnable, "Perceptron")


def ids(spark, n):
    return spark.range(n).select(F.col("id").cast("string").alias("review_id"))


def test_split_is_disjoint_complete_and_independent_of_partitions(spark):
    one = sampling.hash_split(ids(spark, 5000).coalesce(1)).collect()
    many = sampling.hash_split(ids(spark, 5000).repartition(7)).collect()
    assert sorted(one) == sorted(many)
    train = sum(r["split"] == "train" for r in one)
    assert len(one) == 5000 and 0.77 < train / 5000 < 0.83


@pytest.mark.parametrize("n", [1, 10, 333, 2999, 3000, 5000])
def test_cap_rows_equals_sort_and_limit(spark, n):
    table = ids(spark, 3000)
    expected = table.orderBy(F.md5("review_id")).limit(n).collect()
    assert sorted(sampling.cap_rows(table, n).collect()) == sorted(expected)


@pytest.mark.parametrize("n", [0, 1, 10, 50, 99])
def test_cap_rows_with_missing_and_repeated_ids(spark, n):
    missing = spark.createDataFrame(
        [(None if i < 60 else str(i), i) for i in range(100)], "review_id string, x int"
    )
    assert sampling.cap_rows(missing, n).count() == n
    same = spark.createDataFrame([("same", None) for _ in range(100)], missing.schema)
    assert sampling.cap_rows(same, n).count() == n


def test_rows_without_an_id_are_split_too(spark):
    rows = spark.createDataFrame([(None, i) for i in range(1000)], "review_id string, x int")
    train = sampling.hash_split(rows).where("split = 'train'").count()
    assert 700 < train < 900


def test_a_bound_on_the_fit_does_not_bound_the_scores(spark):
    rows = spark.createDataFrame(
        [(str(i), float(i % 2 + 1), float(i % 2)) for i in range(300)],
        "review_id string, rating_category double, x double",
    )
    vectors = features.assemble(rows, ["x"])
    scored, _ = models.train_and_score(vectors, "DecisionTree", max_fit_rows=20)
    assert scored.count() == 300
    assert scored.where("prediction = rating_category").count() == 300


def test_capping_does_not_shuffle_the_rows(spark):
    plan = sampling.cap_rows(ids(spark, 3000), 100)
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


def reviews(spark):
    rows = [
        ("a", "good film good", 3.0),
        ("b", "bad film", 1.0),
        ("c", "the of", 2.0),
        ("d", "plot  twist", 2.0),
    ]
    return spark.createDataFrame(
        rows, "review_id string, cleaned_review string, rating_category float"
    )


def test_hashed_features_equal_the_ml_stages(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import IDF, HashingTF, StopWordsRemover, Tokenizer

    stages = [
        Tokenizer(inputCol="cleaned_review", outputCol="words"),
        StopWordsRemover(inputCol="words", outputCol="filtered"),
        HashingTF(inputCol="filtered", outputCol="raw"),
        IDF(inputCol="raw", outputCol="features"),
    ]
    expected = Pipeline(stages=stages).fit(reviews(spark)).transform(reviews(spark))
    got, model = features.tfidf_features(reviews(spark))
    assert [(f.name, f.dataType) for f in got.schema] == [
        (f.name, f.dataType) for f in schemas.FEATURES
    ]
    key = "review_id"
    assert {r[key]: r["features"] for r in got.collect()} == {
        r[key]: r["features"] for r in expected.collect()
    }


def test_fitted_pipeline_survives_saving(spark, tmp_path):
    from pyspark.ml import PipelineModel

    got, model = features.tfidf_features(reviews(spark), num_features=64)
    model.save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m")).transform(reviews(spark))
    assert sorted(again.select("review_id", "features").collect(), key=str) == sorted(
        got.select("review_id", "features").collect(), key=str
    )


def test_fit_on_train_ignores_test_rows(spark):
    rows = [(str(i), "word" if i % 2 else "other", 1.0) for i in range(60)]
    df = spark.createDataFrame(rows, reviews(spark).schema)
    split = {r["review_id"]: r["split"] for r in sampling.hash_split(df).collect()}
    _, model = features.tfidf_features(df, num_features=64, fit_on="train")
    assert model.stages[-1].numDocs == sum(s == "train" for s in split.values())


def test_count_vectorizer_numbers_words_as_the_vocabulary(spark):
    vectors, terms = features.count_features(reviews(spark), 1000)
    order = [r["word"] for r in sorted(terms.collect(), key=lambda r: r["term"])]
    assert order == ["film", "good", "", "bad", "plot", "twist"]
    model = features.count_vectorizer(terms, "words", "v")
    assert model.vocabulary == order
    rows = {r["review_id"]: r["features"] for r in vectors.collect()}
    assert list(rows["d"].indices) == [2, 4, 5] and rows["c"].numNonzeros() == 0


def test_scaling_divides_by_the_sample_deviation(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 4.0), (4, 9.0)], "x int, y double")
    rows = features.scale(features.assemble(df, ["x", "y"])).collect()
    import numpy as np

    data = np.array([[1, 2.0], [2, 4.0], [4, 9.0]])
    expected = data / data.std(axis=0, ddof=1)
    assert np.allclose([r["scaledFeatures"].toArray() for r in rows], expected)


def test_logistic_regression_takes_large_blocks(spark):
    """For each block MLlib adds up all columns; the block size changes no result."""
    estimator = models.MODELS["LogisticRegression"].estimator("target")
    assert estimator.getMaxBlockSizeInMB() == models.BLOCK_MB > 1
    rows = [(Vectors.sparse(500, [i % 7, 10 + i % 450], [1.0, 1.0 + i % 3]), float(i % 3)) for i in range(90)]
    df = spark.createDataFrame(rows, ["features", "target"])
    found = estimator.fit(df).coefficientMatrix.toArray()
    small = estimator.copy({estimator.maxBlockSizeInMB: 0.001}).fit(df).coefficientMatrix.toArray()
    assert abs(found - small).max() < 1e-6
