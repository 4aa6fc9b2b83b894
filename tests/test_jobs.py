"""The jobs from raw JSON to metrics, on the smallest test tables."""

from pathlib import Path

import pytest

from reviewlab import jobs, schemas
from reviewlab.session import shared_dir
from reviewlab.sources import tables, testtables


@pytest.fixture(scope="module")
def base(spark, small, tmp_path_factory):
    root = tmp_path_factory.mktemp("jobs")
    raw = testtables.raw_reviews(testtables.table(spark, small, "documents"))
    raw.select("review_json.*").write.json(str(root / "in"))
    base = str(root / "out")
    jobs.run(
        spark, ["preprocess", "--folder", str(root / "in"), "--base", base, "--layout", "lines"]
    )
    return base


def test_nothing_is_left_in_the_shared_folder(spark, base, tmp_path):
    before = set(Path(shared_dir(spark).removeprefix("file:")).iterdir())
    jobs.run(spark, ["explore", "--base", base, "--vocabulary-size", "500"])
    assert set(Path(shared_dir(spark).removeprefix("file:")).iterdir()) == before


def test_stage_tables(spark, base):
    assert spark.read.parquet(f"{base}/raw_full").schema == schemas.RAW
    flat = tables.read_flat(spark, f"{base}/flat")
    cleaned = tables.read_cleaned(spark, f"{base}/cleaned")
    features = tables.read_features(spark, f"{base}/features")
    assert flat.count() == 200
    assert 0 < cleaned.count() == features.count() < 200
    assert features.first()["features"].size == 1 << 18


def test_explore(spark, base):
    jobs.run(spark, ["explore", "--base", base])
    cleaned = tables.read_cleaned(spark, f"{base}/cleaned").count()
    out = f"{base}/reports"
    assert spark.read.parquet(f"{out}/topics").count() == 10
    assert spark.read.text(f"{out}/topic_lines").count() == 10
    assert spark.read.parquet(f"{out}/cluster_centers").count() == 5

    def report(name, schema):
        return tables.read_csv_report(spark, f"{out}/{name}", schema)

    sizes = report("cluster_sizes", "prediction int, count long").collect()
    assert sum(r["count"] for r in sizes) == cleaned
    assert report("top_words", schemas.WORD_COUNTS).count() == 20
    shares = report("word_share", "word string, count long, share double").collect()
    assert sum(r["share"] for r in shares) == pytest.approx(1)
    ratings = report("avg_rating_per_reviewer", schemas.REVIEWER_RATINGS)
    sentiment = report("avg_sentiment_per_reviewer", schemas.REVIEWER_SENTIMENT)
    counts = report("review_count_per_reviewer", "reviewer string, total_reviews long")
    assert ratings.count() == sentiment.count() == counts.count() > 0
    assert sum(r["total_reviews"] for r in counts.collect()) == cleaned
    assert report("correlation", "correlation double").count() == 1
    assert report("correlation_matrix", "x string, y string, r double").count() == 9
    bins = report("rating_histogram", "bin int, s double, e double, reviews long").collect()
    assert len(bins) == 20 and sum(r["reviews"] for r in bins) == cleaned
    assert spark.read.csv(f"{out}/flesch_box", header=True).count() == 1
    analysed = tables.read_analysed(spark, f"{base}/analysed")
    assert analysed.count() == cleaned
    assert spark.read.parquet(f"{base}/analysed").schema == analysed.schema


def test_model(spark, base, capsys):
    jobs.run(spark, ["model", "--base", base, "--name", "NaiveBayes"])
    assert "accuracy" in capsys.readouterr().out
    predictions = tables.read_predictions(spark, base, "NaiveBayes")
    cleaned = tables.read_cleaned(spark, f"{base}/cleaned").count()
    assert predictions.count() == cleaned
    assert {r[0] for r in predictions.select("split").distinct().collect()} == {"train", "test"}


def test_unknown_model_name_is_refused(spark, base):
    with pytest.raises(SystemExit):
        jobs.run(spark, ["model", "--base", base, "--name", "Perceptron"])
