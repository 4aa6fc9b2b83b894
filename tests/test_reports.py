import random

import numpy as np
import pytest

from reviewlab.operators import reports
from reviewlab.operators.quantiles import exact_quantiles

QUARTILES = (0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0)


def column(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v double")


def samples():
    rng = random.Random(11)
    return {
        "one": [3.0],
        "two": [1.0, 2.0],
        "constant": [4.0] * 300,
        "uniform": [rng.random() for _ in range(500)],
        "a third is one value": [7.0] * 170 + [rng.gauss(7, 50) for _ in range(330)],
        "two ends": [0.0] * 250 + [0.5, 0.6] + [1.0] * 250,
        "far outliers": [rng.random() for _ in range(400)] + [1e12, -1e12],
        "few values": [float(rng.randint(1, 4)) for _ in range(400)],
    }


@pytest.mark.parametrize("name", list(samples()))
@pytest.mark.parametrize("max_exact_rows, accuracy", [(10_000, 10_000), (5, 30)])
def test_exact_quantiles(spark, name, max_exact_rows, accuracy):
    """With few exact rows and a coarse sketch the interval is narrowed again and again."""
    values = samples()[name]
    df = column(spark, values + [None]).coalesce(1)
    probabilities = QUARTILES if accuracy > 30 else (0.25, 0.5, 0.99)
    got = exact_quantiles(df, "v", probabilities, max_exact_rows, accuracy)
    assert got == pytest.approx(list(np.quantile(values, probabilities)), rel=1e-12)


def test_quantiles_of_nothing(spark):
    assert exact_quantiles(column(spark, [None]), "v", (0.5, 0.9)) == [None, None]


def test_box_summary(spark):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 100.0, -50.0]
    row = reports.box_summary(column(spark, values + [None]), "v").first()
    q1, median, q3 = np.quantile(values, [0.25, 0.5, 0.75])
    assert (row["n"], row["q1"], row["median"], row["q3"]) == (7, q1, median, q3)
    assert (row["whisker_low"], row["whisker_high"], row["outliers"]) == (1.0, 5.0, 2)


def test_whiskers_reach_at_least_the_box(spark):
    row = reports.box_summary(column(spark, [0.0, 0.0, 0.0, 100.0]), "v").first()
    assert (row["q3"], row["whisker_high"], row["outliers"]) == (25.0, 25.0, 1)


def test_box_of_nothing(spark):
    row = reports.box_summary(column(spark, [None]), "v").first()
    assert row["n"] == 0 and row["outliers"] == 0


@pytest.mark.parametrize("values", [[1.0, 2.0, 10.0, 5.5, 5.5], [4.0, 4.0], [0.0, 0.1, 0.2, 1.0]])
def test_histogram_equals_numpy(spark, values):
    rows = reports.histogram(column(spark, values + [None, float("nan")]), "v", 20).collect()
    counts, edges = np.histogram(values, bins=20)
    ordered = sorted(rows, key=lambda r: r["bin"])
    assert [r["reviews"] for r in ordered] == list(counts)
    assert [r["bin_start"] for r in ordered] == pytest.approx(list(edges[:-1]))


def test_histogram_counts_its_input_once(spark, tmp_path):
    path = str(tmp_path / "v")
    column(spark, [1.0, 2.0, 3.0]).write.parquet(path)
    result = reports.histogram(spark.read.parquet(path), "v")
    result.collect()
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange [value" in plan.split("Initial Plan")[0]


def reviews(spark):
    rows = [
        ("ann", "m1", 8.0, "text", 0.5, 10),
        ("ann", "m2", 2.0, None, -0.5, 20),
        ("bob", "m1", 9.0, "text", 0.0, 5),
        ("cat", "m3", None, "text", None, None),
    ]
    return spark.createDataFrame(
        rows,
        "reviewer string, movie string, rating float, cleaned_review string,"
        " sentiment_score float, review_length int",
    )


def test_per_movie_and_per_reviewer(spark):
    movies = reports.avg_rating_per_movie(reviews(spark)).collect()
    assert [(r["movie"], r["avg_rating"]) for r in movies] == [
        ("m1", 8.5),
        ("m2", 2.0),
        ("m3", None),
    ]
    stats = {r["reviewer"]: tuple(r)[1:] for r in reports.reviewer_stats(reviews(spark)).collect()}
    assert stats == {"ann": (1, 5.0, 0.0), "bob": (1, 9.0, 0.0), "cat": (1, None, None)}
    head = reports.head_by_key(reports.reviewer_stats(reviews(spark)), "reviewer", 2)
    assert [r["reviewer"] for r in head.collect()] == ["ann", "bob"]


def test_unselected_aggregates_are_not_computed(spark):
    plan = reports.reviewer_stats(reviews(spark)).select("reviewer", "avg_rating")
    optimized = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "count(" not in optimized and "sentiment" not in optimized.split("LogicalRDD")[0]


def test_correlations(spark):
    df = spark.createDataFrame(
        [(1.0, 2.0, 5.0), (2.0, 4.0, 1.0), (3.0, 6.5, None), (None, 1.0, 2.0)],
        "rating double, flesch_score double, sentiment_score double",
    )
    r = {(x["x"], x["y"]): x["r"] for x in reports.correlation_matrix(df).collect()}
    pdf = df.toPandas().corr()
    assert len(r) == 9
    for (x, y), value in r.items():
        assert value == pytest.approx(pdf.loc[x, y])
    assert reports.correlation(reviews(spark)).first()[0] == pytest.approx(
        np.corrcoef([10, 20, 5], [8, 2, 9])[0, 1]
    )


def test_scatter_bins_and_long_reviews(spark):
    rows = reports.binned_scatter(reviews(spark)).collect()
    assert {(r["bin_x"], r["rating"]): r["reviews"] for r in rows} == {
        (10, 8.0): 1,
        (-10, 2.0): 1,
        (0, 9.0): 1,
    }
    assert reports.long_review_count(reviews(spark), 10).first()[0] == 2
