"""Clusters of reviews by length and rating."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlab.operators.features import assemble, scale
from reviewlab.session import materialize

# Number of clusters and the columns they are formed from.
CLUSTERS = 5
CLUSTER_COLUMNS = ("review_length", "rating")
SEED = 42

CENTERS = T.StructType(
    [
        T.StructField("cluster", T.IntegerType()),
        T.StructField("cluster_center", T.ArrayType(T.DoubleType())),
    ]
)


def fit_clusters(
    reviews: DataFrame,
    columns: tuple[str, ...] = CLUSTER_COLUMNS,
    k: int = CLUSTERS,
    seed: int = SEED,
) -> tuple[DataFrame, KMeansModel]:
    """Reviews with their cluster in ``prediction``, and the model.

    ``reviews`` is read once to scale and, through KMeans' own cache, once to fit.
    """
    scaled = scale(assemble(reviews, list(columns)))
    model = KMeans(featuresCol="scaledFeatures", k=k, seed=seed).fit(scaled)
    return model.transform(scaled), model


def weighted_points(
    reviews: DataFrame, columns: tuple[str, ...] = CLUSTER_COLUMNS
) -> DataFrame:
    """The distinct points of the reviews, with the number of reviews at each in ``weight``.

    Lengths and ratings repeat, so there are far fewer points than reviews.
    """
    points = reviews.select(*[F.col(c).cast("double").alias(c) for c in columns]).dropna()
    return points.groupBy(*columns).agg(F.count(F.lit(1)).cast("double").alias("weight"))


def fit_weighted_clusters(
    reviews: DataFrame,
    columns: tuple[str, ...] = CLUSTER_COLUMNS,
    k: int = CLUSTERS,
    seed: int = SEED,
    iterations: int = 200,
    tolerance: float = 1e-9,
) -> tuple[DataFrame, KMeansModel]:
    """As ``fit_clusters``, but fitted on the weighted distinct points.

    Every step moves the centers as all reviews would, at the price of the distinct points, so it
    can afford to run until the centers rest. The start differs from that of ``fit_clusters``, so
    the two can settle in different places. Reviews without one of the columns are not clustered.
    """
    points = materialize(weighted_points(reviews, columns), "points")
    spread = reviews.dropna(subset=list(columns)).agg(
        *[F.stddev_samp(F.col(c).cast("double")).alias(c) for c in columns]
    ).first()

    def scaled(table: DataFrame) -> DataFrame:
        # A column without spread says nothing; the scaler makes it zero as well.
        names = [f"scaled_{c}" for c in columns]
        values = [F.col(c).cast("double") / spread[c] if spread[c] else F.lit(0.0) for c in columns]
        return assemble(
            table.dropna(subset=list(columns)).withColumns(dict(zip(names, values))),
            names,
            "scaledFeatures",
        ).drop(*names)

    means = KMeans(
        featuresCol="scaledFeatures", weightCol="weight", k=k, seed=seed, maxIter=iterations,
        tol=tolerance,
    )
    model = means.fit(scaled(points))
    return model.transform(scaled(reviews)), model


def cluster_sizes(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("prediction").agg(F.count(F.lit(1)).alias("count"))


def cluster_centers(reviews: DataFrame, model: KMeansModel) -> DataFrame:
    """The ``k`` centers in scaled units, with the cluster number."""
    rows = [(i, [float(x) for x in center]) for i, center in enumerate(model.clusterCenters())]
    return reviews.sparkSession.createDataFrame(rows, CENTERS)
