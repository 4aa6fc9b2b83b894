"""One explicit schema per stage, given to every reader."""

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import types as T

REVIEW = T.StructType(
    [
        T.StructField("review_id", T.StringType()),
        T.StructField("reviewer", T.StringType()),
        T.StructField("movie", T.StringType()),
        T.StructField("rating", T.StringType()),
        T.StructField("review_summary", T.StringType()),
        T.StructField("review_date", T.StringType()),
        T.StructField("spoiler_tag", T.LongType()),
        T.StructField("review_detail", T.StringType()),
        T.StructField("helpful", T.ArrayType(T.StringType())),
    ]
)

RAW = T.StructType([T.StructField("review_json", REVIEW)])

FLAT = REVIEW

CLEANED = T.StructType(
    [T.StructField(f.name, T.FloatType() if f.name == "rating" else f.dataType) for f in REVIEW]
    + [
        T.StructField("rating_category", T.FloatType()),
        T.StructField("cleaned_review", T.StringType()),
    ]
)

ANALYSED = T.StructType(
    CLEANED.fields
    + [
        T.StructField("flesch_score", T.FloatType()),
        T.StructField("sentiment_score", T.FloatType()),
        T.StructField("review_length", T.IntegerType()),
    ]
)

FEATURES = T.StructType(
    [
        T.StructField("review_id", T.StringType()),
        T.StructField("features", VectorUDT()),
        T.StructField("rating_category", T.FloatType()),
    ]
)

PREDICTIONS = T.StructType(
    FEATURES.fields
    + [T.StructField("prediction", T.DoubleType()), T.StructField("split", T.StringType())]
)

BLOB = T.StructType([T.StructField("json_blob", T.StringType())])

TRACK_RECORD = T.StructType(
    [
        T.StructField("track_id", T.LongType()),
        T.StructField("track_name", T.StringType()),
        T.StructField("track_price", T.DoubleType()),
        T.StructField("collection_id", T.LongType()),
        T.StructField("collection_name", T.StringType()),
        T.StructField("artist_id", T.LongType()),
        T.StructField("artist_name", T.StringType()),
    ]
)

WORD_COUNTS = T.StructType(
    [T.StructField("word", T.StringType()), T.StructField("count", T.LongType())]
)

REVIEWER_RATINGS = T.StructType(
    [T.StructField("reviewer", T.StringType()), T.StructField("avg_rating", T.DoubleType())]
)

REVIEWER_SENTIMENT = T.StructType(
    [T.StructField("reviewer", T.StringType()), T.StructField("avg_sentiment", T.DoubleType())]
)
