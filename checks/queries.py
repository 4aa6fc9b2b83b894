"""One query per operator. Each takes the session and the folder of the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reviewlab import schemas
from reviewlab.functions.lexicon import LEXICON, PHRASES
from reviewlab.functions.text import parse_rating
from reviewlab.operators import (
    catalogue,
    clean,
    clusters,
    features,
    models,
    readability,
    reports,
    sampling,
    scores,
    screening,
    sentiment,
    topics,
    words,
)
from reviewlab.plans.modeling import evaluate_model, train_model
from reviewlab.plans.preprocess import preprocess
from reviewlab.session import materialize, scratch_path
from reviewlab.sinks import writers
from reviewlab.sources import landing, tables, testtables

Query = Callable[[SparkSession, str], DataFrame]


#: Words that models over counted words are built from.
VOCABULARY_SIZE = 1 << 18


def rounded(column: str, digits: int = 6) -> Column:
    """The column as a rounded double: engines add floats in another order."""
    return F.round(F.col(column).cast("double"), digits).alias(column)


def raw(spark: SparkSession, sf: str) -> DataFrame:
    documents = tables.spread(testtables.table(spark, sf, "documents"), "doc_id")
    return testtables.raw_reviews(documents)


def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_reviews(clean.flatten_reviews(raw(spark, sf)))


def stored(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """The cleaned stage as a stored table, for operators that read it more than once."""
    return materialize(cleaned(spark, sf).select(*columns), "cleaned")


def analysed(spark: SparkSession, sf: str) -> DataFrame:
    return scores.analyse_reviews(cleaned(spark, sf))


# Cleaning


def flatten_reviews(spark: SparkSession, sf: str) -> DataFrame:
    flat = clean.flatten_reviews(raw(spark, sf))
    return flat.withColumn("helpful", F.array_join("helpful", ","))


def clean_reviews(spark: SparkSession, sf: str) -> DataFrame:
    return cleaned(spark, sf).withColumn("helpful", F.array_join("helpful", ","))


def rating_category_counts(spark: SparkSession, sf: str) -> DataFrame:
    return clean.rating_category_counts(cleaned(spark, sf))


# Reports


def avg_rating_per_movie(spark: SparkSession, sf: str) -> DataFrame:
    return reports.avg_rating_per_movie(cleaned(spark, sf)).select("movie", rounded("avg_rating"))


def review_count_per_reviewer(spark: SparkSession, sf: str) -> DataFrame:
    return reports.reviewer_stats(cleaned(spark, sf)).select("reviewer", "total_reviews")


def avg_rating_per_reviewer(spark: SparkSession, sf: str) -> DataFrame:
    stats = reports.reviewer_stats(cleaned(spark, sf))
    return stats.select("reviewer", rounded("avg_rating"))


def avg_sentiment_per_reviewer(spark: SparkSession, sf: str) -> DataFrame:
    stats = reports.reviewer_stats(scores.with_sentiment(cleaned(spark, sf)))
    return stats.select("reviewer", rounded("avg_sentiment"))


def reviewer_stats(spark: SparkSession, sf: str) -> DataFrame:
    stats = reports.reviewer_stats(scores.with_sentiment(cleaned(spark, sf)))
    return stats.select(
        "reviewer", "total_reviews", rounded("avg_rating"), rounded("avg_sentiment")
    )


def reviewer_head(spark: SparkSession, sf: str) -> DataFrame:
    """The first 20 of many keys: movies stand in for reviewers, of whom there are only 20."""
    return reports.head_by_key(avg_rating_per_movie(spark, sf), "movie")


def length_rating_corr(spark: SparkSession, sf: str) -> DataFrame:
    """Over all reviews; those without a rating are dropped."""
    flat = clean.flatten_reviews(raw(spark, sf))
    reviews = scores.with_length(
        flat.select(parse_rating(F.col("rating")).alias("rating"), F.col("review_detail").alias("cleaned_review"))
    ).na.drop(subset=["review_length", "rating"])
    return reports.correlation(reviews).select(rounded("correlation"))


def long_review_count(spark: SparkSession, sf: str) -> DataFrame:
    """Over all rated reviews, short ones too."""
    flat = clean.flatten_reviews(raw(spark, sf)).where("rating is not null")
    return reports.long_review_count(
        scores.with_length(flat.withColumn("cleaned_review", F.col("review_detail")))
    )


def score_corr_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return reports.correlation_matrix(analysed(spark, sf)).select("x", "y", rounded("r"))


def rating_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return reports.histogram(cleaned(spark, sf)).select(
        "bin", rounded("bin_start"), rounded("bin_end"), "reviews"
    )


def flesch_box(spark: SparkSession, sf: str) -> DataFrame:
    scored = materialize(
        scores.with_flesch(cleaned(spark, sf)).select("flesch_score"), "flesch-scores"
    )
    box = reports.box_summary(scored)
    measures = ("q1", "median", "q3", "whisker_low", "whisker_high")
    return box.select("n", *[rounded(name, 4) for name in measures], "outliers")


def length_boxes(spark: SparkSession, sf: str, group: str) -> DataFrame:
    lengths = scores.with_length(cleaned(spark, sf)).select(group, "review_length")
    boxes = reports.group_boxes(materialize(lengths, "lengths"), group, "review_length")
    measures = ("q1", "median", "q3", "whisker_low", "whisker_high")
    return boxes.select(group, "n", *[rounded(name, 4) for name in measures], "outliers")


def length_box_per_movie(spark: SparkSession, sf: str) -> DataFrame:
    return length_boxes(spark, sf, "movie")


def length_box_per_reviewer(spark: SparkSession, sf: str) -> DataFrame:
    return length_boxes(spark, sf, "reviewer")


def sentiment_rating_bins(spark: SparkSession, sf: str) -> DataFrame:
    return reports.binned_scatter(scores.with_sentiment(cleaned(spark, sf)))


# Words


def tokenize_reviews(spark: SparkSession, sf: str) -> DataFrame:
    return words.with_tokens(cleaned(spark, sf)).select(
        "review_id",
        F.size("words").alias("n_words"),
        F.size("filtered").alias("n_kept"),
        F.array_join("filtered", " ").alias("kept_words"),
    )


def word_counts(spark: SparkSession, sf: str) -> DataFrame:
    return words.word_counts(cleaned(spark, sf))


def top_words(spark: SparkSession, sf: str) -> DataFrame:
    return words.top_words(cleaned(spark, sf))


def frequent_words(spark: SparkSession, sf: str) -> DataFrame:
    """The top words through mergeable sketches and an exact recount."""
    return words.frequent_words(stored(spark, sf, "cleaned_review"))


def word_share(spark: SparkSession, sf: str) -> DataFrame:
    share = words.word_share(words.top_words(cleaned(spark, sf), without=words.NO_WORDS))
    return share.select("word", "count", rounded("share"))


def vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    return words.vocabulary(cleaned(spark, sf))


def vocabulary_left_out(spark: SparkSession, sf: str) -> DataFrame:
    """What a vocabulary of 1,000 words would lose."""
    return words.left_out(words.vocabulary(cleaned(spark, sf)), 1000)


def tfidf_terms(spark: SparkSession, sf: str) -> DataFrame:
    terms = words.tfidf_terms(stored(spark, sf, "review_id", "cleaned_review"))
    return terms.select("review_id", "word", "tf", "df", rounded("tfidf"))


# Scores


def flesch_scores(spark: SparkSession, sf: str) -> DataFrame:
    scored = scores.with_flesch(cleaned(spark, sf))
    return scored.select("review_id", rounded("flesch_score", 3))


def flesch_scores_raw_text(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of the uncleaned texts, which still have their sentence ends."""
    scored = scores.with_flesch(clean.flatten_reviews(raw(spark, sf)))
    return scored.select("review_id", rounded("flesch_score", 3))


def sentiment_scores(spark: SparkSession, sf: str) -> DataFrame:
    scored = scores.with_sentiment(cleaned(spark, sf))
    return scored.select("review_id", rounded("sentiment_score"))


def sentiment_scores_by_join(spark: SparkSession, sf: str) -> DataFrame:
    """A lexicon taken from the texts, too large to write into the plan.

    Every content word gets a polarity between -1 and 1 from its count.
    """
    reviews = stored(spark, sf, "review_id", "cleaned_review")
    polarity = ((F.col("count") % 9 - 4) / 4).alias("polarity")
    lexicon = words.word_counts(reviews).select("word", polarity)
    scored = scores.with_sentiment(reviews, lexicon, max_inline_words=100)
    return scored.select("review_id", rounded("sentiment_score"))


def analysed_reviews(spark: SparkSession, sf: str) -> DataFrame:
    return analysed(spark, sf).select(
        "review_id",
        "rating",
        rounded("flesch_score", 3),
        rounded("sentiment_score"),
        "review_length",
    )


# Features


def tfidf_features(spark: SparkSession, sf: str) -> DataFrame:
    reviews = stored(spark, sf, "review_id", "cleaned_review", "rating_category")
    vectors, _ = features.tfidf_features(reviews)
    return vector_measures(vectors.select("review_id", "rating_category", "features"))


def count_features(spark: SparkSession, sf: str) -> DataFrame:
    reviews = stored(spark, sf, "review_id", "cleaned_review", "rating_category")
    vectors, _ = features.count_features(reviews, VOCABULARY_SIZE)
    return vector_measures(vectors.select("review_id", "rating_category", "features"))


def vector_measures(vectors: DataFrame) -> DataFrame:
    """Entries that are not zero and the Euclidean norm, read from the sparse form."""
    sparse = F.unwrap_udt("features")
    values = F.filter(sparse["values"], lambda x: x != 0)
    return vectors.select(
        "review_id",
        "rating_category",
        F.size(values).alias("n_terms"),
        F.round(
            F.sqrt(F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x * x)), 4
        ).alias("norm"),
    )


def scaled_features(spark: SparkSession, sf: str) -> DataFrame:
    reviews = scores.with_length(cleaned(spark, sf)).select("review_id", "review_length", "rating")
    reviews = materialize(reviews, "lengths")
    scaled = features.scale(features.assemble(reviews, ["review_length", "rating"]))
    values = vector_to_array("scaledFeatures")
    return scaled.select(
        "review_id",
        F.round(values[0], 6).alias("scaled_length"),
        F.round(values[1], 6).alias("scaled_rating"),
    )


# Clusters and topics


def clustered(spark: SparkSession, sf: str):
    reviews = scores.with_length(cleaned(spark, sf)).select("review_id", "review_length", "rating")
    return clusters.fit_clusters(materialize(reviews, "lengths"))


def kmeans_sizes(spark: SparkSession, sf: str) -> DataFrame:
    predictions, _ = clustered(spark, sf)
    return clusters.cluster_sizes(predictions)


def kmeans_centers(spark: SparkSession, sf: str) -> DataFrame:
    predictions, model = clustered(spark, sf)
    return clusters.cluster_centers(predictions, model)


def lda_topics(spark: SparkSession, sf: str) -> DataFrame:
    found, terms = topics.fit_topics(stored(spark, sf, "cleaned_review"), VOCABULARY_SIZE)
    return topics.topic_terms(found, terms)


def lda_topic_lines(spark: SparkSession, sf: str) -> DataFrame:
    return topics.topic_lines(lda_topics(spark, sf))


# Splits and models


def hash_split(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.hash_split(cleaned(spark, sf)).select("review_id", "split")


def stratified_split(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.stratified_split(stored(spark, sf, "review_id", "rating_category"))


def row_cap(spark: SparkSession, sf: str) -> DataFrame:
    """The sampling operator itself: 250 rows chosen by the hash of their id.

    A third of the ids is missing and a third is one and the same.
    """
    flat = clean.flatten_reviews(raw(spark, sf)).select("review_id", "reviewer", "movie")
    number = F.col("review_id").cast("bigint")
    odd = F.when(number % 3 == 0, F.lit(None)).when(number % 3 == 1, "same")
    return sampling.cap_rows(flat.withColumn("review_id", odd.otherwise(F.col("review_id"))), 250)


def decision_tree_scored_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per split that a tree fitted on 50 rows scores: all of them."""
    reviews = scores.with_length(cleaned(spark, sf))
    vectors = features.assemble(reviews, ["review_length"]).select(
        "review_id", "features", "rating_category"
    )
    predictions, _ = models.train_and_score(
        materialize(vectors, "features"), "DecisionTree", max_fit_rows=50
    )
    return predictions.groupBy("split").agg(F.count("prediction").alias("rows"))


def model_query(name: str, num_features: int = features.NUM_FEATURES) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        reviews = stored(spark, sf, "review_id", "cleaned_review", "rating_category")
        vectors, _ = features.tfidf_features(reviews, num_features)
        predictions, _ = models.train_and_score(materialize(vectors, "features"), name)
        return models.evaluate(predictions, name)

    query.__doc__ = f"Train {name} on hashed TF-IDF and evaluate both splits."
    return query


def screened_query(name: str) -> Query:
    """All hashed columns, of which chi-square screening keeps some for the model."""

    def query(spark: SparkSession, sf: str) -> DataFrame:
        reviews = stored(spark, sf, "review_id", "cleaned_review", "rating_category")
        vectors, _ = features.tfidf_features(reviews)
        predictions, _ = models.train_and_score(
            materialize(vectors, "features"), name, max_columns=screening.MAX_COLUMNS
        )
        return models.evaluate(predictions, name)

    query.__doc__ = f"Train {name} on screened hashed TF-IDF and evaluate both splits."
    return query


def detail_texts(spark: SparkSession, sf: str) -> DataFrame:
    """All reviews with their texts as written."""
    flat = clean.flatten_reviews(raw(spark, sf)).select("review_id", "review_detail")
    return materialize(flat, "review-texts")


def word_syllables(spark: SparkSession, sf: str) -> DataFrame:
    """Every distinct word with its reviews and syllables."""
    spoken = readability.spoken_words(F.col("review_detail"))
    texts = detail_texts(spark, sf).select(spoken.alias("cleaned_review"))
    return readability.word_table(texts).select("word", "df", F.col("syllables").cast("bigint"))


def reading_ease(spark: SparkSession, sf: str) -> DataFrame:
    scored = readability.with_reading_ease(detail_texts(spark, sf))
    return scored.select("review_id", rounded("reading_ease", 3))


def rated_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Word counts of the training reviews, from which a lexicon is learned."""
    training = sampling.hash_split(cleaned(spark, sf)).where("split = 'train'")
    return materialize(sentiment.rated_word_counts(training), "rated-words")


def learned_lexicon(spark: SparkSession, sf: str) -> DataFrame:
    return sentiment.learned_lexicon(rated_counts(spark, sf)).select(
        "word", "positive", "negative", rounded("z", 4), rounded("polarity", 4)
    )


def learned_sentiment(spark: SparkSession, sf: str) -> DataFrame:
    """Scores by a lexicon learned from the training reviews."""
    lexicon = materialize(sentiment.learned_lexicon(rated_counts(spark, sf)), "lexicon")
    reviews = stored(spark, sf, "review_id", "cleaned_review")
    scored = scores.with_sentiment(reviews, lexicon.select("word", "polarity"))
    return scored.select("review_id", rounded("sentiment_score", 4))


def phrase_sentiment(spark: SparkSession, sf: str) -> DataFrame:
    """Phrases with negation, taken from the learned lexicon and the default ones."""
    lexicon = sentiment.learned_lexicon(rated_counts(spark, sf), min_z=3.0)
    strongest = lexicon.orderBy(F.desc(F.abs("z")), "word").limit(sentiment.MAX_PHRASES // 2)
    learned = {row["word"]: row["polarity"] for row in strongest.collect()}
    phrases = {**LEXICON, **PHRASES, **learned}
    scored = sentiment.with_phrase_sentiment(cleaned(spark, sf), phrases)
    return scored.select("review_id", rounded("phrase_sentiment"), "phrases", "negated")


def chi_square_words(spark: SparkSession, sf: str) -> DataFrame:
    """How far each word of the training reviews depends on the class, and the 1,000 kept."""
    reviews = stored(spark, sf, "review_id", "cleaned_review", "rating_category")
    training = sampling.hash_split(reviews).where("split = 'train'")
    tokens = words.with_tokens(training, drop_empty_tokens=True)
    entries = screening.word_entries(tokens, F.col("filtered"), "rating_category")
    table = screening.chi_square(entries, screening.class_sizes(training, "rating_category"))
    table = materialize(table, "chi-square")
    kept = screening.best_columns(table, 1_000).select("column", F.lit(True).alias("kept"))
    return table.join(kept, "column", "left").select(
        F.col("column").alias("word"),
        F.col("rows").cast("bigint").alias("rows"),
        rounded("chi_square"),
        F.col("degrees").cast("bigint").alias("degrees"),
        F.coalesce("kept", F.lit(False)).alias("kept"),
    )


def naive_bayes_words(spark: SparkSession, sf: str) -> DataFrame:
    """Naive Bayes over counted words, where SQL can follow every step.

    Rows per split, true class and predicted class, and the accuracy of the split.
    """
    reviews = stored(spark, sf, "review_id", "cleaned_review", "rating_category")
    vectors, _ = features.count_features(reviews, VOCABULARY_SIZE)
    vectors = vectors.select("review_id", "features", "rating_category")
    predictions, _ = models.train_and_score(materialize(vectors, "features"), "NaiveBayes")
    return predictions.groupBy("split", "rating_category", "prediction").agg(
        F.count(F.lit(1)).alias("rows")
    )


def naive_bayes_words_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    reviews = stored(spark, sf, "review_id", "cleaned_review", "rating_category")
    vectors, _ = features.count_features(reviews, VOCABULARY_SIZE)
    vectors = vectors.select("review_id", "features", "rating_category")
    predictions, _ = models.train_and_score(materialize(vectors, "features"), "NaiveBayes")
    return models.evaluate(predictions, "NaiveBayes").select(
        "split", "model", "metric", rounded("value"), "rows"
    )


def linear_regression_on_length(spark: SparkSession, sf: str) -> DataFrame:
    """Linear regression of the class on the length, whose solution SQL knows."""
    reviews = scores.with_length(cleaned(spark, sf))
    vectors = features.assemble(reviews, ["review_length"]).select(
        "review_id", "features", "rating_category"
    )
    predictions, _ = models.train_and_score(materialize(vectors, "features"), "LinearRegression")
    return models.evaluate(predictions, "LinearRegression").select(
        "split", "model", "metric", rounded("value"), "rows"
    )


def stored_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Predictions written to a folder per model and split, and read back by model name."""
    reviews = scores.with_length(cleaned(spark, sf))
    vectors = features.assemble(reviews, ["review_length"]).select(
        "review_id", "features", "rating_category"
    )
    predictions, _ = models.train_and_score(materialize(vectors, "features"), "LinearRegression")
    base = scratch_path(spark, "models")
    writers.write_predictions(predictions, base, "LinearRegression")
    return tables.read_predictions(spark, base, "LinearRegression").select(
        "review_id", "split", "rating_category", rounded("prediction")
    )


# Estimators on groups, where SQL knows what they must predict

#: What a text holds, and the group that makes it; texts with none of them are plain.
GROUPS = (("!!", "bangs"), ("%%%", "marks"), (" | ", "pipes"))


def grouped_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled documents with their group as indicators, and their quality (1 or 2) to learn."""
    labels = testtables.table(spark, sf, "labels").select("doc_id", "quality")
    text = F.col("text")
    group = F.lit("plain")
    for mark, name in reversed(GROUPS):
        group = F.when(text.contains(mark), F.lit(name)).otherwise(group)
    rows = testtables.table(spark, sf, "documents").join(labels, "doc_id").select(
        F.col("doc_id").cast("string").alias("review_id"),
        group.alias("grp"),
        (F.col("quality") + 1).cast("float").alias("target_class"),
    )
    names = [name for _, name in GROUPS]
    flags = rows.select("*", *[(F.col("grp") == n).cast("double").alias(n) for n in names])
    return features.assemble(flags, names).drop(*names)


def group_query(name: str) -> Query:
    def query(spark: SparkSession, sf: str) -> DataFrame:
        rows = materialize(grouped_documents(spark, sf), "features")
        predictions, _ = models.train_and_score(rows, name, label="target_class")
        if name == "RandomForestRegressor":
            # Trees see samples, so only the side of the middle is certain.
            value = F.when(F.col("prediction") > 1.5, 2.0).otherwise(1.0)
        else:
            value = F.round("prediction", 6)
        return predictions.groupBy("split", "grp", value.alias("predicted")).agg(
            F.count(F.lit(1)).alias("rows")
        )

    query.__doc__ = f"What {name} predicts for each group of documents."
    return query


def hashed_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Per review the sum of its hashed term counts, and the reviews that the IDF has seen."""
    reviews = stored(spark, sf, "review_id", "cleaned_review", "rating_category")
    _, model = features.tfidf_features(reviews)
    counts = F.unwrap_udt("rawFeatures")["values"]
    total = F.aggregate(counts, F.lit(0.0), lambda acc, x: acc + x)
    return model.transform(reviews).select(
        "review_id",
        total.cast("bigint").alias("tokens"),
        F.lit(model.stages[-1].numDocs).cast("bigint").alias("documents"),
    )


def kmeans_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Clusters, clustered reviews, and reviews that are nearer to another cluster's center."""
    return cluster_facts(*clustered(spark, sf))


def cluster_facts(predictions: DataFrame, model) -> DataFrame:
    centers = clusters.cluster_centers(predictions, model).collect()
    point = vector_to_array("scaledFeatures")
    distance = [
        F.struct(
            sum((point[i] - F.lit(x)) ** 2 for i, x in enumerate(row["cluster_center"])).alias("d"),
            F.lit(row["cluster"]).alias("cluster"),
        )
        for row in centers
    ]
    nearest = F.array_min(F.array(*distance))["cluster"]
    return predictions.agg(
        F.lit(len(centers)).cast("bigint").alias("clusters"),
        F.count_distinct("prediction").alias("used"),
        F.count(F.lit(1)).alias("reviews"),
        F.count_if(F.col("prediction") != nearest).alias("misplaced"),
    )


def weighted_clusters(spark: SparkSession, sf: str):
    reviews = scores.with_length(cleaned(spark, sf)).select("review_id", "review_length", "rating")
    predictions, model = clusters.fit_weighted_clusters(materialize(reviews, "lengths"))
    return materialize(predictions, "predictions"), model


def kmeans_weighted_points(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct lengths and ratings with the number of their reviews."""
    return clusters.weighted_points(scores.with_length(cleaned(spark, sf)))


def kmeans_weighted_facts(spark: SparkSession, sf: str) -> DataFrame:
    """As kmeans_facts, and the centers that differ from the mean of all their reviews."""
    predictions, model = weighted_clusters(spark, sf)
    centers = clusters.cluster_centers(predictions, model)
    point = vector_to_array("scaledFeatures")
    means = predictions.groupBy("prediction").agg(
        F.avg(point[0]).alias("x"), F.avg(point[1]).alias("y")
    )
    off = F.greatest(
        F.abs(F.col("x") - F.col("cluster_center")[0]), F.abs(F.col("y") - F.col("cluster_center")[1])
    )
    moved = means.join(centers, F.col("prediction") == F.col("cluster")).agg(
        F.count_if(off > 1e-6).alias("moved")
    )
    return cluster_facts(predictions, model).withColumn(
        "moved", F.lit(moved.first()["moved"]).cast("bigint")
    )


def lda_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Per topic: terms, terms that are words of the texts, and neighbours in falling order."""
    reviews = stored(spark, sf, "cleaned_review")
    found, terms = topics.fit_topics(reviews, VOCABULARY_SIZE)
    spelled = topics.topic_terms(found, terms)
    known = words.word_counts(reviews).select("word", F.lit(1).alias("known"))
    below = F.lead("weight").over(Window.partitionBy("topic").orderBy("rank"))
    return (
        spelled.withColumn("falls", F.coalesce(F.col("weight") >= below, F.lit(True)))
        .join(known, "word", "left")
        .groupBy("topic")
        .agg(
            F.count(F.lit(1)).alias("terms"),
            F.count("known").alias("known_terms"),
            F.count_if("falls").alias("falling"),
        )
    )


def topic_line_format(spark: SparkSession, sf: str) -> DataFrame:
    """Lines of a given topic table: the 30 most frequent words in three topics."""
    top = words.top_words(cleaned(spark, sf), 30).select(
        (F.row_number().over(Window.orderBy(F.desc("count"), "word")) - 1).alias("place"),
        "word",
        (F.col("count") % 8 / 8).alias("weight"),
    )
    spelled = top.select(
        (F.col("place") % 3).alias("topic"), (F.col("place") / 3).cast("int").alias("rank"),
        "word", "weight",
    )
    return topics.topic_lines(spelled)


# Landing and catalogue


def land_json(spark: SparkSession, sf: str) -> DataFrame:
    """Reviews written as JSON files, landed as one struct column, and flattened again."""
    folder = scratch_path(spark, "json")
    raw(spark, sf).select("review_json.*").write.json(folder)
    landed = landing.land_raw(
        spark, folder, scratch_path(spark, "landed"), layout=landing.LINES, if_exists="reuse"
    )
    return clean.flatten_reviews(landed).withColumn("helpful", F.array_join("helpful", ","))


def track_blobs(spark: SparkSession, sf: str) -> DataFrame:
    records = testtables.track_records(testtables.table(spark, sf, "events"))
    return catalogue.to_json_blobs(records)


def json_blobs(spark: SparkSession, sf: str) -> DataFrame:
    """Blob tables of two sources, the events and the conversation turns, one after the other."""
    turns = testtables.table(spark, sf, "conversations")
    return catalogue.concat_tables(
        spark, [track_blobs(spark, sf), catalogue.to_json_blobs(turns)]
    )


def json_blob_columns(spark: SparkSession, sf: str) -> DataFrame:
    return catalogue.parse_blobs(track_blobs(spark, sf))[0]


def rejected_blobs(spark: SparkSession, sf: str) -> DataFrame:
    """Blobs that are no JSON object: here the document texts among the records."""
    texts = testtables.table(spark, sf, "documents").select(F.col("text").alias("json_blob"))
    blobs = catalogue.concat_tables(spark, [track_blobs(spark, sf), texts])
    return catalogue.parse_blobs(blobs)[1]


def conflicting_records(spark: SparkSession, sf: str) -> DataFrame:
    """The records twice, and once more with other names: rows of a key repeat and disagree."""
    records = json_blob_columns(spark, sf)
    other = records.withColumns(
        {c: F.concat(F.lit("a "), c) for c in ("track_name", "collection_name", "artist_name")}
    )
    return records.unionByName(records).unionByName(other.where("track_id % 2 = 0"))


def split_tracks(spark: SparkSession, sf: str) -> DataFrame:
    return catalogue.split_tracks(conflicting_records(spark, sf))


def split_collections(spark: SparkSession, sf: str) -> DataFrame:
    return catalogue.split_collections(conflicting_records(spark, sf))


def split_artists(spark: SparkSession, sf: str) -> DataFrame:
    return catalogue.split_artists(conflicting_records(spark, sf))


# Report files


def csv_word_report(spark: SparkSession, sf: str) -> DataFrame:
    """The top-words report through a CSV file with a header; the first row is not lost."""
    path = scratch_path(spark, "top-words")
    writers.write_csv_report(words.top_words(cleaned(spark, sf)), path, single_file=True)
    return tables.read_csv_report(spark, path, schemas.WORD_COUNTS)


def parquet_word_report(spark: SparkSession, sf: str) -> DataFrame:
    """The top-words report through a single parquet file."""
    path = scratch_path(spark, "top-words")
    writers.write_small_parquet(words.top_words(cleaned(spark, sf)), path)
    return spark.read.schema(schemas.WORD_COUNTS).parquet(path)


def text_topic_report(spark: SparkSession, sf: str) -> DataFrame:
    """Topic lines through a single text file."""
    path = scratch_path(spark, "topics")
    writers.write_text_report(topic_line_format(spark, sf), path)
    return spark.read.text(path).withColumnRenamed("value", "TopicDetails")


def csv_reviewer_report(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "reviewers")
    writers.write_csv_report(avg_rating_per_reviewer(spark, sf), path)
    return tables.read_csv_report(spark, path, schemas.REVIEWER_RATINGS)


def csv_broken_names(spark: SparkSession, sf: str) -> DataFrame:
    """A report whose names are the raw texts: line breaks, quotes, commas, empty strings."""
    path = scratch_path(spark, "names")
    flat = clean.flatten_reviews(raw(spark, sf))
    named = flat.select(
        F.col("review_detail").alias("reviewer"), F.length("review_detail").cast("double").alias("avg_rating")
    )
    writers.write_csv_report(named, path)
    return tables.read_csv_report(spark, path, schemas.REVIEWER_RATINGS)


# Landing of nested folders, arrays, selections, and the chain of stages


def json_folder(spark: SparkSession, sf: str, part: str = "review_id is not null") -> str:
    folder = scratch_path(spark, "json")
    raw(spark, sf).select("review_json.*").where(part).write.json(folder)
    return folder


def landed_reviews(landed: DataFrame) -> DataFrame:
    return clean.flatten_reviews(landed).withColumn("helpful", F.array_join("helpful", ","))


def land_nested(spark: SparkSession, sf: str) -> DataFrame:
    """A folder with files and a folder of files in it."""
    folder = json_folder(spark, sf, "spoiler_tag = 0")
    rest = raw(spark, sf).select("review_json.*").where("spoiler_tag = 1")
    rest.write.json(f"{folder}/inner")
    return landed_reviews(
        landing.land_raw(spark, folder, scratch_path(spark, "landed"), layout=landing.LINES)
    )


def land_json_array(spark: SparkSession, sf: str) -> DataFrame:
    """One JSON array per file, as many files as there are languages and sources."""
    folder = scratch_path(spark, "arrays")
    rows = raw(spark, sf).select("review_json.*")
    arrays = rows.groupBy("review_summary").agg(
        F.to_json(F.collect_list(F.struct(*rows.columns))).alias("value")
    )
    # The folder names keep the groups in files of their own.
    arrays.withColumn("part", F.md5("review_summary")).select("value", "part").write.partitionBy(
        "part"
    ).text(folder)
    landed = landing.land_raw(spark, folder, scratch_path(spark, "landed"))
    return landed_reviews(landed)


#: Bytes of a JSON array file.
ARRAY_BYTES = 128 << 20


def write_arrays(lines: DataFrame, folder: str, file_bytes: int) -> None:
    """JSON array files of about as many bytes, each in a folder of its own, from their elements."""
    size = lines.agg(F.sum(F.octet_length("value") + 2)).first()[0] or 0
    files = max(1, -(-size // file_bytes))
    if not size:
        lines = lines.unionByName(lines.sparkSession.createDataFrame([(None,)], lines.schema))
    dealt = lines.withColumn("part", F.pmod(F.xxhash64("value"), F.lit(files)))
    order = Window.partitionBy("part").orderBy("value")
    dealt = dealt.withColumn("place", F.row_number().over(order))
    last = F.col("place") == F.count(F.lit(1)).over(Window.partitionBy("part"))
    text = F.concat(
        F.when(F.col("place") == 1, "[\n").otherwise(","),
        F.coalesce("value", F.lit("")),
        F.when(last, "\n]").otherwise(""),
    )
    arrays = dealt.select(text.alias("value"), "part", "place").sortWithinPartitions("part", "place")
    arrays.select("value", "part").write.partitionBy("part").text(folder)


def land_split_array(spark: SparkSession, sf: str) -> DataFrame:
    """All reviews in a JSON array in one file, read by as many tasks as its size asks for. More than
    ARRAY_BYTES are dealt over several such files, as one task writes a file."""
    folder = scratch_path(spark, "one-array")
    rows = raw(spark, sf).select("review_json.*")
    write_arrays(rows.select(F.to_json(F.struct(*rows.columns)).alias("value")), folder, ARRAY_BYTES)
    landed = landing.land_raw(spark, folder, scratch_path(spark, "landed"), layout=landing.SPLIT)
    return landed_reviews(landed)


def land_new(spark: SparkSession, sf: str) -> DataFrame:
    """Files that come in between three landings; the last finds nothing new."""
    folder, base = scratch_path(spark, "arriving"), scratch_path(spark, "landed")
    rows = raw(spark, sf).select("review_json.*")
    for tag in (0, 1):
        rows.where(F.col("spoiler_tag") == tag).write.json(f"{folder}/part{tag}")
        landing.land_new(spark, folder, base)
    return landed_reviews(landing.land_new(spark, folder, base))


def land_new_blobs(spark: SparkSession, sf: str) -> DataFrame:
    """The same for JSON strings, a few files in each step."""
    folder, base = scratch_path(spark, "arriving"), scratch_path(spark, "landed")
    rows = raw(spark, sf).select("review_json.*")
    for tag in (0, 1):
        part = rows.where(F.col("spoiler_tag") == tag).select("review_id", "reviewer", "rating")
        part.write.json(f"{folder}/part{tag}")
        blobs = landing.land_new_blobs(spark, folder, base, files_at_once=3)
    parsed = F.from_json("json_blob", "review_id string, reviewer string, rating string")
    return blobs.select(parsed.alias("blob")).select("blob.*")


def land_select(spark: SparkSession, sf: str) -> DataFrame:
    """Two of three folders' files, by name."""
    folder = scratch_path(spark, "json")
    rows = raw(spark, sf).select("review_json.*")
    names = []
    for tag in (0, 1, 2):
        part = rows.where(F.col("review_id").cast("bigint") % 3 == tag)
        part.write.json(f"{folder}/part{tag}")
        files = spark.read.format("binaryFile").load(f"{folder}/part{tag}").select("path")
        names += [f"part{tag}/" + row["path"].rsplit("/", 1)[1] for row in files.collect()]
    wanted = [n for n in names if not n.startswith("part1/")]
    landed = landing.land_raw(
        spark, folder, scratch_path(spark, "landed"), landing.SELECT, wanted, landing.LINES
    )
    return landed_reviews(landed)


def land_reuse(spark: SparkSession, sf: str) -> DataFrame:
    """The second landing of a folder that has grown meanwhile gives the first one again."""
    folder = json_folder(spark, sf, "spoiler_tag = 0")
    base = scratch_path(spark, "landed")
    landing.land_raw(spark, folder, base, layout=landing.LINES)
    raw(spark, sf).select("review_json.*").where("spoiler_tag = 1").write.json(f"{folder}/later")
    landed = landing.land_raw(spark, folder, base, layout=landing.LINES, if_exists="reuse")
    return landed_reviews(landed)


def stage_chain(spark: SparkSession, sf: str) -> DataFrame:
    """Raw JSON to metrics through the stored tables of every job: rows of each stage."""
    base = scratch_path(spark, "stages")
    preprocess(
        spark, json_folder(spark, sf), base, layout=landing.LINES, num_features=1024
    )
    train_model(spark, base, "NaiveBayes")
    metrics = evaluate_model(spark, base, "NaiveBayes")
    stages = {
        "raw": tables.read_raw(spark, landing.raw_path(base, landing.FULL)),
        "flat": tables.read_flat(spark, f"{base}/flat"),
        "cleaned": tables.read_cleaned(spark, f"{base}/cleaned"),
        "features": tables.read_features(spark, f"{base}/features"),
        "predictions": tables.read_predictions(spark, base, "NaiveBayes"),
        "metrics": metrics,
    }
    counted = [
        table.agg(F.lit(name).alias("stage"), F.count(F.lit(1)).alias("rows"))
        for name, table in stages.items()
    ]
    return catalogue.concat_tables(spark, counted)


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        flatten_reviews,
        clean_reviews,
        rating_category_counts,
        avg_rating_per_movie,
        review_count_per_reviewer,
        avg_rating_per_reviewer,
        avg_sentiment_per_reviewer,
        reviewer_stats,
        reviewer_head,
        length_rating_corr,
        long_review_count,
        score_corr_matrix,
        rating_histogram,
        flesch_box,
        length_box_per_movie,
        length_box_per_reviewer,
        sentiment_rating_bins,
        tokenize_reviews,
        word_counts,
        top_words,
        frequent_words,
        word_share,
        vocabulary,
        vocabulary_left_out,
        tfidf_terms,
        flesch_scores,
        flesch_scores_raw_text,
        sentiment_scores,
        sentiment_scores_by_join,
        analysed_reviews,
        tfidf_features,
        count_features,
        scaled_features,
        kmeans_sizes,
        kmeans_centers,
        lda_topics,
        lda_topic_lines,
        hash_split,
        stratified_split,
        row_cap,
        decision_tree_scored_rows,
        chi_square_words,
        word_syllables,
        reading_ease,
        learned_lexicon,
        learned_sentiment,
        phrase_sentiment,
        naive_bayes_words,
        naive_bayes_words_accuracy,
        linear_regression_on_length,
        stored_predictions,
        land_json,
        json_blobs,
        json_blob_columns,
        rejected_blobs,
        split_tracks,
        split_collections,
        split_artists,
        csv_word_report,
        parquet_word_report,
        text_topic_report,
        csv_reviewer_report,
        csv_broken_names,
        land_nested,
        land_json_array,
        land_split_array,
        land_new,
        land_new_blobs,
        land_select,
        land_reuse,
        stage_chain,
        hashed_counts,
        kmeans_facts,
        kmeans_weighted_points,
        kmeans_weighted_facts,
        lda_facts,
        topic_line_format,
    )
}
QUERIES |= {f"group_{name}": group_query(name) for name in models.MODELS if name != "NaiveBayes"}
QUERIES |= {f"screened_{name}": screened_query(name) for name in models.MODELS}
QUERIES |= {f"model_{name}": model_query(name) for name in models.MODELS}
