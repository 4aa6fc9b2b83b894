"""Feature vectors: hashed and counted TF-IDF, assembled and scaled columns."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    IDF,
    CountVectorizerModel,
    HashingTF,
    SQLTransformer,
    StandardScaler,
    VectorAssembler,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlab.functions.stopwords import STOP_WORDS
from reviewlab.operators.sampling import hash_split
from reviewlab.operators.words import vocabulary, with_tokens
from reviewlab.session import materialize, scratch_path

# Fixed value: buckets of the hashed term counts (2^18).
NUM_FEATURES = 1 << 18


def tokenizer_stage(drop_empty_tokens: bool = False) -> SQLTransformer:
    """Tokens and content words as one SQL stage, which a saved pipeline keeps.

    Same result as a Tokenizer and a StopWordsRemover stage on cleaned text, but evaluated on
    Spark's own strings; those stages copy every word to a Scala object and back.
    """
    dropped = [w.replace("'", "\\'") for w in STOP_WORDS] + ([""] if drop_empty_tokens else [])
    listed = ", ".join(f"'{w}'" for w in dropped)
    return SQLTransformer(
        statement=f"""
        SELECT *, filter(words, w -> w NOT IN ({listed})) AS filtered
        FROM (SELECT *,
                     CASE WHEN rtrim(cleaned_review) = '' AND cleaned_review <> ''
                          THEN CAST(array() AS array<string>)
                          ELSE split(rtrim(cleaned_review), ' ') END AS words
              FROM __THIS__)
        """
    )


def tfidf_pipeline(
    num_features: int = NUM_FEATURES, drop_empty_tokens: bool = False
) -> Pipeline:
    return Pipeline(
        stages=[
            tokenizer_stage(drop_empty_tokens),
            HashingTF(inputCol="filtered", outputCol="rawFeatures", numFeatures=num_features),
            IDF(inputCol="rawFeatures", outputCol="features"),
        ]
    )


def tfidf_features(
    cleaned: DataFrame,
    num_features: int = NUM_FEATURES,
    drop_empty_tokens: bool = False,
    fit_on: str = "all",
) -> tuple[DataFrame, PipelineModel]:
    """``review_id, features, rating_category`` and the fitted pipeline.

    ``fit_on="train"`` takes document frequencies from the training split only, which keeps the
    test rows out of the weights.
    """
    needed = cleaned.select("review_id", "cleaned_review", "rating_category")
    fitted_on = hash_split(needed).where("split = 'train'") if fit_on == "train" else needed
    model = tfidf_pipeline(num_features, drop_empty_tokens).fit(fitted_on)
    features = model.transform(needed).select("review_id", "features", "rating_category")
    return features, model


def count_features(cleaned: DataFrame, vocabulary_size: int) -> tuple[DataFrame, DataFrame]:
    """TF-IDF over counted words: the reviews with ``features``, and the vocabulary table.

    The texts are split once: the counts are stored.
    """
    counted, terms = counted_words(cleaned, vocabulary_size)
    return weighted(materialize(counted, "counted-words")), terms


def counted_words(cleaned: DataFrame, vocabulary_size: int) -> tuple[DataFrame, DataFrame]:
    """The reviews with ``rawFeatures``, the counts of their words, and the vocabulary table.

    MLlib keeps the vocabulary in memory, so the caller bounds it; ``words.left_out`` tells what
    is lost, and the table has all words. It is ordered by count and word, so term numbers are
    the same in every run.
    """
    terms = materialize(vocabulary(cleaned), "vocabulary")
    kept = terms.where(F.col("term") < vocabulary_size)
    counter = count_vectorizer(kept, "filtered", "rawFeatures")
    return counter.transform(with_tokens(cleaned)).drop("words", "filtered"), terms


def weighted(counted: DataFrame) -> DataFrame:
    """Counts times inverse document frequencies, in ``features``."""
    idf = IDF(inputCol="rawFeatures", outputCol="features").fit(counted)
    return idf.transform(counted).drop("rawFeatures")


def count_vectorizer(terms: DataFrame, input_col: str, output_col: str) -> CountVectorizerModel:
    """The model that counts the words of a vocabulary table ``term, word``.

    ``CountVectorizer.fit`` numbers equally frequent words by chance, and ``from_vocabulary``
    sends the words from Python one by one (a minute and a half for 234,000). So a model is
    saved, its vocabulary file replaced by the table, and loaded again. The file is one row of
    at most as many words as the vocabulary's size limit allows.
    """
    path = scratch_path(terms.sparkSession, "count-vectorizer")
    CountVectorizerModel.from_vocabulary(
        ["placeholder"], inputCol=input_col, outputCol=output_col
    ).save(path)
    in_order = F.array_sort(F.collect_list(F.struct("term", "word")))
    vocabulary_row = terms.agg(F.transform(in_order, lambda e: e["word"]).alias("vocabulary"))
    vocabulary_row.write.mode("overwrite").parquet(f"{path}/data")
    model = CountVectorizerModel.load(path)
    if len(model.vocabulary) != terms.count():
        raise RuntimeError("this version of Spark stores vocabularies in another form")
    return model


def assemble(df: DataFrame, columns: list[str], output: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=columns, outputCol=output).transform(df)


def scale(df: DataFrame, column: str = "features", output: str = "scaledFeatures") -> DataFrame:
    """Divide each entry by its sample standard deviation; the mean stays."""
    scaler = StandardScaler(inputCol=column, outputCol=output, withStd=True, withMean=False)
    return scaler.fit(df).transform(df)
