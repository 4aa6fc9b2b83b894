"""The registered queries of the subpackage, one per operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlab.llm import (
    bpe,
    chunks,
    credentials,
    decontaminate,
    neardup,
    phrases,
    quality,
    repair,
    separators,
    toxicity,
    turns,
    urls,
    wrappers,
)

#: The end-of-document id of the flat files.
FLAT_END = 49_407


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_path_templates(spark: SparkSession, sf: str) -> DataFrame:
    """Labels of a page are those of the document whose number its path ends in."""
    pages = table(spark, sf, "pages").select("page_id", "url")
    number = F.regexp_extract(
        urls.url_parts(F.col("url"))["path"], r"([0-9]{1,18})(?:\.[a-z]+)?/?$", 1
    )
    shown = (
        pages.select("page_id", number.alias("number"))
        .where("number <> ''")
        .select("page_id", F.col("number").cast("long").alias("doc_id"))
    )
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    labels = table(spark, sf, "labels").select("doc_id", bad.alias("bad"))
    return urls.judge_urls(pages, shown.join(labels, "doc_id").select("page_id", "bad"))


def tokenizer(name: str) -> str:
    """Path of a public vocabulary file, where the environment has them."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_repair_tokens(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return repair.stored_tokens(docs, tokenizer("word_bpe_49k.json"))


def op3_line_chunks(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return chunks.drop_repeated(docs, carry=[])


def op4_secret_owners(spark: SparkSession, sf: str) -> DataFrame:
    """A document's source is its owner; its source and language name the repository."""
    return credentials.find_secrets(table(spark, sf, "documents"))


def op5_risk_thresholds(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "lang", "text")
    judged = quality.verdicts(docs, table(spark, sf, "labels"), carry=["doc_id", "lang"])
    return judged.select("row.doc_id", *quality.FEATURES, "base_failed", "kept")


def op6_setsketch(spark: SparkSession, sf: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf, "documents"), shingle=3, percent=85)


def op7_separator_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Flat files of all documents, scanned without an index."""
    docs = table(spark, sf, "documents")
    files = separators.flat_files(docs, tokenizer("word_bpe_49k.json"), FLAT_END)
    return separators.count_tokens(files, FLAT_END)


def op8_wrapper_induction(spark: SparkSession, sf: str) -> DataFrame:
    return wrappers.extract(table(spark, sf, "pages"))


def op9_distinct_words(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    ranks = tokenizer("byte_bpe_50k.tiktoken")
    return bpe.encode_and_decode(table(spark, sf, "documents"), ranks, public_tokenizers.PATTERN)


def op10_bm25_wand(spark: SparkSession, sf: str) -> DataFrame:
    found = decontaminate.find_leaks(
        table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "benchmark")
    )
    return found.select("doc_id", "item_id")


def op11_phrase_growth(spark: SparkSession, sf: str) -> DataFrame:
    return phrases.collocations(table(spark, sf, "documents"))


def op12_turn_repair(spark: SparkSession, sf: str) -> DataFrame:
    return turns.summaries(turns.damaged(table(spark, sf, "conversations")))


def op13_channel_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    """A fifth of the documents, by the crc32 of their number, is held out from learning."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    labels = table(spark, sf, "labels").where(~held_out)
    return toxicity.score_texts(docs, labels).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


QUERIES = {
    "op1_path_templates": op1_path_templates,
    "op2_repair_tokens": op2_repair_tokens,
    "op3_line_chunks": op3_line_chunks,
    "op4_secret_owners": op4_secret_owners,
    "op5_risk_thresholds": op5_risk_thresholds,
    "op6_setsketch": op6_setsketch,
    "op7_separator_scan": op7_separator_scan,
    "op8_wrapper_induction": op8_wrapper_induction,
    "op9_distinct_words": op9_distinct_words,
    "op10_bm25_wand": op10_bm25_wand,
    "op11_phrase_growth": op11_phrase_growth,
    "op12_turn_repair": op12_turn_repair,
    "op13_channel_toxicity": op13_channel_toxicity,
}
