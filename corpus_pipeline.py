"""The corpus pipeline: quality rules, line dedup, near-dedup, decontamination, tokens.

Each stage takes what the stage before kept, stored and read again; all but the last return the
columns of documents. What a stage keeps in scratch tables is deleted when the next one begins, so a
stage's result must be stored before the next stage is called (``run`` does so).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from reviewlab.llm import bpe, chunks, decontaminate, neardup, quality
from reviewlab.session import delete_paths, materialize, scratch_list

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
#: Scratch tables of the stage called last, by application.
_kept: dict[str, list[str]] = {}


def tidy(stage: Stage) -> Stage:
    """The stage, which first deletes the scratch tables of the stage before it."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        application = spark.sparkContext.applicationId
        delete_paths(spark, _kept.pop(application, []))
        with scratch_list() as given:
            done = stage(spark, docs, sf_dir)
        _kept[application] = given
        return done

    return run_stage


@tidy
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or a certified cutoff reject go."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


@tidy
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of whole lines, and chunks of lines, that an earlier document has are cut out.

    A document of which no word is left was a copy and goes, as would one that had none.
    """
    return chunks.with_words(chunks.without_repeated(docs, chunks.passage_lines(docs)))


@tidy
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return neardup.one_of_each(docs)


@tidy
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@tidy
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document the number of byte-level BPE tokens and digests of ids and decoded bytes."""
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode_and_decode(docs, ranks, public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("byte-level BPE", tokens),
]

#: The rows of the last stage come from a tokenizer, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
