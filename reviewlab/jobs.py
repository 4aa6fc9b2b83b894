"""Entry point for spark-submit: ``jobs.py preprocess|explore|model|catalogue ...``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from reviewlab.functions.lexicon import LEXICON
from reviewlab.operators.clean import MIN_CHARS
from reviewlab.operators.features import NUM_FEATURES
from reviewlab.operators.models import MODELS, SEED
from reviewlab.plans.catalogue import build_catalogue
from reviewlab.plans.explore import VOCABULARY_SIZE, explore
from reviewlab.plans.modeling import evaluate_model, train_model
from reviewlab.plans.preprocess import preprocess
from reviewlab.session import scratch_scope
from reviewlab.sources import landing


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="reviewlab")
    jobs = out.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("preprocess", help="land, flatten, clean and featurise reviews")
    job.add_argument("--folder", required=True, help="folder with the raw JSON files")
    job.add_argument("--base", required=True, help="folder for the stage tables")
    job.add_argument("--mode", choices=[landing.FULL, landing.SELECT], default=landing.FULL)
    job.add_argument("--files", default="", help="comma-separated names for mode select")
    layouts = [landing.ARRAY, landing.LINES, landing.SPLIT]
    job.add_argument("--layout", choices=layouts, default=landing.ARRAY)
    job.add_argument("--if-exists", choices=["reuse", "overwrite"], default="reuse")

    job.add_argument("--min-chars", type=int, default=MIN_CHARS)
    job.add_argument("--num-features", type=int, default=NUM_FEATURES)
    job.add_argument("--fit-on", choices=["all", "train"], default="all")
    job.add_argument("--drop-empty-tokens", action="store_true")

    job = jobs.add_parser("explore", help="topics, clusters and reports")
    job.add_argument("--base", required=True)
    job.add_argument("--lexicon", help="parquet table word, polarity; default: the built-in list")
    job.add_argument("--vocabulary-size", type=int, default=VOCABULARY_SIZE)

    job = jobs.add_parser("model", help="train a model, score and evaluate it")
    job.add_argument("--base", required=True)
    job.add_argument("--name", required=True, choices=list(MODELS))
    job.add_argument("--label", default="rating_category")
    job.add_argument("--seed", type=int, default=SEED)
    job.add_argument("--max-fit-rows", type=int, help="bound of the rows a model is fitted on")
    job.add_argument("--max-columns", type=int, help="columns that chi-square screening keeps")

    job = jobs.add_parser("catalogue", help="JSON-string records to entity tables")
    job.add_argument("--base", required=True)
    job.add_argument("--sources", required=True, help="comma-separated paths")
    return out


def run(spark: SparkSession, argv: Sequence[str]) -> None:
    """Run one job; tables kept between its passes are deleted when it ends."""
    args = parser().parse_args(argv)
    with scratch_scope(spark):
        run_job(spark, args)


def run_job(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.job == "preprocess":
        files = landing.parse_file_list(args.files)
        preprocess(
            spark,
            args.folder,
            args.base,
            args.mode,
            files,
            args.layout,
            args.if_exists,
            args.min_chars,
            args.num_features,
            args.fit_on,
            args.drop_empty_tokens,
        )
    elif args.job == "explore":
        lexicon = spark.read.parquet(args.lexicon) if args.lexicon else LEXICON
        explore(spark, args.base, lexicon, args.vocabulary_size)
    elif args.job == "model":
        train_model(
            spark, args.base, args.name, args.label, args.seed, args.max_fit_rows, args.max_columns
        )
        evaluate_model(spark, args.base, args.name, args.label).show(truncate=False)
    else:
        build_catalogue(spark, landing.parse_file_list(args.sources), args.base)


if __name__ == "__main__":
    import sys

    session = SparkSession.builder.appName("reviewlab").getOrCreate()
    run(session, sys.argv[1:])
    session.stop()
