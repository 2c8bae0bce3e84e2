"""spark-submit entry points: train, score and product pairs."""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from basketry.functions.lineage import stages_removed
from basketry.params import ClusterParams, FactorParams, PairParams, ReactivationParams, TreeParams
from basketry.plans.jobs import JobParams, Jobs
from basketry.sources.sinks import MODES
from basketry.sources.tables import RetailTables, load_table


def _parser(description: str) -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(description=description)
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--database", help="catalog database with the input tables")
    source.add_argument("--folder", help="folder with one Parquet table per input")
    parser.add_argument("--out", required=True, help="folder for stages, models and results")
    parser.add_argument("--as-of", type=dt.date.fromisoformat, default=dt.date.today())
    parser.add_argument("--trees", type=int, default=TreeParams.trees)
    parser.add_argument("--calibration", choices=("isotonic", "none"), default=TreeParams.calibration)
    parser.add_argument("--clusters", type=int, default=ClusterParams.clusters)
    parser.add_argument("--pair-months", type=int, default=PairParams.window_months, help="months of purchases to pair")
    parser.add_argument("--min-support", type=int, default=FactorParams.min_support, help="customers a type must have")
    parser.add_argument("--customers", help="table or path of the customers (customer_id) to score")
    parser.add_argument("--types", type=lambda text: [int(t) for t in text.split(",")], help="type ids to model")
    parser.add_argument("--skip-types", type=int, default=JobParams.skip_types, help="most frequent types left out")
    parser.add_argument("--clusters-from", type=_numbers, default=(), help="numbers of clusters to choose from")
    parser.add_argument("--training-limit", type=int, help="rows a trial run trains on, by customer id")
    parser.add_argument("--scoring-limit", type=int, help="customers a trial run scores, by id")
    parser.add_argument("--out-database", help="catalog database the results become tables of as well")
    parser.add_argument("--if-exists", choices=tuple(MODES), default=JobParams.if_exists, help="for those tables")
    return parser


def _numbers(text: str) -> tuple[int, ...]:
    return tuple(int(t) for t in text.split(","))


def _jobs(description: str, argv: list[str] | None) -> Jobs:
    return _made(description, _parser(description).parse_args(argv))


def _made(description: str, args: argparse.Namespace) -> Jobs:
    spark = SparkSession.builder.appName(description).getOrCreate()
    tables = (
        RetailTables.from_database(spark, args.database)
        if args.database
        else RetailTables.from_folder(spark, args.folder)
    )
    params = JobParams(
        PairParams(args.as_of, window_months=args.pair_months),
        ReactivationParams(args.as_of),
        factors=FactorParams(min_support=args.min_support),
        trees=TreeParams(trees=args.trees, calibration=args.calibration),
        clusters=ClusterParams(clusters=args.clusters, candidates=args.clusters_from),
        skip_types=args.skip_types,
        training_limit=args.training_limit,
        scoring_limit=args.scoring_limit,
        database=args.out_database,
        if_exists=args.if_exists,
    )
    listed = load_table(spark, args.customers) if args.customers else None
    return Jobs(spark, tables, args.out, params, listed, args.types)


def train(argv: list[str] | None = None) -> None:
    jobs = _jobs("train-recommender", argv)
    with stages_removed(jobs.spark):
        jobs.train()


def score(argv: list[str] | None = None) -> None:
    jobs = _jobs("score-recommender", argv)
    with stages_removed(jobs.spark):
        jobs.score()


def pair(argv: list[str] | None = None) -> None:
    jobs = _jobs("pair-products", argv)
    with stages_removed(jobs.spark):
        jobs.type_pairs()
        jobs.sku_pairs()
        jobs.mined_reference()


def refresh(argv: list[str] | None = None) -> None:
    parser = _parser("refresh-pairs")
    parser.add_argument("--previous", required=True, help="results folder of the earlier day's run")
    parser.add_argument("--before", type=dt.date.fromisoformat, required=True, help="day of that run")
    parser.add_argument(
        "--restated", type=lambda text: [dt.date.fromisoformat(d) for d in text.split(",")], default=(),
        help="days whose lines were corrected or booked late",
    )
    args = parser.parse_args(argv)
    jobs = _made("refresh-pairs", args)
    with stages_removed(jobs.spark):
        jobs.refresh_sku_pairs(args.previous, args.before, args.restated)
