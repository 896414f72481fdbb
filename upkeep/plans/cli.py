"""The jobs as commands, for ``spark-submit`` or ``python -m upkeep``."""

from __future__ import annotations

import argparse
import json
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from upkeep import learning, sinks, sources
from upkeep.fixed import (
    AVERAGE,
    HORIZON_DAYS,
    INTERRUPTION_ASSET,
    INTERRUPTION_START,
    KEYS,
    SUBSYSTEM,
    UNSCHEDULED_KINDS,
    UTILIZATION_ASSET,
    UTILIZATION_DAY,
)
from upkeep.operators import daily_average, hot_keys, take_requests
from upkeep.operators.labels import check_window
from upkeep.plans.matrix import build_matrix, build_stored_matrix, in_months
from upkeep.plans.scoring import report, score
from upkeep.plans.training import evaluate
from upkeep.session import build_session
from upkeep.sinks import Batches
from upkeep.streaming import read_averages, read_scores, score_stream, update_averages


def spec(path: str) -> dict[str, Any]:
    """A table spec from a JSON file, where connection options may live too."""
    with open(path) as file:
        return json.load(file)


def utilization_columns(job: argparse.ArgumentParser) -> None:
    job.add_argument("--utilization-asset", default=UTILIZATION_ASSET, help="column")
    job.add_argument("--utilization-day", default=UTILIZATION_DAY, help="column")


def parser() -> argparse.ArgumentParser:
    main = argparse.ArgumentParser(prog="upkeep", description=__doc__)
    jobs = main.add_subparsers(dest="job", required=True)

    averages = jobs.add_parser("averages", help="sensor files -> stored daily averages")
    averages.add_argument("--readings", nargs="+", required=True, help="directories")
    averages.add_argument("--series", help="only this sensor")
    averages.add_argument("--out", required=True)
    averages.add_argument(
        "--progress", help="add files not seen yet to OUT; what was seen is kept in this folder"
    )

    stored = jobs.add_parser("store", help="averages or utilization -> table in buckets")
    given = stored.add_mutually_exclusive_group(required=True)
    given.add_argument("--averages", help="stored daily averages")
    given.add_argument("--utilization", type=spec, help="spec file")
    utilization_columns(stored)
    stored.add_argument("--buckets", type=int, required=True, help="the same for both tables")
    stored.add_argument("--out", required=True)

    matrix = jobs.add_parser("matrix", help="inputs -> labelled matrix")
    given = matrix.add_mutually_exclusive_group(required=True)
    given.add_argument("--readings", nargs="+", help="directories of sensor files")
    given.add_argument("--averages", help="stored daily averages")
    given.add_argument("--stored-averages", help="averages in buckets")
    matrix.add_argument("--series", help="only this sensor, if read from files")
    other = matrix.add_mutually_exclusive_group(required=True)
    other.add_argument("--utilization", type=spec, help="spec file")
    other.add_argument("--stored-utilization", help="utilization in buckets")
    matrix.add_argument("--interruptions", type=spec, required=True, help="spec file")
    utilization_columns(matrix)
    matrix.add_argument("--interruption-asset", default=INTERRUPTION_ASSET, help="column")
    matrix.add_argument("--interruption-start", default=INTERRUPTION_START, help="column")
    matrix.add_argument("--subsystem", default=SUBSYSTEM)
    matrix.add_argument("--kinds", nargs="*", default=UNSCHEDULED_KINDS)
    matrix.add_argument("--before", type=int, default=HORIZON_DAYS)
    matrix.add_argument("--after", type=int, default=0)
    matrix.add_argument("--match", choices=["pair", "independent"], default="pair")
    matrix.add_argument("--format", choices=["parquet", "csv"], default="parquet")
    matrix.add_argument(
        "--months", nargs="+", help="only these (YYYY-MM); other months in OUT stay as they are"
    )
    matrix.add_argument("--out", required=True)

    train = jobs.add_parser("train", help="matrix -> model and metrics")
    train.add_argument("--matrix", required=True)
    train.add_argument("--format", choices=["parquet", "csv"], default="parquet")
    train.add_argument("--percent", type=int, default=70)
    train.add_argument("--random", action="store_true", help="split by a seeded draw, not by key")
    train.add_argument("--incomplete", choices=["error", "skip", "keep"], default="error")
    train.add_argument("--fit-indexers-on", choices=["training", "all"], default="training")
    orders = ["fixed", "frequencyDesc", "frequencyAsc", "alphabetDesc", "alphabetAsc"]
    train.add_argument("--label-order", choices=orders, default="fixed")
    train.add_argument("--partitions", type=int, help="of the training rows, fixes the tree")
    train.add_argument("--seed", type=int, default=learning.SEED)
    train.add_argument("--model", required=True)
    train.add_argument("--metrics", required=True)
    train.add_argument("--preview", help="write the first predictions here")
    train.add_argument("--summary", help="write depth, size and importances here")

    scoring = jobs.add_parser("score", help="requests -> verdicts")
    given = scoring.add_mutually_exclusive_group(required=True)
    given.add_argument("--readings", nargs="+", help="directories of sensor files")
    given.add_argument("--averages", help="stored daily averages")
    scoring.add_argument("--series", help="only this sensor, if read from files")
    scoring.add_argument("--requests", type=spec, required=True, help="spec file")
    scoring.add_argument("--utilization", type=spec, required=True, help="spec file")
    utilization_columns(scoring)
    scoring.add_argument("--model", required=True)
    scoring.add_argument("--out", required=True)
    scoring.add_argument("--report", help="write the verdicts for reading here")
    scoring.add_argument("--snapshot", help="keep the requests as they were scored here")
    scoring.add_argument("--stream", help="score a stream, progress kept in this folder")
    return main


def averages_of(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if getattr(args, "readings", None):
        return daily_average(sources.read_readings(spark, args.readings), args.series)
    if Batches(spark, args.averages).exists():
        return read_averages(spark, args.averages)
    return spark.read.parquet(args.averages)


def utilization_of(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    table = sources.read_source(spark, args.utilization)
    return sources.utilization_from(table, args.utilization_asset, args.utilization_day)


def write_json(frame: DataFrame, path: str) -> None:
    """A handful of rows as one file."""
    frame.coalesce(1).write.mode("overwrite").json(path)


def run_averages(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.progress:
        update_averages(
            spark, args.readings, args.out, args.progress, args.series
        ).awaitTermination()
    else:
        sinks.write_by_month(averages_of(spark, args), args.out)


def run_store(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.averages:
        table = averages_of(spark, args).select(*KEYS, AVERAGE)
    else:
        table = utilization_of(spark, args)
    sinks.write_keyed(table, args.out, args.buckets)


def run_matrix(spark: SparkSession, args: argparse.Namespace) -> None:
    check_window(args.before, args.after)
    if bool(args.stored_averages) != bool(args.stored_utilization):
        raise SystemExit("give both tables in buckets, or neither")
    interruptions = sources.interruptions_from(
        sources.read_source(spark, args.interruptions),
        args.subsystem,
        args.kinds or None,
        args.interruption_start,
        args.interruption_asset,
    )
    label = {"before": args.before, "after": args.after, "match": args.match}
    if args.stored_averages:
        averages = sources.read_keyed(spark, args.stored_averages)
        utilization = sources.read_keyed(spark, args.stored_utilization)
        matrix = build_stored_matrix(averages, utilization, interruptions, **label)
    else:
        utilization = utilization_of(spark, args)
        hot = hot_keys(utilization)
        matrix = build_matrix(
            averages_of(spark, args), utilization, interruptions, **label, hot=hot
        )
    if args.months:
        matrix = in_months(matrix, args.months)
    if args.format == "csv":
        sinks.write_matrix_csv(matrix, args.out)
    else:
        sinks.write_by_month(matrix, args.out, args.months)


def run_train(spark: SparkSession, args: argparse.Namespace) -> None:
    read = sources.read_matrix_csv if args.format == "csv" else sources.read_matrix
    trained = learning.train(
        read(spark, args.matrix),
        percent=args.percent,
        random=args.random,
        label_order=args.label_order,
        fit_indexers_on=args.fit_indexers_on,
        incomplete=args.incomplete,
        partitions=args.partitions,
        seed=args.seed,
    )
    sinks.write_model(trained.model, args.model)
    write_json(evaluate(trained), args.metrics)
    if args.preview:
        predicted = learning.predict(trained.model, trained.validation)
        shown = learning.preview(predicted)
        write_json(shown.drop("rawPrediction", "probability"), args.preview)
    if args.summary:
        write_json(learning.tree_summary(spark, trained.model), args.summary)


def run_score(spark: SparkSession, args: argparse.Namespace) -> None:
    model = sinks.read_model(args.model)
    if args.stream:
        requests = sources.read_requests(sources.read_source(spark, args.requests, stream=True))
        score_stream(
            requests,
            lambda: averages_of(spark, args),
            lambda: utilization_of(spark, args),
            model,
            args.out,
            args.stream,
            find_hot=True,
        ).awaitTermination()
    else:
        requests = sources.read_requests(sources.read_source(spark, args.requests))
        with take_requests(requests, args.snapshot) as asked:
            scored = score(
                asked, averages_of(spark, args), utilization_of(spark, args), model, find_hot=True
            )
            scored.write.mode("overwrite").parquet(args.out)
    if args.report:
        scores = read_scores(spark, args.out) if args.stream else spark.read.parquet(args.out)
        report(scores).write.mode("overwrite").parquet(args.report)


JOBS = {
    "averages": run_averages,
    "store": run_store,
    "matrix": run_matrix,
    "train": run_train,
    "score": run_score,
}


def main(arguments: list[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    spark = build_session(f"upkeep {args.job}")
    JOBS[args.job](spark, args)
