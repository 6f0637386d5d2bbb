"""Command line: one job for spark-submit, or ``python -m salesloom`` locally."""

from __future__ import annotations

import argparse
import sys
from datetime import date

from pyspark.sql import SparkSession

from salesloom.plans.daily import Outcome, answer_all, run_day
from salesloom.plans.registry import ANSWERS
from salesloom.schemas import LAYOUT
from salesloom.sources.ingest import ingest
from salesloom.sources.snapshots import Staged
from salesloom.streaming.arrivals import run_on_arrival


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="salesloom", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, explanation: str, *folders: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name, help=explanation)
        for folder in folders:
            sub.add_argument(f"--{folder}", required=True, help=f"root folder of the {folder}")
        sub.add_argument("--date", type=date.fromisoformat, help="load date, by default today")
        return sub

    one = job("ingest", "convert source files to snapshots", "source", "staging")
    one.add_argument("tables", nargs="*", choices=[[], *LAYOUT], help="by default all eight")
    one.add_argument("--permissive", action="store_true", help="bad values become null")
    some = job("answer", "write answers from snapshots", "staging", "results")
    some.add_argument("answers", nargs="*", choices=[[], *ANSWERS], help="by default all ten")
    day = job("day", "ingest, answer and register", "source", "staging", "results")
    day.add_argument("--database", help="prefix of the databases to register in")
    day.add_argument("--again", action="store_true", help="also what an earlier run has finished")
    watch = job("watch", "run when a set of source files arrives", "source", "staging", "results")
    watch.add_argument("--progress", required=True, help="folder that remembers what was seen")
    watch.add_argument("--every", help='look again and again, for example "5 minutes"')
    watch.add_argument("--database", help="prefix of the databases to register in")
    return parser.parse_args(arguments)


def show(outcomes: list[Outcome]) -> bool:
    """Print what happened; whether everything went well."""
    for outcome in outcomes:
        print(f"{outcome.answer} {outcome.seconds:.1f}s {outcome.error or outcome.path}")
    return all(outcome.error is None for outcome in outcomes)


def run(spark: SparkSession, options: argparse.Namespace) -> bool:
    """Do one job; whether everything went well."""
    day = options.date or date.today()
    if options.job == "ingest":
        loaded = ingest(
            spark,
            options.source,
            options.staging,
            day,
            tuple(options.tables),
            strict=not options.permissive,
        )
        for table, result in loaded.items():
            rejected = f", {result.rejected} lines rejected, see {result.rejects}" if result.rejected else ""
            print(f"{table} {result.path}{rejected}")
        return True
    if options.job == "answer":
        tables = Staged(spark, options.staging, day)
        return show(answer_all(tables, options.results, day, tuple(options.answers)))
    if options.job == "day":
        return show(
            run_day(
                spark, options.source, options.staging, options.results, day, options.database, options.again
            )
        )
    reports: list[bool] = []
    run_on_arrival(
        spark,
        options.source,
        options.staging,
        options.results,
        options.progress,
        options.date,
        options.database,
        options.every,
        report=lambda outcomes: reports.append(show(outcomes)),
    ).awaitTermination()
    return all(reports)


def main() -> None:
    options = parse()
    spark = SparkSession.builder.appName(f"salesloom {options.job}").getOrCreate()
    try:
        done = run(spark, options)
    finally:
        spark.stop()
    sys.exit(0 if done else 1)


if __name__ == "__main__":
    main()
