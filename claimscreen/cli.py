"""Command line: run, analyze, generate-sample. Exit code 0 on success, else 1."""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import SparkSession

from claimscreen.operators.first_digit import distribution_report
from claimscreen.plans import reports
from claimscreen.plans.screening import ClaimScreen
from claimscreen.sources.generate import write_sample
from claimscreen.sources.io import read_claims, read_results, write_results

log = logging.getLogger("claimscreen")
FORMATS = ("parquet", "csv", "json")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="claimscreen")
    sub = top.add_subparsers(dest="command")
    run = sub.add_parser("run", help="score claims")
    run.add_argument("--input", "-i", required=True)
    run.add_argument("--output", "-o", required=True)
    run.add_argument("--format", "-f", choices=FORMATS, default="parquet")
    run.add_argument("--local", action="store_true")
    look = sub.add_parser("analyze", help="report on scored claims")
    look.add_argument("--results", "-r", required=True)
    look.add_argument("--report", choices=("summary", "providers", "benfords"), default="summary")
    look.add_argument("--format", "-f", choices=FORMATS, default="parquet")
    make = sub.add_parser("generate-sample", help="write synthetic claims")
    make.add_argument("--output", "-o", required=True)
    make.add_argument("--num-claims", "-n", type=int, default=10_000)
    make.add_argument("--fraud-rate", type=float, default=0.05)
    return top


def session(local: bool = False) -> SparkSession:
    builder = SparkSession.builder.appName("claimscreen").config("spark.sql.session.timeZone", "UTC")
    return (builder.master("local[*]") if local else builder).getOrCreate()


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    write_results(ClaimScreen().detect(read_claims(spark, args.input, args.format)), args.output, args.format)


def analyze(spark: SparkSession, args: argparse.Namespace) -> None:
    results = read_results(spark, args.results, args.format)
    if args.report == "summary":
        reports.risk_summary(results).show(truncate=False, vertical=True)
    elif args.report == "providers":
        reports.risky_providers(results).show(20, truncate=False)
    else:
        distribution_report(results, "charge_amount").show(truncate=False)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    if args.command is None:
        parser().print_help()
        return 1
    own = spark is None
    try:
        spark = spark or session(getattr(args, "local", True))
        if args.command == "run":
            run(spark, args)
        elif args.command == "analyze":
            analyze(spark, args)
        else:
            write_sample(spark, args.output, num_claims=args.num_claims, fraud_rate=args.fraud_rate)
        return 0
    except Exception:
        log.exception("%s failed", args.command)
        return 1
    finally:
        if own and spark:
            spark.stop()


if __name__ == "__main__":
    sys.exit(main())
