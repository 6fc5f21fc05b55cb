"""The three jobs as commands, for ``spark-submit`` or ``python -m kindred``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from kindred import params as P
from kindred.session import clear_scratch
from kindred.plans.jobs import run_knn, run_recommend, run_similarity


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="kindred")
    commands = parser.add_subparsers(dest="command", required=True)
    pairs = (P.EXPECTED_TRAIN_ROWS, P.EXPECTED_TEST_ROWS)
    for name, (*inputs, expected) in {
        "similarity": ("train", "test", pairs),
        "knn": ("train", "test", pairs),
        "recommend": ("data", "personal", (P.EXPECTED_RATINGS_ROWS, P.EXPECTED_CATALOG_ROWS)),
    }.items():
        command = commands.add_parser(name)
        for path in inputs:
            command.add_argument(f"--{path}", required=True)
        command.add_argument("--json", help="folder for the JSON report")
        command.add_argument("--expect", type=int, nargs=2, metavar="ROWS", default=expected, help="rows that the two inputs must have")
        command.add_argument("--any-size", action="store_true", help="take inputs of any number of rows")
        if name == "similarity":
            command.add_argument("--timing-runs", type=int, default=P.TIMING_RUNS)
        if name == "recommend":
            command.add_argument("--user", type=int, default=P.PERSONAL_USER_ID)
    return parser


def main(argv: list[str] | None = None) -> None:
    args = arguments().parse_args(argv)
    own_session = SparkSession.getActiveSession() is None
    spark = SparkSession.builder.appName(f"kindred-{args.command}").getOrCreate()
    expected = None if args.any_size else tuple(args.expect)
    if args.command == "similarity":
        report = run_similarity(spark, args.train, args.test, args.json, expected, args.timing_runs)
    elif args.command == "knn":
        report = run_knn(spark, args.train, args.test, args.json, expected)
    else:
        report = run_recommend(spark, args.data, args.personal, args.json, args.user, expected)
    report.show(truncate=False)
    if own_session:  # in a session of the caller's, other tables may be in use
        clear_scratch(spark)


if __name__ == "__main__":
    main()
