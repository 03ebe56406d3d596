"""Command line: ``python -m tremorline ingest|analyse ...``, or the same by spark-submit."""

from __future__ import annotations

import argparse
import logging
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from tremorline import (
    Run,
    flat_events,
    ingest,
    ingest_new_documents,
    nested_events,
    read_table,
    show_answers,
    string_events,
    subsecond_events,
    write_answers,
)
from tremorline.sources import latest_day, read_cells, whole_runs
from tremorline.sources.paths import STAMP

SHAPES = ["nested", "flat", "string", "subsecond"]


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tremorline", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)

    batch = commands.add_parser("ingest", help="clean one run's landed documents")
    batch.add_argument("--root", required=True, help="folder of landing, silver and rejected")
    batch.add_argument("--run", required=True, help="stamp of the run, as 20241025_075530 (UTC)")
    batch.add_argument("--by-day", action="store_true", help="lay the table out by day")
    batch.add_argument(
        "--by-run",
        action=argparse.BooleanOptionalAction,
        default=True,
        help="keep the run in a table partition of its own (default)",
    )

    stream = commands.add_parser("ingest-new", help="clean what landed since the last call")
    stream.add_argument("--root", required=True)
    stream.add_argument("--checkpoint", required=True, help="folder of this stream's progress")

    questions = commands.add_parser("analyse", help="print the answer to every question")

    questions.add_argument("--output", help="folder for all answers, as parquet, unprinted")
    questions.add_argument("--rows", type=int, help="print so many rows of each answer at most")

    for command in (batch, stream, questions):
        command.add_argument("--table", required=True, help="path, or name with --catalog")
    for command in (batch, questions):
        command.add_argument("--catalog", action="store_true")
        command.add_argument("--format", default="parquet")
    for command in (batch, stream):
        command.add_argument("--shape", choices=SHAPES, default="nested")
        command.add_argument("--zone", help="time zone of the string and subsecond shapes")

    given = parser.parse_args(arguments)
    logging.basicConfig(level=logging.INFO)
    spark = (
        SparkSession.builder.appName(f"tremorline-{given.command}")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    if given.command == "analyse":
        table = read_table(spark, given.table, catalog=given.catalog, format=given.format)
        known = {"last_day": latest_day(spark, given.table, catalog=given.catalog, format=given.format)}
        if not given.catalog and whole_runs(spark, given.table):
            known["cells"] = read_cells(spark, given.table, format=given.format)
        if given.output:
            write_answers(table, given.output, **known)
        else:
            show_answers(table, given.rows, **known)
    elif given.command == "ingest":
        run = Run(given.root, datetime.strptime(given.run, STAMP).replace(tzinfo=timezone.utc))
        report = ingest(
            spark,
            run,
            given.table,
            _options(given),
            catalog=given.catalog,
            format=given.format,
            by_run=given.by_run,
            by_day=given.by_day,
        )
        print(report)
    else:
        print(
            ingest_new_documents(
                spark, given.root, given.table, given.checkpoint, _options(given)
            )
        )


def _options(given: argparse.Namespace):
    shapes = {
        "nested": nested_events,
        "flat": flat_events,
        "string": lambda: string_events(given.zone),
        "subsecond": lambda: subsecond_events(given.zone),
    }
    return shapes[given.shape]()


if __name__ == "__main__":
    main()
