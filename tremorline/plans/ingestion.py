"""Ingestion: landed documents to clean rows, in the table and in the silver layer."""

from __future__ import annotations

import json
import logging
from dataclasses import asdict, dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import types as T

from tremorline.operators import (
    CleanOptions,
    add_insert_date,
    clean_counted,
    event_rows,
    feature_rows,
    losses,
)
from tremorline.schema import INSERTED, feed_schema
from tremorline.sources import (
    Run,
    append_table,
    read_landing,
    read_run,
    rejected,
    write_cells,
    write_landing,
    write_silver,
)
from tremorline.sources.files import TEXT_CODEC, is_whole
from tremorline.sources.paths import require_utc
from tremorline.sources.silver import SECOND_FORMAT, SUBSECOND_FORMAT

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class IngestReport:
    """What was read and what was not kept: whole documents, single features, and, by
    column, values whose token could not be read."""

    documents: int
    rejected: int
    damaged: int = 0
    lost: dict[str, int] = field(default_factory=dict)


class Counted:
    """The event rows of documents, and a report on them that is observed in the pass
    that writes these rows."""

    def __init__(self, documents: DataFrame, options: CleanOptions, *keep: str) -> None:
        self._wide, self._counters = clean_counted(feature_rows(documents, *keep), options, keep)
        self._observation = Observation()
        self.events = event_rows(self._wide.observe(self._observation, *self._counters))

    def report(self) -> IngestReport:
        """The report, after the rows were written; before that, by a pass of its own."""
        try:
            counts = self._observation.get
        except Py4JJavaError as error:
            if "AssertionError" not in str(error.java_exception):
                raise
            # When no row gets through, a plan with a shuffle is cut off above it at run
            # time, and what was observed goes with it. Count once more.
            return self.recount()
        return _report(counts)

    def recount(self) -> IngestReport:
        return _report(self._wide.agg(*self._counters).first().asDict())


def _report(counts: dict[str, int]) -> IngestReport:
    plain = {name: counts[name] for name in ("documents", "rejected", "damaged")}
    return IngestReport(**plain, lost=losses(counts))


def ingest(
    spark: SparkSession,
    run: Run,
    table: str,
    options: CleanOptions = CleanOptions(),
    *,
    lines: DataFrame | None = None,
    per_file: int | None = None,
    catalog: bool = False,
    format: str = "parquet",
    by_run: bool = True,
    by_day: bool = False,
) -> IngestReport:
    """One run: land ``lines`` if given, at most ``per_file`` of them in a file, then clean what
    is landed into both sinks.

    With ``by_run`` the table is appended first, the run's rows in a folder of their own,
    and silver is written from that folder. So documents are parsed once, nothing is
    cached, and a lost executor costs no second parse of what is already written. Each folder of the
    run counts only when its write has ended. A run that ended early, wherever that was,
    goes on where it stopped when called again without ``lines``: what is whole is kept
    and what is not is written anew. Silver comes last; a run that has it is refused, so that repeating
    one cannot double its rows. Without ``by_run``, as for a ``format`` that has no partitions, each
    sink parses the documents.

    Documents without ``features`` and damaged features are counted and written to
    ``run.rejected``; the others go on. The report is kept in ``run.report``, and the run's
    cells by day and region beside a path table.
    """
    require_utc(spark)
    if by_run:
        held = f"{table} already holds run {run.stamp}; drop its partition to repeat it"
        schema = options.table_schema()
        # The rows' own schema is the same whatever the documents hold.
        stored = read_run(spark, table, run.stamp, schema or _own_schema(spark, options), catalog=catalog, format=format)
        if stored is not None and (lines is not None or is_whole(spark, run.silver)):
            raise ValueError(held)
    if lines is not None:
        mode = "errorifexists" if is_whole(spark, run.landing) else "overwrite"
        write_landing(lines, run.landing, mode, per_file=per_file)

    documents = read_landing(spark, run.landing)
    counted = Counted(documents, options)
    events = add_insert_date(counted.events, run.at, options)
    if not by_run:
        append_table(events, table, options.table_schema(), catalog=catalog, format=format, by_day=by_day)
        report = counted.report()
        stored = events
    elif stored is None:
        append_table(
            events, table, schema, catalog=catalog, format=format, run=run.stamp, by_day=by_day
        )
        report = counted.report()
        stored = read_run(spark, table, run.stamp, events.schema, catalog=catalog, format=format)
    elif is_whole(spark, run.report):
        report = IngestReport(**json.loads(spark.read.text(run.report).first().value))
    else:
        report = counted.recount()
    text = spark.createDataFrame([(json.dumps(asdict(report)),)], "value string").coalesce(1)
    text.write.mode("overwrite").text(run.report)
    if by_run and not catalog:
        write_cells(stored, table, run.stamp)

    if report.rejected or report.damaged:
        rejected(documents).write.mode("overwrite").option("compression", TEXT_CODEC).json(run.rejected)
        log.warning(
            "run %s: %d documents and %d features rejected", run.stamp, report.rejected, report.damaged
        )
    write_silver(stored.drop(INSERTED), run.silver, silver_format(options), mode="overwrite")
    log.info("run %s: %d documents ingested", run.stamp, report.documents - report.rejected)
    return report


def silver_format(options: CleanOptions) -> str:
    return SUBSECOND_FORMAT if options.time_mode == "local_subsecond" else SECOND_FORMAT


def _own_schema(spark: SparkSession, options: CleanOptions) -> T.StructType:
    documents = spark.createDataFrame([], T.StructType([feed_schema()["features"]]))
    return add_insert_date(Counted(documents, options).events, None, options).schema
