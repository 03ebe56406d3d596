"""Incremental ingestion: each call cleans the documents landed since the last one.

The same flatten and clean steps as a batch run, over the landing folders of all
runs. Each micro-batch is a run of the table, under its number: table, cells, rejects and silver are
written in one go, and a batch that is repeated after it was cut short replaces what it had
written. So nothing is lost or doubled. Such a table belongs to its stream: its runs are
numbers of batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tremorline.operators import CleanOptions, add_insert_date
from tremorline.plans.ingestion import Counted, IngestReport, silver_format
from tremorline.schema import INSERTED
from tremorline.sources import append_table, has_run, read_run, rejected, write_cells, write_silver
from tremorline.sources.files import TEXT_CODEC
from tremorline.sources.landing import parse_lines, stream_lines
from tremorline.sources.paths import LANDING, REJECTED, SILVER, require_utc

# The time of the micro-batch, which a repeated batch keeps.
_AT = "_at"


def ingest_new_documents(
    spark: SparkSession,
    root: str,
    table: str,
    checkpoint: str,
    options: CleanOptions = CleanOptions(),
    *,
    max_files: int | None = None,
) -> IngestReport:
    """Clean new documents under ``root`` into the table and into silver.

    ``checkpoint`` is a folder of this stream's own; keep it between calls. ``max_files``
    bounds the landed files of one micro-batch. Each new document is parsed once; those of a
    batch with rejects once more, to set these aside. The report is on the batches
    that this call has ended.
    """
    require_utc(spark)
    reports: dict[int, IngestReport] = {}

    def write(batch: DataFrame, number: int) -> None:
        reports[number] = _ingest_batch(batch, number, root, table, options)

    lines = stream_lines(spark, f"{root}/{LANDING}/*", max_files)
    query = (
        lines.withColumn(_AT, F.current_timestamp())
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    lost: dict[str, int] = {}
    for report in reports.values():
        for name, n in report.lost.items():
            lost[name] = lost.get(name, 0) + n
    return IngestReport(
        documents=sum(r.documents for r in reports.values()),
        rejected=sum(r.rejected for r in reports.values()),
        damaged=sum(r.damaged for r in reports.values()),
        lost=lost,
    )


def _ingest_batch(
    batch: DataFrame, number: int, root: str, table: str, options: CleanOptions
) -> IngestReport:
    spark, name = batch.sparkSession, f"{number:09d}"
    documents = parse_lines(batch)
    counted = Counted(documents, options, _AT)
    events = add_insert_date(counted.events, F.col(_AT), options).drop(_AT)
    if has_run(spark, table, name):
        # The batch was cut short after its table was whole.
        report = counted.recount()
    else:
        append_table(events, table, options.table_schema(), run=name)
        report = counted.report()
    stored = read_run(spark, table, name, options.table_schema() or events.schema)
    write_cells(stored, table, name)
    if report.rejected or report.damaged:
        folder = f"{root}/{REJECTED}/stream/batch={name}"
        rejected(documents).write.mode("overwrite").option("compression", TEXT_CODEC).json(folder)
    silver = f"{root}/{SILVER}/stream/batch={name}"
    write_silver(stored.drop(INSERTED), silver, silver_format(options), mode="overwrite")
    return report
