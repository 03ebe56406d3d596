"""Whole runs: landing to both sinks."""

from __future__ import annotations

from datetime import datetime, timezone
from pathlib import Path

import pytest
from documents import document, feature
from pyspark.sql import functions as F

from tremorline import (
    IngestReport,
    Run,
    flat_events,
    ingest,
    nested_events,
    read_table,
    string_events,
    subsecond_events,
)
from tremorline import operators as ops
from tremorline.sources import read_cells, read_run, read_silver, whole_runs
from tremorline.sources.silver import SECOND_FORMAT, SUBSECOND_FORMAT

RUN_AT = datetime(2024, 10, 25, 7, 55, 30, 123456, tzinfo=timezone.utc)
ZONE = "America/Los_Angeles"


def lines(spark, *texts):
    return spark.createDataFrame([(text,) for text in texts], "value string")


LINES = [
    document(feature(code="a", place="1 km N of X", mag=1), feature(code="b", place=None)),
    document(feature(code="c", time=0, place="Y")),
    "None",
    '{"x": 1}',
    document(),
]


@pytest.mark.parametrize("by_run", [None, False])
@pytest.mark.parametrize(
    "options",
    [nested_events(), flat_events(), string_events(ZONE), subsecond_events(ZONE)],
    ids=["nested", "flat", "string", "subsecond"],
)
def test_both_sinks_hold_the_run(spark, tmp_path, options, by_run):
    run = Run(str(tmp_path), RUN_AT)
    table = f"{tmp_path}/table"
    report = ingest(spark, run, table, options, lines=lines(spark, *LINES), by_run=by_run)
    assert report == IngestReport(documents=5, rejected=2)
    stored = read_table(spark, table)
    if options.table_schema() is not None:
        assert stored.schema == options.table_schema()
    assert "insert_date" in stored.columns
    assert sorted(row.code for row in stored.collect()) == ["a", "b", "c"]

    schema = stored.drop("insert_date").schema
    fraction = options.time_mode == "local_subsecond"
    silver = read_silver(spark, run.silver, schema, SUBSECOND_FORMAT if fraction else SECOND_FORMAT)
    expected = stored.drop("insert_date").orderBy("code").collect()
    assert silver.orderBy("code").collect() == expected
    assert "insert_date" not in spark.read.json(run.silver).columns

    reasons = [row.reason for row in spark.read.json(run.rejected).collect()]
    assert sorted(reasons) == ["no features", "unreadable"]


@pytest.mark.parametrize("by_day", [False, True])
def test_runs_add_up_and_stay_apart(spark, tmp_path, by_day):
    table = f"{tmp_path}/table"
    for second in (30, 31):
        run = Run(str(tmp_path), RUN_AT.replace(second=second))
        ingest(spark, run, table, lines=lines(spark, *LINES), by_day=by_day)
        assert spark.read.json(run.silver).count() == 3
    stored = read_table(spark, table)
    assert stored.count() == 6
    per_run = stored.groupBy(F.col("insert_date").cast("string").alias("d")).count().collect()
    assert {row.d: row["count"] for row in per_run} == {
        "2024-10-25 07:55:30": 3,
        "2024-10-25 07:55:31": 3,
    }


def test_landed_by_someone_else(spark, tmp_path):
    run = Run(str(tmp_path), RUN_AT)
    Path(run.landing).mkdir(parents=True)
    Path(run.landing, "feed.json").write_text(LINES[0] + "\n")
    assert ingest(spark, run, f"{tmp_path}/table") == IngestReport(documents=1, rejected=0)
    assert not Path(run.rejected).exists()


def test_catalog_run(spark, tmp_path):
    spark.sql(f"CREATE DATABASE quakes2 LOCATION '{tmp_path}/quakes2'")
    try:
        for second in (30, 31):
            run = Run(str(tmp_path), RUN_AT.replace(second=second))
            ingest(spark, run, "quakes2.events", lines=lines(spark, *LINES), catalog=True)
            assert spark.read.json(run.silver).count() == 3
        assert spark.table("quakes2.events").count() == 6
    finally:
        spark.sql("DROP DATABASE quakes2 CASCADE")


@pytest.mark.parametrize("by_day", [False, True])
@pytest.mark.parametrize("texts", [["None", "None"], []], ids=["rejects", "empty"])
def test_nothing_usable_landed(spark, tmp_path, texts, by_day):
    run = Run(str(tmp_path), RUN_AT)
    landed = lines(spark, *texts)
    report = ingest(spark, run, f"{tmp_path}/table", lines=landed, by_day=by_day)
    assert report == IngestReport(documents=len(texts), rejected=len(texts))
    assert spark.read.schema("code string").json(run.silver).count() == 0


def test_a_run_is_not_appended_twice(spark, tmp_path):
    table = f"{tmp_path}/table"
    spark.sql(f"CREATE DATABASE quakes3 LOCATION '{tmp_path}/quakes3'")
    try:
        for target, catalog in ((table, False), ("quakes3.events", True)):
            for root in ("first", "second"):
                run = Run(f"{tmp_path}/{root}-{catalog}", RUN_AT)
                if root == "first":
                    ingest(spark, run, target, lines=lines(spark, *LINES), catalog=catalog)
                    continue
                with pytest.raises(ValueError, match="already holds run 20241025_075530"):
                    ingest(spark, run, target, lines=lines(spark, *LINES), catalog=catalog)
            assert read_table(spark, target, catalog=catalog).count() == 3
    finally:
        spark.sql("DROP DATABASE quakes3 CASCADE")


def test_one_table_takes_all_shapes(spark, tmp_path):
    table = f"{tmp_path}/table"
    shapes = [nested_events(), flat_events(), subsecond_events(ZONE)]
    for second, options in enumerate(shapes):
        run = Run(str(tmp_path), RUN_AT.replace(second=second))
        ingest(spark, run, table, options, lines=lines(spark, *LINES))
    assert read_table(spark, table, merge_schema=True).count() == 9
    for wrong in ({"by_run": False}, {"by_day": True, "by_run": False}):
        run = Run(str(tmp_path), RUN_AT.replace(second=40 + len(wrong)))
        with pytest.raises(ValueError, match="laid out by"):
            ingest(spark, run, table, lines=lines(spark, *LINES), **wrong)
    with pytest.raises(ValueError, match="as bigint, not as string"):
        run = Run(str(tmp_path), RUN_AT.replace(second=50))
        ingest(spark, run, table, string_events(ZONE), lines=lines(spark, *LINES))
    assert read_table(spark, table, merge_schema=True).count() == 9


def test_a_run_that_lacks_silver_goes_on(spark, tmp_path):
    run, table = Run(str(tmp_path), RUN_AT), f"{tmp_path}/table"
    first = ingest(spark, run, table, lines=lines(spark, *LINES))
    for part in Path(run.silver).iterdir():
        part.unlink()
    assert ingest(spark, run, table) == first
    assert spark.read.json(run.silver).count() == read_table(spark, table).count() == 3
    with pytest.raises(ValueError, match="already holds"):
        ingest(spark, run, table)


def unmarked(folder):
    """Take the mark of an ended write away, and one of its files, as if it had been cut short."""
    files = sorted(p for p in Path(folder).rglob("*") if p.name.startswith("part-"))
    files[0].unlink()
    Path(folder, "_SUCCESS").unlink()


@pytest.mark.parametrize("by_day", [False, True])
@pytest.mark.parametrize("lost", [["table"], ["silver"], ["table", "silver", "report"], ["silver", "report"]])
def test_a_run_that_was_cut_short_anywhere_goes_on(spark, tmp_path, lost, by_day):
    run, table = Run(str(tmp_path), RUN_AT), f"{tmp_path}/table"
    landed = lines(spark, *LINES, document(None, feature(code="d", mag="?"))).repartition(3)
    first = ingest(spark, run, table, lines=landed, by_day=by_day)
    assert first == IngestReport(documents=6, rejected=2, damaged=1, lost={"mag": 1})
    whole = read_table(spark, table).orderBy("code").collect()
    for part in lost:
        unmarked(f"{table}/run={run.stamp}" if part == "table" else getattr(run, part))
    if "table" in lost:
        assert whole_runs(spark, table) == []
        assert read_table(spark, table, nested_events().table_schema()).count() == 0
    if lost == ["table"]:
        # Silver is whole, so the run counts as ended; its table must still not stay half.
        assert read_run(spark, table, run.stamp, nested_events().table_schema()) is None
    assert ingest(spark, run, table, by_day=by_day) == first
    assert read_table(spark, table).orderBy("code").collect() == whole
    assert spark.read.json(run.silver).count() == len(whole)
    assert sorted(r.reason for r in spark.read.json(run.rejected).collect()) == [
        "damaged feature", "no features", "unreadable"
    ]
    with pytest.raises(ValueError, match="already holds"):
        ingest(spark, run, table, by_day=by_day)


def test_cells_equal_the_events_after_every_run(spark, tmp_path):
    table = f"{tmp_path}/table"
    for second in range(3):
        run = Run(str(tmp_path), RUN_AT.replace(second=second))
        ingest(spark, run, table, lines=lines(spark, *LINES))
        if second == 1:
            unmarked(f"{table}/_cells/run={run.stamp}")
        cells, events = read_cells(spark, table), read_table(spark, table)
        for question in (ops.count_by_day, ops.count_by_day_and_region, ops.average_daily_count):
            answer = question(cells)
            assert sorted(map(tuple, answer.collect()), key=repr) == sorted(map(tuple, question(events).collect()), key=repr)
    files = [f for f in ops.count_by_day(cells).inputFiles() if "/_cells/" not in f]
    assert all(f"run={RUN_AT.replace(second=1):%Y%m%d_%H%M%S}/" in f for f in files)


def test_session_must_be_utc(spark, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        with pytest.raises(ValueError, match="timeZone"):
            ingest(spark, Run(str(tmp_path), RUN_AT), f"{tmp_path}/table")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
