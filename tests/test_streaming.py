"""Incremental ingestion over several calls."""

from __future__ import annotations

from datetime import datetime, timezone
from pathlib import Path

import pytest
from documents import document, feature, land

from tremorline import IngestReport, Run, ingest_new_documents, read_table, subsecond_events
from tremorline.sources import read_silver

RUN_AT = datetime(2024, 10, 25, 7, 55, 30, tzinfo=timezone.utc)


def codes(frame):
    return sorted(row.code for row in frame.collect())


@pytest.mark.parametrize("max_files", [None, 1])
def test_each_document_once(spark, tmp_path, max_files):
    root, table = str(tmp_path), f"{tmp_path}/table"

    def call():
        return ingest_new_documents(
            spark, root, table, f"{root}/checkpoint", max_files=max_files
        )

    land(Path(Run(root, RUN_AT).landing), document(feature(code="a"), feature(code="b")), "None")
    assert call() == IngestReport(documents=2, rejected=1)
    assert codes(read_table(spark, table)) == ["a", "b"]

    assert call() == IngestReport(documents=0, rejected=0)
    for minute, code in ((56, "c"), (57, "d")):
        run = Run(root, RUN_AT.replace(minute=minute))
        land(Path(run.landing), document(feature(code=code, place="1 km N of X")))
    assert call() == IngestReport(documents=2, rejected=0)
    stored = read_table(spark, table)
    assert codes(stored) == ["a", "b", "c", "d"]
    assert {row.insert_date is None for row in stored.collect()} == {False}

    silver = read_silver(spark, f"{root}/silver/stream", stored.drop("insert_date").schema)
    assert silver.orderBy("code").collect() == stored.drop("insert_date").orderBy("code").collect()


@pytest.mark.parametrize("lacking", [[], ["silver"], ["silver", "reports", "rejected"], ["table", "silver"]])
def test_a_repeated_batch_changes_nothing(spark, tmp_path, lacking):
    root, table = str(tmp_path), f"{tmp_path}/table"
    land(Path(Run(root, RUN_AT).landing), document(feature(code="a"), None, feature(code="b")), "None")
    first = ingest_new_documents(spark, root, table, f"{root}/checkpoint")
    assert first == IngestReport(documents=2, rejected=1, damaged=1)
    before = read_table(spark, table).orderBy("code").collect()
    # As if the call had been cut short somewhere before it was noted as done.
    for note in Path(root, "checkpoint", "commits").iterdir():
        if note.name.lstrip(".").startswith("0"):
            note.unlink()
    for layer in lacking:
        for path in Path(root, layer).rglob("*"):
            if path.name in ("_SUCCESS", "._SUCCESS.crc") or (path.name.startswith("part-") and layer != "table"):
                path.unlink()
    assert ingest_new_documents(spark, root, table, f"{root}/checkpoint") == first
    assert read_table(spark, table).orderBy("code").collect() == before
    assert codes(spark.read.json(f"{root}/silver/stream")) == ["a", "b"]
    assert spark.read.json(f"{root}/rejected/stream").count() == 2


def test_rejects_are_set_aside_once(spark, tmp_path):
    root = str(tmp_path)
    for minute, text in ((55, "None"), (56, document(feature())), (57, '{"x": 1}')):
        land(Path(Run(root, RUN_AT.replace(minute=minute)).landing), text)
        ingest_new_documents(spark, root, f"{root}/table", f"{root}/checkpoint")
    found = spark.read.json(f"{root}/rejected/stream").collect()
    assert sorted(row.reason for row in found) == ["no features", "unreadable"]


def test_options_apply(spark, tmp_path):
    root = str(tmp_path)
    land(Path(Run(root, RUN_AT).landing), document(feature(code="a", place="Alaska")))
    options = subsecond_events("America/Los_Angeles")
    ingest_new_documents(spark, root, f"{root}/table", f"{root}/checkpoint", options)
    row = read_table(spark, f"{root}/table").selectExpr("cast(time as string)", "area").first()
    assert row == ("2024-10-25 00:55:30.123", None)


def test_rejects_of_many_batches_are_all_counted(spark, tmp_path):
    root = str(tmp_path)
    folder = Path(Run(root, RUN_AT).landing)
    folder.mkdir(parents=True)
    for i in range(105):
        text = "None" if i == 0 else document(feature(code=str(i)))
        (folder / f"{i:03}.json").write_text(text + "\n")
    report = ingest_new_documents(spark, root, f"{root}/table", f"{root}/checkpoint", max_files=1)
    assert report == IngestReport(documents=105, rejected=1)
    assert [row.line for row in spark.read.json(f"{root}/rejected/stream").collect()] == ["None"]
