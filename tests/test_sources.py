"""Landing, silver and table, one at a time."""

from __future__ import annotations

import json
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from documents import document, feature, land
from pyspark.sql import functions as F

from tremorline import flat_events, nested_events
from tremorline.operators import (
    add_insert_date,
    clean,
    count_by_day,
    explode_features,
    strongest_regions,
)
from tremorline.schema import flat_event_schema, nested_event_schema
from tremorline.sources import (
    Run,
    append_shape,
    append_table,
    conform,
    conform_losses,
    latest_day,
    merged_schema,
    read_landing,
    read_shapes,
    read_silver,
    read_table,
    rejected,
    write_landing,
    write_silver,
)
from tremorline.sources.derived_feed import to_documents
from tremorline.sources.landing import is_rejected
from tremorline.sources.paths import require_utc, scratch_dir

RUN_AT = datetime(2024, 10, 25, 7, 55, 30, tzinfo=timezone.utc)


def events(spark, path, *features, options=nested_events()):
    return clean(explode_features(read_landing(spark, land(path, document(*features)))), options)


def test_run_folders():
    run = Run("s3://bucket/quakes", RUN_AT)
    assert run.landing == "s3://bucket/quakes/landing/20241025_075530"
    assert run.silver == "s3://bucket/quakes/silver/20241025_075530"
    assert Run("s3://bucket/quakes/", RUN_AT).landing == run.landing
    elsewhere = RUN_AT.astimezone(timezone(timedelta(hours=-7)))
    assert Run("x", elsewhere).landing == Run("x", RUN_AT).landing
    assert Run("x", RUN_AT.replace(tzinfo=None)).landing == Run("x", RUN_AT).landing


def test_landing_keeps_lines_and_reads_globs(spark, tmp_path):
    lines = [document(feature(code="é")), "None", document(feature(code="b"), feature(code="c"))]
    frame = spark.createDataFrame([(line,) for line in lines], "value string")
    for stamp in ("20241025_075530", "20241026_075530"):
        write_landing(frame, f"{tmp_path}/landing/{stamp}")
    text = spark.read.text(f"{tmp_path}/landing/20241025_075530")
    assert sorted(row.value for row in text.collect()) == sorted(lines)
    for path, n in ((f"{tmp_path}/landing/20241025_*", 3), (f"{tmp_path}/landing/*/part-*", 6)):
        assert explode_features(read_landing(spark, path)).count() == n


def test_rejected(spark, tmp_path):
    good = [document(), document(feature()), document(feature(title="\u2028 é"))]
    cut_short = document(feature(), feature())[:-40]
    unreadable = ["None", '{"features": [', cut_short, "{'features': []}"]
    featureless = ['{"x": 1}', '{"features": null}', "{}"]
    documents = read_landing(spark, land(tmp_path, *good, *unreadable, *featureless))
    found = rejected(documents).collect()
    assert sorted(row.line for row in found if row.reason == "unreadable") == sorted(unreadable)
    assert [row.line for row in found if row.reason == "no features"] == [None] * 3
    assert all(row.file.endswith("feed.json") for row in found)
    assert documents.where(~is_rejected()).count() == 3
    assert explode_features(documents).count() == 2


def test_silver_is_json_with_nulls(spark, tmp_path):
    rows = events(spark, tmp_path / "in", feature(mag=1.5, place="N of Ⅹ"))
    write_silver(rows, f"{tmp_path}/silver")
    [text] = [row.value for row in spark.read.text(f"{tmp_path}/silver").collect()]
    values = json.loads(text)
    assert list(values) == rows.columns
    assert (values["time"], values["mag"], values["area"], values["tz"]) == (
        "2024-10-25 07:55:30",
        1.5,
        "Ⅹ",
        None,
    )
    assert read_silver(spark, f"{tmp_path}/silver", rows.schema).collect() == rows.collect()


def test_conform(spark):
    frame = spark.createDataFrame([("x", "1.5", "7")], "depth string, mag string, felt string")
    row = conform(frame, flat_event_schema())
    assert row.schema == flat_event_schema()
    assert row.select("mag", "felt", "depth", "place").first() == (1.5, 7, None, None)
    with pytest.raises(ValueError, match="surplus"):
        conform(frame.withColumn("surplus", F.lit(1)), flat_event_schema())


def test_append_creates_then_adds(spark, tmp_path):
    rows = add_insert_date(events(spark, tmp_path / "in", feature(), feature()), RUN_AT)
    for expected in (2, 4):
        append_table(rows, f"{tmp_path}/table", nested_event_schema())
        assert read_table(spark, f"{tmp_path}/table").count() == expected
    assert read_table(spark, f"{tmp_path}/table").schema == nested_event_schema()


@pytest.mark.parametrize("run, by_day", [("20241025_075530", False), (None, True), ("7", True)])
def test_layouts_hold_the_same_rows(spark, tmp_path, run, by_day):
    features = [feature(code=str(i), time=1729842930123 + i * 40_000_000) for i in range(6)]
    features.append(feature(code="no time", time=None))
    rows = add_insert_date(events(spark, tmp_path / "in", *features), RUN_AT)
    target = f"{tmp_path}/table"
    append_table(rows, target, nested_event_schema(), run=run, by_day=by_day)
    table = read_table(spark, target, nested_event_schema())
    names = nested_event_schema().names
    stored = table.select(names).orderBy("code").collect()
    assert stored == rows.select(names).orderBy("code").collect()
    assert count_by_day(table).orderBy("day").collect() == (
        count_by_day(rows).orderBy("day").collect()
    )
    folders = {p.parent.name for p in Path(target).rglob("*.parquet")}
    assert any(name.startswith("event_date=") for name in folders) == by_day


def test_catalog_table(spark, tmp_path):
    rows = add_insert_date(events(spark, tmp_path / "in", feature()), RUN_AT)
    spark.sql(f"CREATE DATABASE quakes LOCATION '{tmp_path}/quakes'")
    try:
        for _ in range(2):
            append_table(rows, "quakes.events", nested_event_schema(), catalog=True)
        assert read_table(spark, "quakes.events", catalog=True).count() == 2
    finally:
        spark.sql("DROP DATABASE quakes CASCADE")


def test_appends_without_a_schema_keep_their_own(spark, tmp_path):
    target = f"{tmp_path}/table"
    append_table(events(spark, tmp_path / "a", feature()), target)
    append_table(events(spark, tmp_path / "b", feature(), options=flat_events()), target)
    table = read_table(spark, target, merge_schema=True)
    assert {"geometry", "latitude"} <= set(table.columns)
    assert table.where("geometry is null").count() == 1


def test_shapes_of_any_types_unite(spark, tmp_path):
    target = f"{tmp_path}/table"
    first = spark.createDataFrame([(1, 2.5, "x", datetime(2024, 1, 1), (1, "p"))], "a int, b double, c string, t timestamp, s struct<u int, v string>")
    second = spark.createDataFrame([(7.0, 2**40, 3, "late", (2.5,))], "a double, b bigint, c bigint, t string, s struct<u double>")
    third = spark.createDataFrame([(2**60, datetime(2024, 1, 2).date())], "a bigint, d date")
    for rows in (first, second, third, first):
        append_shape(rows, target)
    table = read_shapes(spark, target)
    assert table.schema.simpleString() == (
        "struct<a:double,b:double,c:string,t:string,s:struct<u:double,v:string>,d:date>"
    ) or set(table.schema.simpleString()[7:-1]) == set(
        "a:double,b:double,c:string,t:string,s:struct<u:double,v:string>,d:date"
    )
    assert table.count() == 4
    assert sorted(r.c for r in table.where("c is not null").collect()) == ["3", "x", "x"]
    assert sorted(r.s.u for r in table.where("s is not null").collect()) == [1.0, 1.0, 2.5]
    assert merged_schema([third.schema, first.schema])["a"].dataType.simpleString() == "bigint"


def test_latest_day_is_known_from_folders(spark, tmp_path):
    features = [feature(code=str(i), mag=i, place="N of X", time=1729842930123 + i * 86_400_000) for i in range(9)]
    features.append(feature(code="no time", time=None))
    rows = add_insert_date(events(spark, tmp_path / "in", *features), RUN_AT)
    for run in (None, "1", "2"):
        target = f"{tmp_path}/table-{'plain' if run is None else 'runs'}"
        part = rows if run != "2" else rows.where("code = '3'")
        append_table(part, target, nested_event_schema(), run=run, by_day=True)
        last = latest_day(spark, target)
        assert last == datetime(2024, 11, 2).date()
        table = read_table(spark, target, nested_event_schema())
        answer = strongest_regions(table, last_day=last)
        assert answer.collect() == strongest_regions(table).collect()
        plan = answer._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: []" not in plan
    assert latest_day(spark, f"{tmp_path}/nothing") is None


def test_conform_counts_what_it_loses(spark):
    frame = spark.createDataFrame([("x", "1.5", "7"), (None, "?", "7.5")], "depth string, mag string, felt string")
    counts = frame.agg(*conform_losses(frame, flat_event_schema())).first().asDict()
    assert {k: v for k, v in counts.items()} == {"depth": 1, "mag": 1, "felt": 1} | {
        k: 0 for k in counts if k not in ("depth", "mag", "felt")
    }


@pytest.mark.parametrize("n, per_document", [(0, 10), (1, 10), (10, 10), (25, 10)])
def test_documents_are_bounded_and_whole(spark, tmp_path, n, per_document):
    one = json.dumps(feature())
    frame = spark.range(0, n, 1, 1).select(F.lit(one).alias("value"))
    write_landing(to_documents(frame, per_document), f"{tmp_path}/landing")
    sizes = read_landing(spark, f"{tmp_path}/landing").select(F.size("features").alias("n"))
    found = sorted(row.n for row in sizes.collect())
    assert sum(found) == n
    assert all(size <= per_document for size in found)


def test_session_settings(spark):
    require_utc(spark)
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        with pytest.raises(ValueError, match="timeZone"):
            require_utc(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first != second
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        assert first.startswith(shared)


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "yarn"}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(Session(), "x")


def test_lines_that_are_not_one_document_are_rejected(spark, tmp_path):
    good = document(feature(code="a"))
    odd = [good + good, good + ", " + good, good + " trailing", f"[{good}]", '"text"', "3", "null"]
    # These end the list that the parser is given; what follows must not be lost.
    odd += [good + "] trailing", f"{good}],[{good}", good + "]", f'{good},{{"_end":"x"}}]', good + ","]
    path = land(tmp_path / "landing", good, *odd, "", "  ")
    documents = read_landing(spark, path)
    assert documents.count() == 1 + len(odd)
    found = sorted((row.reason, row.line) for row in rejected(documents).collect())
    assert found == sorted(("unreadable", line) for line in odd)
