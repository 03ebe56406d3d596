"""The plans are the ones intended: little read, little shuffled, no Python."""

from __future__ import annotations

import re
from datetime import datetime

import pytest
from documents import document, feature, land
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tremorline import CleanOptions, analyse, flat_events, string_events, subsecond_events
from tremorline import operators as ops
from tremorline.operators import (
    add_insert_date,
    clean,
    clean_counted,
    event_rows,
    explode_features,
    feature_rows,
)
from tremorline.schema import nested_event_schema
from tremorline.sources import append_table, read_landing, read_run, read_table, rejected
from tremorline.sources.landing import is_rejected

PYTHON = re.compile(r"Python|Pandas|Arrow(?!Columnar)")


@pytest.fixture(scope="module")
def landing(tmp_path_factory):
    features = [feature(code=str(i), mag=i, place=f"N of {i % 2}") for i in range(4)]
    return land(tmp_path_factory.mktemp("landing"), document(*features))


@pytest.fixture(scope="module", params=[False, True], ids=["plain", "by_day"])
def table(request, spark, landing, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("table")) + "/t"
    rows = add_insert_date(clean(explode_features(read_landing(spark, landing))))
    append_table(rows, path, nested_event_schema(), by_day=request.param)
    return read_table(spark, path)


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def read_columns(plan):
    return set(re.findall(r"ReadSchema: struct<([^>]*)", plan))


@pytest.mark.parametrize(
    "options",
    [CleanOptions(), flat_events(), string_events("UTC"), subsecond_events("UTC")],
)
def test_clean_is_one_pass_without_python(spark, landing, options):
    plan = plan_of(clean(explode_features(read_landing(spark, landing)), options))
    assert not PYTHON.search(plan)
    assert "Exchange" not in plan
    assert plan.count("FileScan") == 1
    assert parses(plan) == 1


def parses(plan):
    """How often a plan parses whole lines. (Two more ``from_json`` stand in the branch for
    documents that the first one could not read.)"""
    assert plan.count("from_json") == 3 * plan.count("from_json(ArrayType")
    return plan.count("from_json(ArrayType")


@pytest.mark.parametrize("options", [CleanOptions(), string_events("UTC")])
def test_documents_are_parsed_once_in_every_plan(spark, landing, options):
    documents = read_landing(spark, landing)
    wide, counters = clean_counted(feature_rows(documents), options)
    plans = {
        "events": clean(explode_features(documents), options),
        "counted": event_rows(wide.observe(Observation(), *counters)),
        "counts": wide.agg(*counters),
        "rejects": rejected(documents),
        "accepted": explode_features(documents.where(~is_rejected())),
        "filtered": clean(explode_features(documents), options).where("area = 'x' and time is not null"),
        "one column": clean(explode_features(documents), options).select("area"),
    }
    for name, frame in plans.items():
        plan = plan_of(frame)
        assert parses(plan) == 1, name
        assert plan.count("FileScan") == 1 and "Exchange hash" not in plan, name


def test_methods_of_the_clean_step_are_small_enough_to_be_compiled(spark, landing, capsys):
    for options in (CleanOptions(), flat_events(), string_events("UTC"), subsecond_events("UTC")):
        clean(explode_features(read_landing(spark, landing)), options).explain("codegen")
        sizes = re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)
        assert sizes and max(map(int, sizes)) < 8000, options


def test_questions_stay_on_the_jvm_and_never_gather_a_region(table):
    for answer in analyse(table).values():
        plan = plan_of(answer)
        assert not PYTHON.search(plan)
        for operator in ("CartesianProduct", "NestedLoopJoin", "collect_list", "Window"):
            assert operator not in plan


def test_aggregates_are_partial_before_the_shuffle(table):
    for answer in (
        ops.count_by_region(table),
        ops.magnitudes_by_region(table),
        ops.average_magnitude_by_region(table),
        ops.count_by_day(table),
        ops.count_by_day_and_region(table),
        ops.regions_above(table),
    ):
        plan = plan_of(answer)
        assert plan.count("Exchange") == 1
        assert re.search(r"Exchange[^\n]*\n[^\n]*HashAggregate[^\n]*partial_", plan)


def test_only_needed_columns_are_read(table):
    by_day = "event_date" in table.columns
    time = "" if by_day else "time:timestamp"
    expected = {
        "count_by_region": {"area:string"},
        "avg_mag_by_region": {"mag:double,area:string"},
        "count_by_day": {time},
        "count_by_day_region": {"area:string" if by_day else "time:timestamp,area:string"},
        "avg_daily_count": {time},
        "regions_above_5": {"mag:double,area:string"},
        "top_regions": {"mag:double,area:string"},
    }
    answers = analyse(table)
    for question, columns in expected.items():
        assert read_columns(plan_of(answers[question])) == columns


def test_filters_reach_the_scan(table):
    plan = plan_of(ops.regions_above(table))
    assert "GreaterThan(mag,5.0)" in plan and "IsNotNull(area)" in plan
    plan = plan_of(ops.strongest_regions(table))
    assert "GreaterThan(time,ScalarSubquery" in plan
    if "event_date" in table.columns:
        assert re.search(r"PartitionFilters: \[isnotnull\(event_date[^]]*event_date#\d+ >=", plan)


def test_a_run_is_read_back_by_its_partition(spark, table, tmp_path):
    path = f"{tmp_path}/t"
    rows = add_insert_date(table.select(*nested_event_schema().names), datetime(2024, 10, 25))
    for stamp in ("20241025_075530", "20241025_075531"):
        append_table(rows, path, nested_event_schema(), run=stamp)
    stored = read_run(spark, path, "20241025_075530", nested_event_schema())
    # Only that run's folder is listed.
    assert all("/run=20241025_075530/" in file for file in stored.inputFiles())
    assert stored.count() == rows.count()
    assert read_run(spark, path, "20241025_075532", nested_event_schema()) is None


def test_strongest_aggregates_the_week_once(table):
    answer = ops.strongest_regions(table)
    answer.collect()
    assert "ReusedExchange" in plan_of(answer)


def test_top_is_not_a_full_sort(table):
    assert "TakeOrderedAndProject" in plan_of(ops.top_regions(table))
