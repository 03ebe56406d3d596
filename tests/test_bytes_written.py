"""What runs and queries leave on disk: compressed layers, and no feed landed twice for one run."""

from __future__ import annotations

import re
from datetime import datetime, timezone
from pathlib import Path

import pytest
from documents import document, feature
from pyspark.sql import functions as F

from tremorline import Run, flat_events, ingest
from tremorline import operators as ops
from tremorline.functions import as_double, cast
from tremorline.plans import registry
from tremorline.sources import append_shape, read_landing, read_shapes, write_landing

RUN_AT = datetime(2024, 10, 25, 7, 55, 30, tzinfo=timezone.utc)


def parts(folder):
    return [path.name for path in Path(folder).rglob("part-*")]


def test_the_layers_of_a_run_are_compressed(spark, tmp_path):
    texts = [document(feature(code=f"c{i}")) for i in range(7)] + ["None"]
    lines = spark.createDataFrame([(text,) for text in texts], "value string").coalesce(1)
    run = Run(str(tmp_path), RUN_AT)
    ingest(spark, run, f"{tmp_path}/table", lines=lines, per_file=3)
    for folder, ending in (
        (run.landing, ".txt.gz"),
        (run.silver, ".json.gz"),
        (run.rejected, ".json.gz"),
        (f"{tmp_path}/table/run={run.stamp}", ".zstd.parquet"),
    ):
        assert parts(folder) and all(name.endswith(ending) for name in parts(folder)), folder
    # Three documents in a file at most.
    assert len(parts(run.landing)) == 3
    assert ops.explode_features(read_landing(spark, run.landing)).count() == 7


def test_tables_of_all_shapes_are_compressed(spark, tmp_path):
    write_landing(spark.createDataFrame([(document(feature(code="a")),)], "value string"), f"{tmp_path}/in")
    events = ops.clean(ops.explode_features(read_landing(spark, f"{tmp_path}/in")), flat_events())
    append_shape(events, f"{tmp_path}/table")
    rows = [name for name in parts(tmp_path / "table") if name.endswith(".parquet")]
    assert rows and all(name.endswith(".zstd.parquet") for name in rows)
    assert read_shapes(spark, f"{tmp_path}/table").count() == 1


@pytest.mark.parametrize(
    "query, landings",
    [("one_table_all_shapes", 3), ("avg_daily_count_from_cells", 2), ("resumed_ingest", 1), ("ingest_report", 1)],
)
def test_the_feed_is_landed_once_for_each_run(spark, sf_dir, tmp_path, monkeypatch, query, landings):
    monkeypatch.setattr(registry, "_made", {})
    monkeypatch.setattr(registry, "scratch_dir", lambda spark, label: f"{tmp_path}/{label}")
    registry.QUERIES[query](spark, sf_dir).count()
    folders = {path.parent for path in tmp_path.rglob("part-*.txt.gz")} | {
        path.parent for path in tmp_path.rglob("part-*.txt") if "reports" not in path.parts
    }
    assert len(folders) == landings


def test_foreign_characters_are_listed_one_by_one(spark):
    # A range or a class among them makes the search five times as slow.
    assert not re.search(r"\w-\w|\\[sdwSDW]", cast._FOREIGN)
    frame = spark.createDataFrame([(i, f"1{chr(i)}") for i in range(0x3000)], "i int, v string")
    kept = {row.i for row in frame.where(as_double(F.col("v")).isNotNull()).collect()}
    assert kept == {ord(c) for c in "0123456789. \t\n\x0b\f\r"}
