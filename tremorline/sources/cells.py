"""Cells of a table that keeps runs apart: how many events each run has by day and region.

Cells are added up, never changed: those of a run are written once, beside the table, when
the run is whole. Questions about days then read a row for each run, day and region, and
no event. A run whose cells are not there is counted from its events, so cells and
events give the same answers after every run, and also after one that ended early.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremorline.schema import RUN
from tremorline.sources.files import DONE, matching
from tremorline.sources.table import read_runs, whole_runs

_SCHEMA = "day date, area string, n bigint"


def cells_of(events: DataFrame) -> DataFrame:
    """day, area and n of events; events without a time have no day and are left out."""
    dated = events.select(F.to_date("time").alias("day"), "area").where("day is not null")
    return dated.groupBy("day", "area").agg(F.count(F.lit(1)).alias("n"))


def write_cells(events: DataFrame, table: str, run: str) -> None:
    """Write the cells of a whole run of a path table, replacing older ones."""
    cells_of(events).write.mode("overwrite").parquet(_folder(table, run))


def read_cells(spark: SparkSession, table: str, *, format: str = "parquet") -> DataFrame:
    """The cells of all whole runs of a path table."""
    runs = whole_runs(spark, table) or []
    found = matching(spark, f"{_folder(table, '*')}/{DONE}")
    have = {path.split("/")[-2].partition("=")[2] for path in found} & set(runs)
    cells = spark.createDataFrame([], _SCHEMA)
    if have:
        folders = [_folder(table, run) for run in sorted(have)]
        cells = spark.read.schema(_SCHEMA).parquet(*folders)
    lacking = sorted(set(runs) - have)
    if lacking:
        schema = T.StructType.fromDDL("time timestamp, area string")
        cells = cells.union(cells_of(read_runs(spark, table, lacking, schema, format=format)))
    return cells


def _folder(table: str, run: str) -> str:
    return f"{table.rstrip('/')}/_cells/{RUN}={run}"
