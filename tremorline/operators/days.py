"""Questions answered by UTC day. Events without a time belong to no day.

Each takes events, or cells (day, area, n) that were counted run by run: a frame with the
columns of cells is added up and not counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremorline.schema import DAY


def count_by_day(events: DataFrame) -> DataFrame:
    """Number of events per day."""
    return _with_day(events).groupBy("day").agg(_number(events))


def count_by_day_and_region(events: DataFrame) -> DataFrame:
    """Number of events per day and region."""
    return _with_day(events).groupBy("day", "area").agg(_number(events))


def average_daily_count(events: DataFrame) -> DataFrame:
    """Mean number of events over the days that have any, as one row."""
    return count_by_day(events).agg(F.avg("n").alias("avg_n"))


def average_daily_count_by_region(events: DataFrame) -> DataFrame:
    """Per region, mean number of events over the days on which it has any."""
    return count_by_day_and_region(events).groupBy("area").agg(F.avg("n").alias("avg_n"))


CELLS = ["day", "area", "n"]


def _number(events: DataFrame) -> Column:
    return (F.sum("n") if events.columns == CELLS else F.count(F.lit(1))).alias("n")


def _with_day(events: DataFrame) -> DataFrame:
    if events.columns == CELLS:
        return events
    # A table laid out by day answers from its partition values and never reads time.
    day = F.col(DAY) if DAY in events.columns else F.to_date("time")
    return events.withColumn("day", day).where(F.col("day").isNotNull())
