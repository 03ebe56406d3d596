"""Questions answered by region.

Each function takes clean events and reads only the columns it names. A NULL area
is a group of its own in counts and means, and left out where the answer is a
region name. All groupings are plain aggregates, so a region that holds most of the
events is reduced before the shuffle and never gathered.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremorline.schema import DAY


def area_and_magnitude(events: DataFrame) -> DataFrame:
    """The (area, mag) pairs behind the magnitude questions, one per event."""
    return events.select("area", "mag")


def count_by_region(events: DataFrame) -> DataFrame:
    """Number of events per region."""
    return events.groupBy("area").agg(F.count(F.lit(1)).alias("n"))


def magnitudes_by_region(events: DataFrame) -> DataFrame:
    """All magnitudes of each region, as (area, mag, n) with n the multiplicity.

    The same information as one list per region, in rows: a list would put a whole
    region into one task, however large. Missing magnitudes are kept (mag NULL).
    """
    return events.groupBy("area", "mag").agg(F.count(F.lit(1)).alias("n"))


def average_magnitude_by_region(events: DataFrame) -> DataFrame:
    """Mean magnitude per region over the events that have one."""
    return events.groupBy("area").agg(F.avg("mag").alias("avg_mag"))


def strongest_regions(
    events: DataFrame, as_of: datetime | None = None, days: int = 7, *, last_day: date | None = None
) -> DataFrame:
    """Region and magnitude of the strongest event in the last ``days`` x 24 hours.

    ``as_of`` closes the period (inclusive; a naive value is UTC) and defaults to the
    latest event. All regions that share the highest magnitude are returned.

    Of a table laid out by day, ``last_day`` says which its last one is (``latest_day`` knows
    it from the folders). Then only that day is looked through for the latest event; without
    it, the names of all files' days are.
    """
    by_day = DAY in events.columns
    if as_of is None:
        if by_day:
            # The latest event is on the table's last day, known without reading rows.
            last = events.agg(F.max(DAY)).scalar() if last_day is None else F.lit(last_day)
            ends = events.where(F.col(DAY) >= last)
            events = events.where(F.col(DAY) >= F.date_sub(last, days))
        else:
            ends = events
        start = F.max("time") - F.make_dt_interval(F.lit(days))
        recent = events.where(F.col("time") > ends.agg(start).scalar())
    else:
        end = as_of if as_of.tzinfo else as_of.replace(tzinfo=timezone.utc)
        first, last = F.lit(end - timedelta(days=days)), F.lit(end)
        recent = events.where((F.col("time") > first) & (F.col("time") <= last))
        if by_day:
            recent = recent.where(F.col(DAY).between(F.to_date(first), F.to_date(last)))
    peaks = (
        recent.where(F.col("area").isNotNull() & F.col("mag").isNotNull())
        .groupBy("area")
        .agg(F.max("mag").alias("mag"))
    )
    return peaks.where(F.col("mag") == peaks.agg(F.max("mag")).scalar())


def regions_above(events: DataFrame, magnitude: float = 5.0) -> DataFrame:
    """Regions with events stronger than ``magnitude``: the maximum and how many."""
    strong = events.where((F.col("mag") > magnitude) & F.col("area").isNotNull())
    return strong.groupBy("area").agg(
        F.max("mag").alias("max_mag"), F.count(F.lit(1)).alias("n")
    )


def top_regions(events: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` regions with most events; the higher maximum, then the name, decides ties."""
    named = events.where(F.col("area").isNotNull())
    ranked = named.groupBy("area").agg(
        F.count(F.lit(1)).alias("n"), F.max("mag").alias("max_mag")
    )
    return ranked.orderBy(F.desc("n"), F.desc_nulls_last("max_mag"), F.asc("area")).limit(k)
