"""Which of several versions of an event counts, in a table whose runs overlap."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What names an event, and what tells which version of it is the later one.
IDENTITY = ["net", "code"]
ORDER = ["updated", "insert_date"]


def latest_events(events: DataFrame) -> DataFrame:
    """One row for each event, its latest version: the one updated last, then inserted last; of
    versions that agree in that, the greatest by all columns in order.

    The maximum of whole rows is a mergeable aggregate, so each task keeps one version of an event
    before the shuffle, however often the event comes. Events without a code have no
    identity and are all kept.
    """
    order = [name for name in ORDER if name in events.columns]
    row = F.struct(*order, *[n for n in events.columns if n not in (*order, *IDENTITY)])
    known = events.where(F.col("code").isNotNull())
    latest = known.groupBy(*IDENTITY).agg(F.max(row).alias("row")).select(*IDENTITY, "row.*")
    return latest.select(events.columns).union(events.where(F.col("code").isNull()))
