"""Analysis: every question about the clean event table."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tremorline import operators as ops

QUESTIONS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "count_by_region": ops.count_by_region,
    "avg_mag_by_region": ops.average_magnitude_by_region,
    "count_by_day": ops.count_by_day,
    "count_by_day_region": ops.count_by_day_and_region,
    "avg_daily_count": ops.average_daily_count,
    "avg_daily_count_by_region": ops.average_daily_count_by_region,
    "strongest_region_last_week": ops.strongest_regions,
    "regions_above_5": ops.regions_above,
    "top_regions": ops.top_regions,
}


#: The questions that cells (``read_cells``) answer as well as events do.
BY_CELLS = ["count_by_day", "count_by_day_region", "avg_daily_count", "avg_daily_count_by_region"]


def analyse(
    events: DataFrame, *, cells: DataFrame | None = None, last_day: date | None = None
) -> dict[str, DataFrame]:
    """One lazy answer per question, over the clean event table.

    Needs the columns area, mag and time, so the nested and the flat table both do. With
    ``cells`` the questions about days add these up and read no events; ``last_day`` spares a
    table by day the search for it.
    """
    answers = {}
    for name, question in QUESTIONS.items():
        if cells is not None and name in BY_CELLS:
            answers[name] = question(cells)
        elif name == "strongest_region_last_week":
            answers[name] = question(events, last_day=last_day)
        else:
            answers[name] = question(events)
    return answers


def write_answers(events: DataFrame, folder: str, format: str = "parquet", **known: object) -> None:
    """Write every answer in full, each into a folder of its question's name. ``known`` goes
    to ``analyse``."""
    for question, answer in analyse(events, **known).items():
        answer.write.format(format).save(f"{folder.rstrip('/')}/{question}")


def show_answers(events: DataFrame, rows: int | None = None, **known: object) -> None:
    """Print every answer in the order of its columns: in full, or its first ``rows`` and how
    many more there are. Each answer is computed once.

    In full, its sorted parts come to the driver one after the other, so the largest part has
    to fit there and not the answer. With ``rows`` only these come, and the others are
    counted in the same pass.
    """
    for question, answer in analyse(events, **known).items():
        print(question, "\t".join(answer.columns), sep="\n")
        if rows is None:
            shown = answer.orderBy(*answer.columns).toLocalIterator()
            total = None
        else:
            counted = Observation()
            whole = answer.observe(counted, F.count(F.lit(1)).alias("n"))
            shown = whole.orderBy(*answer.columns).limit(rows).collect()
            total = counted.get["n"] if shown else 0
        for row in shown:
            print("\t".join("NULL" if value is None else str(value) for value in row))
        if total is not None and total > rows:
            print(f"{total - rows} more rows")
