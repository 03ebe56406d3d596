"""The default clean step in plain Python, one feature at a time, for comparison."""

from __future__ import annotations

import json
from collections.abc import Iterator
from datetime import datetime, timedelta

from tremorline.schema import PROPERTIES

EPOCH = datetime(1970, 1, 1)


def second(ms):
    return EPOCH + timedelta(seconds=ms // 1000) if ms is not None and ms > 0 else None


def area(place):
    if place is None:
        return None
    _, found, after = place.partition(" of ")
    return after.strip() if found else place


def clean_rows(lines) -> Iterator[tuple]:
    """Rows of well-formed documents: the 26 properties, area, and the coordinates."""
    for line in lines:
        for feature in json.loads(line)["features"]:
            values = feature["properties"]
            row = [
                second(values[name]) if ddl == "timestamp" else values[name]
                for name, ddl in PROPERTIES
            ]
            yield (*row, area(values["place"]), *feature["geometry"]["coordinates"])
