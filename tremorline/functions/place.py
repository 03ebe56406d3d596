"""Region name out of the free-text place description."""

from __future__ import annotations

from typing import Literal

from pyspark.sql import Column
from pyspark.sql import functions as F

# The text that separates distance and region in a place.
SEPARATOR = " of "

# All characters that count as blank at either end of a region name.
BLANKS = (
    "\x09\x0a\x0b\x0c\x0d\x1c\x1d\x1e"
    "\x1f\x20\x85\xa0\u1680\u2000\u2001\u2002"
    "\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    """Remove blanks, Unicode ones included, from both ends."""
    return F.btrim(text, F.lit(BLANKS))


def area_of(place: Column, fallback: Literal["place", "null"] = "place") -> Column:
    """Stripped text after the first separator.

    A place without separator is returned as it is (not stripped), or gives NULL
    with ``fallback="null"``. A NULL place gives NULL.
    """
    found = F.nullif(F.instr(place, SEPARATOR), F.lit(0))
    after = strip(F.substr(place, found + len(SEPARATOR)))
    return F.coalesce(after, place) if fallback == "place" else after
