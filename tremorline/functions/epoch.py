"""Epoch milliseconds to timestamps.

Inputs are tokens or numbers. All results are NULL for NULL, unreadable, not-a-number
and out-of-range input. The local variants store the wall clock of ``zone``, so they
are meant for a session whose time zone is UTC. ``parsed`` says that the input is a double
that ``as_double`` has given, which need not be looked at as text again.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tremorline.functions.cast import as_double

# First and last millisecond of the years 1 to 9999.
FIRST_MS = -62135596800000.0
LAST_MS = 253402300799999.0


def _instant(ms: Column) -> Column:
    # Whole milliseconds stay integers, so no microsecond is lost in a double product.
    whole = F.floor(ms)
    micros = whole * 1000 + F.rint((ms - whole) * 1000).cast("bigint")
    # NaN sorts above every number, so the range test also turns it away.
    return F.when(ms.between(FIRST_MS, LAST_MS), F.timestamp_micros(micros))


def utc_second(ms: Column, *, parsed: bool = False) -> Column:
    """UTC second; zero and negative epochs mean "unknown" and give NULL."""
    ms = ms if parsed else as_double(ms)
    return F.when(ms > 0, F.date_trunc("second", _instant(ms)))


def local_second(ms: Column, zone: str, *, parsed: bool = False) -> Column:
    """Wall-clock second in ``zone``; zero and negative epochs are ordinary instants."""
    ms = ms if parsed else as_double(ms)
    return F.from_utc_timestamp(F.date_trunc("second", _instant(ms)), zone)


def local_subsecond(ms: Column, zone: str, *, parsed: bool = False) -> Column:
    """Wall clock in ``zone`` with its fraction; only zero means "unknown"."""
    ms = ms if parsed else as_double(ms)
    return F.when(ms != 0, F.from_utc_timestamp(_instant(ms), zone))
