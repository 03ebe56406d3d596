"""Casts from raw JSON tokens that give NULL instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A character that no decimal number has, and the largest double. Casts alone
# would take Java's suffixes, hexadecimal forms and names of infinities too. Single characters,
# as Java looks these up in a table; ranges and classes among them take five times as long.
_FOREIGN = r"[^0123456789eE+. \t\n\x0B\f\r-]"
_LARGEST = 1.7976931348623157e308


def as_double(token: Column) -> Column:
    """NaN and infinities give NULL: they would win every comparison and spoil every mean."""
    number = token.try_cast("double")
    return F.when(~token.cast("string").rlike(_FOREIGN) & (F.abs(number) <= _LARGEST), number)


def as_bigint(token: Column) -> Column:
    """Whole-number tokens are taken exactly; ``3.0`` and ``1.7e12`` go through double."""
    return F.coalesce(token.try_cast("bigint"), as_double(token).try_cast("bigint"))
