"""Clean projection: raw feature rows to typed event rows."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone
from typing import Literal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremorline.functions import (
    area_of,
    as_bigint,
    as_double,
    local_second,
    local_subsecond,
    utc_second,
)
from tremorline.operators.flatten import (
    DAMAGED,
    PLACE,
    REJECTED,
    feature_counts,
    named_parts,
)
from tremorline.schema import (
    FLAT_GEOMETRY,
    NESTED_GEOMETRY,
    PROPERTIES,
    flat_event_schema,
    nested_event_schema,
)

# Lists of parsed tokens, and the prefix of what ``clean_counted`` counts.
_DOUBLES, _BIGINTS, _TIMES, _EPOCHS = "_doubles", "_bigints", "_times", "_epochs"
_COORDINATES, _LOST = "_coordinates", "_lost_"

# The whole-number columns of the string shape.
_TEXT_NUMBERS = ("tsunami", "sig")


@dataclass(frozen=True)
class CleanOptions:
    """The row shapes the clean step can produce. The defaults are the current table."""

    geometry: Literal["nested", "flat"] = "nested"
    time_mode: Literal["utc", "local", "local_subsecond"] = "utc"
    area_fallback: Literal["place", "null"] = "place"
    typing: Literal["typed", "string"] = "typed"
    zone: str | None = None

    def __post_init__(self) -> None:
        if self.time_mode != "utc" and self.zone is None:
            raise ValueError(f"time_mode={self.time_mode!r} needs a zone")
        if self.typing == "string" and self.geometry != "flat":
            raise ValueError("string typing has flat geometry only")

    def table_schema(self) -> T.StructType | None:
        """Schema to enforce at the table sink; None takes the rows' own schema."""
        if self.typing == "string":
            return None
        return nested_event_schema() if self.geometry == "nested" else flat_event_schema()

    def to_timestamp(self, ms: Column) -> Column:
        """The timestamp of an epoch that ``as_double`` has given."""
        if self.time_mode == "utc":
            return utc_second(ms, parsed=True)
        if self.time_mode == "local":
            return local_second(ms, self.zone, parsed=True)
        return local_subsecond(ms, self.zone, parsed=True)

    def means_unknown(self, ms: Column) -> Column:
        """True for an epoch that stands for no time at all."""
        if self.time_mode == "utc":
            return ms <= 0
        return ms == 0 if self.time_mode == "local_subsecond" else F.lit(False)


def nested_events() -> CleanOptions:
    """Current shape: geometry record, UTC seconds."""
    return CleanOptions()


def flat_events() -> CleanOptions:
    """As the current shape, with three coordinate columns."""
    return CleanOptions(geometry="flat")


def string_events(zone: str) -> CleanOptions:
    """Properties as text, local seconds, no area without separator."""
    return CleanOptions("flat", "local", "null", "string", zone)


def subsecond_events(zone: str) -> CleanOptions:
    """Flat and typed, local time with its fraction, no area without separator."""
    return CleanOptions("flat", "local_subsecond", "null", "typed", zone)


def clean(features: DataFrame, options: CleanOptions = CleanOptions()) -> DataFrame:
    """Project exploded features to event rows, without ``insert_date``."""
    return _with_numbers(features, options).select(*_values(options).values())


def clean_counted(
    rows: DataFrame, options: CleanOptions = CleanOptions(), keep: tuple[str, ...] = ()
) -> tuple[DataFrame, list[Column]]:
    """The event rows of ``feature_rows`` still among its other rows, and aggregates that
    count these and, by column, the values that were lost: a token is there, and the
    column is NULL though the token does not stand for a missing value.

    ``event_rows`` leaves the events over. What lies between can be observed, so that
    all is counted in the pass that writes the events.
    """
    lost = {}
    for kind, names in _numbers(options).items():
        for place, name in enumerate(names):
            missing = F.get(kind, F.lit(place)).isNull() & F.col(name).isNotNull()
            if kind == _TIMES:
                unknown = options.means_unknown(F.get(_EPOCHS, F.lit(place)))
                missing = missing & ~F.coalesce(unknown, F.lit(False))
            lost[name] = missing
    for place, name in enumerate(FLAT_GEOMETRY):
        token = F.get("coordinates", F.lit(place))
        lost[name] = F.get(_COORDINATES, F.lit(place)).isNull() & token.isNotNull()
    wide = _with_numbers(rows, options).select(
        *_values(options).values(), *keep, PLACE, REJECTED, DAMAGED, *[c.alias(_LOST + name) for name, c in lost.items()]
    )
    return wide, [*feature_counts(), *[F.count_if(F.col(_LOST + name)).alias(_LOST + name) for name in lost]]


def event_rows(wide: DataFrame) -> DataFrame:
    """The events of ``clean_counted``, without what was counted."""
    marks = [name for name in wide.columns if name.startswith(_LOST)]
    rows = wide.where(~F.col(DAMAGED) & F.col(PLACE).isNotNull())
    return rows.drop(PLACE, REJECTED, DAMAGED, *marks)


def losses(counts: dict[str, int]) -> dict[str, int]:
    """The lost values by column, of the counts that ``clean_counted`` defines."""
    return {k.removeprefix(_LOST): n for k, n in counts.items() if k.startswith(_LOST) and n}


def _numbers(options: CleanOptions) -> dict[str, list[str]]:
    """Which properties become numbers and times, by the list that holds them."""
    kinds = {_DOUBLES: "double", _BIGINTS: "bigint", _TIMES: "timestamp"}
    names = {kind: [name for name, ddl in PROPERTIES if ddl == of] for kind, of in kinds.items()}
    if options.typing == "string":
        names |= {_DOUBLES: [], _BIGINTS: [n for n in names[_BIGINTS] if n in _TEXT_NUMBERS]}
    return names


def _with_numbers(features: DataFrame, options: CleanOptions) -> DataFrame:
    """``features`` with lists of the parsed tokens of each kind.

    Casting each property by itself makes one method of all columns, larger than the 8,000
    bytes up to which Java compiles; interpreted, it takes half of the time of the whole step. A
    list has one cast for all its tokens. The projection of their own keeps Spark from
    parsing a token for each use.
    """
    names = _numbers(options)
    lists = {
        _DOUBLES: F.transform(F.array(*names[_DOUBLES]), as_double),
        _BIGINTS: F.transform(F.array(*names[_BIGINTS]), as_bigint),
        _EPOCHS: F.transform(F.array(*names[_TIMES]), as_double),
        _COORDINATES: F.transform("coordinates", as_double),
    }
    rows = features.withColumns({name: column for name, column in lists.items() if names.get(name, True)})
    return rows.withColumn(_TIMES, F.transform(_EPOCHS, options.to_timestamp))


def _values(options: CleanOptions) -> dict[str, Column]:
    """The columns of an event by the property they come from."""
    convert = _as_text if options.typing == "string" else lambda name, ddl: F.col(name)
    values = {name: convert(name, ddl) for name, ddl in PROPERTIES}
    for kind, names in _numbers(options).items():
        values |= {name: F.get(kind, F.lit(place)).alias(name) for place, name in enumerate(names)}
    values["area"] = area_of(F.col("place"), options.area_fallback).alias("area")
    return values | {f"geometry {i}": column for i, column in enumerate(_geometry(options))}


def insert_date(
    run_at: datetime | Column | None = None, options: CleanOptions = CleanOptions()
) -> Column:
    """The run's time as the table stores it; a naive ``run_at`` is UTC."""
    if run_at is None:
        now = F.current_timestamp()
    elif isinstance(run_at, Column):
        now = run_at
    else:
        now = F.timestamp_micros(F.lit(_epoch_micros(run_at)))
    if options.time_mode != "local_subsecond":
        now = F.date_trunc("second", now)
    if options.time_mode != "utc":
        now = F.from_utc_timestamp(now, options.zone)
    return now


def add_insert_date(
    events: DataFrame,
    run_at: datetime | Column | None = None,
    options: CleanOptions = CleanOptions(),
) -> DataFrame:
    """Add the run's time, one value for all rows."""
    return events.withColumn("insert_date", insert_date(run_at, options))


def _as_text(name: str, ddl: str) -> Column:
    # This shape writes a missing value as the text None, and calls the
    # magnitude "mng".
    return F.coalesce(F.col(name), F.lit("None")).alias("mng" if name == "mag" else name)


def _geometry(options: CleanOptions) -> list[Column]:
    if options.geometry == "nested":
        return [F.struct(*named_parts(F.col(_COORDINATES), NESTED_GEOMETRY)).alias("geometry")]
    longitude, latitude, depth = named_parts(F.col(_COORDINATES), FLAT_GEOMETRY)
    if options.typing == "string":
        return [longitude, latitude, depth]
    return [latitude, longitude, depth]


def _epoch_micros(moment: datetime) -> int:
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    since = moment - datetime(1970, 1, 1, tzinfo=timezone.utc)
    return (since.days * 86400 + since.seconds) * 1_000_000 + since.microseconds
