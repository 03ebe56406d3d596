"""The registered queries as SQL over the tables, for DuckDB.

The SQL starts from the feed's rows, not from documents: landing keeps every value.
"""

from __future__ import annotations

from tremorline.schema import PROPERTIES
from tremorline.sources.derived_feed import FEED_SQL

ZONE = "America/Los_Angeles"

_FEED = FEED_SQL.format(
    s="VARCHAR", ms="(epoch_us(ts) // 1000)", events="events", nation="nation", region="region"
)


def _utc(name: str) -> str:
    return f"CASE WHEN {name} > 0 THEN date_trunc('second', make_timestamp({name} * 1000)) END"


def _local(name: str) -> str:
    # Epochs before 1970 need the floor, which date_trunc takes.
    utc = f"date_trunc('second', make_timestamp({name} * 1000))"
    return f"timezone('{ZONE}', timezone('UTC', {utc}))"


def _local_subsecond(name: str) -> str:
    utc = f"make_timestamp({name} * 1000)"
    return f"CASE WHEN {name} <> 0 THEN timezone('{ZONE}', timezone('UTC', {utc})) END"


def _second(value: str) -> str:
    return f"strftime({value}, '%Y-%m-%d %H:%M:%S')"


def _milli(value: str) -> str:
    return f"strftime({value}, '%Y-%m-%d %H:%M:%S.%g')"


_AFTER = "trim(substr(place, strpos(place, ' of ') + 4))"
_AREA = f"CASE WHEN strpos(place, ' of ') > 0 THEN {_AFTER} ELSE place END"
_AREA_OR_NULL = f"CASE WHEN strpos(place, ' of ') > 0 THEN {_AFTER} END"

_KEPT = [name for name, _ in PROPERTIES]
_TYPED = ", ".join(
    f"{_utc(name)} AS {name}" if ddl == "timestamp" else name for name, ddl in PROPERTIES
)
_SHOWN = ", ".join(
    f"{_second(name)} AS {name}" if ddl == "timestamp" else name for name, ddl in PROPERTIES
)

_WITH = f"""WITH feed AS ({_FEED}),
q AS (SELECT {_TYPED}, {_AREA} AS area, longitude, latitude, depth FROM feed)
"""

_NESTED = f"SELECT {_SHOWN}, area, longitude AS longtiude, latitude, depth"

_TEXT = {
    "mag": "mag AS mng",
    "time": f"{_second(_local('time'))} AS time",
    "updated": f"{_second(_local('updated'))} AS updated",
    "tsunami": "tsunami",
    "sig": "sig",
}
_FLOAT_TEXT = ["cdi", "mmi", "dmin", "rms", "gap"]
_STRING = ", ".join(
    _TEXT.get(name)
    or (name if name in _FLOAT_TEXT else f"coalesce(CAST({name} AS VARCHAR), 'None') AS {name}")
    for name in _KEPT
)
_NONE = ", ".join(f"{name} IS NULL AS {name}_none" for name in _FLOAT_TEXT)

# Schema enforcement: what is unreadable by the event's number.
_SPOILT = {"mag": 13, "sig": 17, "time": 19}


def _spoilt(name: str, value: str) -> str:
    return f"CASE WHEN event_id % {_SPOILT[name]} = 0 THEN NULL ELSE {value} END" if name in _SPOILT else value


_ENFORCED = ", ".join(
    f"{_spoilt(name, _second(_utc(name)) if ddl == 'timestamp' else name)} AS {name}" for name, ddl in PROPERTIES
)
_ODD = {"mag": 11, "nst": 13, "updated": 17}


def _unless_odd(name: str, value: str) -> str:
    return f"CASE WHEN event_id % {_ODD[name]} = 0 THEN NULL ELSE {value} END" if name in _ODD else value


# The typed shape in a table that also has the string shape: whole numbers are text there.
_TEXT_KEPT = ("double", "string")
_FLAT_AMONG_TEXT = ", ".join(
    f"{_second(_utc(name))} AS {name}"
    if ddl == "timestamp"
    else name
    if ddl in _TEXT_KEPT or name in ("tsunami", "sig")
    else f"CAST({name} AS VARCHAR) AS {name}"
    for name, ddl in PROPERTIES
)
_NOT_NONE = ", ".join(f"CASE WHEN {name} IS NOT NULL THEN false END AS {name}_none" for name in _FLOAT_TEXT)

_COUNT = "SELECT area, count(*) AS n FROM q GROUP BY area"
_DAYS = "SELECT CAST(time AS DATE) AS day, count(*) AS n FROM q WHERE time IS NOT NULL GROUP BY 1"
_DAYS_AREAS = (
    "SELECT CAST(time AS DATE) AS day, area, count(*) AS n "
    "FROM q WHERE time IS NOT NULL GROUP BY 1, 2"
)
_TABLE_TYPES = ",".join(
    [f"{name}:{ddl}" for name, ddl in PROPERTIES]
    + ["area:string", "latitude:double", "longitude:double", "depth:double"]
    + ["insert_date:timestamp"]
)


def _strongest(start: str, end: str) -> str:
    return f"""
, w AS (SELECT area, mag FROM q WHERE area IS NOT NULL AND mag IS NOT NULL
        AND time > {start} AND time <= {end})
SELECT DISTINCT area, mag FROM w WHERE mag = (SELECT max(mag) FROM w)"""


# The second run's version of every third event, where that is the later one.
_AGAIN = "event_id % 3 = 0 AND updated IS NOT NULL"
_LATER = f"CASE WHEN {_AGAIN} THEN updated + 3600000 ELSE updated END"
_LATEST = [
    f"strftime(CASE WHEN {_LATER} > 0 THEN date_trunc('second', make_timestamp(({_LATER}) * 1000)) END, '%Y-%m-%d %H:%M:%S') AS updated"
    if name == "updated"
    else f"CASE WHEN event_id % 3 = 0 THEN mag + 1 ELSE mag END AS mag"
    if name == "mag"
    else f"{_second(_utc(name))} AS {name}"
    if ddl == "timestamp"
    else name
    for name, ddl in PROPERTIES
]

# Lines of more than one document, or with something after it.
_ONE = '{"features":[{"properties":{"code":"lost"}}]}'
_TAILS = ["] t", f"],[{_ONE}", f",{_ONE}", " t", ","]

_BODIES = {
    "landing_source": """SELECT net, status, types, count(*) AS n, count(place) AS n_place
FROM feed GROUP BY ALL""",
    "quarantine": f"""SELECT 'unreadable' AS reason, 'None' AS line, CAST(NULL AS BIGINT) AS position, count(*) AS n FROM customer
UNION ALL SELECT 'unreadable', '{_ONE}' || [{", ".join(f"'{t}'" for t in _TAILS)}][1 + c_custkey % 5], NULL, count(*)
  FROM customer GROUP BY ALL
UNION ALL SELECT 'no features', NULL, NULL, count(*) FROM supplier
UNION ALL SELECT 'damaged feature', NULL, 0, count(*) FROM part
UNION ALL SELECT 'accepted', NULL, NULL, (SELECT count(*) FROM feed) + (SELECT count(*) FROM part)""",
    "ingest_report": f"""SELECT 'rejected' AS measure,
  (SELECT 2 * count(*) FROM customer) + (SELECT count(*) FROM supplier) AS n
UNION ALL SELECT 'damaged', count(*) FROM part
UNION ALL SELECT 'mag', count(*) FROM feed WHERE event_id % 11 = 0
UNION ALL SELECT 'nst', count(*) FROM feed WHERE event_id % 13 = 0
UNION ALL SELECT 'updated', count(*) FROM feed WHERE event_id % 17 = 0""",
    "resumed_ingest": """SELECT area, count(*) AS n, sink
FROM (SELECT area, 'silver' AS sink FROM q UNION ALL SELECT area, 'table' FROM q) u
GROUP BY area, sink""",
    "one_table_all_shapes": f"""SELECT code, area, count(*) AS n, max(nested_depth) AS nested_depth,
  max(flat_depth) AS flat_depth, {_milli("min(time)")} AS first_time FROM (
  SELECT code, {_AREA} AS area, {_utc("time")} AS time, depth AS nested_depth, NULL AS flat_depth FROM feed
  UNION ALL SELECT code, {_AREA}, {_utc("time")}, NULL, depth FROM feed
  UNION ALL SELECT code, {_AREA_OR_NULL}, {_local_subsecond("time")}, NULL, depth FROM feed) u
GROUP BY code, area""",
    "latest_events": f"""SELECT {", ".join(_LATEST)}, area, longitude AS longtiude, latitude, depth
FROM (SELECT *, {_AREA} AS area FROM feed) f""",
    "answers_written": f"""
, days AS ({_DAYS}), days_areas AS ({_DAYS_AREAS}), top AS (
  SELECT area, count(*) AS n, max(mag) AS value FROM q WHERE area IS NOT NULL GROUP BY area
  ORDER BY n DESC, value DESC NULLS LAST, area LIMIT 10
), w AS (SELECT area, mag FROM q WHERE area IS NOT NULL AND mag IS NOT NULL
  AND time > (SELECT max(time) FROM q) - INTERVAL 7 DAY)
SELECT 'count_by_region' AS question, CAST(NULL AS VARCHAR) AS day, area, count(*) AS n, CAST(NULL AS DOUBLE) AS value
  FROM q GROUP BY area
UNION ALL SELECT 'avg_mag_by_region', NULL, area, NULL, round(avg(mag), 9) FROM q GROUP BY area
UNION ALL SELECT 'count_by_day', CAST(day AS VARCHAR), NULL, n, NULL FROM days
UNION ALL SELECT 'count_by_day_region', CAST(day AS VARCHAR), area, n, NULL FROM days_areas
UNION ALL SELECT 'avg_daily_count', NULL, NULL, NULL, round(avg(n), 9) FROM days
UNION ALL SELECT 'avg_daily_count_by_region', NULL, area, NULL, round(avg(n), 9) FROM days_areas GROUP BY area
UNION ALL (SELECT DISTINCT 'strongest_region_last_week', NULL, area, NULL, round(mag, 9) FROM w
  WHERE mag = (SELECT max(mag) FROM w))
UNION ALL SELECT 'regions_above_5', NULL, area, count(*), round(max(mag), 9) FROM q
  WHERE mag > 5 AND area IS NOT NULL GROUP BY area
UNION ALL SELECT 'top_regions', NULL, area, n, round(value, 9) FROM top""",
    "silver_roundtrip": f"{_NESTED} FROM q",
    "append_twice": "SELECT area, 2 * count(*) AS n FROM q GROUP BY area",
    "typed_table": f"""SELECT {_ENFORCED}, CAST(NULL AS VARCHAR) AS area, CAST(NULL AS DOUBLE) AS latitude,
CAST(NULL AS DOUBLE) AS longitude, CAST(NULL AS DOUBLE) AS depth, CAST(NULL AS VARCHAR) AS insert_date,
'struct<{_TABLE_TYPES}>' AS schema FROM feed""",
    "typed_table_losses": " UNION ALL ".join(
        f"SELECT '{name}' AS column, count(*) FILTER (event_id % {_SPOILT[name]} = 0) AS lost FROM feed"
        if name in _SPOILT
        else f"SELECT '{name}', 0"
        for name, _ in sorted(PROPERTIES, key=lambda p: p[0] not in _SPOILT)
    ),
    "autodetect_append": f"""SELECT {_FLAT_AMONG_TEXT}, {_AREA} AS area, latitude, longitude, depth,
CAST(NULL AS DOUBLE) AS mng, CAST(NULL AS BOOLEAN) AS mng_none, {_NOT_NONE} FROM feed
UNION ALL BY NAME SELECT {_STRING}, {_NONE}, mag IS NULL AS mng_none, CAST(NULL AS DOUBLE) AS mag,
{_AREA_OR_NULL} AS area, latitude, longitude, depth FROM feed""",
    "mixed_shapes": """SELECT area, round(avg(mag), 9) AS avg_mag, 2 * count(*) AS n,
count(*) AS n_nested, count(*) AS n_flat FROM q GROUP BY area""",
    "table_source": f"{_NESTED}, '2024-10-25 07:55:30' AS insert_date FROM q",
    "two_sinks": """SELECT area, count(*) AS n, sink
FROM (SELECT area, 'silver' AS sink FROM q UNION ALL SELECT area, 'table' FROM q) u
GROUP BY area, sink""",
    "incremental_ingest": """SELECT area, count(*) AS n, sink
FROM (SELECT area, 'silver' AS sink FROM q UNION ALL SELECT area, 'table' FROM q) u
GROUP BY area, sink""",
    "flatten_nested": "SELECT code, longitude AS longtiude, latitude, depth FROM feed",
    "flatten_flat": "SELECT code, longitude, latitude, depth FROM feed",
    "lenient_numbers": f"""SELECT code, mag, {_second("time")} AS time,
{_second("updated")} AS updated, sig, nst FROM q""",
    "odd_numbers": f"""SELECT code, {_unless_odd("mag", "mag")} AS mag, {_second(_utc("time"))} AS time,
{_unless_odd("updated", _second(_utc("updated")))} AS updated, sig, {_unless_odd("nst", "nst")} AS nst FROM feed""",
    "time_utc": f"""SELECT code, {_second(_utc("time"))} AS time,
{_second(_utc("updated"))} AS updated FROM feed""",
    "time_local": f"""SELECT code, {_second(_local("time"))} AS time,
{_second(_local("updated"))} AS updated FROM feed""",
    "time_local_subsecond": f"""SELECT code, {_milli(_local_subsecond("time"))} AS time,
{_milli(_local_subsecond("updated"))} AS updated FROM feed""",
    "area_default": f"SELECT code, place, {_AREA} AS area FROM feed",
    "area_null": f"SELECT code, place, {_AREA_OR_NULL} AS area FROM feed",
    "clean_nested": f"{_NESTED} FROM q",
    "clean_flat": f"SELECT {_SHOWN}, area, latitude, longitude, depth FROM q",
    "clean_string": f"""SELECT {_STRING}, {_NONE}, mag IS NULL AS mng_none, {_AREA_OR_NULL} AS area,
longitude, latitude, depth FROM feed""",
    "insert_date": """SELECT code, '2024-10-25 07:55:30.000' AS utc,
'2024-10-25 00:55:30.000' AS local, '2024-10-25 00:55:30.250' AS local_subsecond FROM feed""",
    "area_mag": "SELECT area, mag FROM q",
    "count_by_region": _COUNT,
    "mags_by_region": "SELECT area, mag, count(*) AS n FROM q GROUP BY area, mag",
    "mags_by_region_summary": """SELECT area, nullif(count(mag), 0) AS n_mags,
min(mag) AS min_mag, max(mag) AS max_mag FROM q GROUP BY area""",
    "avg_mag_by_region": "SELECT area, round(avg(mag), 9) AS avg_mag FROM q GROUP BY area",
    "count_by_day": f"SELECT CAST(day AS VARCHAR) AS day, n FROM ({_DAYS}) d",
    "count_by_day_partitioned": f"SELECT CAST(day AS VARCHAR) AS day, n FROM ({_DAYS}) d",
    "count_by_day_region": f"SELECT CAST(day AS VARCHAR) AS day, area, n FROM ({_DAYS_AREAS}) d",
    "avg_daily_count": f"SELECT round(avg(n), 9) AS avg_n FROM ({_DAYS}) d",
    "avg_daily_count_by_region": f"""SELECT area, round(avg(n), 9) AS avg_n
FROM ({_DAYS_AREAS}) d GROUP BY area""",
    "count_by_day_from_cells": f"SELECT CAST(day AS VARCHAR) AS day, 2 * n AS n FROM ({_DAYS}) d",
    "count_by_day_region_from_cells": f"SELECT CAST(day AS VARCHAR) AS day, area, 2 * n AS n FROM ({_DAYS_AREAS}) d",
    "avg_daily_count_from_cells": f"SELECT round(avg(2 * n), 9) AS avg_n FROM ({_DAYS}) d",
    "avg_daily_count_by_region_from_cells": f"""SELECT area, round(avg(2 * n), 9) AS avg_n
FROM ({_DAYS_AREAS}) d GROUP BY area""",
    "strongest_region_last_week": _strongest(
        "(SELECT max(time) FROM q) - INTERVAL 7 DAY", "(SELECT max(time) FROM q)"
    ),
    "strongest_region_partitioned": _strongest(
        "(SELECT max(time) FROM q) - INTERVAL 7 DAY", "(SELECT max(time) FROM q)"
    ),
    "strongest_region_as_of": _strongest(
        "TIMESTAMP '2024-01-13 00:00:00'", "TIMESTAMP '2024-01-20 00:00:00'"
    ),
    "regions_above_5": """SELECT area, max(mag) AS max_mag, count(*) AS n
FROM q WHERE mag > 5 AND area IS NOT NULL GROUP BY area""",
    "top_regions": """SELECT area, count(*) AS n, max(mag) AS max_mag
FROM q WHERE area IS NOT NULL GROUP BY area
ORDER BY n DESC, max_mag DESC NULLS LAST, area LIMIT 10""",
}

ORACLE: dict[str, str] = {name: _WITH + body for name, body in _BODIES.items()}
