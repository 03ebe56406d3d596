"""Schemas of the landed feed and of the clean event table."""

from __future__ import annotations

from pyspark.sql import types as T

# The feature properties that are kept, in table order, with the
# type each has in the clean event table.
PROPERTIES: list[tuple[str, str]] = [
    ("mag", "double"),
    ("place", "string"),
    ("time", "timestamp"),
    ("updated", "timestamp"),
    ("tz", "bigint"),
    ("url", "string"),
    ("detail", "string"),
    ("felt", "bigint"),
    ("cdi", "double"),
    ("mmi", "double"),
    ("alert", "string"),
    ("status", "string"),
    ("tsunami", "bigint"),
    ("sig", "bigint"),
    ("net", "string"),
    ("code", "string"),
    ("ids", "string"),
    ("sources", "string"),
    ("types", "string"),
    ("nst", "bigint"),
    ("dmin", "double"),
    ("rms", "double"),
    ("gap", "double"),
    ("magType", "string"),
    ("type", "string"),
    ("title", "string"),
]

# Field names of the nested geometry record, by coordinate
# position. "longtiude" is how existing tables spell it.
NESTED_GEOMETRY = ["longtiude", "latitude", "depth"]

# The same three coordinates as top-level columns, by position.
FLAT_GEOMETRY = ["longitude", "latitude", "depth"]

# Where the scan puts the text of a line it cannot read.
CORRUPT = "_corrupt_record"

# When a run's rows were inserted; an ordinary column.
INSERTED = "insert_date"

# Partition columns of the table: the stamp of each run, and each UTC day of ``time``.
RUN = "run"
DAY = "event_date"


def feed_schema() -> T.StructType:
    """Read schema of one landed document (one FeatureCollection per line).

    Every property and coordinate is read as its raw token. A typed read would
    give up the whole document for one odd token; here the document survives and
    the clean step decides, field by field, what the token means.
    """
    properties = T.StructType([T.StructField(name, T.StringType()) for name, _ in PROPERTIES])
    geometry = T.StructType([T.StructField("coordinates", T.ArrayType(T.StringType()))])
    feature = T.StructType(
        [T.StructField("properties", properties), T.StructField("geometry", geometry)]
    )
    return T.StructType(
        [
            T.StructField("features", T.ArrayType(feature)),
            T.StructField(CORRUPT, T.StringType()),
        ]
    )


def nested_event_schema() -> T.StructType:
    """The current table: 26 properties, area, geometry record, insert date."""
    geometry = T.StructType([T.StructField(name, T.DoubleType()) for name in NESTED_GEOMETRY])
    return (
        _property_schema()
        .add("area", T.StringType())
        .add("geometry", geometry)
        .add("insert_date", T.TimestampType())
    )


def flat_event_schema() -> T.StructType:
    """The older table: coordinates as three columns, latitude first."""
    schema = _property_schema().add("area", T.StringType())
    for name in ["latitude", "longitude", "depth"]:
        schema = schema.add(name, T.DoubleType())
    return schema.add("insert_date", T.TimestampType())


def _property_schema() -> T.StructType:
    return T.StructType([T.StructField(name, T.DataType.fromDDL(ddl)) for name, ddl in PROPERTIES])
