"""Silver layer: clean rows as JSON lines, with explicit nulls, compressed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tremorline.sources.files import TEXT_CODEC

# How timestamps are written as text, without and with their fraction.
SECOND_FORMAT = "yyyy-MM-dd HH:mm:ss"
SUBSECOND_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def write_silver(
    events: DataFrame, path: str, timestamp_format: str = SECOND_FORMAT, mode: str = "errorifexists"
) -> None:
    writer = events.write.mode(mode).option("ignoreNullFields", "false").option("compression", TEXT_CODEC)
    writer.option("timestampFormat", timestamp_format).json(path)


def read_silver(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    timestamp_format: str = SECOND_FORMAT,
) -> DataFrame:
    rows = spark.read.schema(schema).option("timestampFormat", timestamp_format).json(path)
    # The batches of a stream lie in folders, whose number is not part of a row.
    return rows.select(schema.names)
