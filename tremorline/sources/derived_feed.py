"""A landed feed derived from the ``events``, ``nation`` and ``region`` tables.

One feature per event. The CASE branches below place missing, zero and negative
values among the rows; every event is kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tremorline.schema import FLAT_GEOMETRY, PROPERTIES

# {s} is the engine's text type, {ms} its floor of ts to epoch milliseconds.
FEED_SQL = """
SELECT event_id,
  CASE WHEN event_id % 89 = 0 THEN NULL ELSE value / 50 END AS mag,
  CASE WHEN event_id % 97 = 0 THEN NULL
       WHEN event_type = 'view' THEN n_name || ', ' || r_name
       WHEN event_type = 'error' THEN 'South of the ' || n_name || '  '
       ELSE CAST(event_id % 120 AS {s}) || ' km NNE of ' || n_name || ', ' || r_name END AS place,
  CASE WHEN event_id % 101 = 0 THEN 0 WHEN event_id % 103 = 0 THEN NULL ELSE {ms} END AS time,
  CASE WHEN event_id % 107 = 0 THEN -5000 ELSE {ms} + event_id END AS updated,
  CAST(NULL AS BIGINT) AS tz,
  'https://feed.example/e/' || CAST(event_id AS {s}) AS url,
  'https://feed.example/d/' || CAST(event_id AS {s}) AS detail,
  CASE WHEN event_id % 3 = 0 THEN event_id % 50 END AS felt,
  CASE WHEN event_id % 3 = 0 THEN CAST(event_id % 10 AS DOUBLE) / 2 END AS cdi,
  CASE WHEN event_id % 5 = 0 THEN value / 100 END AS mmi,
  CASE event_id % 4 WHEN 0 THEN 'green' WHEN 1 THEN 'yellow' END AS alert,
  CASE WHEN event_id % 2 = 0 THEN 'reviewed' ELSE 'automatic' END AS status,
  CAST(CASE WHEN event_id % 50 = 0 THEN 1 ELSE 0 END AS BIGINT) AS tsunami,
  user_id AS sig,
  substr(event_type, 1, 2) AS net,
  CAST(event_id AS {s}) AS code,
  ',' || substr(event_type, 1, 2) || CAST(event_id AS {s}) || ',' AS ids,
  ',' || substr(event_type, 1, 2) || ',' AS sources,
  ',origin,phase-data,' AS types,
  CASE WHEN event_id % 7 <> 0 THEN event_id % 60 END AS nst,
  value / 1000 AS dmin,
  value / 700 AS rms,
  CAST(event_id % 360 AS DOUBLE) AS gap,
  CASE WHEN event_id % 2 = 0 THEN 'ml' ELSE 'md' END AS magType,
  'earthquake' AS type,
  'M ' || coalesce(n_name, 'unknown') AS title,
  CAST(user_id AS DOUBLE) - 75 AS longitude,
  value / 10 AS latitude,
  CAST(event_id % 700 AS DOUBLE) AS depth
FROM {events}
JOIN {nation} ON user_id % 25 = n_nationkey
JOIN {region} ON n_regionkey = r_regionkey
"""


def feed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed as typed columns, before it is turned into documents."""
    tables = {
        name: spark.read.parquet(f"{sf_dir}/{name}.parquet")
        for name in ("events", "nation", "region")
    }
    sql = FEED_SQL.replace("{s}", "STRING")
    sql = sql.replace("{ms}", "unix_millis(CAST(ts AS TIMESTAMP))")
    return spark.sql(sql, **tables)


def loosely_typed(rows: DataFrame) -> DataFrame:
    """The same feed with numbers spelled as text or as floats, as lax sources do."""
    return rows.withColumns(
        {
            "mag": F.col("mag").cast("string"),
            "time": F.col("time").cast("string"),
            "updated": F.col("updated").cast("double"),
            "sig": F.col("sig").cast("double"),
            "nst": F.col("nst").cast("string"),
        }
    )


def oddly_spelled(rows: DataFrame) -> DataFrame:
    """The feed with some tokens that look like numbers to a cast and are none in JSON, and
    numbers beyond what a double holds, picked by the event's number."""
    odd = F.array(*[F.lit(token) for token in ODD_TOKENS])
    pick = F.get(odd, (F.col("event_id") % len(ODD_TOKENS)).cast("int"))

    def some(name: str, every: int) -> Column:
        return F.when(F.col("event_id") % every == 0, pick).otherwise(F.col(name).cast("string"))

    return rows.withColumns({"mag": some("mag", 11), "nst": some("nst", 13), "updated": some("updated", 17)})


# Tokens that no number is read from.
ODD_TOKENS = ["1d", "2.5F", "0x1p3", "NaN", "-Infinity", "inf", "1e400", "12,5", "--1", "1e", ""]


def to_features(rows: DataFrame) -> DataFrame:
    """One GeoJSON feature, as text, per row."""
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(*[name for name, _ in PROPERTIES]).alias("properties"),
        F.struct(
            F.lit("Point").alias("type"), F.array(*FLAT_GEOMETRY).alias("coordinates")
        ).alias("geometry"),
    )
    return rows.select(F.to_json(feature, {"ignoreNullFields": "false"}).alias("value"))


def to_documents(features: DataFrame, per_document: int = 500) -> DataFrame:
    """Pack features into documents of bounded size, within each partition.

    Without a grouping key there is no shuffle, and no document outgrows its bound
    however the features' keys are distributed.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).to_pylist()
            documents = [
                '{"type":"FeatureCollection","features":['
                + ",".join(texts[start : start + per_document])
                + "]}"
                for start in range(0, len(texts), per_document)
            ]
            yield pa.RecordBatch.from_pydict({"value": pa.array(documents, pa.string())})

    return features.mapInArrow(pack, "value string")
