"""From landed documents to one row per feature."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremorline.functions import as_double
from tremorline.schema import FLAT_GEOMETRY, NESTED_GEOMETRY

# Marks of ``feature_rows``.
PLACE, REJECTED, DAMAGED = "_place", "_rejected", "_damaged"


def explode_features(documents: DataFrame) -> DataFrame:
    """One row per feature: its raw property tokens and its ``coordinates`` array.

    Documents without features, unreadable ones included, give no rows, and neither do
    features without properties; ``rejected`` has these.
    """
    rows = feature_rows(documents).where(~F.col(DAMAGED) & F.col(PLACE).isNotNull())
    return rows.drop(PLACE, REJECTED, DAMAGED)


def feature_rows(documents: DataFrame, *keep: str) -> DataFrame:
    """All features, damaged ones too, and a row without place for each document that has
    none: raw tokens, ``coordinates``, the columns ``keep`` of the document, and marks for
    counting."""
    # An outer generator: an inner one has the optimizer look at the list once more below.
    # The mark stands in a projection of its own; beside the generator it would make every
    # feature carry the whole list.
    documents = documents.withColumn(REJECTED, F.col("features").isNull())
    rows = documents.select(*keep, REJECTED, F.posexplode_outer("features").alias(PLACE, "feature"))
    damaged = F.col(PLACE).isNotNull() & F.col("feature.properties").isNull()
    return rows.select(
        "feature.properties.*", "feature.geometry.coordinates", *keep, PLACE, REJECTED, damaged.alias(DAMAGED)
    )


def feature_counts() -> list[Column]:
    """Aggregates over ``feature_rows``: documents, rejected ones, damaged features."""
    return [
        F.count_if(F.coalesce(F.col(PLACE), F.lit(0)) == 0).alias("documents"),
        F.count_if(F.col(REJECTED)).alias("rejected"),
        F.count_if(F.col(DAMAGED)).alias("damaged"),
    ]


def nested_geometry(coordinates: Column) -> Column:
    """Coordinates as one record; missing positions are NULL."""
    return F.struct(*named_parts(F.transform(coordinates, as_double), NESTED_GEOMETRY))


def flat_geometry(coordinates: Column) -> list[Column]:
    """Coordinates as three columns; missing positions are NULL."""
    return named_parts(F.transform(coordinates, as_double), FLAT_GEOMETRY)


def named_parts(numbers: Column, names: list[str]) -> list[Column]:
    """The first elements of a list as columns."""
    return [F.get(numbers, F.lit(place)).alias(name) for place, name in enumerate(names)]
