"""What the operators of this subpackage share: tables, folds, scratch tables, positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tremorline.sources.paths import scratch_dir

WORD = r"[^\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(rows: DataFrame, label: str) -> DataFrame:
    """``rows`` as a table in the shared scratch folder: lineage ends there, and a lost
    executor costs no more than reading it again."""
    spark = rows.sparkSession
    path = scratch_dir(spark, label)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; -1 for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus, F.lit(-1))


def held_out(doc_id: str, modulus: int, held: int) -> Column:
    """True for the fold nothing is learned from. A row without an id is in that fold."""
    return remainder(doc_id, modulus).isin(held, -1)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, _UPPER, _UPPER.lower())


def word_list(text: Column) -> Column:
    """The words of a text; none for a null."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.coalesce(words, F.array().cast("array<string>"))


def running_start(rows: DataFrame, group: list[str], order: list[str], value: str) -> DataFrame:
    """``rows`` with ``start``: the sum of ``value`` over the rows before each in its group.

    Rows are dealt out by range, so a group that holds most rows is spread over many
    tasks; each part adds up its own rows and gets the sum of the parts before it.
    """
    ranged = rows.repartitionByRange(*group, *order).withColumn("_part", F.spark_partition_id())
    ranged = written(ranged, "ranged")
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = (
        ranged.groupBy("_part", *group)
        .agg(F.sum(value).alias("_sum"))
        .select("_part", *group, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    )
    inside = (
        Window.partitionBy("_part", *group)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        ranged.join(sums, ["_part", *group])
        .withColumn("start", F.col("_offset") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .drop("_part", "_offset")
    )
