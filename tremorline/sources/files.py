"""What a folder holds. The only place that asks the file system itself: a read of a
missing path is logged as a failed query, and a table's read lists all its files."""

from __future__ import annotations

from pyspark.sql import SparkSession

# What a write leaves in its folder when all its files are in place.
DONE = "_SUCCESS"

# How layers of text and path tables are compressed. Readers of text know it by
# the files' names; a feed of named properties shrinks to an eighth.
TEXT_CODEC, TABLE_CODEC = "gzip", "zstd"


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of the entries of a folder, not of those below; none if it is not there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    return [entry.getPath().getName() for entry in files.listStatus(path)]


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Whole paths that a pattern matches, in order; one listing for each level with a
    wildcard."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = files.globStatus(path)
    return sorted(entry.getPath().toString() for entry in found) if found else []


def is_whole(spark: SparkSession, folder: str) -> bool:
    """True if the job that wrote a folder has ended."""
    return DONE in names_in(spark, folder)
