"""Bronze layer: landed documents, one whole FeatureCollection per line of text."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremorline.schema import CORRUPT, feed_schema
from tremorline.sources.files import TEXT_CODEC

FILE = "_file"

_OPTIONS = {"allowSingleQuotes": "false"}
_END = "_end"


def write_landing(
    lines: DataFrame, path: str, mode: str = "errorifexists", *, per_file: int | None = None
) -> None:
    """Land documents, given as a frame with one string column, as they are, compressed.

    A compressed file is read by one task; ``per_file`` bounds the documents in it where those
    that one task writes are too many for one that reads.
    """
    writer = lines.write.mode(mode).option("compression", TEXT_CODEC)
    if per_file is not None:
        writer = writer.option("maxRecordsPerFile", per_file)
    writer.text(path)


def read_landing(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Parse landed documents, once. ``path`` is a folder, file or glob.

    A line holds one document. A line with anything before or after it, such as a second
    document, or with a list around it is unreadable as a whole. The columns are
    ``features``, the text of an unreadable line, and the file.
    """
    return parse_lines(spark.read.text(path).select("value", _file()))


def stream_landing(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The same as a stream of new files; ``max_files`` bounds those of one micro-batch."""
    return parse_lines(stream_lines(spark, path, max_files))


def stream_lines(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """New lines with their file, not parsed."""
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(path).select("value", _file())


def parse_lines(lines: DataFrame) -> DataFrame:
    """Documents of lines (value, and other columns that are kept), as ``read_landing``
    gives them.

    A parser stops after the first value of its text, whatever follows. So the line is made the
    first element of a list whose second is a mark drawn for this read. A line that
    is one document leaves two elements, the second the mark; one that ends the list by
    itself never comes to the mark, and any other gives more elements or no list.

    The generators keep the optimizer from computing what is parsed once more in each
    filter and column above it.
    """
    mark = uuid.uuid4().hex
    document = feed_schema()["features"]
    element = T.StructType([document, T.StructField(_END, T.StringType())])
    text = F.concat(F.lit("["), "value", F.lit(f',{{"{_END}":"{mark}"}}]'))
    values = F.from_json(text, T.ArrayType(element), _OPTIONS)
    others = [name for name in lines.columns if name != "value"]
    lines = lines.where(F.trim("value") != "")
    parsed = lines.select("value", *others, F.explode_outer(F.array(F.struct(values.alias("of")))).alias("p"))

    first, last = F.get("p.of", F.lit(0)), F.get("p.of", F.lit(1))
    whole = (F.size("p.of") == 2) & F.coalesce(last[_END] == mark, F.lit(False)) & first.isNotNull()
    features = F.when(whole, F.coalesce(first["features"], _one_by_one(F.col("value"))))
    made = F.struct(features.alias("features"), F.when(~whole, F.col("value")).alias(CORRUPT))
    documents = parsed.select(*others, F.explode_outer(F.array(made)).alias("d"))
    return documents.select("d.features", f"d.{CORRUPT}", *others)


def _one_by_one(document: Column) -> Column:
    """The features of a document among which there is something other than an object or
    null, which makes the parser give up the list. Only such documents come here."""
    features = feed_schema()["features"]
    texts = F.from_json(document, T.StructType([T.StructField("features", T.ArrayType(T.StringType()))]), _OPTIONS)
    return F.transform(texts["features"], lambda text: F.from_json(text, features.dataType.elementType, _OPTIONS))


def _file() -> Column:
    return F.col("_metadata.file_path").alias(FILE)


def is_rejected() -> Column:
    """True for a document that holds no ``features``: unreadable, or another object.

    An empty ``features`` array is an ordinary document.
    """
    return F.col("features").isNull()


def rejected(documents: DataFrame) -> DataFrame:
    """What is set aside: documents without features, with their text if unreadable, and
    single features without properties, with their place in the document and what was read
    of them. Each with the file it came from.

    A damaged feature does not reject its document: the others go on.
    """
    damaged = F.exists("features", lambda feature: feature["properties"].isNull())
    # Sound documents need not be taken apart.
    documents = documents.withColumn("none", is_rejected()).where(F.col("none") | damaged)
    rows = documents.select(FILE, CORRUPT, "none", F.posexplode_outer("features").alias("position", "feature"))
    reason = (
        F.when(F.col(CORRUPT).isNotNull(), "unreadable")
        .when(F.col("none"), "no features")
        .when(F.col("position").isNotNull() & F.col("feature.properties").isNull(), "damaged feature")
    )
    return rows.select(
        reason.alias("reason"),
        F.col(FILE).alias("file"),
        F.col(CORRUPT).alias("line"),
        F.col("position").cast("long").alias("position"),
        F.to_json("feature").alias("feature"),
    ).where("reason is not null")
