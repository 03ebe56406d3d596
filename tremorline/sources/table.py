"""Warehouse table: an appendable table, by path or by catalog name."""

from __future__ import annotations

import hashlib
import json
from datetime import date

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tremorline.schema import DAY, RUN
from tremorline.sources.files import DONE, TABLE_CODEC, is_whole, matching, names_in


def conform(events: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows with exactly the columns and types of ``schema``.

    A value that does not fit its type and a column that the rows lack give NULL; a
    column that the schema lacks is an error, since writing would lose it.
    """
    unknown = [name for name in events.columns if name not in schema.names]
    if unknown:
        raise ValueError(f"columns not in the table schema: {', '.join(unknown)}")
    return events.select([_conformed(events, field) for field in schema])


def conform_losses(events: DataFrame, schema: T.StructType) -> list[Column]:
    """Aggregates that count, by column, values that ``conform`` turns into NULL. Observed over
    the rows that are conformed, they cost no pass of their own."""
    return [
        F.count_if(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()).alias(f.name)
        for f in schema
        if f.name in events.columns
    ]


def append_table(
    events: DataFrame,
    target: str,
    schema: T.StructType | None = None,
    *,
    catalog: bool = False,
    format: str = "parquet",
    run: str | None = None,
    by_day: bool = False,
) -> None:
    """Append rows, creating the table if it is not there.

    ``target`` is a path, or a table name with ``catalog=True``. Without ``schema`` the
    rows keep their own. All appends to a table must use the same layout and the same
    type for a column of one name; others are refused before anything is written:

    - ``run`` keeps the rows of the run with that stamp in a folder of their own, which is
      a data set with a mark of its own. Until the mark is there the run does not count:
      ``read_table`` and ``read_run`` leave it out, and another append with the
      stamp replaces it. A run that is there is refused.
    - ``by_day`` lays rows out by UTC day, so that day questions and time ranges skip
      other days' files. Days are gathered before the write, big ones split, to get
      few files of even size; that is one shuffle of the appended rows.
    """
    spark = events.sparkSession
    if run is not None and has_run(spark, target, run, catalog=catalog):
        raise ValueError(f"{target} already holds run {run}; drop its partition to repeat it")
    if schema is not None:
        events = conform(events, schema)
    if by_day:
        events = events.withColumn(DAY, F.to_date("time")).hint("rebalance", DAY)
    partitions = [name for name, wanted in ((RUN, run is not None), (DAY, by_day)) if wanted]
    _refuse_a_mix(events, target, partitions, catalog=catalog, format=format)
    if catalog:
        _append_to_catalog(events, target, format, run, partitions)
    elif run is not None:
        writer = _path_writer(events, "overwrite", format)
        (writer.partitionBy(DAY) if by_day else writer).save(_run_folder(target, run))
    else:
        writer = _path_writer(events, "append", format)
        (writer.partitionBy(DAY) if by_day else writer).save(target)


def _path_writer(events: DataFrame, mode: str, format: str = "parquet") -> DataFrameWriter:
    writer = events.write.mode(mode).format(format)
    return writer.option("compression", TABLE_CODEC) if format == "parquet" else writer


def _append_to_catalog(
    events: DataFrame, target: str, format: str, run: str | None, partitions: list[str]
) -> None:
    """A catalog's table has no folders to mark, so its whole runs are listed in a small
    table beside it. What a run that is not listed has left is replaced."""
    spark = events.sparkSession
    if run is None:
        writer = events.write.mode("append").format(format)
        (writer.partitionBy(*partitions) if partitions else writer).saveAsTable(target)
        return
    if not spark.catalog.tableExists(target):
        empty = events.withColumn(RUN, F.lit(run)).where("false")
        empty.write.format(format).partitionBy(*partitions).saveAsTable(target)
    names = [name for name in spark.table(target).columns if name != RUN]
    stamp = run.replace("\\", "\\\\").replace("'", "\\'")
    spec = ", ".join([f"{RUN} = '{stamp}'", *partitions[1:]])
    spark.sql(
        f"INSERT OVERWRITE TABLE {target} PARTITION ({spec}) SELECT * FROM {{rows}}",
        rows=events.select(names),
    )
    listed = spark.createDataFrame([(run,)], f"{RUN} string").coalesce(1)
    listed.write.mode("append").format("parquet").saveAsTable(_run_list(target))


def whole_runs(spark: SparkSession, source: str, *, catalog: bool = False) -> list[str] | None:
    """Stamps of the runs whose writes have ended; None if the table keeps no runs apart."""
    if catalog:
        if not spark.catalog.tableExists(_run_list(source)):
            return None
        return sorted({row[0] for row in spark.table(_run_list(source)).collect()})
    if not any(name.startswith(f"{RUN}=") for name in names_in(spark, source)):
        return None
    found = matching(spark, f"{_run_folder(source, '*')}/{DONE}")
    return [path.split("/")[-2].partition("=")[2] for path in found]


def has_run(spark: SparkSession, source: str, run: str, *, catalog: bool = False) -> bool:
    if catalog:
        return run in (whole_runs(spark, source, catalog=True) or [])
    return is_whole(spark, _run_folder(source, run))


def _run_folder(target: str, run: str) -> str:
    return f"{target.rstrip('/')}/{RUN}={run}"


def _run_list(target: str) -> str:
    return f"{target}_{RUN}s"


def read_table(
    spark: SparkSession,
    source: str,
    schema: T.StructType | None = None,
    *,
    catalog: bool = False,
    format: str = "parquet",
    merge_schema: bool = False,
) -> DataFrame:
    """The whole table; of one that keeps runs apart, those that are whole.

    ``schema`` spares a path table the look into its files. ``merge_schema`` unites the
    columns of differing appends; it looks into every file.
    """
    runs = whole_runs(spark, source, catalog=catalog)
    if catalog:
        rows = spark.table(source)
        return (rows if runs is None else rows.where(F.col(RUN).isin(runs))).drop(RUN)
    reader = spark.read.format(format).option("mergeSchema", merge_schema)
    if schema is not None:
        reader = reader.schema(schema)
    if runs is None:
        return reader.load(source)
    if not runs:
        if schema is None:
            raise ValueError(f"{source} has no whole run")
        return spark.createDataFrame([], schema)
    folders = [_run_folder(source, run) for run in runs]
    return reader.option("basePath", source).load(folders).drop(RUN)


def read_run(
    spark: SparkSession,
    source: str,
    run: str,
    schema: T.StructType,
    *,
    catalog: bool = False,
    format: str = "parquet",
) -> DataFrame | None:
    """One run's rows of a table that keeps runs apart, or None if it is not there or not
    whole. Of a path table only the run's own folder is looked at."""
    if not has_run(spark, source, run, catalog=catalog):
        return None
    if catalog:
        return spark.table(source).where(F.col(RUN) == run).select(schema.names)
    folder = _run_folder(source, run)
    return spark.read.format(format).schema(schema).load(folder).select(schema.names)


def latest_day(
    spark: SparkSession, source: str, *, catalog: bool = False, format: str = "parquet"
) -> date | None:
    """The last day of a table laid out by day that has rows; None if it has none or is laid
    out otherwise. Known from the names of folders, latest first: no file is read but
    to see that the day's are not empty."""
    if catalog:
        if not spark.catalog.tableExists(source):
            return None
        described = spark.sql(f"DESCRIBE TABLE EXTENDED {source}").where("col_name = 'Location'")
        source = described.first()["data_type"]
    runs = whole_runs(spark, source)
    pattern = f"{DAY}=*" if runs is None else f"{RUN}=*/{DAY}=*"
    found: dict[str, list[str]] = {}
    for path in matching(spark, f"{source.rstrip('/')}/{pattern}"):
        run, day = (part.partition("=")[2] for part in path.split("/")[-2:])
        if runs is None or run in runs:
            found.setdefault(day, []).append(path)
    for day in sorted((d for d in found if not d.startswith("__")), reverse=True):
        if not spark.read.format(format).schema("time timestamp").load(found[day]).isEmpty():
            return date.fromisoformat(day)
    return None


def read_runs(
    spark: SparkSession, source: str, runs: list[str], schema: T.StructType, *, format: str = "parquet"
) -> DataFrame:
    """Rows of some runs of a path table, whole or not."""
    folders = [_run_folder(source, run) for run in runs]
    reader = spark.read.format(format).schema(schema).option("basePath", source)
    return reader.load(folders).select(schema.names)


def united(tables: list[DataFrame]) -> DataFrame:
    """Rows of tables of differing shapes as one: columns by name, absent ones NULL, and
    where the tables give one name different types the narrowest that holds all of them."""
    schema = merged_schema([rows.schema for rows in tables])
    out = None
    for rows in tables:
        have = {f.name: f.dataType for f in rows.schema}
        shaped = rows.select([
            _shaped(F.col(f"`{f.name}`") if f.name in have else None, have.get(f.name), f.dataType).alias(f.name)
            for f in schema
        ])
        out = shaped if out is None else out.union(shaped)
    return out


def _shaped(value: Column | None, kind: T.DataType | None, wanted: T.DataType) -> Column:
    """``value`` as the merged type: records by the names of their fields."""
    if value is None:
        return F.lit(None).cast(wanted)
    if isinstance(kind, T.StructType) and isinstance(wanted, T.StructType):
        have = {f.name: f.dataType for f in kind}
        fields = [
            _shaped(value[f.name] if f.name in have else None, have.get(f.name), f.dataType).alias(f.name)
            for f in wanted
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType) and isinstance(wanted, T.ArrayType):
        return F.transform(value, lambda x: _shaped(x, kind.elementType, wanted.elementType))
    if isinstance(kind, (T.StructType, T.ArrayType)):
        return F.to_json(value)
    return value.cast(wanted)


def merged_schema(schemas: list[T.StructType]) -> T.StructType:
    """All columns, in the order in which they first come, each with the narrowest type that
    holds all of its own: whole numbers, then doubles, then text; dates, then timestamps,
    then text; records field by field, lists by their elements; text for the rest."""
    kinds: dict[str, T.DataType] = {}
    for schema in schemas:
        for f in schema:
            kinds[f.name] = _wider(kinds[f.name], f.dataType) if f.name in kinds else f.dataType
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


# Chains of types of which each holds the values of those before it; text ends all of them.
_CHAINS = [
    [T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType(), T.DoubleType()],
    [T.FloatType(), T.DoubleType()],
    [T.DateType(), T.TimestampType()],
]


def _wider(a: T.DataType, b: T.DataType) -> T.DataType:
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return merged_schema([a, b])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(_wider(a.elementType, b.elementType))
    for chain in _CHAINS:
        if a in chain and b in chain:
            return chain[max(chain.index(a), chain.index(b))]
    if {a, b} <= {kind for chain in _CHAINS[:2] for kind in chain}:
        return T.DoubleType()
    return T.StringType()


def append_shape(events: DataFrame, target: str) -> None:
    """Append rows of any schema to a table that takes all of them. Rows of one schema lie
    in a folder of their own, and the schemas are kept beside the table."""
    spark = events.sparkSession
    shape = hashlib.sha256(events.schema.json().encode()).hexdigest()[:12]
    noted = f"{target.rstrip('/')}/_schemas/{shape}"
    if not is_whole(spark, noted):
        text = spark.createDataFrame([(events.schema.json(),)], "value string").coalesce(1)
        text.write.mode("overwrite").text(noted)
    _path_writer(events, "append").save(f"{target.rstrip('/')}/shape={shape}")


def read_shapes(spark: SparkSession, source: str) -> DataFrame:
    """The rows of all schemas in the merged one. No file of rows is looked into for it."""
    root = source.rstrip("/")
    tables = []
    for path in matching(spark, f"{root}/shape=*"):
        noted = f"{root}/_schemas/{path.rpartition('=')[2]}"
        schema = T.StructType.fromJson(json.loads(spark.read.text(noted, wholetext=True).first().value))
        tables.append(spark.read.schema(schema).parquet(path))
    if not tables:
        raise ValueError(f"{source} holds no rows")
    return united(tables)


def _refuse_a_mix(
    events: DataFrame, target: str, partitions: list[str], *, catalog: bool, format: str
) -> None:
    """Readers of a folder with files and partitions side by side would lose some of them,
    and a column of two types could not be read at all."""
    spark = events.sparkSession
    if catalog:
        if not spark.catalog.tableExists(target):
            return
        found = spark.table(target)
    else:
        names = [n for n in names_in(spark, target) if not n.startswith(("_", "."))]
        if not names:
            return
        top = {n.partition("=")[0] if "=" in n else "" for n in names}
        if top != {partitions[0] if partitions else ""}:
            raise ValueError(f"{target} is laid out by {sorted(top)}, not by {partitions}")
        runs = whole_runs(spark, target)
        if runs == []:
            return
        # Each run was compared with the one before it.
        found = spark.read.format(format).load(_run_folder(target, runs[-1]) if runs else target)
    kinds = dict(events.dtypes)
    for name, kind in found.dtypes:
        if name not in (RUN, DAY) and kinds.get(name, kind) != kind:
            raise ValueError(f"{target} has {name} as {kind}, not as {kinds[name]}")


def _conformed(events: DataFrame, field: T.StructField) -> Column:
    if field.name not in events.columns:
        return F.lit(None).cast(field.dataType).alias(field.name)
    return F.col(field.name).try_cast(field.dataType).alias(field.name)
