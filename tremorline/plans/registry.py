"""Every query and operator by name, over a feed derived from a folder of tables.

Queries about the table read the table that one ingestion run has filled. Timestamps
and dates are given as text, so that results compare the same in every client.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone
from functools import wraps

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tremorline import operators as ops
from tremorline.functions import (
    area_of,
    as_bigint,
    as_double,
    local_second,
    local_subsecond,
    utc_second,
)
from tremorline.plans.analysis import QUESTIONS, write_answers
from tremorline.plans.ingestion import ingest
from tremorline.schema import PROPERTIES, flat_event_schema, nested_event_schema
from tremorline.sources import (
    Run,
    append_shape,
    append_table,
    conform_losses,
    latest_day,
    read_cells,
    read_landing,
    read_shapes,
    read_silver,
    read_table,
    rejected,
    write_landing,
)
from tremorline.sources.derived_feed import (
    feed_rows,
    loosely_typed,
    oddly_spelled,
    to_documents,
    to_features,
)
from tremorline.sources.files import TABLE_CODEC
from tremorline.sources.landing import FILE, parse_lines
from tremorline.sources.paths import scratch_dir
from tremorline.streaming import ingest_new_documents

RUN_AT = datetime(2024, 10, 25, 7, 55, 30, tzinfo=timezone.utc)
ZONE = "America/Los_Angeles"

# Means are compared to this many decimals: engines add in different orders, and with
# fewer decimals some means of the feed lie exactly between two roundings.
DECIMALS = 9

# Documents of the feed in a landed file, about 15 MB of text before it is compressed.
PER_FILE = 50

Query = Callable[[SparkSession, str], DataFrame]

# --- inputs, made once per application and folder ---------------------------------

_made: dict[tuple[str, ...], str] = {}


def _once(spark: SparkSession, sf_dir: str, what: str, make: Callable[[str], None]) -> str:
    key = (spark.conf.get("spark.app.id"), sf_dir, what)
    if key not in _made:
        path = scratch_dir(spark, what)
        make(path)
        _made[key] = path
    return _made[key]


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return to_documents(to_features(feed_rows(spark, sf_dir)))


def _run(spark: SparkSession, sf_dir: str) -> Run:
    """A run over the derived feed, with both sinks written."""

    def make(root: str) -> None:
        lines = _documents(spark, sf_dir)
        ingest(spark, Run(root, RUN_AT), f"{root}/table", lines=lines, per_file=PER_FILE)

    return Run(_once(spark, sf_dir, "run", make), RUN_AT)


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.explode_features(read_landing(spark, _run(spark, sf_dir).landing))


def _table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, f"{_run(spark, sf_dir).root}/table", nested_event_schema())


def _loose_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    def make(path: str) -> None:
        rows = loosely_typed(feed_rows(spark, sf_dir))
        write_landing(to_documents(to_features(rows)), path, per_file=PER_FILE)

    return ops.explode_features(read_landing(spark, _once(spark, sf_dir, "loose", make)))


def _by_day_path(spark: SparkSession, sf_dir: str) -> str:
    def make(path: str) -> None:
        append_table(_table(spark, sf_dir), path, nested_event_schema(), by_day=True)

    return _once(spark, sf_dir, "by-day", make)


def _table_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, _by_day_path(spark, sf_dir), nested_event_schema())


# --- columns as they are compared --------------------------------------------------


def _second(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)


def _milli(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss.SSS").alias(name)


def _plain(events: DataFrame) -> DataFrame:
    """Records as their parts, timestamps as text."""
    columns = []
    for field in events.schema:
        kind = field.dataType.typeName()
        if kind == "timestamp":
            columns.append(_second(field.name))
        elif kind == "struct":
            columns += [F.col(f"{field.name}.{part}").alias(part) for part in field.dataType.names]
        else:
            columns.append(F.col(field.name))
    return events.select(columns)


def _daily(answer: DataFrame) -> DataFrame:
    return answer.withColumn("day", F.col("day").cast("string"))


# --- sources and sinks -------------------------------------------------------------


def landing_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run-stamped landing folder, read back by glob, parsed and exploded."""
    landing = _run(spark, sf_dir).root + "/landing/*/part-*"
    features = ops.explode_features(read_landing(spark, landing))
    return features.groupBy("net", "status", "types").agg(
        F.count(F.lit(1)).alias("n"), F.count("place").alias("n_place")
    )


def silver_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = ops.clean(_features(spark, sf_dir)).schema
    return _plain(read_silver(spark, _run(spark, sf_dir).silver, schema))


def append_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = scratch_dir(spark, "append")
    events = _table(spark, sf_dir)
    append_table(events, target, nested_event_schema())
    append_table(events, target, nested_event_schema())
    return ops.count_by_region(read_table(spark, target, nested_event_schema()))


def _loosely_typed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows for a table with a schema: numbers and times as text, in another order, some
    unreadable, and no coordinates."""
    broken = F.col("code").try_cast("bigint")
    times = {n: F.date_format(utc_second(F.col(n)), "yyyy-MM-dd HH:mm:ss") for n in ("time", "updated")}
    spoilt = {"mag": 13, "sig": 17, "time": 19}
    features = _features(spark, sf_dir).withColumns(times)
    features = features.withColumns(
        {n: F.when(broken % every == 0, "unread").otherwise(F.col(n)) for n, every in spoilt.items()}
    )
    return features.select(*[name for name, _ in reversed(PROPERTIES)])


def typed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schema enforcement: every row as the table has it, and the table's schema."""
    target = scratch_dir(spark, "typed")
    append_table(_loosely_typed_rows(spark, sf_dir), target, flat_event_schema())
    table = read_table(spark, target)
    return _plain(table).withColumn("schema", F.lit(table.schema.simpleString()))


def typed_table_losses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The values that schema enforcement could not keep, by column, counted in the pass
    that appends the rows."""
    rows, schema, observation = _loosely_typed_rows(spark, sf_dir), flat_event_schema(), Observation()
    counted = rows.observe(observation, *conform_losses(rows, schema))
    append_table(counted, scratch_dir(spark, "typed-losses"), schema)
    return spark.createDataFrame(sorted(observation.get.items()), "column string, lost bigint")


def autodetect_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Appends of two shapes with schemas of their own to one table, read as one: each of the
    31 columns in the narrowest type that holds both."""
    target = scratch_dir(spark, "autodetect")
    features = _features(spark, sf_dir)
    append_shape(ops.clean(features, ops.flat_events()), target)
    append_shape(ops.clean(features, ops.string_events(ZONE)), target)
    return _comparable(_plain(read_shapes(spark, target)))


def ingest_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run reports of a feed with odd tokens, failed fetches and damaged features."""

    root = scratch_dir(spark, "report")
    run = Run(root, RUN_AT)
    good = to_documents(to_features(oddly_spelled(feed_rows(spark, sf_dir))))
    write_landing(good, run.landing, per_file=PER_FILE)
    write_landing(_failed(spark, sf_dir).union(_damaged(spark, sf_dir)), run.landing, "append")
    report = ingest(spark, run, f"{root}/table")
    counts = {n: getattr(report, n) for n in ("documents", "rejected", "damaged")} | report.lost
    rows = [(name, n) for name, n in counts.items() if name != "documents"]
    return spark.createDataFrame(rows, "measure string, n bigint")


def resumed_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that was cut short in the middle of its table write, with some of its rows in place
    and no silver, and is called again: rows per region in either sink."""
    root = scratch_dir(spark, "resumed")
    run = Run(root, RUN_AT)
    write_landing(_documents(spark, sf_dir), run.landing, per_file=PER_FILE)
    landed = ops.explode_features(read_landing(spark, run.landing))
    events = ops.add_insert_date(ops.clean(landed), RUN_AT)
    half = events.where(F.col("code").try_cast("bigint") % 2 == 0)
    leaves_no_mark = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "false"}
    half.write.options(compression=TABLE_CODEC, **leaves_no_mark).parquet(f"{root}/table/run={run.stamp}")
    ingest(spark, run, f"{root}/table")
    silver = read_silver(spark, run.silver, events.drop("insert_date").schema)
    table = read_table(spark, f"{root}/table", nested_event_schema())
    return ops.count_by_region(silver).withColumn("sink", F.lit("silver")).unionByName(
        ops.count_by_region(table).withColumn("sink", F.lit("table"))
    )


def one_table_all_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of the three typed shapes in one table, read as one."""
    root = scratch_dir(spark, "all-shapes")
    lines = _documents(spark, sf_dir)
    shapes = [ops.nested_events(), ops.flat_events(), ops.subsecond_events(ZONE)]
    for second, options in enumerate(shapes):
        run = Run(root, RUN_AT.replace(second=second))
        ingest(spark, run, f"{root}/table", options, lines=lines, per_file=PER_FILE)
        lines = spark.read.text(run.landing)
    table = read_table(spark, f"{root}/table", merge_schema=True)
    return table.groupBy("code", "area").agg(
        F.count(F.lit(1)).alias("n"),
        F.max("geometry.depth").alias("nested_depth"),
        F.max("depth").alias("flat_depth"),
        F.date_format(F.min("time"), "yyyy-MM-dd HH:mm:ss.SSS").alias("first_time"),
    )


def latest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest version of each event in a table of two runs that overlap: the second brings
    every third event again, updated an hour later, with another magnitude."""

    def make(root: str) -> None:
        rows = feed_rows(spark, sf_dir)
        again = rows.where("event_id % 3 = 0").withColumns(
            {"updated": F.col("updated") + 3_600_000, "mag": F.col("mag") + 1}
        )
        for minute, part in enumerate((rows, again)):
            run = Run(root, RUN_AT.replace(minute=minute))
            ingest(spark, run, f"{root}/table", lines=to_documents(to_features(part)), per_file=PER_FILE)

    root = _once(spark, sf_dir, "overlap", make)
    table = read_table(spark, f"{root}/table", nested_event_schema())
    return _plain(ops.latest_events(table).drop("insert_date"))


def answers_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All answers in full, as they are written to files."""
    folder = scratch_dir(spark, "answers")
    run = _run(spark, sf_dir)
    write_answers(_table(spark, sf_dir), folder, cells=read_cells(spark, f"{run.root}/table"))
    out = None
    for name in QUESTIONS:
        answer = spark.read.parquet(f"{folder}/{name}")
        value = next((c for c in ("avg_mag", "avg_n", "max_mag", "mag") if c in answer.columns), None)
        rows = answer.select(
            F.lit(name).alias("question"),
            (F.col("day").cast("string") if "day" in answer.columns else F.lit(None).cast("string")).alias("day"),
            (F.col("area") if "area" in answer.columns else F.lit(None).cast("string")).alias("area"),
            (F.col("n") if "n" in answer.columns else F.lit(None).cast("bigint")).alias("n"),
            (F.round(value, DECIMALS) if value else F.lit(None).cast("double")).alias("value"),
        )
        out = rows if out is None else out.union(rows)
    return out


def mixed_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One table with appends of the nested and the flat shape, read as one."""
    target = scratch_dir(spark, "mixed-shapes")
    features = _features(spark, sf_dir)
    for options in (ops.nested_events(), ops.flat_events()):
        events = ops.add_insert_date(ops.clean(features, options), RUN_AT, options)
        append_table(events, target, options.table_schema())
    table = read_table(spark, target, merge_schema=True)
    return table.groupBy("area").agg(
        F.avg("mag").alias("avg_mag"),
        F.count(F.lit(1)).alias("n"),
        F.count("geometry").alias("n_nested"),
        F.count("depth").alias("n_flat"),
    ).withColumn("avg_mag", F.round("avg_mag", DECIMALS))


def table_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(_table(spark, sf_dir))


def two_sinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per region in either sink of the same run."""
    schema = ops.clean(_features(spark, sf_dir)).schema
    silver = read_silver(spark, _run(spark, sf_dir).silver, schema)
    both = [
        ops.count_by_region(events).withColumn("sink", F.lit(sink))
        for sink, events in (("silver", silver), ("table", _table(spark, sf_dir)))
    ]
    return both[0].unionByName(both[1])


def _failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that are no document, or more than one: failed fetches, objects without features,
    and documents with something after them, some of which end the list that a parser
    might put around the line."""
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    empty = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.to_json(F.struct("s_suppkey")))
    one = '{"features":[{"properties":{"code":"lost"}}]}'
    tails = ["] t", f"],[{one}", f",{one}", " t", ","]
    odd = F.get(F.array(*[F.lit(one + tail) for tail in tails]), (F.col("c_custkey") % len(tails)).cast("int"))
    return customers.select(F.lit("None")).union(customers.select(odd)).union(empty)


def _damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of one good feature each, and one that is none."""
    parts = spark.read.parquet(f"{sf_dir}/part.parquet")
    bad = ["null", '"x"', '{"properties":null}', '{"properties":"z"}', "[1]", "7"]
    good = F.concat(F.lit('{"properties":{"code":"p'), F.col("p_partkey").cast("string"), F.lit('"}}'))
    odd = F.get(F.array(*[F.lit(text) for text in bad]), (F.col("p_partkey") % len(bad)).cast("int"))
    return parts.select(F.concat(F.lit('{"features":['), odd, F.lit(","), good, F.lit("]}")))


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failed fetches, lines of more than one document, documents without features and damaged
    features among good ones: set aside, not fatal."""

    def make(path: str) -> None:
        write_landing(_documents(spark, sf_dir), path, per_file=PER_FILE)
        write_landing(_failed(spark, sf_dir).union(_damaged(spark, sf_dir)), path, "append")

    documents = read_landing(spark, _once(spark, sf_dir, "mixed", make))
    accepted = ops.explode_features(documents)
    return (
        rejected(documents)
        .select("reason", "line", "position")
        .unionByName(accepted.select(F.lit("accepted").alias("reason")), allowMissingColumns=True)
        .groupBy("reason", "line", "position")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs land, each followed by an incremental ingestion of what is new."""
    root = scratch_dir(spark, "incremental")
    rows = feed_rows(spark, sf_dir)
    reviewed = F.col("status") == "reviewed"
    for minute, part in enumerate((rows.where(reviewed), rows.where(~reviewed))):
        run = Run(root, RUN_AT.replace(minute=minute))
        write_landing(to_documents(to_features(part)), run.landing, per_file=PER_FILE)
        ingest_new_documents(spark, root, f"{root}/table", f"{root}/checkpoint")
    silver = read_silver(spark, f"{root}/silver/stream", nested_event_schema())
    counts = ops.count_by_region(read_table(spark, f"{root}/table"))
    return counts.withColumn("sink", F.lit("table")).unionByName(
        ops.count_by_region(silver).withColumn("sink", F.lit("silver"))
    )


# --- flattening, scalar functions, clean projections -------------------------------


def flatten_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    geometry = ops.nested_geometry(F.col("coordinates"))
    return _features(spark, sf_dir).select("code", geometry.alias("g")).select("code", "g.*")


def flatten_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _features(spark, sf_dir).select("code", *ops.flat_geometry(F.col("coordinates")))


def _lenient(features: DataFrame) -> DataFrame:
    return _plain(
        features.select(
            "code",
            as_double(F.col("mag")).alias("mag"),
            utc_second(F.col("time")).alias("time"),
            utc_second(F.col("updated")).alias("updated"),
            as_bigint(F.col("sig")).alias("sig"),
            as_bigint(F.col("nst")).alias("nst"),
        )
    )


def lenient_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lenient(_loose_features(spark, sf_dir))


def odd_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens with suffixes, in hexadecimal, not a number, infinite or too large give NULL."""

    def make(path: str) -> None:
        write_landing(to_documents(to_features(oddly_spelled(feed_rows(spark, sf_dir)))), path, per_file=PER_FILE)

    landed = _once(spark, sf_dir, "odd-numbers", make)
    return _lenient(ops.explode_features(read_landing(spark, landed)))


def _times(convert: Callable[[Column], Column], show: Callable[[str], Column]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        times = _features(spark, sf_dir).select(
            "code",
            convert(F.col("time")).alias("time"),
            convert(F.col("updated")).alias("updated"),
        )
        return times.select("code", show("time"), show("updated"))

    return query


def _areas(fallback: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        area = area_of(F.col("place"), fallback)
        return _features(spark, sf_dir).select("code", "place", area.alias("area"))

    return query


def clean_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(ops.clean(_features(spark, sf_dir), ops.nested_events()))


def clean_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(ops.clean(_features(spark, sf_dir), ops.flat_events()))


def _comparable(events: DataFrame) -> DataFrame:
    """Text that spells floats as numbers, as engines spell them unlike, and whether it is the
    text None in a column of its own."""
    floats = [n for n in ("mng", "cdi", "mmi", "dmin", "rms", "gap") if n in events.columns]
    return events.withColumns(
        {f"{name}_none": F.col(name) == "None" for name in floats}
        | {name: F.nullif(F.col(name), F.lit("None")).cast("double") for name in floats}
    )


def clean_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable(_plain(ops.clean(_features(spark, sf_dir), ops.string_events(ZONE))))


def insert_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = _features(spark, sf_dir).select("code")
    options = [ops.nested_events(), ops.string_events(ZONE), ops.subsecond_events(ZONE)]
    names = ["utc", "local", "local_subsecond"]
    moment = RUN_AT.replace(microsecond=250_000)
    stamped = codes.select(
        "code", *[ops.insert_date(moment, o).alias(name) for o, name in zip(options, names)]
    )
    return stamped.select("code", *[_milli(name) for name in names])


# --- questions ---------------------------------------------------------------------


def area_mag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.area_and_magnitude(_table(spark, sf_dir))


def count_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.count_by_region(_table(spark, sf_dir))


def mags_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.magnitudes_by_region(_table(spark, sf_dir))


def mags_by_region_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size and extremes of each region's values, from the grouped values."""
    grouped = ops.magnitudes_by_region(_table(spark, sf_dir))
    return grouped.groupBy("area").agg(
        F.sum(F.when(F.col("mag").isNotNull(), F.col("n"))).alias("n_mags"),
        F.min("mag").alias("min_mag"),
        F.max("mag").alias("max_mag"),
    )


def avg_mag_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = ops.average_magnitude_by_region(_table(spark, sf_dir))
    return means.withColumn("avg_mag", F.round("avg_mag", DECIMALS))


def count_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily(ops.count_by_day(_table(spark, sf_dir)))


def count_by_day_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As count_by_day, from a table laid out by day."""
    return _daily(ops.count_by_day(_table_by_day(spark, sf_dir)))


def count_by_day_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _daily(ops.count_by_day_and_region(_table(spark, sf_dir)))


def avg_daily_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    answer = ops.average_daily_count(_table(spark, sf_dir))
    return answer.withColumn("avg_n", F.round("avg_n", DECIMALS))


def avg_daily_count_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    answer = ops.average_daily_count_by_region(_table(spark, sf_dir))
    return answer.withColumn("avg_n", F.round("avg_n", DECIMALS))


def _from_cells(question: Query) -> Query:
    """A question about days from the cells of three runs: each half of the feed, and all of it
    once more in a run that lacks its cells, as if it had ended before writing them."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        def make(root: str) -> None:
            rows = feed_rows(spark, sf_dir)
            runs = [Run(root, RUN_AT.replace(minute=minute)) for minute in range(3)]
            for half, run in enumerate(runs[:2]):
                part = to_documents(to_features(rows.where(f"event_id % 2 = {half}")))
                ingest(spark, run, f"{root}/table", lines=part, per_file=PER_FILE)
            # The halves are landed; only rows that are in neither are made into documents again.
            landed = read_landing(spark, [run.landing for run in runs[:2]]).drop(FILE)
            others = rows.where("coalesce(event_id % 2, -1) NOT IN (0, 1)")
            whole = landed.union(parse_lines(to_documents(to_features(others))))
            events = ops.add_insert_date(ops.clean(ops.explode_features(whole)), RUN_AT)
            append_table(events, f"{root}/table", nested_event_schema(), run=runs[2].stamp)

        return question(read_cells(spark, f"{_once(spark, sf_dir, 'cells', make)}/table"))

    return query


def strongest_region_last_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.strongest_regions(_table(spark, sf_dir))


def strongest_region_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a table laid out by day, whose last day its folders tell."""
    table = _table_by_day(spark, sf_dir)
    return ops.strongest_regions(table, last_day=latest_day(spark, _by_day_path(spark, sf_dir)))


def strongest_region_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for a given date."""
    as_of = datetime(2024, 1, 20, tzinfo=timezone.utc)
    return ops.strongest_regions(_table_by_day(spark, sf_dir), as_of)


def regions_above_5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.regions_above(_table(spark, sf_dir))


def top_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.top_regions(_table(spark, sf_dir))


def _in_utc(query: Query) -> Query:
    """The query in a session set to UTC, as ingestion asks for."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return query(spark, sf_dir)

    return run


_QUERIES: dict[str, Query] = {
    "landing_source": landing_source,
    "quarantine": quarantine,
    "silver_roundtrip": silver_roundtrip,
    "append_twice": append_twice,
    "typed_table": typed_table,
    "typed_table_losses": typed_table_losses,
    "autodetect_append": autodetect_append,
    "ingest_report": ingest_report,
    "resumed_ingest": resumed_ingest,
    "one_table_all_shapes": one_table_all_shapes,
    "latest_events": latest_events,
    "answers_written": answers_written,
    "mixed_shapes": mixed_shapes,
    "table_source": table_source,
    "two_sinks": two_sinks,
    "incremental_ingest": incremental_ingest,
    "flatten_nested": flatten_nested,
    "flatten_flat": flatten_flat,
    "lenient_numbers": lenient_numbers,
    "odd_numbers": odd_numbers,
    "time_utc": _times(utc_second, _second),
    "time_local": _times(lambda ms: local_second(ms, ZONE), _second),
    "time_local_subsecond": _times(lambda ms: local_subsecond(ms, ZONE), _milli),
    "area_default": _areas("place"),
    "area_null": _areas("null"),
    "clean_nested": clean_nested,
    "clean_flat": clean_flat,
    "clean_string": clean_string,
    "insert_date": insert_date,
    "area_mag": area_mag,
    "count_by_region": count_by_region,
    "mags_by_region": mags_by_region,
    "mags_by_region_summary": mags_by_region_summary,
    "avg_mag_by_region": avg_mag_by_region,
    "count_by_day": count_by_day,
    "count_by_day_partitioned": count_by_day_partitioned,
    "count_by_day_region": count_by_day_region,
    "count_by_day_from_cells": _from_cells(lambda cells: _daily(ops.count_by_day(cells))),
    "count_by_day_region_from_cells": _from_cells(lambda c: _daily(ops.count_by_day_and_region(c))),
    "avg_daily_count_from_cells": _from_cells(
        lambda c: ops.average_daily_count(c).withColumn("avg_n", F.round("avg_n", DECIMALS))
    ),
    "avg_daily_count_by_region_from_cells": _from_cells(
        lambda c: ops.average_daily_count_by_region(c).withColumn("avg_n", F.round("avg_n", DECIMALS))
    ),
    "avg_daily_count": avg_daily_count,
    "avg_daily_count_by_region": avg_daily_count_by_region,
    "strongest_region_last_week": strongest_region_last_week,
    "strongest_region_partitioned": strongest_region_partitioned,
    "strongest_region_as_of": strongest_region_as_of,
    "regions_above_5": regions_above_5,
    "top_regions": top_regions,
}

QUERIES = {name: _in_utc(query) for name, query in _QUERIES.items()}
