"""Mixing sources to target weights along a time-varying curriculum.

Every source has a weight and a schedule: how its demand for words is spread over the
training time from 0 to 1, as a piecewise linear curve. A source's documents stand in
a fixed pseudo-random order, pass after pass; each takes a stretch of the source's
cumulative demand, and the inverse of the integrated schedule turns the beginning of
that stretch into the document's training position.

Whole documents are taken. A source's last pass takes the documents that end within
its target, and then further ones that fit into the gap that is left, in rounds, until
no document that it has not taken fits any more.

Defined cases: a null text has size 0; a null source is a source of its own, ordered
last; documents of size 0 are taken 0 times; repeated rows are separate documents; an
empty table gives an empty mix. Columns of the input other than ``doc_id``, ``text``
and ``source`` are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tremorline.llm.common import running_start, word_list, written

WEIGHTS = (5.0, 2.0, 1.0)
MAX_REPEATS = 3
#: Knots (time, relative demand) of the schedule of each weight: heavy sources come
#: more at the beginning, light ones more towards the end.
SCHEDULES = {
    5.0: ((0.0, 1.5), (1.0, 0.5)),
    2.0: ((0.0, 1.0), (1.0, 1.0)),
    1.0: ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)),
}


def position_of(share: Column, knots: tuple[tuple[float, float], ...]) -> Column:
    """The time by which a schedule has demanded ``share`` (0 to 1) of all it demands."""
    pieces = list(zip(knots, knots[1:]))
    areas = [(x1 - x0) * (y0 + y1) / 2 for (x0, y0), (x1, y1) in pieces]
    total = sum(areas)
    position = F.lit(1.0)
    done = total
    for ((x0, y0), (x1, y1)), area in reversed(list(zip(pieces, areas))):
        done -= area
        slope = (y1 - y0) / (x1 - x0)
        rest = F.greatest(share * total - done, F.lit(0.0))
        root = F.sqrt(F.greatest(F.lit(y0 * y0) + 2 * slope * rest, F.lit(0.0)))
        inside = F.least(x0 + 2 * rest / (y0 + root), F.lit(float(x1)))
        position = F.when(share * total < done + area, inside).otherwise(position)
    return position


def source_targets(sizes: DataFrame) -> DataFrame:
    """One row per source: source_size, weight and target, in words.

    The rounds of resharing are aggregates over the sources; each caps at least one more
    source, and a few rounds settle any ordinary set of weights.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # Spark compares strings by their UTF-8 bytes, which is the order of code points.
    keyed = written(sources.withColumn("one", F.lit(1)).withColumn("last", F.isnull("source")), "sources")
    keyed = keyed.withColumn("all", F.lit(0)).withColumn("key", F.coalesce("source", F.lit("")))
    placed = running_start(keyed, ["all"], ["last", "key"], "one")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("start") % len(WEIGHTS) + 1).cast("int"))
    placed = written(placed.select("source", "source_size", weight.alias("weight")), "weights")
    limit = MAX_REPEATS * F.col("source_size").cast("double")
    total = float(placed.agg(F.sum("source_size")).first()[0] or 0)
    level, seen = 0.0, -1
    while True:
        capped = (F.col("weight") * level >= limit) if seen >= 0 else F.lit(False)
        n, taken, weights = placed.agg(
            F.count_if(capped), F.sum(F.when(capped, limit)), F.sum(F.when(~capped, F.col("weight")))
        ).first()
        if n == seen or not weights:
            break
        seen, level = n, (total - (taken or 0.0)) / weights
    return placed.withColumn("target", F.least(F.col("weight") * level, limit))


def mix(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, passes, taken and
    positions (the training position of each time it is taken)."""
    size = F.size(word_list(F.col("text"))).cast("long")
    sizes = docs.select("doc_id", "source", size.alias("size"))
    # A fixed shuffle: the hash of the id decides, so that reruns agree.
    sizes = written(sizes.withColumn("turn", F.xxhash64("doc_id", F.lit("turn"))), "sizes")
    targets = written(source_targets(sizes), "targets")

    keyed = sizes.withColumn("key", F.coalesce(F.col("source"), F.lit(""))).withColumn(
        "last", F.isnull("source")
    )
    placed = running_start(keyed, ["last", "key"], ["turn", "doc_id", "size"], "size")
    # Sources are few next to documents, but nothing bounds their number: no hint here,
    # Spark broadcasts the table when its size allows.
    placed = placed.join(
        targets.select(
            F.coalesce("source", F.lit("")).alias("key"),
            F.isnull("source").alias("last"),
            "source_size", "target", "weight",
        ),
        ["key", "last"],
    )
    full = F.floor(F.col("target") / F.greatest("source_size", F.lit(1)))
    placed = placed.withColumn("full", F.least(full, F.lit(MAX_REPEATS)).cast("long"))
    placed = placed.withColumn("budget", F.col("target") - F.col("full") * F.col("source_size"))
    placed = _last_pass(placed)

    passes = F.when(
        F.col("size") > 0, F.col("full") + F.when(F.col("more"), 1).otherwise(0)
    ).otherwise(0)
    out = placed.withColumn("passes", passes.cast("int"))

    def position(k: Column) -> Column:
        begins = F.when(k < F.col("full"), F.col("start")).otherwise(F.col("last_start"))
        share = (k * F.col("source_size") + begins) / F.greatest("target", F.lit(1e-9))
        by_weight = [
            F.when(F.col("weight") == w, position_of(share, knots)) for w, knots in SCHEDULES.items()
        ]
        return F.coalesce(*by_weight)

    times = F.when(F.col("passes") > 0, F.sequence(F.lit(0), F.col("passes") - 1)).otherwise(
        F.array().cast("array<int>")
    )
    return out.select(
        "doc_id", "source", "size", "source_size", "target", "passes",
        (F.col("passes") * F.col("size")).alias("taken"),
        F.transform(times, position).alias("positions"),
    )


def _last_pass(placed: DataFrame) -> DataFrame:
    """``placed`` with more, whether a source's last pass takes the document, and
    last_start, where it stands in that pass.

    After the stretch of the fixed order that ends within the budget, each round takes,
    of the documents of at most half the gap, the stretch that fits; where there are none,
    the largest document that fits, among equals the last in the fixed order. A round
    halves the gap or leaves only documents of more than half of it, so the rounds are
    at most about twice the binary logarithm of the gap.
    """
    source = ["key", "last"]
    columns = [*placed.columns, "more", "last_start"]
    ends = F.col("start") + F.col("size")
    placed = placed.withColumn("more", (F.col("size") > 0) & (ends <= F.col("budget")))
    placed = written(placed.withColumn("last_start", F.col("start")), "placed")
    filled = F.coalesce(F.sum(F.when(F.col("more"), F.col("size"))), F.lit(0))
    gaps = placed.groupBy(source).agg(filled.alias("filled"), (F.first("budget") - filled).alias("gap"))
    gaps = written(gaps, "gaps")
    open_ = ~F.col("more") & (F.col("size") > 0)
    settled = placed.where(~open_)
    left = placed.where(open_).withColumnRenamed("start", "own_start")
    while True:
        fits = left.join(gaps, source).where(F.col("size") <= F.col("gap"))
        best = F.max(F.struct("size", "own_start")).alias("best")
        at = fits.groupBy(source).agg(
            F.first("filled").alias("filled"), F.first("gap").alias("gap"), F.min("size").alias("least"), best
        )
        at = written(at, "round")
        if at.isEmpty():
            break
        met = written(left.join(at, source, "left"), "met")
        fit = F.coalesce(F.col("size") <= F.col("gap"), F.lit(False))
        settled = settled.union(met.where(~fit).withColumnRenamed("own_start", "start").select(columns))
        small = F.col("size") * 2 <= F.col("gap")
        stretch = running_start(met.where(fit & small), source, ["turn", "doc_id", "size"], "size")
        stretch = stretch.withColumn("more", ends <= F.col("gap"))
        large = met.where(fit & ~small).withColumn("start", F.lit(0).cast("long"))
        alone = (F.col("least") * 2 > F.col("gap")) & (F.struct("size", "own_start") == F.col("best"))
        tried = written(stretch.unionByName(large.withColumn("more", alone)), "tried")
        gained = F.coalesce(F.sum(F.when(F.col("more"), F.col("size"))), F.lit(0))
        gaps = tried.groupBy(source).agg(
            (F.first("filled") + gained).alias("filled"), (F.first("gap") - gained).alias("gap")
        )
        gaps = written(gaps, "gaps")
        taken = tried.where("more").withColumn("last_start", F.col("filled") + F.col("start"))
        settled = settled.union(taken.drop("start").withColumnRenamed("own_start", "start").select(columns))
        left = tried.where(~F.col("more")).drop("filled", "gap", "least", "best", "start")
    return settled.union(left.withColumnRenamed("own_start", "start").select(columns))


def arrange(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The training sequence: each document as often as the mix takes it, with
    ``position`` (in place of a column of that name), sorted by range over all files."""
    size = F.size(word_list(F.col("text"))).cast("long")
    # Rows that share an id are paired one to one, by source and size.
    docs = docs.withColumn("_nth", F.row_number().over(_within_id(F.col("source"), size)))
    nth = F.row_number().over(_within_id(F.col("source"), F.col("size")))
    taken = mixed.select(F.col("doc_id").alias("_id"), nth.alias("_n"), F.col("positions").alias("_positions")).where(
        F.size("_positions") > 0
    )
    paired = docs.join(taken, docs["doc_id"].eqNullSafe(taken["_id"]) & (F.col("_nth") == F.col("_n")))
    return (
        paired.drop("_nth", "_id", "_n")
        .withColumn("position", F.explode("_positions"))
        .drop("_positions")
        .repartitionByRange("position", "doc_id")
        .sortWithinPartitions("position", "doc_id")
    )


def _within_id(source: Column, size: Column) -> WindowSpec:
    return Window.partitionBy("doc_id").orderBy(source, size)
