"""Approximate nearest neighbours by collision counting over single projections.

Vectors are dealt into blocks of bounded size. For a block and each of ``PROJECTIONS``
random directions the index holds the vectors' projections as a sorted array. A query
opens a window around its own projection in every array; a vector that lies in the
windows of at least a share ``COLLISIONS`` of all arrays is a candidate. While a block has
fewer candidates than ``SHARE`` of its vectors (and than are asked for), all windows grow
by the factor ``GROWTH``: virtual rehashing, which only counts what the windows gain.
Candidates are verified on the original vectors, in double precision.

Largest inner products become smallest distances by one more coordinate that gives
all vectors the length of the longest one. The queries are a stated set that is searched
against all rows, block by block. A visit brings a share of the queries to a set of blocks:
single vectors, those of the blocks first, so a task holds its set's index and one batch of
queries, however many queries come by. A visit yields at most k rows for a query.

Defined cases: vectors that are null or zero, of another length than most, or that hold a
null or non-finite component take no part, and neither do rows without id; rows that
repeat an id count once, by the greatest vector; with fewer vectors than k all are returned;
ties go to the smaller id; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tremorline.llm.common import written

BLOCK, QUERIES = 8192, 256
#: So many visits at least if the table allows, so many bytes of blocks in a visit, and so
#: many queries.
VISITS, SET_BYTES, SHARE_QUERIES = 48, 100_000_000, 131_072
PROJECTIONS = 96
COLLISIONS = 0.75
SHARE = 0.3
#: Half a window's first width, in standard deviations of two vectors' difference.
FIRST_WIDTH, GROWTH = 1.1, 1.12
SEED = 20


def usable(vectors: DataFrame, id_column: str, column: str) -> DataFrame:
    """vec_id and v (doubles, or floats if the column has them) of the vectors that take part,
    one row for each id."""
    narrow = vectors.select(column).dtypes[0][1] == "array<float>"
    v = F.col(column).cast("array<float>" if narrow else "array<double>")
    ok = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf)) & F.exists(v, lambda x: x != 0)
    rows = vectors.where(F.col(id_column).isNotNull()).select(F.col(id_column).cast("long").alias("vec_id"), v.alias("v"))
    return rows.where(ok).groupBy("vec_id").agg(F.max("v").alias("v"))


class Block(NamedTuple):
    """Ids and vectors, and for each direction the sorted projections and the vectors' ranks."""

    ids: np.ndarray
    v: np.ndarray
    ordered: np.ndarray
    ranks: np.ndarray


def _directions(dimension: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((dimension + 1, PROJECTIONS))


def _lifted(v: np.ndarray, longest: float) -> np.ndarray:
    v = v / longest
    rest = np.sqrt(np.maximum(1 - (v * v).sum(axis=1), 0))
    return np.column_stack((v, rest))


def build_index(ids: np.ndarray, v: np.ndarray, longest: float) -> Block:
    """The index of one block."""
    projected = (_lifted(v, longest) @ _directions(v.shape[1])).T
    order = np.argsort(projected, axis=1, kind="stable")
    ranks = np.empty(order.shape, np.uint16 if len(ids) < 1 << 16 else np.uint32)
    np.put_along_axis(ranks, order, np.arange(len(ids), dtype=ranks.dtype)[None], axis=1)
    return Block(ids, v, np.take_along_axis(projected, order, axis=1), ranks)


def candidates(q: np.ndarray, ordered: np.ndarray, ranks: np.ndarray, wanted: int) -> Iterator[np.ndarray]:
    """For each query (a row of projections) the block's vectors that collide with it often
    enough, by windows that grow until there are ``wanted``."""
    directions, n = ordered.shape
    wanted, least = min(wanted, n), math.ceil(COLLISIONS * directions)
    width = FIRST_WIDTH * math.sqrt(2) * float(ordered.std(axis=1).mean()) or 1.0
    edges: list[tuple[np.ndarray, np.ndarray]] = []
    past, inside, count = np.empty_like(ranks), np.empty(ranks.shape, bool), np.empty(n, np.uint8)

    def level(i: int) -> tuple[np.ndarray, np.ndarray]:
        while len(edges) <= i:
            half = width * GROWTH ** len(edges)
            sides = [(q - half, "left"), (q + half, "right")]
            low, high = (
                np.stack([np.searchsorted(ordered[d], x[:, d], side) for d in range(directions)], axis=1)
                for x, side in sides
            )
            edges.append((low.astype(ranks.dtype), (high - low).astype(ranks.dtype)))
        return edges[i]

    def colliding(row: int, i: int) -> np.ndarray:
        low, wide = (x[row][:, None] for x in level(i))
        # Ranks below the window wrap around, so one comparison sees both of its ends.
        np.less(np.subtract(ranks, low, out=past), wide, out=inside)
        np.add.reduce(inside.view(np.uint8), axis=0, dtype=np.uint8, out=count)
        return np.flatnonzero(count >= least)

    # What collides at a width does so at all greater ones, so the first width that gives
    # enough is looked for from where the query before has found its own.
    i = 0
    for row in range(len(q)):
        found = colliding(row, i)
        while i and len(found) >= wanted and len(fewer := colliding(row, i - 1)) >= wanted:
            i, found = i - 1, fewer
        while len(found) < wanted:
            i += 1
            found = colliding(row, i)
        yield found


def best(block: Block, near: np.ndarray, quick: np.ndarray, x: np.ndarray, k: int, slack: float) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the k of the candidates ``near`` with the greatest products with x.
    Each of ``quick``, their products out of a matrix product, is off by less than half of
    ``slack``; those that it cannot rule out are multiplied by themselves."""
    if len(near) > k:
        least = np.partition(quick, len(near) - k)[len(near) - k] - slack
        near = near[~(quick < least)]
    score = (block.v[near] * x).sum(axis=1)
    ids = block.ids[near]
    order = np.lexsort((ids, -score))[:k]
    return ids[order], score[order]


def answer(blocks: list[Block], query_ids: np.ndarray, q: np.ndarray, k: int, longest: float) -> pa.RecordBatch:
    """The k nearest found in the blocks for each query."""
    length = np.sqrt((q * q).sum(axis=1, keepdims=True))
    projected = (q / length) @ _directions(q.shape[1])[:-1]
    slack = 8 * q.shape[1] * np.finfo(np.float64).eps * longest * length[:, 0]
    found: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in q]
    for block in blocks:
        wanted = k + 1 + math.ceil(SHARE * len(block.ids))
        quick = q @ block.v.T
        for row, near in enumerate(candidates(projected, block.ordered, block.ranks, wanted)):
            near = near[block.ids[near] != query_ids[row]]
            found[row].append(best(block, near, quick[row, near], q[row], k, slack[row]))
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for own, parts in zip(query_ids, found):
        ids, score = (np.concatenate(x) for x in zip(*parts))
        order = np.lexsort((ids, -score))[:k]
        out.append((np.full(len(order), own), ids[order], score[order]))
    columns = [np.concatenate(c) for c in zip(*out)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query_id", "vec_id", "score"])


def visited(batches: Iterator[pa.RecordBatch], last: int, k: int, longest: float) -> Iterator[pa.RecordBatch]:
    """Answers for rows of visit, block, vec_id and v in the order of visit and block. Block
    ``last`` is none: its rows are the queries, and the visit's blocks stand before them."""
    blocks: list[Block] = []
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    now = (-1, -1)
    for batch in batches:
        visit, block, ids = (batch.column(name).to_numpy() for name in ("visit", "block", "vec_id"))
        v = batch.column("v").flatten().to_numpy().reshape(len(ids), -1)
        cuts = np.flatnonzero((np.diff(visit) != 0) | (np.diff(block) != 0)) + 1
        for start, end in zip((0, *cuts), (*cuts, len(ids))):
            key = (visit[start], block[start])
            if key != now and parts:
                blocks.append(build_index(*(np.concatenate(x) for x in zip(*parts)), longest))
                parts = []
            if key[0] != now[0]:
                blocks = []
            now = key
            if key[1] < last:
                parts.append((ids[start:end].copy(), v[start:end].astype(np.float64)))
            elif blocks:
                for at in range(start, end, QUERIES):
                    some = slice(at, min(at + QUERIES, end))
                    yield answer(blocks, ids[some], v[some].astype(np.float64), k, longest)


def search(vectors: DataFrame, is_query: str, k: int = 20, *, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score: the k nearest found of every row for which the
    SQL condition ``is_query`` (over vec_id) holds."""
    rows = written(usable(vectors, id_column, column), "vectors")
    shapes = rows.groupBy(F.size("v").alias("d")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))).alias("square")
    )
    most = shapes.orderBy(F.desc("n"), "d").first()
    schema = "query_id long, vec_id long, score double"
    if most is None:
        found = rows.sparkSession.createDataFrame([], schema)
        return found.selectExpr("query_id", "0 as rank", "vec_id", "score")
    dimension, longest = most.d, math.sqrt(most.square)
    rows = rows.where(F.size("v") == dimension)
    queries = rows.where(is_query)
    blocks = max(1, math.ceil(most.n / BLOCK))
    asked = max(1, queries.count())
    # A vector is sent once to each share, a query once to each set.
    held = max(1, SET_BYTES // (BLOCK * (8 * dimension + 10 * PROJECTIONS)))
    sets = math.ceil(blocks / max(1, min(held, blocks * 2 // VISITS)))
    shares = max(math.ceil(asked / SHARE_QUERIES), min(math.ceil(asked / QUERIES), math.ceil(VISITS / sets)))

    block = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    share = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(shares)).cast("int")
    every = F.sequence(F.lit(0), F.lit(shares - 1))
    held_rows = rows.select(block.alias("block"), F.explode(every).alias("share"), "vec_id", "v")
    held_rows = held_rows.select((F.col("block") % sets * shares + F.col("share")).alias("visit"), "block", "vec_id", "v")
    asking = queries.select(share.alias("share"), F.explode(F.sequence(F.lit(0), F.lit(sets - 1))).alias("set"), "vec_id", "v")
    asking = asking.select((F.col("set") * shares + F.col("share")).alias("visit"), F.lit(blocks).alias("block"), "vec_id", "v")
    dealt = held_rows.union(asking).repartitionById(sets * shares, "visit").sortWithinPartitions("visit", "block")
    found = dealt.mapInArrow(lambda batches: visited(batches, blocks, k, longest), schema)
    nearest = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
