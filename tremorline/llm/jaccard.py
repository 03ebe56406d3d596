"""Similarity join of documents by the Jaccard index of their word shingles.

A size-aware heavy-light join. Equal sets become one class first. Then

- **light** sets, up to a boundary size, are joined by enumerating subsets: two sets of
  n and m shingles reach the threshold exactly if they share a subset of
  ``ceil(t (n + m) / (1 + t))`` elements. Documents that share a subset's key are
  linked, without any check.
- **heavy** sets are joined by scanning inverted lists of their rarest shingles. In an
  order common to all, a set must share one of its first ``n - ceil(t n) + 1`` shingles with
  every set it reaches the threshold with. The order is by a count sketch, rare
  first. A chunk of documents asks which of its shingles anyone else has, and only
  those go into the lists.

The boundary is where enumerating subsets costs more keys than scanning lists.

Lists can be as long as a group of near copies, so no list is expanded into all pairs.
First, for a few rounds, each member is compared with one document of its list, and what
is linked becomes a component. A list that has but one component is done. In another
one, the members outside its largest component are compared with the rest, across
components, if the key's places in both allow the threshold. That leaves no pair
uncompared that could join two components.

Defined cases: a null text, or one without words, has no shingles and links with
nothing; fewer than ``SHINGLE`` words are one shingle; a row without an id is counted
but has no component; repeated rows are members of one class; an empty table gives no
rows. Rows that repeat an id should repeat its text. Other columns than ``doc_id`` and ``text`` are not looked at.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import zlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremorline.llm.common import written
from tremorline.llm.graph import components
from tremorline.llm.hashing import OTHER, batched, mix, word_hashes

SHINGLE = 5
THRESHOLD = Fraction(4, 5)
#: Sizes that are tried as the boundary, and keys that one shingle in a list counts for.
MAX_LIGHT = 16
#: Times that lists are compared with one of their documents before all pairs are.
STAR_ROUNDS = 2
LIST_COST = 8
#: Bytes of text that stand for one chunk of lists.
CHUNK_BYTES = 32_000_000
#: Characters of text whose shingles a task holds together; hashing takes some fifty bytes for each.
HELD = 250_000
#: Cells of the sketch: the bounds of its size, and shingles that share a cell.
SKETCH_BITS = (16, 24)
PER_CELL = 64
_SLICES = 16
_ID_BITS = 27


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """The sorted distinct shingles of each text."""
    words, counts = word_hashes(texts)
    joined = np.zeros(max(0, len(words) - SHINGLE + 1), np.uint64)
    for k in range(SHINGLE):
        joined = joined * OTHER + words[k : k + len(joined)]
        joined ^= joined >> np.uint64(29)
    joined = mix(joined)
    sets, start = [], 0
    for n in counts.tolist():
        if n >= SHINGLE:
            own = np.sort(joined[start : start + n - SHINGLE + 1])
            sets.append(own[np.concatenate(([True], own[1:] != own[:-1]))])
        elif n:
            whole = words[start : start + n]
            value = np.uint64(n)
            for word in whole:
                value = mix(np.array([value], np.uint64) * OTHER + word)[0]
            sets.append(np.array([value], np.uint64))
        else:
            sets.append(np.empty(0, np.uint64))
        start += n
    return sets


def least_overlap(n: int, m: int) -> int:
    """How many shingles sets of n and m must share."""
    return math.ceil(THRESHOLD * (n + m) / (1 + THRESHOLD))


def prefix_length(n: int) -> int:
    return n - math.ceil(THRESHOLD * n) + 1


def partner_sizes(n: int, largest: int) -> list[int]:
    """Sizes up to ``largest`` that a set of n shingles can be linked with."""
    return [m for m in range(math.ceil(THRESHOLD * n), math.floor(n / THRESHOLD) + 1) if m <= largest]


def light_boundary(sizes: dict[int, int]) -> int:
    """The boundary with the fewest keys: up to it subsets are enumerated, beyond it lists
    are scanned. ``sizes`` counts the documents of each size up to ``MAX_LIGHT``."""

    def cost(boundary: int) -> int:
        total = 0
        for n, documents in sizes.items():
            if n <= boundary:
                total += documents * sum(
                    math.comb(n, least_overlap(n, m)) for m in partner_sizes(n, boundary)
                )
            if n >= math.ceil(THRESHOLD * (boundary + 1)):
                total += documents * prefix_length(n) * LIST_COST
        return total

    return min(range(MAX_LIGHT + 1), key=cost)


_chosen: dict[tuple[int, int], np.ndarray] = {}


def _subsets(n: int, c: int) -> np.ndarray:
    if (n, c) not in _chosen:
        _chosen[n, c] = np.array(list(itertools.combinations(range(n), c)), np.int64).reshape(-1, c)
    return _chosen[n, c]


def subset_keys(shingles: np.ndarray, boundary: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each size of partner: that size, and the keys of the subsets to share with it."""
    n = len(shingles)
    for m in partner_sizes(n, boundary):
        c = least_overlap(n, m)
        low, high = min(n, m), max(n, m)
        salt = np.uint64(low * 1000 + high)
        keys = mix(mix(shingles[_subsets(n, c)] + salt).sum(axis=1, dtype=np.uint64) + salt)
        # The last bit tells whether the key is for two sets of one size.
        yield m, keys & ~np.uint64(1) | np.uint64(n == m)


def describe(docs: DataFrame, cells: int) -> DataFrame:
    """One pass over the texts: kind 0 rows are documents with size and digest of their
    sets, kind 1 rows are slices of the task's counts of shingles by sketch cell."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(cells, np.uint32)
        for batch, texts in batched(batches, "text", HELD):
            sets = shingle_sets(texts)
            if sets:
                np.add.at(counts, (np.concatenate(sets) & np.uint64(cells - 1)).astype(np.int64), 1)
            digests = [hashlib.blake2b(own.tobytes(), digest_size=16).digest() for own in sets]
            k = len(sets)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([0] * k, pa.int32()),
                    batch.column("doc_id"),
                    pa.array([len(own) for own in sets], pa.int64()),
                    pa.array(digests, pa.binary()),
                ],
                names=names,
            )
        for i, part in enumerate(np.split(np.minimum(counts, 65535).astype("<u2"), _SLICES)):
            if part.any():
                blob = zlib.compress(part.tobytes(), 1)
                row = [[1], [None], [i], [blob]]
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types)], names=names)

    names = ["kind", "doc_id", "n", "blob"]
    types = [pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    return docs.select("doc_id", "text").mapInArrow(scan, "kind int, doc_id long, n long, blob binary")


def sketch(described: DataFrame, cells: int) -> np.ndarray:
    """The order's first part: the logarithm of each cell's count, one byte a cell. Its
    size is bounded by ``SKETCH_BITS`` whatever the corpus holds."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(zlib.decompress(blob), "<u2").astype(np.int64)
                sums[i] = sums.get(i, 0) + part
        for i, part in sums.items():
            level = np.minimum(np.log2(part + 1) * 8, 255).astype(np.uint8)
            yield pa.RecordBatch.from_pydict({"n": pa.array([i], pa.int64()), "blob": pa.array([level.tobytes()])})

    slices = described.where("kind = 1").select("n", "blob").repartition(_SLICES, "n")
    levels = np.zeros((_SLICES, cells // _SLICES), np.uint8)
    for row in slices.mapInArrow(add, "n long, blob binary").collect():
        levels[row.n] = np.frombuffer(row.blob, np.uint8)
    return levels.reshape(-1)


def _keys(docs: DataFrame, reps: DataFrame, levels: np.ndarray, boundary: int) -> DataFrame:
    """The subset keys (light) and the rarest shingles (lists), as blobs, of the documents that
    ``reps`` names (and of the few others that a bitmap lets through)."""
    shared = docs.sparkSession.sparkContext.broadcast((levels, _bitmap(reps)))
    lowest_listed = math.ceil(THRESHOLD * (boundary + 1))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, bitmap = shared.value
        for batch, texts in batched((_named(b, bitmap) for b in batches), "text", HELD):
            sizes, lists, light = [], [], []
            for own in shingle_sets(texts):
                n = len(own)
                sizes.append(n)
                if n >= lowest_listed:
                    level = order[(own & np.uint64(len(order) - 1)).astype(np.int64)]
                    # Sets are sorted, so a stable sort keeps shingles of one level in order.
                    rarest = np.argsort(level, kind="stable")[: prefix_length(n)]
                    lists.append(own[rarest].tobytes())
                else:
                    lists.append(b"")
                pairs = list(subset_keys(own, boundary)) if 0 < n <= boundary else []
                light.append(b"".join(k.tobytes() for _, k in pairs))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(lists, pa.binary()), pa.array(light, pa.binary())],
                names=["doc_id", "n", "lists", "light"],
            )

    return _hashed(docs).mapInArrow(emit, "doc_id long, n long, lists binary, light binary")


def _shared_postings(keys: DataFrame, chunks: int) -> DataFrame:
    """(key, doc_id, n, light, place) for the keys that at least two documents have; ``place``
    is a list key's place in the document's order."""
    rows = keys.withColumn("chunk", F.pmod(F.xxhash64("doc_id"), F.lit(chunks)))
    edges = np.array([(b << 64) // chunks for b in range(chunks)], np.uint64)

    def flat(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        blobs = [a + b for a, b in zip(table.column("lists").to_pylist(), table.column("light").to_pylist())]
        return np.frombuffer(b"".join(blobs), np.uint64), np.array([len(b) // 8 for b in blobs], np.int64)

    def ask(table: pa.Table) -> pa.Table:
        distinct, counts = np.unique(flat(table)[0], return_counts=True)
        at = np.append(np.searchsorted(distinct, edges), len(distinct))
        asked = [(b, at[b], at[b + 1]) for b in range(chunks) if at[b + 1] > at[b]]
        return pa.table(
            {
                "bucket": pa.array([b for b, _, _ in asked], pa.int32()),
                "chunk": pa.array([table.column("chunk")[0].as_py()] * len(asked), pa.int64()),
                "keys": pa.array([distinct[i:j].tobytes() for _, i, j in asked], pa.binary()),
                "many": pa.array([np.packbits(counts[i:j] > 1).tobytes() for _, i, j in asked], pa.binary()),
            }
        )

    def answer(table: pa.Table) -> pa.Table:
        asked = [np.frombuffer(k, np.uint64) for k in table.column("keys").to_pylist()]
        many = [
            np.unpackbits(np.frombuffer(m, np.uint8), count=len(k))
            for k, m in zip(asked, table.column("many").to_pylist())
        ]
        distinct, inverse = np.unique(np.concatenate(asked), return_inverse=True)
        total = np.bincount(inverse, np.concatenate(many).astype(np.float64) + 1, len(distinct))
        found = (total > 1)[inverse]
        borders = np.cumsum([0, *map(len, asked)])
        blobs = [np.packbits(found[a:b]).tobytes() for a, b in zip(borders[:-1], borders[1:])]
        return pa.table({"chunk": table.column("chunk"), "bucket": table.column("bucket"), "found": pa.array(blobs, pa.binary())})

    def finish(own: pa.Table, answers: pa.Table) -> pa.Table:
        flat_keys, lengths = flat(own)
        distinct = np.unique(flat_keys)
        at = np.append(np.searchsorted(distinct, edges), len(distinct))
        found = np.zeros(len(distinct), bool)
        for b, blob in zip(answers.column("bucket").to_pylist(), answers.column("found").to_pylist()):
            found[at[b] : at[b + 1]] = np.unpackbits(np.frombuffer(blob, np.uint8), count=at[b + 1] - at[b])
        keep = found[np.searchsorted(distinct, flat_keys)] if len(distinct) else np.zeros(0, bool)
        listed = np.array([len(b) // 8 for b in own.column("lists").to_pylist()], np.int64)
        ids = own.column("doc_id").to_numpy()
        sizes = own.column("n").to_numpy()
        place = np.arange(len(flat_keys)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        is_light = place >= np.repeat(listed, lengths)
        return pa.table(
            {
                "key": pa.array(flat_keys.view(np.int64)[keep]),
                "doc_id": pa.array(np.repeat(ids, lengths)[keep]),
                "n": pa.array(np.repeat(sizes, lengths)[keep]),
                "light": pa.array(is_light[keep]),
                "place": pa.array(place[keep]),
            }
        )

    answers = rows.groupBy("chunk").applyInArrow(ask, "bucket int, chunk long, keys binary, many binary")
    answers = answers.groupBy("bucket").applyInArrow(answer, "chunk long, bucket int, found binary")
    return (
        rows.groupBy("chunk")
        .cogroup(answers.groupBy("chunk"))
        .applyInArrow(finish, "key long, doc_id long, n long, light boolean, place long")
    )


def _bitmap(ids: DataFrame) -> np.ndarray:
    """A bitmap of bounded size (16 MB at most) in which the ids' hashes are set."""
    bits = 1 << min(_ID_BITS, max(16, (8 * ids.count()).bit_length()))
    at = F.pmod(F.xxhash64("doc_id"), F.lit(bits))
    words = (
        ids.select(at.alias("at"))
        .groupBy(F.floor(F.col("at") / 32).alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, int(at % 32)))").alias("mask"))
        .toPandas()
    )
    bitmap = np.zeros(bits // 32, np.uint32)
    bitmap[words["word"].to_numpy(np.int64)] = words["mask"].to_numpy(np.int64).astype(np.uint32)
    return bitmap


def _hashed(docs: DataFrame) -> DataFrame:
    at = F.pmod(F.xxhash64("doc_id"), F.lit(1 << _ID_BITS))
    return docs.where("doc_id is not null").select("doc_id", "text", at.alias("at"))


def _named(batch: pa.RecordBatch, bitmap: np.ndarray) -> pa.RecordBatch:
    """The rows (doc_id, text, at) whose ids the bitmap holds, without ``at``."""
    at = batch.column(2).to_numpy(zero_copy_only=False).astype(np.uint64) % np.uint64(32 * len(bitmap))
    hit = (bitmap[(at // np.uint64(32)).astype(np.int64)] >> (at % np.uint64(32)).astype(np.uint32)) & 1
    return batch.select([0, 1]).filter(pa.array(hit.astype(bool)))


def _only(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """About the rows of ``docs`` that ``ids`` names (the bitmap lets a few others
    through), so that texts nobody asks for are not shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(_bitmap(ids))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _named(batch, shared.value)

    return _hashed(docs).mapInArrow(keep, "doc_id long, text string")


def verified(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) of ``pairs`` whose documents reach the threshold, by their texts."""
    pairs = written(pairs.select("a", "b").distinct(), "pairs")
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select(F.col("b").alias("doc_id"))).distinct()
    texts = _only(docs, ids)
    left = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    both = left.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts_a in batched(batches, "text_a", HELD):
            texts_b = batch.column("text_b").to_pylist()
            keep = []
            for one, other in zip(shingle_sets(texts_a), shingle_sets(texts_b)):
                shared = len(np.intersect1d(one, other, assume_unique=True))
                union = len(one) + len(other) - shared
                keep.append(THRESHOLD.denominator * shared >= THRESHOLD.numerator * union > 0)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "text_a", "text_b").mapInArrow(check, "a long, b long")


def link(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id (null for a row without id) of every row."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = min(SKETCH_BITS[1], max(SKETCH_BITS[0], (size // 6 // PER_CELL).bit_length()))
    described = written(describe(docs, 1 << bits), "described")
    own = described.where("kind = 0").select("doc_id", F.col("n").alias("n_shingles"), "blob")
    with_set = own.where("doc_id is not null and n_shingles > 0")
    classes = with_set.groupBy("blob").agg(F.min("doc_id").alias("rep"))
    reps = written(classes.select(F.col("rep").alias("doc_id"), "blob"), "classes")

    small = own.where((F.col("n_shingles") > 0) & (F.col("n_shingles") <= MAX_LIGHT))
    sizes = {r.n_shingles: r["count"] for r in small.groupBy("n_shingles").count().collect()}
    larger = own.where(F.col("n_shingles") > MAX_LIGHT).count()
    boundary = light_boundary(sizes | {MAX_LIGHT + 1: larger})

    chunks = max(1, math.ceil(size / CHUNK_BYTES))
    keys = _keys(docs, reps.select("doc_id"), sketch(described, 1 << bits), boundary)
    postings = _shared_postings(keys, chunks).join(reps.select("doc_id").distinct(), "doc_id")
    postings = written(postings, "postings")

    # Light: who shares a subset's key is linked; with two sizes, both must be there.
    light = postings.where("light")
    met = light.groupBy("key").agg(
        F.min("doc_id").alias("b"), F.count(F.lit(1)).alias("members"),
        F.min("n").alias("low"), F.max("n").alias("high"),
    )
    light_edges = _light_edges(light, met)

    # Heavy, first step: the members of each list against its most central document.
    lists = written(_weighted(postings.where("not light").select("key", "doc_id", "n", "place").distinct()), "lists")
    edges = written(light_edges, "links")
    found = components(edges)
    for turn in range(STAR_ROUNDS):
        mixed = _mixed(lists, found)
        pivot = F.max(F.struct("weight", (-F.col("doc_id")).alias("minus_id"), "n", "place", "component"))
        usable = mixed if turn == 0 else mixed.where("component <> main")
        pivots = usable.groupBy("key").agg(pivot.alias("pivot"))
        stars = mixed.join(pivots, "key").where(F.col("component") != F.col("pivot.component"))
        sizes = (F.col("n"), F.col("pivot.n"), F.col("place"), F.col("pivot.place"))
        stars = stars.where(_compared(*sizes, boundary))
        stars = stars.select(F.col("doc_id").alias("a"), (-F.col("pivot.minus_id")).alias("b"))
        edges = written(edges.union(verified(docs, stars)), "links")
        found = components(edges)

    # Heavy, second step: across the components that lists still hold.
    mixed = _mixed(lists, found)
    outside = mixed.where("component <> main").select(
        "key", F.col("doc_id").alias("a"), F.col("n").alias("n_a"), F.col("place").alias("place_a"), F.col("component").alias("of_a")
    )
    rest = mixed.select(
        "key", F.col("doc_id").alias("b"), F.col("n").alias("n_b"), F.col("place").alias("place_b"), F.col("component").alias("of_b"), "main"
    )
    sizes = (F.col("n_a"), F.col("n_b"), F.col("place_a"), F.col("place_b"))
    across = outside.join(rest, "key").where(
        (F.col("of_a") != F.col("of_b"))
        & ((F.col("of_b") == F.col("main")) | (F.col("a") > F.col("b")))
        & _compared(*sizes, boundary)
    )
    across = across.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    more = verified(docs, across)
    found = components(edges.union(more))

    by_rep = reps.join(found.withColumnRenamed("vertex", "doc_id"), "doc_id", "left").select(
        "blob", F.coalesce("component", "doc_id").alias("component_id")
    )
    alone = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return own.join(by_rep, "blob", "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), alone).alias("component_id")
    )


def _light_edges(light: DataFrame, met: DataFrame) -> DataFrame:
    # A key is for two sizes. If they differ, only sets of both sizes make a link, and then
    # each member of one size is linked to each of the other.
    linked = met.where((F.col("low") < F.col("high")) | (F.col("key") % 2 != 0))
    return light.join(linked, "key").where("doc_id <> b").select(F.col("doc_id").alias("a"), "b").distinct()


def _weighted(lists: DataFrame) -> DataFrame:
    """Lists with ``weight``: how long the lists are, together, that a document is in. In a
    group of near copies the text that the others were made from has the most."""
    lengths = lists.groupBy("key").agg(F.count(F.lit(1)).alias("length"))
    weights = lists.join(lengths, "key").groupBy("doc_id").agg(F.sum("length").alias("weight"))
    return lists.join(weights, "doc_id")


def _mixed(lists: DataFrame, found: DataFrame) -> DataFrame:
    """The members, with component and the list's largest one (main), of the lists that
    hold more than one component."""
    placed = lists.join(found.withColumnRenamed("vertex", "doc_id"), "doc_id", "left")
    placed = placed.withColumn("component", F.coalesce("component", "doc_id"))
    parts = placed.groupBy("key", "component").agg(F.count(F.lit(1)).alias("members"))
    main = parts.groupBy("key").agg(
        F.max_by("component", F.struct("members", "component")).alias("main"), F.count(F.lit(1)).alias("parts")
    )
    return written(placed.join(main.where("parts > 1"), "key"), "mixed")


def _compared(n: Column, m: Column, place_n: Column, place_m: Column, boundary: int) -> Column:
    """Whether a common key at these places can be the first that two sets have in common,
    if they reach the threshold; and they are not both light."""
    t = THRESHOLD
    low, high = F.least(n, m), F.greatest(n, m)
    fit = t.denominator * low >= t.numerator * high
    least = F.ceil(t.numerator * (n + m) / (t.numerator + t.denominator))
    return fit & (place_n + least <= n) & (place_m + least <= m) & (high > boundary)
