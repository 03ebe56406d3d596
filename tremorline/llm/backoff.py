"""Language model scores by a weighted backoff automaton over hashed n-grams.

States are contexts of up to ``order - 1`` tokens seen in training. A state has an arc
for every token that followed it, weighted by the token's smoothed probability, and a
failure arc to the next shorter context, weighted by what smoothing leaves for tokens
that never followed. Smoothing is interpolation with a prior of ``strength`` counts from
the shorter context; at the bottom are add-one unigrams with one share for all unknown
tokens. So probabilities over the vocabulary and the unknown sum to one in each state.

The model is never in one place. Documents are grouped into chunks of bounded size. A
chunk sends the sorted 64-bit keys of its distinct n-grams, with their training counts,
to buckets of the key space; a bucket adds the counts of equal keys and answers each
chunk in the order it was asked. A chunk then has the part of the automaton that its
documents can reach, and walks it from left to right for all of them side by side. A
frequent n-gram is one key for a chunk, however often it occurs.

Defined cases: a null or empty text is the end token alone; repeated rows count and are
scored each; an empty table gives no rows; without training tokens every token is
unknown. Other columns than ``doc_id`` and ``text`` are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremorline.llm.common import held_out

ORDER = 2
STRENGTH = 400.0
#: Bytes of text that are counted and scored together by one task.
CHUNK_BYTES = 8_000_000
# The end token, and the state before the first one. No word is empty.
_END = b""
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


class Tokens:
    """The n-grams of a chunk: for each length k, the key of the n-gram that ends at each
    position (0 where the document is too short), all documents one after the other."""

    def __init__(self, texts: list[str | None], order: int) -> None:
        words: list[bytes] = []
        lengths = []
        for text in texts:
            # Bytes are split at ASCII white space and lowered in A-Z only.
            own = (text or "").encode().lower().split()
            words += own
            words.append(_END)
            lengths.append(len(own) + 1)
        self.lengths = np.array(lengths, np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        codes, distinct = pd.factorize(np.array(words + [None], object)[:-1])
        hashed = pd.util.hash_array(np.array([*distinct, _END], object), categorize=False)
        single = hashed[codes]
        self.keys = [(single << np.uint64(1)) | np.uint64(1)]
        previous = np.empty_like(single)
        previous[1:] = single[:-1]
        previous[self.starts] = hashed[-1]
        place = np.arange(len(single)) - np.repeat(self.starts, self.lengths)
        context = previous
        for k in range(2, order + 1):
            if k > 2:
                shifted = np.empty_like(context)
                shifted[1:] = joined[:-1]  # noqa: F821  the (k-1)-gram that ends one before
                shifted[:1] = 0
                context = shifted
            joined = _join(context, single, k)
            self.keys.append(np.where(place >= k - 2, joined & ~np.uint64(1) | np.uint64(2), np.uint64(0)))
        self.all_keys = np.unique(np.concatenate(self.keys)) if len(single) else np.empty(0, np.uint64)


def _join(a: np.ndarray, b: np.ndarray, k: int) -> np.ndarray:
    x = (a + np.uint64(k)) * _MIX[0] ^ (b >> np.uint64(7)) * _MIX[1] ^ b
    x ^= x >> np.uint64(29)
    x *= _MIX[1]
    return x ^ (x >> np.uint64(32))


def _planes(values: np.ndarray) -> bytes:
    """Numbers as bytes, all first bytes before all second ones and so on: the high bytes of
    small numbers are runs of zeros, which shuffles compress."""
    return values.view(np.uint8).reshape(len(values), -1).T.tobytes()


def _from_planes(blob: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(blob, np.uint8).reshape(width, -1).T).view(kind).reshape(-1)


def _split(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins among sorted keys: buckets are ranges of the key space."""
    edges = [(b << 64) // buckets for b in range(buckets)]
    return np.append(np.searchsorted(keys, np.array(edges, np.uint64)), len(keys))


def _requests(
    chunk: int, texts: list[str | None], held: list[bool], order: int, buckets: int
) -> pa.Table:
    """A chunk's keys and training counts, one row for each bucket that has any."""
    tokens = Tokens(texts, order)
    keys = tokens.all_keys
    training = np.repeat(~np.array(held, bool), tokens.lengths)
    counts = np.zeros(len(keys), np.int64)
    for level in tokens.keys:
        counts += np.bincount(np.searchsorted(keys, level[training]), minlength=len(keys))
    at = _split(keys, buckets)
    rows = [(b, at[b], at[b + 1]) for b in range(buckets) if at[b + 1] > at[b]]
    return pa.table(
        {
            "bucket": pa.array([r[0] for r in rows], pa.int32()),
            "chunk": pa.array([chunk] * len(rows), pa.int64()),
            "keys": pa.array([_planes(np.diff(keys[a:b], prepend=np.uint64(0))) for _, a, b in rows], pa.binary()),
            "counts": pa.array([_planes(counts[a:b].astype("<u4")) for _, a, b in rows], pa.binary()),
        }
    )


_REQUESTS = "bucket int, chunk long, keys binary, counts binary"


def _summed(table: pa.Table) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray]:
    # Keys came as the differences of sorted ones.
    keys = [np.cumsum(_from_planes(x, "<u8"), dtype=np.uint64) for x in table.column("keys").to_pylist()]
    counts = [_from_planes(x, "<u4") for x in table.column("counts").to_pylist()]
    distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    totals = np.bincount(inverse, np.concatenate(counts)).astype(np.int64)
    return [len(k) for k in keys], distinct, totals, inverse


def training_size(docs: DataFrame, buckets: int) -> tuple[int, int]:
    """All training tokens and the distinct ones among them; ``docs`` has held_out."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[str | None] = []
        size = 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                waiting.append(text)
                size += len(text or "")
                if size > CHUNK_BYTES:
                    yield from _requests(0, waiting, [False] * len(waiting), 1, buckets).to_batches()
                    waiting, size = [], 0
        if waiting:
            yield from _requests(0, waiting, [False] * len(waiting), 1, buckets).to_batches()

    def add(table: pa.Table) -> pa.Table:
        _, distinct, totals, _ = _summed(table)
        return pa.table({"n": pa.array([int(totals.sum())]), "v": pa.array([len(distinct)], pa.int64())})

    sizes = docs.where("not held_out").select("text").mapInArrow(count, _REQUESTS)
    sizes = sizes.groupBy("bucket").applyInArrow(add, "n long, v long")
    row = sizes.agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    return row.n or 0, row.v or 0


def walk(tokens: Tokens, counts: list[np.ndarray], n: int, v: int, strength: float) -> np.ndarray:
    """log10 probability of each document: one walk through the automaton from left to
    right, all documents of the chunk side by side.

    ``counts[k - 1]`` is the training count of the k-gram that ends at each position. A
    document's state is the length of its context: how many of its last tokens are
    one of the automaton's states.
    """
    order = len(counts)
    begins = np.zeros(len(counts[0]), bool)
    begins[tokens.starts] = True
    end_count = counts[0][tokens.starts + tokens.lengths - 1]
    probability = (counts[0] + 1.0) / (n + v + 1.0)
    arcs, failures = [np.log10(probability)], [np.zeros(0)]
    for k in range(2, order + 1):
        context = np.zeros(len(counts[0]))
        context[1:] = counts[k - 2][:-1]
        context[tokens.starts] = end_count if k == 2 else 0
        probability = np.where(
            context > 0, (counts[k - 1] + strength * probability) / (context + strength), probability
        )
        arcs.append(np.log10(probability))
        failures.append(np.log10(strength / (context + strength)))

    # Longest documents first: those still walking are always the first ones.
    by_length = np.argsort(-tokens.lengths, kind="stable")
    starts, lengths = tokens.starts[by_length], tokens.lengths[by_length]
    walking = np.searchsorted(-lengths, -np.arange(1, lengths.max(initial=0) + 1), side="right")
    score = np.zeros(len(starts))
    state = np.minimum((end_count[by_length] > 0).astype(np.int64), order - 1)
    for t, m in enumerate(walking):
        at, depth = starts[:m] + t, state[:m].copy()
        gained, found = np.zeros(m), np.zeros(m, bool)
        for k in range(order, 1, -1):
            here = ~found & (depth == k - 1)
            arc = here & (counts[k - 1][at] > 0)
            gained[arc] += arcs[k - 1][at[arc]]
            failed = here & ~arc
            gained[failed] += failures[k - 1][at[failed]]
            depth[failed] -= 1
            found |= arc
        rest = ~found
        gained[rest] += arcs[0][at[rest]]
        score[:m] += gained
        reached = np.where(found, depth + 1, (counts[0][at] > 0).astype(np.int64))
        state[:m] = np.minimum(reached, order - 1)
    out = np.empty(len(starts))
    out[by_length] = score
    return out


def score(docs: DataFrame, order: int = ORDER, strength: float = STRENGTH) -> DataFrame:
    """Scores of all rows of ``docs`` (doc_id, text, held_out); the model learns from the
    rows that are not held out."""
    rows = docs.select("doc_id", "text", "held_out")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # As many buckets as chunks: a bucket gets about as many keys as a chunk has.
    chunks = max(1, math.ceil(size / CHUNK_BYTES))
    n, v = training_size(rows, chunks)
    in_chunks = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)))

    def ask(table: pa.Table) -> pa.Table:
        texts, held = table.column("text").to_pylist(), table.column("held_out").to_pylist()
        return _requests(table.column("chunk")[0].as_py(), texts, held, order, chunks)

    def answer(table: pa.Table) -> pa.Table:
        sizes, _, totals, inverse = _summed(table)
        found = totals[inverse].astype("<u4" if totals.max(initial=0) < 1 << 32 else "<u8")
        borders = np.cumsum([0, *sizes])
        return pa.table(
            {
                "chunk": table.column("chunk"),
                "bucket": table.column("bucket"),
                "totals": pa.array(
                    [_planes(found[a:b]) for a, b in zip(borders[:-1], borders[1:])], pa.binary()
                ),
            }
        )

    def finish(asked: pa.Table, answers: pa.Table) -> pa.Table:
        tokens = Tokens(asked.column("text").to_pylist(), order)
        keys = tokens.all_keys
        at = _split(keys, chunks)
        totals = np.zeros(len(keys), np.int64)
        for bucket, blob in zip(answers.column("bucket").to_pylist(), answers.column("totals").to_pylist()):
            a, b = at[bucket], at[bucket + 1]
            totals[a:b] = _from_planes(blob, "<u4" if len(blob) == 4 * (b - a) else "<u8")
        counts = [totals[np.searchsorted(keys, level)] for level in tokens.keys]
        for level, own in zip(tokens.keys, counts):
            own[level == 0] = 0
        base = np.log10((counts[0] + 1) / (n + v + 1))
        per_doc = (lambda x: np.add.reduceat(x, tokens.starts)) if len(tokens.starts) else (lambda x: x[:0])
        rows_out = len(tokens.starts)
        return pa.table(
            {
                "doc_id": asked.column("doc_id"),
                "held_out": asked.column("held_out"),
                "n_tokens": pa.array(tokens.lengths),
                "n_known": pa.array(per_doc((counts[0] > 0).astype(np.int64))),
                "train_tokens": pa.array([n] * rows_out, pa.int64()),
                "base_score": pa.array(per_doc(base)),
                "score": pa.array(walk(tokens, counts, n, v, strength)),
            }
        )

    answers = in_chunks.groupBy("chunk").applyInArrow(ask, _REQUESTS)
    answers = answers.groupBy("bucket").applyInArrow(answer, "chunk long, bucket int, totals binary")
    return (
        in_chunks.groupBy("chunk")
        .cogroup(answers.groupBy("chunk"))
        .applyInArrow(
            finish,
            "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
            "base_score double, score double",
        )
    )


def score_documents(docs: DataFrame, modulus: int = 7, held: int = 2, **settings) -> DataFrame:
    return score(docs.withColumn("held_out", held_out("doc_id", modulus, held)), **settings)
