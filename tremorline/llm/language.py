"""Language identification by rank-order n-gram profiles.

A language's profile is the list of its most frequent character n-grams (1 to 3
letters, with a mark for word borders), by rank. A document's own most frequent
n-grams are compared with each profile: the distance is the sum of how far each
n-gram is out of place, with a fixed penalty for one that the profile lacks.

Defined cases: a text that is null or has no letter gives ``und`` with score 0, and so
does every text if nothing was learned. Ties go to the language first by code point.
Rows keep their number: repeated rows are predicted each. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tremorline.llm.common import held_out
from tremorline.llm.hashing import batched

PROFILE = 400
#: N-grams that a task holds before it adds them up; adding up takes some sixty bytes for each.
WAITING = 500_000
_BORDER = 1
_letters: np.ndarray | None = None


def _is_letter(codes: np.ndarray) -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters[codes]


def ngrams(text: str | None) -> np.ndarray:
    """All n-grams of 1 to 3 characters of the text's words, as numbers of 21 bits a character."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), np.uint32)
    letter = _is_letter(codes)
    if not letter.any():
        return np.empty(0, np.int64)
    seq = np.where(letter, codes, _BORDER).astype(np.int64)
    seq = np.concatenate(([_BORDER], seq, [_BORDER]))
    keep = np.ones(len(seq), bool)
    keep[1:] = (seq[1:] != _BORDER) | (seq[:-1] != _BORDER)
    seq = seq[keep]
    inner = seq != _BORDER
    two = (seq[:-1] << 21) | seq[1:]
    three = ((seq[:-2] << 42) | (seq[1:-1] << 21) | seq[2:])[inner[1:-1]]
    return np.concatenate((seq[inner], two, three))


def top_ngrams(text: str | None, k: int) -> np.ndarray:
    keys, counts = np.unique(ngrams(text), return_counts=True)
    return keys[np.lexsort((keys, -counts))[:k]]


def learn_profiles(docs: DataFrame, k: int = PROFILE) -> dict[str, list[int]]:
    """Profiles from all rows with a language. Counts are summed in Spark; what comes to
    the driver is k numbers for each language."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        waiting = 0

        def emit() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                keys, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
                n = np.bincount(inverse, np.concatenate([p[1] for p in parts])).astype(np.int64)
                yield pa.RecordBatch.from_pydict(
                    {"lang": pa.array([lang] * len(keys), pa.string()), "key": pa.array(keys), "n": pa.array(n)}
                )
            held.clear()

        for batch, texts in batched(batches, "text"):
            for text, lang in zip(texts, batch.column("lang").to_pylist()):
                pair = np.unique(ngrams(text), return_counts=True)
                held.setdefault(lang, []).append(pair)
                waiting += len(pair[0])
                if waiting > WAITING:
                    yield from emit()
                    waiting = 0
        yield from emit()

    counts = (
        docs.where("lang is not null")
        .select("text", "lang")
        .mapInArrow(count, "lang string, key long, n long")
        .groupBy("lang", "key")
        .agg(F.sum("n").alias("n"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "key")
    top = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    profiles: dict[str, list[int]] = {}
    for row in sorted(top.select("lang", "rank", "key").collect()):
        profiles.setdefault(row.lang, []).append(row.key)
    return profiles


def _matrix(profiles: dict[str, list[int]], k: int) -> tuple[list[str], np.ndarray, np.ndarray]:
    langs = sorted(profiles)
    keys = np.array(sorted({x for keys in profiles.values() for x in keys}), np.int64)
    ranks = np.full((len(keys) + 1, len(langs)), -1, np.int32)
    for j, lang in enumerate(langs):
        ranks[np.searchsorted(keys, profiles[lang]), j] = np.arange(len(profiles[lang]))
    return langs, keys, ranks


def predict(docs: DataFrame, profiles: dict[str, list[int]], k: int = PROFILE) -> DataFrame:
    """``docs`` (all columns) with lang_pred and score: 1 for all n-grams in their places
    of the best profile, 0 for none in it."""
    langs, keys, ranks = _matrix(profiles, k)

    def one(text: str | None) -> tuple[str, float]:
        top = top_ngrams(text, k)
        if not len(top) or not langs:
            return "und", 0.0
        at = np.minimum(np.searchsorted(keys, top), len(keys) - 1)
        found = ranks[np.where(keys[at] == top, at, len(keys))]
        out = np.abs(found - np.arange(len(top))[:, None])
        distance = np.where(found < 0, k, out).sum(axis=0)
        best = int(distance.argmin())
        return langs[best], float(1 - distance[best] / (k * len(top)))

    def guess(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in batched(batches, "text"):
            pairs = [one(t) for t in texts]
            columns = [c for c, name in zip(batch.columns, batch.schema.names) if name not in drop]
            columns += [pa.array([p[0] for p in pairs], pa.string()), pa.array([p[1] for p in pairs], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=out_names)

    drop = {"lang_pred", "score"}
    kept = [f for f in docs.schema.fields if f.name not in drop]
    out_names = [f.name for f in kept] + ["lang_pred", "score"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return docs.mapInArrow(guess, f"{schema}, lang_pred string, score double")


def identify(docs: DataFrame, modulus: int = 4, held: int = 2) -> DataFrame:
    """Learn from the rows outside the held-out fold, predict all rows."""
    docs = docs.withColumn("held_out", held_out("doc_id", modulus, held))
    return predict(docs, learn_profiles(docs.where("not held_out")))
