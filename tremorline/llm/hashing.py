"""Word hashes of whole texts, in numpy, and slices of Arrow batches of bounded size."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are looked at together.
BATCH_BYTES = 2_000_000
FACTOR = np.uint64(0x9E3779B97F4A7C15)
OTHER = np.uint64(0xC2B2AE3D27D4EB4F)
_LOWER = bytes(range(256)).lower()


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * FACTOR
    x = (x ^ (x >> np.uint64(27))) * OTHER
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(max(n, 1) - 1, FACTOR, np.uint64))))


def word_hashes(texts: list[str | None], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word, in order, and the number of words of each text. Words are
    taken in lower case unless ``lower`` is False."""
    parts = [(t or "").encode() for t in texts]
    if lower:
        parts = [p.translate(_LOWER) for p in parts]
    data = np.frombuffer(b" ".join(parts) + b" ", np.uint8)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    begins = np.flatnonzero(~space & np.concatenate(([True], space[:-1])))
    letters = np.flatnonzero(~space)
    if not len(letters):
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    first = np.searchsorted(letters, begins)
    lengths = np.diff(np.append(first, len(letters)))
    place = np.arange(len(letters)) - np.repeat(first, lengths)
    codes = mix(np.arange(1, 257, dtype=np.uint64))
    values = codes[data[letters]] * _powers(int(lengths.max()))[place]
    hashes = mix(np.add.reduceat(values, first) + lengths.astype(np.uint64))
    ends = np.cumsum([len(p) + 1 for p in parts])
    counts = np.diff(np.concatenate(([0], np.searchsorted(begins, ends))))
    return hashes, counts


def give_back() -> None:
    """Returns memory that is free in this process to the system, where the C library can.

    Python workers live on between tasks, and what the allocator keeps for them counts as
    the executor's.
    """
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def batched(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = BATCH_BYTES
) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Slices of the batches whose texts have at most about ``limit`` bytes. Only a slice's
    texts are Python objects at a time. Memory is given back at the start, for the task before,
    and at the end."""
    give_back()
    for batch in batches:
        texts = batch.column(column)
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
        start, size = 0, 0
        for i, own in enumerate(sizes):
            size += own
            if size > limit or i == len(sizes) - 1:
                yield batch.slice(start, i + 1 - start), texts.slice(start, i + 1 - start).to_pylist()
                start, size = i + 1, 0
    give_back()
