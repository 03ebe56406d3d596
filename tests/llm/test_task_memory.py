"""What a task holds at a time follows the slice it looks at, not the Arrow batch."""

from __future__ import annotations

import random
import re
import tracemalloc
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from tremorline.llm import language, packing
from tremorline.llm.hashing import batched
from tremorline.llm.queries import tokenizer_path


class _Frame:
    """Takes the place of a frame and gives back the function that tasks would run."""

    def select(self, *columns):
        return self

    def where(self, *conditions):
        return self

    def mapInArrow(self, function, schema):
        self.function = function
        return self


def _batch(rows: int, words: int) -> pa.RecordBatch:
    draw = random.Random(5)
    some = ["".join(draw.choices("abcdefghij", k=6)) for _ in range(500)]
    texts = [" ".join(draw.choices(some, k=words)) for _ in range(rows)]
    columns = [pa.array(range(rows), pa.int64()), pa.array(texts), pa.array(["xx"] * rows)]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "text", "lang"])


def _peak(function, batch: pa.RecordBatch) -> tuple[int, int]:
    """Rows out, and the most bytes of Python and numpy held meanwhile."""
    tracemalloc.start()
    try:
        rows = sum(out.num_rows for out in function(iter([batch])))
        return rows, tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


@pytest.mark.parametrize("rows, words", [(4000, 600)])
def test_packing_holds_a_slice(monkeypatch, rows, words):
    class Context:
        get = staticmethod(lambda: Context)
        partitionId = staticmethod(lambda: 3)

    monkeypatch.setattr(packing, "TaskContext", Context)
    batch = _batch(rows, words)
    assert batch.nbytes > 16_000_000
    found, peak = _peak(packing.pieces(_Frame(), tokenizer_path()).function, batch.select([0, 1]))
    assert found >= rows
    assert peak < batch.nbytes


def test_language_counts_in_slices(monkeypatch):
    class Stop(Exception):
        pass

    class Counted(_Frame):
        def mapInArrow(self, function, schema):
            self.function = function
            raise Stop

    batch, docs = _batch(3000, 800), Counted()
    with pytest.raises(Stop):
        language.learn_profiles(docs)
    found, peak = _peak(docs.function, batch.select([1, 2]))
    assert found > 0
    assert peak < 3 * batch.nbytes


def _held_mb() -> float:
    kept = re.findall(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())
    return sum(map(int, kept)) / 1024


def test_free_memory_is_given_back():
    blocks = [np.ones(8_000) for _ in range(3000)]
    pins = blocks[::100]
    del blocks
    before = _held_mb()
    batch = _batch(10, 10)
    assert sum(len(texts) for _, texts in batched(iter([batch]), "text")) == 10
    assert _held_mb() < before - 100
    assert len(pins) == 30
