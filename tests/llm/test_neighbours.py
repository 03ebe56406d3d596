from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tremorline.llm import neighbours

TABLE = "vec_id long, embedding array<float>"


def some_vectors(n, dimension=12, seed=5):
    """The last ones are there twice, under another id."""
    v = np.random.default_rng(seed).standard_normal((n, dimension)).astype(np.float32)
    return np.concatenate((v, v[-20:]))


def table_of(spark, v):
    return spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(v)], TABLE)


def plain(v, block_of, asked, k):
    """Collision counting with every difference looked at; ids by query, best first."""
    v = v.astype(np.float64)
    longest = max(math.sqrt(x @ x) for x in v)
    directions = neighbours._directions(v.shape[1])
    lifted = np.column_stack((v / longest, [math.sqrt(max(0, 1 - x @ x)) for x in v / longest]))
    projected = lifted @ directions
    found = {}
    for q in asked:
        of = v[q] / math.sqrt(v[q] @ v[q]) @ directions[:-1]
        pool = []
        for block in set(block_of):
            ids = np.flatnonzero(block_of == block)
            apart = np.abs(projected[ids] - of)
            half = neighbours.FIRST_WIDTH * math.sqrt(2) * projected[ids].std(axis=0).mean()
            wanted = min(len(ids), k + 1 + math.ceil(neighbours.SHARE * len(ids)))
            least = math.ceil(neighbours.COLLISIONS * neighbours.PROJECTIONS)
            while ((apart <= half).sum(axis=1) >= least).sum() < wanted:
                half *= neighbours.GROWTH
            pool += [i for i in ids[(apart <= half).sum(axis=1) >= least] if i != q]
        found[q] = sorted(pool, key=lambda i: (-(v[i] * v[q]).sum(), i))[:k]
    return found


@pytest.mark.parametrize("set_bytes, visits, share", [(1, 6, 1000), (10**9, 6, 1000), (10**9, 2, 7), (10**9, 1, 1000)])
def test_every_block_meets_every_query(spark, monkeypatch, set_bytes, visits, share):
    for name, value in (("BLOCK", 60), ("QUERIES", 5), ("SET_BYTES", set_bytes), ("VISITS", visits), ("SHARE_QUERIES", share)):
        monkeypatch.setattr(neighbours, name, value)
    v = some_vectors(400)
    table = table_of(spark, v)
    blocks = math.ceil(len(v) / 60)
    number = F.pmod(F.xxhash64("vec_id"), F.lit(blocks))
    block_of = np.array([r.b for r in table.select(number.alias("b")).orderBy("vec_id").collect()])
    found = {}
    for r in neighbours.search(table, "vec_id % 10 = 0", 8).orderBy("query_id", "rank").collect():
        assert r.score == (v[r.query_id].astype(np.float64) * v[r.vec_id]).sum()
        found.setdefault(r.query_id, []).append(r.vec_id)
    assert found == plain(v, block_of, range(0, len(v), 10), 8)


def test_floats_and_doubles_give_the_same(spark):
    table = table_of(spark, some_vectors(150))
    doubles = table.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    rows = [sorted(neighbours.search(t, "vec_id % 20 = 0").collect()) for t in (table, doubles)]
    assert rows[0] and rows[0] == rows[1]


def test_python_gets_single_vectors(spark, monkeypatch):
    """A row with a block in it was made for each batch of queries, and the join held all of
    a block's at once."""
    given = []
    kind = type(spark.range(0))
    passed_on = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda self, *a, **b: given.append(self) or passed_on(self, *a, **b))
    v = some_vectors(400)
    found = neighbours.search(table_of(spark, v), "vec_id % 2 = 0", 3)
    sent = given[0].toArrow()
    assert sent.num_rows >= len(v) and sent.nbytes < 500 * sent.num_rows
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()


def test_queries_stream_past_their_blocks():
    v = some_vectors(300).astype(np.float64)
    longest = float(np.sqrt((v * v).sum(axis=1)).max())
    rows = [(visit, block, i) for visit in (0, 1) for block in (0, 2) for i in range(block, len(v), 4)]
    rows += [(visit, 4, i) for visit in (0, 1, 7) for i in range(visit, len(v), 2)]
    rows.sort(key=lambda r: r[:2])

    def batches(size, pulled):
        for at in range(0, len(rows), size):
            visit, block, ids = (list(x) for x in zip(*rows[at : at + size]))
            pulled.append(max(visit))
            columns = [pa.array(visit, pa.int32()), pa.array(block, pa.int32()), pa.array(ids), pa.array(v[ids].tolist())]
            yield pa.RecordBatch.from_arrays(columns, names=["visit", "block", "vec_id", "v"])

    whole = list(neighbours.visited(batches(10_000, []), 4, 5, longest))
    whole = sorted(r for b in whole for r in zip(*b.to_pydict().values()))
    # Visit 7 has no blocks, so nothing is found for its queries a second time.
    assert len(whole) == 5 * len(v)
    pulled: list[int] = []
    stream = neighbours.visited(batches(7, pulled), 4, 5, longest)
    first = next(stream)
    # The first batch with a query is answered before another is asked for.
    assert pulled == [0] * len(pulled) and first.num_rows <= 5 * 7
    asked = next(n for n, r in enumerate(rows) if r[1] == 4) // 7 + 1
    assert len(pulled) == asked
    pieces = sorted(r for b in (first, *stream) for r in zip(*b.to_pydict().values()))
    assert [r[:2] for r in pieces] == [r[:2] for r in whole]
