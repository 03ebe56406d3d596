"""Runs of words against brute force over small alphabets, and over whole tables."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from tremorline.llm import queries, repeats

ODD = [None, "", " \n", "one", "a " * 11, "a\tb\n" * 6, "Ünï　x " * 9, "x" * 30_000, "A a " * 8]
SCHEMA = "doc_id long, text string, lang string, runs string, start long, n_words int, collapsed int"


def brute_runs(words, least=repeats.LEAST):
    n, found = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            e = i + q
            inside = any(a <= s and a + length >= e and p < q for a, length, p in found)
            if e - s >= max(least, 2 * q) and not inside:
                found.append((s, e - s, q))
    return sorted(found)


def planted(doc_id, text):
    h, words = zlib.crc32(str(doc_id).encode()), (text or "").encode().split()
    n, g = len(words), h // 10
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def plain_result(doc_id, text):
    words = planted(doc_id, text)
    runs = brute_runs(words)
    best = min(((-length, s, p) for s, length, p in runs), default=None)
    first = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
    gone = {i for s, length, p in runs for i in range(s + p, s + length)}
    lines = "".join(f"{s},{length},{p}\n" for s, length, p in runs).encode()
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (len(runs), *first, hashlib.sha256(lines).hexdigest(), hashlib.sha256(kept).hexdigest())


COLUMNS = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def repeating(draw, most=90):
    """A list of numbers with stretches that repeat, and stretches within these."""
    k, n = draw.choice([1, 2, 3, 5, 20]), draw.randrange(most)
    words = [draw.randrange(k) for _ in range(n)]
    for _ in range(draw.randrange(4) if n else 0):
        a = draw.randrange(n)
        p = 1 + draw.randrange(max(1, (n - a) // 2))
        for i in range(a + p, min(n, a + p * draw.randrange(1, 6) + draw.randrange(p))):
            words[i] = words[i - p]
    return words


@pytest.mark.parametrize("least", [1, 4, 12])
def test_automaton_against_brute_force(least):
    draw = random.Random(least)
    for _ in range(400):
        words = repeating(draw)
        assert repeats.runs_of(words, least) == brute_runs(words, least), words


def test_cutting_at_lone_words_loses_no_run():
    draw = random.Random(8)
    texts = [" ".join(f"w{x}" for x in repeating(draw)) for _ in range(500)] + ODD
    draw.shuffle(texts)
    _, found = repeats.text_runs(texts)
    assert found == [brute_runs((t or "").encode().split()) for t in texts]
    assert sum(map(bool, found)) > 100


def test_a_long_periodic_text():
    words = [i % 700 for i in range(20_000)]
    assert repeats.runs_of(words) == [(0, 20_000, 700)]
    assert repeats.runs_of([1] * 5000) == [(0, 5000, 1)]


def test_query_against_brute_force(spark, tmp_path):
    draw = random.Random(9)
    texts = [" ".join(f"w{x}" for x in repeating(draw)) for _ in range(200)] + ODD
    rows = [(i, t, "en", "r", 1, 2, 3) for i, t in enumerate(texts)] + [(None, ODD[4], None, "r", 1, 2, 3)]
    rows += rows[-4:]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op11_suffix_automaton_runs(spark, str(tmp_path)).collect()
    got = sorted(((r.doc_id, *(r[c] for c in COLUMNS)) for r in found), key=repr)
    assert got == sorted(((r[0], *plain_result(*r[:2])) for r in rows), key=repr)


def test_operator_keeps_other_columns(spark):
    rows = spark.createDataFrame([(1, "x y " * 8 + "z", "en", "old", 5, 6, 7)], SCHEMA)
    row = repeats.find_runs(rows).first()
    assert (row.lang, row.start, row.n_words, row.collapsed) == ("en", 5, 17, "x y z")
    assert [tuple(r) for r in row.runs] == [(0, 16, 2)]


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.op11_suffix_automaton_runs(spark, str(tmp_path)).collect() == []
