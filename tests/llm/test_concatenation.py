"""Concatenate and cut: exact round trips over texts of all kinds, whole tables, and plans."""

from __future__ import annotations

import collections
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from tremorline.llm import concatenation, queries

ODD = [
    None, "", " ", "\n\n  \n", "one", "I'll  can't 12 34x!?  ", "Ünïcode Straße á 　 x\xa0y\x85z",
    "x" * 30_000, " " * 3000 + "a", "a<|endoftext|>b <|endoftext|> ", "日本語 テスト 한국어 кот Ω ǅ ²½ ٣ 😀👍🏽",
    "tab\tnew\r\nline \x00\x1f", "é ​﻿", "'s't 're'", "word " * 5000,
]
SCHEMA = "doc_id long, text string, ids string, length int, sequence_id int, part int, before int"


@pytest.fixture(scope="module")
def exact():
    return Tokenizer.from_file(queries.byte_tokenizer_path())


def ids_of(exact, text):
    return np.array([*exact.encode(text or "", add_special_tokens=False).ids, 0], "<u4")


def frame(spark, texts, parts=5):
    rows = [(i if i % 7 else None, t, "x", 1, 2, 3, 4) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows + rows[-1:], SCHEMA).repartition(parts)


def test_both_encoders_give_the_same_ids(exact):
    encoder, draw = concatenation.ByteIds(queries.byte_tokenizer_path()), random.Random(2)
    assert encoder.fast
    signs = "ab Zé\n \t'.,19ßœ-—…кΩ日ん한٣²\xa0 😀Ƿ́ǅ"
    texts = ["".join(draw.choices(signs, k=draw.randrange(40))) for _ in range(4000)]
    ordinary = [chr(c) for c in range(0x3000) if concatenation._ORDINARY.fullmatch(chr(c))]
    texts += [f"a{c}{c} {c}1{c}\n {c}" for c in ordinary] + ODD
    assert sum(bool(concatenation._ORDINARY.fullmatch(t or "")) for t in texts) > 1000
    for text in texts:
        assert encoder(text).tolist() == ids_of(exact, text).tolist(), repr(text)


@pytest.mark.parametrize("sequence", [1024, 7])
def test_every_id_has_one_place(spark, exact, sequence):
    draw = random.Random(3)
    texts = [" ".join(draw.choices(["a", "bc", "défi", "12"], k=draw.randrange(300))) for _ in range(60)] + ODD
    rows = concatenation.pack(frame(spark, texts), queries.byte_tokenizer_path(), sequence, keep_ids=True).collect()
    expected = collections.Counter(ids_of(exact, t).tobytes() for t in [*texts, texts[-1]])
    total = sum(len(ids) // 4 * n for ids, n in expected.items())
    sequences = collections.defaultdict(list)
    for r in rows:
        assert len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32 and r.length > 0
        sequences[r.sequence_id].append((r.offset, r))
    stream, lengths = [], []
    for number in range(len(sequences)):
        place = 0
        for offset, r in sorted(sequences[number], key=lambda x: x[0]):
            assert offset == place
            place += r.length
            stream.append(r)
        lengths.append(place)
    full = total // sequence
    assert lengths[:full] == [sequence] * full and sum(lengths) == total
    assert lengths[full:] == [1 << b for b in range(10, -1, -1) if total % sequence >> b & 1]
    # In the order of the stream, pieces put the documents together again.
    found, held = collections.Counter(), b""
    for r in stream:
        assert r.start == len(held) // 4
        held += bytes(r.ids)
        if len(held) == 4 * r.doc_tokens:
            found[held] += 1
            held = b""
    assert not held and found == expected


def test_query_on_the_table(spark, sf_dir, exact):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    own = {r.doc_id: ids_of(exact, r.text) for r in docs}
    rows = queries.op13_concatenate_and_cut(spark, sf_dir).collect()
    pieces = collections.defaultdict(list)
    for r in rows:
        assert r.doc_tokens == len(own[r.doc_id])
        assert zlib.crc32(own[r.doc_id][r.start : r.start + r.length].tobytes()) == r.ids_crc32
        pieces[r.doc_id].append((r.start, r.length))
    for doc_id, found in pieces.items():
        found.sort()
        ends = [a + n for a, n in found]
        assert [a for a, _ in found] == [0, *ends[:-1]] and ends[-1] == len(own[doc_id])
    assert set(pieces) == set(own)


def test_empty_table(spark):
    docs = frame(spark, ["a"]).where("doc_id = 5")
    assert concatenation.pack(docs, queries.byte_tokenizer_path()).collect() == []


def test_texts_and_ids_are_not_shuffled(spark, exact):
    packed = concatenation.pack(frame(spark, ["a b c"] * 20), queries.byte_tokenizer_path())
    plan = packed._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
