"""Both of packing's ways to ids against the tokenizer's own library."""

from __future__ import annotations

import json
import random

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tremorline.llm import packing
from tremorline.llm.queries import tokenizer_path

ODD = [
    None, "", " ", "\n\n", "'", "''s", "!'s", "don'T we'LL'd 'sing 're'd '", "l'l 'r 'v it's'm 'l", "'\n   ", "x'",
    "12 3.4a5", "a\x0bb\x0cc\x85d\xa0e", "<|endoftext|>", "a<|ENDOFTEXT|> <|startoftext|>b", "<| endoftext |>",
    "ΑΣ İx é.", "Straße ÉÈ ŒUVRE «où» “x” ½²", "é ́", "日本語、한국어 ＡＢ！", "\U0001f600 a", "\x00a\x1cb",
    "a" * 200, "b" * 201, "-" * 3000, "日" * 250, "a   b", "﻿x", "￿z",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokenizer_path())


@pytest.fixture(scope="module")
def made():
    return packing.end_ranks(tokenizer_path())


def check(encoder, tokenizer, texts):
    found = encoder(texts)
    assert len(found) == len(texts)
    for text, ids in zip(texts, found):
        assert ids.tolist() == [*tokenizer.encode(text or "", add_special_tokens=False).ids, packing.SEPARATOR], text


def test_distinct_ordinary_words_go_round_the_library(monkeypatch):
    """Words that occur once are most of a large vocabulary; each one cost a call before."""

    class Context:
        get = staticmethod(lambda: Context)
        partitionId = staticmethod(lambda: 3)

    def called(self, word):
        raise AssertionError(word)

    draw = random.Random(3)
    words = ["".join(draw.choices("abcdeéß", k=draw.randrange(1, 12))) + draw.choice(["", ",", "'s", "12", "?!"]) for _ in range(9000)]
    texts = [" ".join(words[i : i + 30]).title() for i in range(0, len(words), 30)]

    class Frame:
        def select(self, *columns):
            return self

        def mapInArrow(self, function, schema):
            return function

    monkeypatch.setattr(packing, "TaskContext", Context)
    monkeypatch.setattr(packing.WordIds, "_word", called)
    cut = packing.pieces(Frame(), tokenizer_path(), keep_ids=True)
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    rows = [row for out in cut(iter([batch])) for row in out.to_pylist()]
    whole = Tokenizer.from_file(tokenizer_path())
    assert [np.frombuffer(r["ids"], "<u4").tolist() for r in rows] == [
        [*whole.encode(t, add_special_tokens=False).ids, 0] for t in texts
    ]


def test_odd_texts(tokenizer, made):
    encoder = packing.TextIds(tokenizer_path(), made)
    check(encoder, tokenizer, ODD)
    check(encoder, tokenizer, [])
    for text in ODD:
        check(encoder, tokenizer, [text])
        check(encoder, tokenizer, ["one", text, "it's 2"])


def test_mixed_texts(tokenizer, made):
    draw = random.Random(4)
    parts = [t for t in ODD if t and len(t) < 40] + ["'", "s", "'ll", "re", " ", " ", "\n", "the", "1", ".", "é", "Ü", "tion"]
    texts = ["".join(draw.choices(parts, k=draw.randrange(1, 12))) for _ in range(3000)]
    check(packing.TextIds(tokenizer_path(), made), tokenizer, texts)
    ordinary = list("abcstdmlrve'' .,12ÉßΣ\n-“日가")
    texts = ["".join(draw.choices(ordinary, k=draw.randrange(1, 60))) for _ in range(3000)]
    check(packing.TextIds(tokenizer_path(), made), tokenizer, texts)


def test_every_ordinary_character(tokenizer, made):
    encoder = packing.TextIds(tokenizer_path(), made)
    ordinary = [chr(c) for c in np.flatnonzero(encoder.kinds < packing._OTHER)]
    assert len(ordinary) > 30_000
    texts = [f"a{c}b {c}{c} '{c}s {c}' 1{c} -{c}'s" for c in ordinary]
    assert not len(encoder._ordinary(texts)[1])
    check(encoder, tokenizer, texts)


def test_tokens_come_about_in_one_way(made):
    """The second encoder joins two neighbours whenever their bytes are a token, the library only
    those two that the token was merged of. Both do the same if each token is what merging its own bytes
    gives: neighbours that fill a token's bytes were merged as in the token alone."""
    with open(tokenizer_path(), encoding="utf-8") as file:
        model = json.load(file)["model"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    rank = {(a, b): i for i, (a, b) in enumerate(merges)}
    for a, b in merges:
        own = (a + b).removesuffix("</w>")
        parts = list(own)
        if own != a + b:
            parts[-1] += "</w>"
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: rank.get((parts[i], parts[i + 1]), len(rank)))
            assert (parts[best], parts[best + 1]) in rank
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        assert parts == [a + b]


@pytest.mark.parametrize("change", ["order", "suffix", "splitting", "normalizer", "bytes"])
def test_other_files_go_by_words(tmp_path, change):
    with open(tokenizer_path(), encoding="utf-8") as file:
        made = json.load(file)
    vocab = made["model"]["vocab"]
    if change == "order":
        vocab["in"], vocab["th"] = vocab["th"], vocab["in"]
    elif change == "bytes":
        vocab["a"], vocab["a</w>"] = vocab["a</w>"], vocab["a"]
    elif change == "suffix":
        made["model"]["end_of_word_suffix"] = "@"
    elif change == "splitting":
        made["pre_tokenizer"]["pretokenizers"][0]["invert"] = False
    else:
        made["normalizer"] = None
    path = str(tmp_path / "other.json")
    with open(path, "w", encoding="utf-8") as file:
        json.dump(made, file)
    assert packing.end_ranks(path) is None
    if change in ("order", "bytes"):
        check(packing.TextIds(path, None), Tokenizer.from_file(path), ["in the thin", None, "a it's a 12 anthem"])
