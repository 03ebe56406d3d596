"""Packing documents into sequences: concatenate all ids, then cut.

All documents' ids, a separator after each, form one stream in the order of the tasks that
tokenize them. Two passes give each document its place in the stream:

1. Each task tokenizes its documents, adds up their lengths as it goes, and writes the ids.
2. The tasks' totals are added up in order; a task's base plus the sum within the task is
   a document's place.

Then the stream is cut at every ``SEQUENCE`` ids. Each window that a document lies in gives a
boundary record: which of the document's ids stand where in which sequence. What is left
after the last full window is cut into windows of the powers of two that add up to it, so
no window needs padding.

Texts are never shuffled. Ids are written once, where their task is, and read once.

Defined cases: a null text is empty; an empty document is the separator alone; repeated rows
and null ids are packed each; an empty table gives no rows. Other columns of the input are
not looked at. A document may be cut into any number of pieces.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tremorline.llm.common import written

SEQUENCE = 1024
SEPARATOR = 0
#: Bytes of ids that a task hands on at a time.
ROWS_BYTES = 16_000_000

# The splitting pattern of byte-level vocabularies, and the bytes that such a
# vocabulary spells as themselves; the others follow from code point 256 on, in order.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]

# Characters whose kind (letter, number, blank) every Unicode version tells alike, in words
# and blanks short enough for an encoder whose time grows with the square of a word.
_SIGNS = (
    "!-~\xa1-ɏΑ-ΡΣ-ώЀ-џ‐-‧‰-⁞₠-€"
    "、-〃ぁ-んァ-ヶ一-龥가-힣！-～"
)
_ORDINARY = re.compile(rf"(?:[{_SIGNS}]{{1,500}}+(?![{_SIGNS}])|[ \n\t\r]{{1,500}}+(?![ \n\t\r]))*+")


class ByteIds:
    """Ids of whole texts by a byte-level vocabulary file.

    The vocabulary of the file is also given to a second, faster encoder, if ids are in the order
    of merges, as that one takes it. Ordinary texts go through it; texts with special tokens, with
    other characters or with very long words go through the file's own library.
    """

    def __init__(self, path: str) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            made = json.load(file)
        self.special = [token["content"] for token in made["added_tokens"]]
        split = made["pre_tokenizer"] or {}
        model = made["model"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
        usual = split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
        in_order = all(model["vocab"].get(a + b) == 256 + i for i, (a, b) in enumerate(merges))
        self.fast = None
        if usual and in_order and made["normalizer"] is None and not model.get("ignore_merges"):
            others = [b for b in range(256) if b not in _PRINTED]
            spelled = {chr(b): b for b in _PRINTED} | {chr(256 + i): b for i, b in enumerate(others)}
            ranks = {
                bytes(spelled[c] for c in token): i
                for token, i in model["vocab"].items()
                if token not in self.special
            }
            self.fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str | None) -> np.ndarray:
        text = text or ""
        plain = self.fast and not any(token in text for token in self.special) and _ORDINARY.fullmatch(text)
        ids = self.fast.encode_ordinary(text) if plain else self.exact.encode(text, add_special_tokens=False).ids
        return np.array([*ids, SEPARATOR], "<u4")


def tokenized(docs: DataFrame, path: str) -> DataFrame:
    """The first pass: doc_id, doc_tokens, ids (binary, unsigned 32 bits each), the task
    (``part``), and the number of tokens before the document within it."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, before = ByteIds(path), TaskContext.get().partitionId(), 0
        for batch in batches:
            rows, size = [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encoder(text)
                rows.append((doc_id, len(ids), before, ids.tobytes()))
                before += len(ids)
                size += ids.nbytes
                if size > ROWS_BYTES:
                    yield made(rows, part)
                    rows, size = [], 0
            yield made(rows, part)

    def made(rows: list[tuple], part: int) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * 4
        types = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        arrays = [pa.array(column, kind) for column, kind in zip(columns, types)]
        names = ["doc_id", "doc_tokens", "before", "ids", "part"]
        return pa.RecordBatch.from_arrays([*arrays, pa.array([part] * len(rows), pa.int32())], names=names)

    schema = "doc_id long, doc_tokens long, before long, ids binary, part int"
    return docs.select("doc_id", "text").mapInArrow(encode, schema)


def rest_windows(total: int, sequence: int = SEQUENCE) -> list[tuple[int, int, int]]:
    """The windows after the last full one, as (first place, end, number): one for each
    power of two in what is left, the largest first."""
    full, rest = divmod(total, sequence)
    windows, place = [], full * sequence
    for bit in range(rest.bit_length() - 1, -1, -1):
        if rest >> bit & 1:
            windows.append((place, place + (1 << bit), full + len(windows)))
            place += 1 << bit
    return windows


def pack(docs: DataFrame, path: str, sequence: int = SEQUENCE, *, keep_ids: bool = False) -> DataFrame:
    """The boundary records: doc_id, start (the document's ids before the piece), length,
    ids_crc32, doc_tokens, sequence_id, offset (place in the sequence). ``keep_ids`` adds
    the piece's ids."""
    rows = written(tokenized(docs, path), "ids")
    totals = rows.groupBy("part").agg(F.sum("doc_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each task of the first pass. As a table of its own its size is known, so
    # Spark broadcasts it if it is small, and joins it otherwise.
    bases = totals.select("part", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    bases = written(bases, "bases")
    total = bases.agg(F.sum("n")).first()[0] or 0
    full = total // sequence

    begin = F.col("base") + F.col("before")
    rows = rows.join(bases.select("part", "base"), "part").select(
        "doc_id", "doc_tokens", "ids", begin.alias("begin"), (begin + F.col("doc_tokens")).alias("end")
    )
    first = F.floor(F.col("begin") / sequence)
    last = F.least(F.floor((F.col("end") - 1) / sequence), F.lit(full - 1))
    regular = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<long>"))
    windows = F.transform(
        regular,
        lambda k: F.struct((k * sequence).alias("low"), ((k + 1) * sequence).alias("high"), k.alias("number")),
    )
    rest = [
        F.struct(F.lit(a).cast("long").alias("low"), F.lit(b).cast("long").alias("high"), F.lit(k).cast("long").alias("number"))
        for a, b, k in rest_windows(total, sequence)
    ]
    if rest:
        met = F.filter(F.array(*rest), lambda w: (w["low"] < F.col("end")) & (w["high"] > F.col("begin")))
        windows = F.concat(windows, met)

    def record(window):
        low, high = F.greatest(window["low"], F.col("begin")), F.least(window["high"], F.col("end"))
        start, length = low - F.col("begin"), high - low
        ids = F.substring("ids", (4 * start + 1).cast("int"), (4 * length).cast("int"))
        return F.struct(
            start.alias("start"), length.alias("length"), F.crc32(ids).alias("ids_crc32"),
            window["number"].alias("sequence_id"), (low - window["low"]).alias("offset"),
            *([ids.alias("ids")] if keep_ids else []),
        )

    pieces = rows.select("doc_id", "doc_tokens", F.explode(F.transform(windows, record)).alias("p"))
    columns = ["p.start", "p.length", "p.ids_crc32", "doc_tokens", "p.sequence_id", "p.offset"]
    return pieces.select("doc_id", *columns, *(["p.ids"] if keep_ids else []))
