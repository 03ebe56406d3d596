"""Packing documents into sequences: length patterns, fitted by non-negative least squares.

The histogram of piece lengths has at most ``SEQUENCE`` entries whatever the corpus
holds, so the plan is made on the driver from it alone:

1. Patterns are multisets of one to three length classes that fill a sequence. Repeat
   counts of the patterns are fitted to the histogram of classes by non-negative least
   squares (active set method) and rounded down.
2. Each pattern is filled with actual lengths of its classes.
3. What is left is packed by best fit, longest first, into the gaps of these sequences
   and into new ones, in groups of equal gaps.

The plan says which ranks of each length go to which sequence and place; pieces get their
ranks by a distributed count, and one join with the plan places them.

Ordinary texts are split in numpy and go through a second, faster encoder made of the same
vocabulary; all others go through the tokenizer's own library, word by word.

Defined cases: a null text is empty; an empty document is one piece of the separator
alone; repeated rows are packed each; an empty table gives no rows. Other columns of
the input are not looked at.
"""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tremorline.llm import concatenation
from tremorline.llm.common import written
from tremorline.llm.hashing import batched

SEQUENCE = 2048
#: Classes of lengths that patterns are made of; sequences have this many parts.
CLASSES = 128
SEPARATOR = 0
#: Words kept with their ids by a task (some 150 bytes each), and texts' bytes that are Python
#: objects at a time (their words and places take some twenty times as much).
CACHE_WORDS = 500_000
LOOKUP_BYTES = 500_000
_PLAIN = re.compile(r"([a-z]+)([.,!?%$#&*;:)(\"]*)")

# What the second encoder takes: the normalizers and the splitting of a vocabulary file.
_NORMALIZERS = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
    {"type": "Lowercase"},
]
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_SPLITS = [
    {"type": "Split", "pattern": {"Regex": _PATTERN}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]
_END = "</w>"
#: Longest piece for the second encoder, whose time grows with the square of it.
LONGEST = 200
_BLANK, _LETTER, _NUMBER, _SIGN, _OTHER, _MARK = range(6)


def end_ranks(path: str) -> tuple[dict[bytes, int], list[str]] | None:
    """The bytes of each token, a blank for its end mark, with its id, and the special tokens.

    None for a file that the second encoder cannot take. It joins the neighbours that give the
    smallest id, so ids have to be in the order of merges, after the bytes without and with the mark.
    """
    with open(path, encoding="utf-8") as file:
        made = json.load(file)
    model, added = made["model"], made["added_tokens"]
    options = [model.get(name) for name in ("continuing_subword_prefix", "dropout", "ignore_merges")]
    if model["type"] != "BPE" or model.get("end_of_word_suffix") != _END or any(options):
        return None
    if (made["normalizer"] or {}).get("normalizers") != _NORMALIZERS or any(t["normalized"] for t in added):
        return None
    if (made["pre_tokenizer"] or {}).get("pretokenizers") != _SPLITS:
        return None
    others = [b for b in range(256) if b not in concatenation._PRINTED]
    spelled = {chr(b): b for b in concatenation._PRINTED} | {chr(256 + i): b for i, b in enumerate(others)}
    vocab = model["vocab"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    inner, last = ({vocab.get(c + end) for c in spelled} for end in ("", _END))
    in_order = all(vocab.get(a + b) == 512 + i for i, (a, b) in enumerate(merges))
    whole = inner == set(range(256)) and last == set(range(256, 512)) and len(vocab) == 512 + len(merges)
    if not (in_order and whole):
        return None
    ranks = {}
    for token, i in vocab.items():
        own = token.removesuffix(_END)
        ranks[bytes(spelled[c] for c in own) + b" " * (own != token)] = i
    return ranks, [token["content"] for token in added]


def _kinds() -> tuple[np.ndarray, np.ndarray]:
    """Kind and lower case of each code point below 65,536; the last one stands for all above."""
    known = re.compile(f"[{concatenation._SIGNS}]")
    kinds, lower = np.full(65536, _OTHER, np.uint8), np.arange(65536, dtype=np.uint32)
    kinds[[*range(9, 14), 32]] = _BLANK
    for code, letter in enumerate(map(chr, range(65535))):
        if known.match(letter) and len(letter.lower()) == 1 and unicodedata.is_normalized("NFC", letter):
            kinds[code] = {"L": _LETTER, "N": _NUMBER}.get(unicodedata.category(letter)[0], _SIGN)
            lower[code] = ord(letter.lower())
    return kinds, lower


class WordIds:
    """Ids of whole texts by a tokenizer that drops white space, word by word.

    Equal words have equal ids, so each distinct word is tokenized once for a task.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._reset()

    def _reset(self) -> None:
        self.index: dict[bytes, int] = {}
        self.flat = np.empty(1 << 16, np.uint32)
        self.begins = array("q", [0])

    def _word(self, word: bytes) -> list[int]:
        text = word.decode()
        plain = _PLAIN.fullmatch(text)
        if plain is None:
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        # Lower-case letters, then signs: two runs that the tokenizer's own splitting
        # keeps apart and its normalizer leaves as they are.
        tokenize = self.tokenizer.model.tokenize
        return [t.id for part in plain.groups() if part for t in tokenize(part)]

    def __call__(self, texts: list[str | None]) -> list[np.ndarray]:
        """One array of ids for each text."""
        if len(self.index) > CACHE_WORDS:
            self._reset()
        index, codes, counts = self.index, [], []
        known = len(index)
        for text in texts:
            data = (text or "").encode()
            # Special tokens are matched before letters are lowered, so keep their case.
            words = (data if b"<|" in data else data.lower()).split()
            codes.extend([index.setdefault(w, len(index)) for w in words])
            counts.append(len(words))
        for word in islice(index, known, None):
            ids = self._word(word)
            begin = self.begins[-1]
            if begin + len(ids) > len(self.flat):
                self.flat = np.concatenate((self.flat, np.empty(max(len(self.flat), len(ids)), np.uint32)))
            self.flat[begin : begin + len(ids)] = ids
            self.begins.append(begin + len(ids))
        begins = np.array(self.begins)
        at = np.array(codes, np.int64)
        first, lengths = begins[at], begins[at + 1] - begins[at]
        before = np.cumsum(lengths) - lengths
        ids = self.flat[np.repeat(first - before, lengths) + np.arange(lengths.sum())]
        words_before = np.cumsum([0, *counts])
        borders = np.append(before, len(ids))[words_before]
        return [ids[a:b] for a, b in zip(borders[:-1], borders[1:])]


class TextIds:
    """Ids of whole texts, each with ``SEPARATOR`` after it.

    Texts of characters whose kind every Unicode version tells alike go through the second
    encoder; others, those with special tokens and those with very long words through ``WordIds``.
    """

    def __init__(self, path: str, made: tuple[dict[bytes, int], list[str]] | None) -> None:
        import tiktoken

        self.path, self.words, self.encoder = path, None, None
        if made:
            ranks, self.special = made
            # A split word comes with one blank after it, and "\n " for the end of a text.
            # Words hold no white space, so no other piece gives the id of that.
            self.encoder = tiktoken.Encoding("own", pat_str=r"[^ ]+ ", mergeable_ranks=ranks, special_tokens={})
            self.end_of_text = ranks[b"\n "]
            self.kinds, self.lower = _kinds()

    def __call__(self, texts: list[str | None]) -> list[np.ndarray]:
        """One array of ids for each text."""
        texts = [text or "" for text in texts]
        if not self.encoder:
            return self._by_words(texts)
        found, odd = self._ordinary(texts)
        if len(odd):
            for i, own in zip(odd, self._by_words([texts[i] for i in odd])):
                found[i] = own
        return found

    def _by_words(self, texts: list[str]) -> list[np.ndarray]:
        self.words = self.words or WordIds(self.path)
        return [np.append(own, np.uint32(SEPARATOR)) for own in self.words(texts)]

    def _ordinary(self, texts: list[str]) -> tuple[list[np.ndarray], np.ndarray]:
        """Ids of all texts, and the numbers of those whose ids are not to be taken."""
        # Three blanks at the end, so that places after a sign can be looked at.
        codes = np.frombuffer(("\n".join(texts) + "\n   ").encode("utf-32-le"), "<u4")
        places = np.minimum(codes, 65535)
        kinds, codes = self.kinds[places], self.lower[places]
        del places
        ends = np.cumsum([len(text) + 1 for text in texts], dtype=np.int64)
        kinds[ends - 1] = _MARK

        # A piece is a run of letters or signs, or one number.
        begins = np.empty(len(kinds), bool)
        begins[0] = True
        np.not_equal(kinds[1:], kinds[:-1], out=begins[1:])
        begins |= (kinds == _NUMBER) | (kinds == _MARK)
        self._contractions(codes, kinds, begins)
        filled = kinds != _BLANK
        begins &= filled
        last = np.append(filled[:-1] & (begins[1:] | ~filled[1:]), False)

        odd = {i for i, text in enumerate(texts) if any(token in text for token in self.special)}
        starts = np.flatnonzero(begins)
        long = starts[np.flatnonzero(last) - starts >= LONGEST]
        strange = np.concatenate((np.flatnonzero(kinds == _OTHER), long))
        odd.update(np.searchsorted(ends, strange, "right").tolist())
        odd = np.array(sorted(odd), np.int64)
        for i in odd:
            begin, end = ends[i] - len(texts[i]) - 1, ends[i] - 1
            filled[begin:end] = last[begin:end] = False

        times = filled.astype(np.uint8) + last
        out = np.repeat(codes, times)
        out[np.cumsum(times, dtype=np.int64)[last] - 1] = 32
        spaced = out.tobytes().decode("utf-32-le")
        del codes, kinds, begins, filled, last, times, out, starts
        ids = np.array(self.encoder.encode_ordinary(spaced), np.uint32)
        borders = np.flatnonzero(ids == self.end_of_text) + 1
        ids[borders - 1] = SEPARATOR
        return [ids[a:b] for a, b in zip([0, *borders[:-1].tolist()], borders.tolist())], odd

    @staticmethod
    def _contractions(codes: np.ndarray, kinds: np.ndarray, begins: np.ndarray) -> None:
        """'s, 't, 're, 've, 'm, 'll and 'd are pieces where no other sign is before them."""
        at = np.flatnonzero((codes[:-3] == ord("'")) & begins[:-3])
        pairs = codes[at + 1] << 16 | codes[at + 2]
        one = np.isin(codes[at + 1], [ord(c) for c in "stmd"])
        two = np.isin(pairs, [ord(a) << 16 | ord(b) for a, b in ("re", "ve", "ll")])
        begins[at[one | two] + 1] = False
        begins[at[one] + 2] = True
        begins[at[two] + 3] = True


def pieces(docs: DataFrame, path: str, *, keep_ids: bool = False) -> DataFrame:
    """Documents' ids, a separator after each, cut into pieces of at most ``SEQUENCE``.

    ``part`` and ``nth`` number the pieces of one length within one task.
    """
    made = end_ranks(path)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = TextIds(path, made)
        part = TaskContext.get().partitionId()
        seen: dict[int, int] = defaultdict(int)
        for batch, texts in batched(batches, "text", LOOKUP_BYTES):
            rows = _cut(batch.column("doc_id").to_pylist(), texts, lookup, seen)
            columns = list(zip(*rows)) or [()] * 7
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types)]
            arrays.append(pa.array([part] * len(rows), pa.int32()))
            if not keep_ids:
                del arrays[6]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    def _cut(ids: list, texts: list, lookup: TextIds, seen: dict[int, int]) -> list[tuple]:
        rows = []
        for doc_id, found in zip(ids, lookup(texts)):
            own = found.astype("<u4", copy=False)
            for piece, start in enumerate(range(0, len(own), SEQUENCE)):
                data = own[start : start + SEQUENCE].tobytes()
                length = len(data) // 4
                rows.append(
                    (doc_id, piece, start, length, zlib.crc32(data), seen[length], data if keep_ids else None)
                )
                seen[length] += 1
        return rows

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, nth long, ids binary, part int"
    if not keep_ids:
        schema = schema.replace(" ids binary,", "")
    names = [column.split()[0] for column in schema.split(", ")]
    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def patterns(classes: int = CLASSES) -> np.ndarray:
    """All multisets of up to three classes (1 to ``classes``) that add up to ``classes``."""
    a, b = np.meshgrid(np.arange(classes + 1), np.arange(classes + 1), indexing="ij")
    c = classes - a - b
    ok = (a <= b) & (b <= c)
    return np.stack((a[ok], b[ok], c[ok]), axis=1)


def non_negative_least_squares(a: np.ndarray, h: np.ndarray, rounds: int = 1000) -> np.ndarray:
    """x >= 0 that makes a @ x closest to h, with an active set of columns."""
    gram, target = a.T @ a, a.T @ h
    x = np.zeros(a.shape[1])
    active = np.zeros(a.shape[1], bool)
    tolerance = 1e-9 * max(1.0, float(np.abs(target).max(initial=0)))
    for _ in range(rounds):
        gradient = np.where(active, -np.inf, target - gram @ x)
        best = int(gradient.argmax())
        if gradient[best] <= tolerance:
            break
        active[best] = True
        while True:
            on = np.flatnonzero(active)
            fitted = np.linalg.lstsq(gram[np.ix_(on, on)], target[on], rcond=None)[0]
            if fitted.min() > 0:
                x[:] = 0
                x[on] = fitted
                break
            negative = fitted <= 0
            step = (x[on][negative] / np.maximum(x[on][negative] - fitted[negative], 1e-300)).min()
            x[on] += step * (fitted - x[on])
            off = on[(x[on] <= 1e-12) & negative]
            if not len(off):
                off = on[negative]
            active[off] = False
            x[off] = 0
    return x


def plan(histogram: dict[int, int], sequence: int = SEQUENCE) -> list[tuple[tuple[int, ...], int]]:
    """Groups of equal sequences: the lengths in each, and how many there are of it.

    A group's count stands for any number of sequences, so the plan's size depends on the
    number of distinct lengths only.
    """
    left = np.zeros(sequence + 1, np.int64)
    for length, n in histogram.items():
        left[length] = n
    groups: list[tuple[tuple[int, ...], int]] = []
    if left[sequence]:
        groups.append(((sequence,), int(left[sequence])))
        left[sequence] = 0

    width = max(1, sequence // CLASSES)
    classes = sequence // width
    class_of = -(-np.arange(sequence + 1) // width)
    counts = np.bincount(class_of, left, classes + 1)[1 : classes + 1]
    made = patterns(classes)
    matrix = np.zeros((classes + 1, len(made)))
    for column in made.T:
        np.add.at(matrix, (column, np.arange(len(made))), 1.0)
    repeats = np.floor(non_negative_least_squares(matrix[1:], counts) + 1e-6).astype(int)
    open_groups: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)

    def close(lengths: tuple[int, ...], n: int) -> None:
        open_groups[sequence - sum(lengths)].append((lengths, n))

    for k in np.flatnonzero(repeats):
        wanted = [int(c) for c in made[k] if c]
        todo = int(repeats[k])
        while todo:
            # The last length may fill what the others leave of their classes.
            chosen: list[int] = []
            for i, c in enumerate(wanted):
                top = c * width if i < len(wanted) - 1 else sequence - sum(chosen)
                options = range(top, (c - 1) * width, -1)
                own = next((x for x in options if left[x] > chosen.count(x)), None)
                if own is None:
                    break
                chosen.append(own)
            if len(chosen) < len(wanted):
                break
            n = min([todo, *(int(left[x]) // chosen.count(x) for x in chosen)])
            for x in chosen:
                left[x] -= n
            close(tuple(chosen), n)
            todo -= n

    for length in range(sequence - 1, 0, -1):
        n = int(left[length])
        while n:
            gap = min((g for g, found in open_groups.items() if g >= length and found), default=None)
            if gap is None:
                fit = sequence // length
                if n >= fit:
                    close((length,) * fit, n // fit)
                    n -= n // fit * fit
                else:
                    close((length,) * n, 1)
                    n = 0
                continue
            lengths, m = open_groups[gap].pop()
            take = min(m, n)
            if m > take:
                open_groups[gap].append((lengths, m - take))
            close((*lengths, length), take)
            n -= take
    return groups + [group for found in open_groups.values() for group in found]


def slots(groups: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """For each length the ranks [low, high) that a group takes, its first sequence, and
    the place in the sequence."""
    used: dict[int, int] = defaultdict(int)
    rows, first = [], 0
    for lengths, n in groups:
        place = 0
        for length in lengths:
            rows.append((length, used[length], used[length] + n, first, place))
            used[length] += n
            place += length
        first += n
    return rows


def pack(docs: DataFrame, path: str, *, keep_ids: bool = False) -> DataFrame:
    """Pieces with sequence_id and offset; ``keep_ids`` adds the ids themselves (binary,
    unsigned 32 bits each, little-endian)."""
    spark: SparkSession = docs.sparkSession
    cut = written(pieces(docs, path, keep_ids=keep_ids), "pieces")
    per_part = cut.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    per_part = written(per_part, "lengths")
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_part.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    histogram = {row.length: row.n for row in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}

    # A length's ranges follow each other without gaps, so a rank's range is found among
    # the range ends of its length. At most a few thousand rows for any corpus.
    rows = slots(plan(histogram))
    ranges = spark.createDataFrame(rows, "length long, low long, high long, first long, offset long")
    by_length = ranges.groupBy("length").agg(
        F.sort_array(F.collect_list(F.struct("high", "low", "first", "offset"))).alias("ranges")
    )
    ranked = cut.join(bases, ["length", "part"]).withColumn("rank", F.col("base") + F.col("nth"))
    placed = ranked.join(F.broadcast(by_length), "length").withColumn(
        "slot", F.filter("ranges", lambda r: (r["low"] <= F.col("rank")) & (F.col("rank") < r["high"]))[0]
    )
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if keep_ids else [])]
    return placed.select(
        *columns,
        (F.col("slot.first") + F.col("rank") - F.col("slot.low")).alias("sequence_id"),
        F.col("slot.offset").alias("offset"),
    )
