"""Quality scores by attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words; only the bag has a label. Every
passage is described by the make-up of its characters and words and encoded by a hidden
layer. A gated attention network weighs the passages of a bag; the score is a logistic
function of their weighted sum. All layers are trained together in numpy, on at most
``2 * SAMPLE`` labelled documents (the documented bound), whose passages' features are
what comes to the driver; scoring runs over all documents and whole texts.

Defined cases: a null text is empty, and a text without words is one passage of zeros;
without labels every score is 0.5; repeated rows are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremorline.llm.common import held_out
from tremorline.llm.hashing import FACTOR, batched, mix, word_hashes
from tremorline.llm.learning import Adam, labelled_sample, sigmoid

PASSAGE = 64
#: Labelled documents of each class, at most, that the classifier is fitted on.
SAMPLE = 2000
HIDDEN, ATTENTION = 16, 8
STEPS, RATE = 400, 0.02


def _classes() -> tuple[np.ndarray, int]:
    """A class for each byte: lower, upper, digit, break, blank, above ASCII, each sign."""
    kind = np.zeros(256, np.int64)
    signs = [i for i in range(33, 127) if not chr(i).isalnum()]
    for i in range(256):
        c = chr(i)
        if i >= 128:
            kind[i] = 5
        elif c.isalpha():
            kind[i] = 0 if c.islower() else 1
        elif c.isdigit():
            kind[i] = 2
        elif i in (10, 13):
            kind[i] = 3
        elif i in signs:
            kind[i] = 6 + signs.index(i)
        else:
            kind[i] = 4
    return kind, 6 + len(signs)


_KIND, _KINDS = _classes()
FEATURES = _KINDS + 7


def passages(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages (row by row) and the number of passages of each text."""
    data = np.frombuffer(b" ".join((t or "").encode() for t in texts) + b" ", np.uint8)
    space = (data == 32) | ((data >= 9) & (data <= 13))
    begins = np.flatnonzero(~space & np.concatenate(([True], space[:-1])))
    hashes, words = word_hashes(texts)
    bags = np.maximum(1, -(-words // PASSAGE))
    first_word = np.cumsum(words) - words
    place = np.arange(len(hashes)) - np.repeat(first_word, words)
    first_bag = np.cumsum(bags) - bags
    of_word = np.repeat(first_bag, words) + place // PASSAGE
    total = int(bags.sum())
    out = np.zeros((total, FEATURES), np.float32)
    if len(hashes):
        # A character belongs to the passage of the last word that began before it.
        of_char = of_word[np.maximum(np.searchsorted(begins, np.arange(len(data)), side="right") - 1, 0)]
        made = np.bincount(of_char * _KINDS + _KIND[data], minlength=total * _KINDS).reshape(total, _KINDS)
        n = np.bincount(of_word, minlength=total)
        chars = np.maximum(made.sum(axis=1), 1)
        some = np.maximum(n, 1)
        out[:, :_KINDS] = np.sqrt(made / chars[:, None])
        starts_upper = np.bincount(of_word, _KIND[data[begins]] == 1, total)
        _, first = np.unique(mix(hashes + of_word.astype(np.uint64) * FACTOR), return_index=True)
        distinct = np.bincount(of_word[first], minlength=total)
        again = np.zeros(len(hashes))
        again[1:] = (hashes[1:] == hashes[:-1]) & (of_word[1:] == of_word[:-1])
        lengths = np.diff(np.append(begins, len(data)))
        out[:, _KINDS] = starts_upper / some
        out[:, _KINDS + 1] = distinct / some
        out[:, _KINDS + 2] = np.bincount(of_word, again, total) / some
        out[:, _KINDS + 3] = np.log1p(chars / some) / 4
        out[:, _KINDS + 4] = np.log1p(np.bincount(of_word, lengths > 16, total) / some)
        out[:, _KINDS + 5] = np.log1p(n) / np.log1p(PASSAGE)
    out[:, _KINDS + 6] = np.repeat(np.log1p(words) / 10, bags)
    return out, bags


class AttentionBags:
    """Encoder, gated attention and logistic output; bags are runs of rows."""

    def __init__(self, seed: int = 7) -> None:
        draw = np.random.default_rng(seed)

        def layer(m: int, n: int) -> np.ndarray:
            return (draw.standard_normal((m, n)) / np.sqrt(m)).astype(np.float32)

        self.p = {
            "encode": layer(FEATURES, HIDDEN), "encode_b": np.zeros(HIDDEN, np.float32),
            "v": layer(HIDDEN, ATTENTION), "u": layer(HIDDEN, ATTENTION), "w": layer(ATTENTION, 1)[:, 0],
            "out": layer(HIDDEN, 1)[:, 0], "out_b": np.zeros(1, np.float32),
        }
        self.mean, self.scale = np.zeros(FEATURES, np.float32), np.ones(FEATURES, np.float32)

    def _forward(self, x: np.ndarray, bags: np.ndarray) -> dict[str, np.ndarray]:
        p, starts = self.p, np.cumsum(bags) - bags
        h = np.tanh(x @ p["encode"] + p["encode_b"])
        tv, su = np.tanh(h @ p["v"]), sigmoid(h @ p["u"])
        raw = (tv * su) @ p["w"]
        raw = raw - np.repeat(np.maximum.reduceat(raw, starts), bags)
        e = np.exp(raw)
        a = e / np.repeat(np.add.reduceat(e, starts), bags)
        z = np.add.reduceat(a[:, None] * h, starts)
        return {"h": h, "tv": tv, "su": su, "a": a, "z": z, "y": sigmoid(z @ p["out"] + p["out_b"])}

    def fit(self, x: np.ndarray, bags: np.ndarray, labels: np.ndarray) -> None:
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 0.02
        x = np.clip((x - self.mean) / self.scale, -6, 6)
        p, adam = self.p, Adam(self.p, RATE, 1e-4)
        share = labels.mean()
        if 0 < share < 1:
            weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
        else:
            weight = np.ones(len(labels))
        starts = np.cumsum(bags) - bags
        for _ in range(STEPS):
            f = self._forward(x, bags)
            dy = (f["y"] - labels) * weight / len(labels)
            g = {"out": f["z"].T @ dy, "out_b": np.array([dy.sum()])}
            dz = np.repeat(dy[:, None] * p["out"], bags, axis=0)
            da = (dz * f["h"]).sum(axis=1)
            draw = f["a"] * (da - np.repeat(np.add.reduceat(f["a"] * da, starts), bags))
            dg = draw[:, None] * p["w"]
            g["w"] = (f["tv"] * f["su"]).T @ draw
            dv, du = dg * f["su"] * (1 - f["tv"] ** 2), dg * f["tv"] * f["su"] * (1 - f["su"])
            g["v"], g["u"] = f["h"].T @ dv, f["h"].T @ du
            dh = (f["a"][:, None] * dz + dv @ p["v"].T + du @ p["u"].T) * (1 - f["h"] ** 2)
            g["encode"], g["encode_b"] = x.T @ dh, dh.sum(axis=0)
            adam(g)

    def __call__(self, x: np.ndarray, bags: np.ndarray) -> np.ndarray:
        return self._forward(np.clip((x - self.mean) / self.scale, -6, 6), bags)["y"]


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality") -> AttentionBags | None:
    """A classifier of the labelled documents that are not held out, or None without any."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in batched(batches, "text"):
            x, bags = passages(texts)
            borders = np.cumsum(np.concatenate(([0], bags)))
            blobs = [x[a:b].tobytes() for a, b in zip(borders[:-1], borders[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label").cast(pa.int32()), pa.array(blobs, pa.binary())],
                names=["doc_id", "label", "x"],
            )

    sample = labelled_sample(docs, labels, label, SAMPLE)
    rows = sample.mapInArrow(describe, "doc_id long, label int, x binary").collect()
    rows = sorted(rows, key=lambda r: (r.doc_id, r.label, r.x))
    if not rows:
        return None
    x = [np.frombuffer(r.x, np.float32).reshape(-1, FEATURES) for r in rows]
    model = AttentionBags()
    model.fit(np.concatenate(x), np.array([len(part) for part in x]), np.array([float(r.label) for r in rows]))
    return model


def score(docs: DataFrame, model: AttentionBags | None) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in batched(batches, "text"):
            y = model(*passages(texts)) if model else np.full(len(texts), 0.5)
            y = np.asarray(y, np.float64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(y), pa.array((y >= 0.5).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select("doc_id", "held_out", "text")
    return rows.mapInArrow(rate, "doc_id long, held_out boolean, score double, predicted int")


def rate_documents(docs: DataFrame, labels: DataFrame, modulus: int = 3, held: int = 1) -> DataFrame:
    docs = docs.withColumn("held_out", held_out("doc_id", modulus, held))
    return score(docs, fit(docs, labels))
