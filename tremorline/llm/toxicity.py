"""Toxicity scores by a bidirectional gated recurrent network with attention pooling.

The network reads overlapping windows of ``WINDOW`` words. A word's input is the
embedding of the word, if the vocabulary has it, the mean embedding of the character
trigrams it is spelled with, and a learned direction times the word's lift: the logarithm of how
much more often than by chance the word is in toxic documents, shrunk to 0 for rare words. Two gated recurrent layers read the window in both
directions, attention pools their states, and a logistic function scores the window. A
document's score is that of its most toxic window, and all windows of the whole text
are scored.

Only documents have labels. So training alternates: all windows of the sample are
scored, and the network learns on each document's highest windows, as its label says. It is
trained in numpy on at most ``2 * SAMPLE`` labelled documents (the documented bound). For
training the lifts come from other folds of the sample than the document's own, and the
embeddings of some words are left out, so that words of single documents are no evidence.

Defined cases: a text that is null or has no word has score 0; without labels of both
kinds every score is 0; repeated rows are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tremorline.llm.common import held_out
from tremorline.llm.hashing import batched
from tremorline.llm.learning import Adam, labelled_sample, positive_share, sigmoid

#: Labelled documents of each class, at most, that the network is fitted on.
SAMPLE = 1500
WINDOW, STRIDE = 32, 24
INPUT, HIDDEN, ATTENTION = 12, 8, 8
VOCABULARY, LEAST_DOCUMENTS, TRIGRAMS = 20_000, 3, 8192
ROUNDS, PASSES, RATE = 10, 2, 0.01
BLOCK = 2048
#: Folds that lifts come from, documents that shrink them, share of words left out in training.
FOLDS, SHRINK, LEFT_OUT = 4, 2.0, 0.3
THRESHOLD = 0.3
# Letters stay, what else ASCII has separates words.
_TABLE = bytes(i if i >= 128 or chr(i).isalnum() else 32 for i in range(256))


def split_words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(_TABLE).split()


def trigrams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the character trigrams of words (with a mark at both ends), and how many
    each word has."""
    data = np.frombuffer(b"".join(b"\x01" + w + b"\x02" for w in words), np.uint8).astype(np.int64)
    bucket = ((data[:-2] * 961 + data[1:-1]) * 961 + data[2:]) % 1_000_003 % TRIGRAMS
    counts = np.array([len(w) for w in words], np.int64)
    starts = np.cumsum(counts + 2) - (counts + 2)
    inside = np.repeat(starts - np.concatenate(([0], np.cumsum(counts)[:-1])), counts) + np.arange(counts.sum())
    return bucket[inside], counts


class Network:
    def __init__(self, vocabulary: list[bytes], seed: int = 11) -> None:
        draw = np.random.default_rng(seed)

        def layer(*shape: int) -> np.ndarray:
            return (draw.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

        self.index = {w: i + 1 for i, w in enumerate(vocabulary)}
        self.lifts = np.zeros(len(vocabulary) + 1, np.float32)
        self.bias_shift = 0.0
        self.p = {
            "words": (0.1 * draw.standard_normal((len(vocabulary) + 1, INPUT))).astype(np.float32),
            "chars": (0.3 * draw.standard_normal((TRIGRAMS, INPUT))).astype(np.float32),
            "lift": layer(INPUT, 1)[:, 0],
            "attend": layer(2 * HIDDEN, ATTENTION), "attend_v": layer(ATTENTION, 1)[:, 0],
            "out": layer(2 * HIDDEN, 1)[:, 0], "out_b": np.full(1, -1.0, np.float32),
        }
        for side in "fb":
            self.p |= {
                f"in_{side}": layer(INPUT, 3 * HIDDEN), f"in_b_{side}": np.zeros(3 * HIDDEN, np.float32),
                f"rec_{side}": layer(HIDDEN, 3 * HIDDEN),
            }

    def inputs(
        self, words: list[bytes], lifts: np.ndarray | None = None, left_out: np.ndarray | None = None
    ) -> tuple[np.ndarray, tuple]:
        """Input vectors of words, a row of zeros (for padding) last. ``lifts`` stand in for the
        vocabulary's; the embeddings of words that are ``left_out`` are not used."""
        known = np.array([self.index.get(w, 0) for w in words], np.int64)
        lifts = self.lifts[known] if lifts is None else lifts
        if left_out is not None:
            known = np.where(left_out, 0, known)
        bucket, counts = trigrams(words)
        spelled = np.add.reduceat(self.p["chars"][bucket], np.cumsum(counts) - counts) / counts[:, None]
        x = self.p["words"][known] * (known > 0)[:, None] + spelled + lifts[:, None] * self.p["lift"]
        return np.vstack((x, np.zeros((1, INPUT)))).astype(np.float32), (known, bucket, counts, lifts)

    def _read(self, side: str, given: np.ndarray, windows: np.ndarray, real: np.ndarray, keep: list | None) -> np.ndarray:
        """States of one direction, (window, place, HIDDEN); ``given``: inputs already
        multiplied by the input layer."""
        m, n = windows.shape
        states = np.empty((n, m, HIDDEN), np.float32)
        h, rec = np.zeros((m, HIDDEN), np.float32), self.p[f"rec_{side}"]
        for t in range(n) if side == "f" else range(n - 1, -1, -1):
            a, b = given[windows[:, t]], h @ rec
            gates = 1 / (1 + np.exp(-(a[:, : 2 * HIDDEN] + b[:, : 2 * HIDDEN])))
            z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
            c = np.tanh(a[:, 2 * HIDDEN :] + r * b[:, 2 * HIDDEN :])
            after = (c + z * (h - c)) * real[:, t, None]
            if keep is not None:
                keep.append((t, h, z, r, c, b[:, 2 * HIDDEN :]))
            h = states[t] = after
        return states

    def forward(self, x: np.ndarray, windows: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """Logit of each window; windows hold rows of ``x``, padding is its last row."""
        real = (windows != len(x) - 1).astype(np.float32)
        steps = {side: [] if keep is not None else None for side in "fb"}
        both = []
        for side in "fb":
            given = x @ self.p[f"in_{side}"] + self.p[f"in_b_{side}"]
            both.append(self._read(side, given, windows, real, steps[side]))
        s = np.concatenate(both, axis=2)
        t = np.tanh(s @ self.p["attend"])
        raw = t @ self.p["attend_v"] - 1e4 * (1 - real.T)
        e = np.exp(raw - raw.max(axis=0))
        a = e / e.sum(axis=0)
        pooled = np.einsum("tm,tmh->mh", a, s)
        if keep is not None:
            keep.update(real=real, steps=steps, s=s, t=t, a=a, pooled=pooled)
        return pooled @ self.p["out"] + self.p["out_b"][0]

    def gradients(self, x: np.ndarray, made: tuple, windows: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> dict:
        p, keep = self.p, {}
        d = (sigmoid(self.forward(x, windows, keep)) - labels) * weight / len(labels)
        s, t, a, real = keep["s"], keep["t"], keep["a"], keep["real"]
        g = {"out": keep["pooled"].T @ d, "out_b": np.array([d.sum()])}
        dpool = d[:, None] * p["out"]
        ds = a[:, :, None] * dpool[None]
        da = np.einsum("tmh,mh->tm", s, dpool)
        draw = a * (da - (a * da).sum(axis=0))
        dt = draw[:, :, None] * p["attend_v"] * (1 - t * t)
        g["attend_v"] = np.einsum("tmk,tm->k", t, draw)
        g["attend"] = np.einsum("tmh,tmk->hk", s, dt)
        ds = ds + dt @ p["attend"].T
        dx = np.zeros((len(x), INPUT))
        for i, side in enumerate("fb"):
            rec, win = p[f"rec_{side}"], p[f"in_{side}"]
            g[f"rec_{side}"] = np.zeros_like(rec)
            dgiven = np.zeros((len(x), 3 * HIDDEN))
            dh = np.zeros((len(windows), HIDDEN))
            for place, h, z, r, c, bc in reversed(keep["steps"][side]):
                dh = (dh + ds[place, :, i * HIDDEN : (i + 1) * HIDDEN]) * real[:, place, None]
                dc = dh * (1 - z) * (1 - c * c)
                dz = dh * (h - c) * z * (1 - z)
                dr = dc * bc * r * (1 - r)
                db = np.concatenate((dz, dr, dc * r), axis=1)
                np.add.at(dgiven, windows[:, place], np.concatenate((dz, dr, dc), axis=1))
                g[f"rec_{side}"] += h.T @ db
                dh = dh * z + db @ rec.T
            g[f"in_{side}"], g[f"in_b_{side}"] = x.T @ dgiven, dgiven.sum(axis=0)
            dx += dgiven @ win.T
        known, bucket, counts, lifts = made
        g["lift"] = lifts @ dx[:-1]
        g["words"], g["chars"] = np.zeros_like(p["words"]), np.zeros_like(p["chars"])
        np.add.at(g["words"], known, dx[:-1] * (known > 0)[:, None])
        np.add.at(g["chars"], bucket, np.repeat(dx[:-1] / counts[:, None], counts, axis=0))
        return g


def windows_of(counts: np.ndarray, codes: np.ndarray, padding: int) -> tuple[np.ndarray, np.ndarray]:
    """All overlapping windows over documents' word codes, and the document of each."""
    n = np.where(counts > 0, np.maximum(1, -(-(counts - (WINDOW - STRIDE)) // STRIDE)), 0)
    of = np.repeat(np.arange(len(counts)), n)
    place = (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)) * STRIDE
    first = np.cumsum(counts) - counts
    at = place[:, None] + np.arange(WINDOW)
    inside = at < counts[of][:, None]
    index = np.where(inside, first[of][:, None] + at, 0)
    return np.where(inside, codes[index] if len(codes) else padding, padding), of


def _encoded(texts: list[str | None]) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """How many words each text has, the distinct words, and the words as numbers of these.
    Only one text's words are held as objects at a time."""
    index: dict[bytes, int] = {}
    codes = [np.array([index.setdefault(w, len(index)) for w in split_words(t)], np.int32) for t in texts]
    counts = np.array([len(own) for own in codes], np.int64)
    return counts, list(index), np.concatenate(codes) if codes else np.empty(0, np.int32)


def _all_inputs(network: Network, words: list[bytes], lifts: np.ndarray, step: int = 20_000) -> np.ndarray:
    """``inputs`` of many words, with the trigrams of ``step`` of them at a time."""
    parts = [network.inputs(words[i : i + step], lifts[i : i + step])[0][:-1] for i in range(0, len(words), step)]
    return np.vstack([*parts, np.zeros((1, INPUT), np.float32)])


def document_logits(network: Network, texts: list[str | None]) -> np.ndarray:
    """The highest logit of all windows of each text; minus infinity without words."""
    counts, distinct, codes = _encoded(texts)
    out = np.full(len(texts), -np.inf)
    if len(codes):
        x, _ = network.inputs(distinct)
        windows, of = windows_of(counts, codes, len(distinct))
        for i in range(0, len(windows), BLOCK):
            np.maximum.at(out, of[i : i + BLOCK], network.forward(x, windows[i : i + BLOCK]))
    return out


def _vocabulary(distinct: list[bytes], documents: np.ndarray) -> list[bytes]:
    """The words that most documents have, of the number of documents each word is in."""
    often = [(-int(documents[i]), distinct[i]) for i in np.flatnonzero(documents >= LEAST_DOCUMENTS)]
    return [w for _, w in sorted(often)[:VOCABULARY]]


def _lifts(toxic: np.ndarray, clean: np.ndarray, share: float) -> np.ndarray:
    """How much more often than by chance words are in toxic documents (a logarithm), of the
    documents of both kinds that they are in and the share of toxic ones."""
    return np.log((toxic + SHRINK) / ((toxic + clean) * share + SHRINK))


def train(texts: list[str], labels: list[int], share: float, seed: int = 5) -> Network | None:
    """A network for documents with labels; ``share`` is that of label 1 in the corpus."""
    if len(set(labels)) < 2:
        return None
    y = np.array(labels, np.float64)
    counts, distinct, codes = _encoded(texts)
    windows, of = windows_of(counts, codes, len(distinct))
    windows = windows.astype(np.int32)

    # The documents that each word is in, by fold and label.
    seen = np.unique(np.repeat(np.arange(len(texts)), counts) * (len(distinct) + 1) + codes)
    doc, word = seen // (len(distinct) + 1), seen % (len(distinct) + 1)
    fold = np.zeros(len(texts), np.int64)
    for label in (0, 1):
        fold[y == label] = np.arange((y == label).sum()) % FOLDS
    toxic, clean = (
        np.stack([np.bincount(word, own[doc] * (fold[doc] == k), len(distinct)) for k in range(FOLDS)])
        for own in (y, 1 - y)
    )
    del seen, doc, word
    network = Network(_vocabulary(distinct, (toxic + clean).sum(axis=0)))
    known = np.array([network.index.get(w, 0) for w in distinct], np.int64)
    network.lifts[known] = _lifts(toxic.sum(axis=0), clean.sum(axis=0), y.mean())
    network.lifts[0] = 0
    apart = [
        _lifts(toxic.sum(axis=0) - toxic[k], clean.sum(axis=0) - clean[k], y.mean()) * (known > 0) for k in range(FOLDS)
    ]
    apart = np.stack(apart).astype(np.float32)

    # The first choice of windows: words that only toxic documents have stand out.
    scores = np.empty(len(windows))
    for k in range(FOLDS):
        own, odds = np.flatnonzero(fold[of] == k), np.append(np.maximum(apart[k], 0), 0)
        for i in range(0, len(own), BLOCK):
            scores[own[i : i + BLOCK]] = odds[windows[own[i : i + BLOCK]]].sum(axis=1)

    draw, adam = np.random.default_rng(seed), Adam(network.p, RATE, 1e-6)
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    width = len(distinct) + 1
    for turn in range(ROUNDS):
        for k in range(FOLDS) if turn else ():
            own, x = np.flatnonzero(fold[of] == k), _all_inputs(network, distinct, apart[k])
            for i in range(0, len(own), BLOCK):
                scores[own[i : i + BLOCK]] = network.forward(x, windows[own[i : i + BLOCK]])
        order = np.lexsort((-scores, of))
        rank = np.arange(len(order)) - np.searchsorted(of[order], of[order])
        # Of a toxic document its highest window, of a clean one the two highest and others.
        chosen = order[(rank == 0) | ((y[of[order]] == 0) & ((rank == 1) | (draw.random(len(order)) < 0.05)))]
        for _ in range(PASSES):
            draw.shuffle(chosen)
            step = min(256, max(16, len(chosen) // 24))
            for i in range(0, len(chosen), step):
                part = chosen[i : i + step]
                own = of[part]
                # One word has an input for each fold; padding comes last.
                pairs = np.where(windows[part] < len(distinct), fold[own][:, None] * width + windows[part], FOLDS * width)
                used, local = np.unique(pairs, return_inverse=True)
                used = used[used < FOLDS * width]
                lifts = apart[used // width, used % width]
                x, made = network.inputs([distinct[u] for u in used % width], lifts, draw.random(len(used)) < LEFT_OUT)
                adam(network.gradients(x, made, local.reshape(len(part), -1), y[own], weight[own]))
    # The sample holds the classes in other shares than the corpus.
    even = min(max(share, 1e-4), 1 - 1e-4)
    network.bias_shift = float(np.log(even / (1 - even)))
    return network


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> Network | None:
    rows = labelled_sample(docs, labels, label, SAMPLE).select("doc_id", "text", "label").collect()
    rows = sorted(rows, key=lambda r: (r.doc_id, r.label, r.text or ""))
    return train([r.text for r in rows], [r.label for r in rows], positive_share(docs, labels, label))


def with_score(docs: DataFrame, network: Network | None) -> DataFrame:
    """``docs`` (all columns but older ones of these names) with score and predicted."""

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        if shared.value:
            held = Network([])
            held.__dict__.update(shared.value)
        for batch, texts in batched(batches, "text"):
            logits = document_logits(held, texts) if held else np.full(len(texts), -np.inf)
            y = np.where(np.isfinite(logits), sigmoid(logits + (held.bias_shift if held else 0)), 0.0)
            columns = [batch.column(f.name) for f in kept]
            columns += [pa.array(y), pa.array((y >= THRESHOLD).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    shared = docs.sparkSession.sparkContext.broadcast(network and vars(network))
    kept = [f for f in docs.schema.fields if f.name not in ("score", "predicted")]
    names = [f.name for f in kept] + ["score", "predicted"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return docs.mapInArrow(rate, f"{schema}, score double, predicted int")


def rate_documents(docs: DataFrame, labels: DataFrame, modulus: int = 4, held: int = 2) -> DataFrame:
    docs = docs.withColumn("held_out", held_out("doc_id", modulus, held))
    return with_score(docs, fit(docs, labels))
