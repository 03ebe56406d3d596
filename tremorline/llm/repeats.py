"""Runs: stretches of consecutive words that repeat with a period, in whole texts.

A run is as long as it can be with its smallest period, and at least ``max(LEAST, 2 * period)``
words long. Runs are found with a suffix automaton and link-cut access:

1. The automaton of a stretch of words gives the tree of its suffix links. The words up to
   place i end in one state, and the path from there to the root holds all suffixes.
2. Place by place, that path is accessed. It falls into segments that were last passed at
   one earlier place each. A segment of length L last passed at j says that the L words up to
   i and up to j are equal, and no more. With i - j <= L they make a square of period i - j,
   that begins i - j + L words back.
3. Access makes the path one segment of the colour i, as link-cut trees do: segments are
   splay trees, so a text of n words takes O(n log n) steps.
4. Squares of one beginning and period are one run, extended to the last of their ends.

Words are numbered before that, and what cannot be in a run is left out: each word of a run lies
in six words that its run holds twice. So texts are cut where six words occur once, again and
again until nothing changes. This is exact, and most texts have nothing left.

Each text is handled by itself, in batches of bounded size; there is no shuffle.

Defined cases: a null text has no words, and empty texts no runs; words are compared as they
are spelled; repeated rows and null ids get a result each; an empty table gives no rows. All
columns are kept but older ones of the names of the results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tremorline.llm.hashing import FACTOR, batched, mix, word_hashes

#: Words in the shortest run.
LEAST = 12
#: Words that occur twice in a run wherever one looks: half of ``LEAST``.
GRAM = LEAST // 2
RUN_TYPE = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


class SuffixAutomaton:
    """States of all substrings of a list of numbers: lengths, links, and the state of
    each prefix."""

    def __init__(self, words: list[int]) -> None:
        steps: list[dict[int, int]] = [{}]
        self.length, self.link, self.prefix = [0], [-1], []
        length, link, last = self.length, self.link, 0
        for i, word in enumerate(words):
            state = len(length)
            length.append(i + 1)
            link.append(0)
            steps.append({})
            p = last
            while p >= 0 and word not in steps[p]:
                steps[p][word] = state
                p = link[p]
            if p >= 0:
                q = steps[p][word]
                if length[q] != length[p] + 1:
                    copy = len(length)
                    length.append(length[p] + 1)
                    link.append(link[q])
                    steps.append(dict(steps[q]))
                    while p >= 0 and steps[p].get(word) == q:
                        steps[p][word] = copy
                        p = link[p]
                    link[q] = copy
                    q = copy
                link[state] = q
            last = state
            self.prefix.append(state)


class LastPassed:
    """Link-cut access to the tree of suffix links: which place passed a node last.

    The nodes that one place passed last form a vertical path, a splay tree by depth.
    The root of each splay tree has the colour of all of it.
    """

    def __init__(self, parents: list[int]) -> None:
        n = len(parents)
        self.parent, self.upper, self.lower = list(parents), [-1] * n, [-1] * n
        self.colour = [-1] * n

    def _splay(self, x: int) -> None:
        parent, upper, lower = self.parent, self.upper, self.lower
        top = x
        while True:
            p = parent[x]
            if p < 0 or (upper[p] != x and lower[p] != x):
                break
            g = parent[p]
            inner = g >= 0 and (upper[g] == p or lower[g] == p)
            if not inner:
                top = p
                self._rotate(x, p)
            elif (upper[g] == p) == (upper[p] == x):
                self._rotate(p, g)
                self._rotate(x, p)
                top = g
            else:
                self._rotate(x, p)
                self._rotate(x, g)
                top = g
        # The last node that went below x was the tree's root.
        self.colour[x] = self.colour[top]

    def _rotate(self, x: int, p: int) -> None:
        parent, upper, lower = self.parent, self.upper, self.lower
        g = parent[p]
        if g >= 0:
            if upper[g] == p:
                upper[g] = x
            elif lower[g] == p:
                lower[g] = x
        parent[x] = g
        if upper[p] == x:
            child = upper[p] = lower[x]
            lower[x] = p
        else:
            child = lower[p] = upper[x]
            upper[x] = p
        if child >= 0:
            parent[child] = p
        parent[p] = x

    def access(self, node: int, place: int) -> Iterator[tuple[int, int]]:
        """The segments above ``node``, as (deepest node, place that passed it last), and
        all of the path passed by ``place``."""
        parent, lower, colour = self.parent, self.lower, self.colour
        below, x = -1, node
        while x >= 0:
            self._splay(x)
            if colour[x] >= 0:
                yield x, colour[x]
            if lower[x] >= 0:
                colour[lower[x]] = colour[x]
            lower[x] = below
            below, x = x, parent[x]
        self._splay(node)
        colour[node] = place


def runs_of(words: list[int], least: int = LEAST) -> list[tuple[int, int, int]]:
    """All runs of a list of numbers, as (start, length, period) in order."""
    automaton = SuffixAutomaton(words)
    length, tree, ends = automaton.length, LastPassed(automaton.link), {}
    for place, state in enumerate(automaton.prefix):
        for node, before in tree.access(state, place):
            period = place - before
            if length[node] >= period:
                ends[place - period - length[node] + 1, period] = place
    found = [(start, end - start + 1, period) for (start, period), end in ends.items()]
    return sorted((s, n, p) for s, n, p in found if n >= least)


def stretches(hashes: np.ndarray, counts: np.ndarray) -> list[tuple[int, int, int]]:
    """Where runs may be, as (text, first word, end) with words numbered over all texts."""
    of = np.repeat(np.arange(len(counts)), counts)
    piece, alive = of.astype(np.uint64), np.ones(len(hashes), bool)
    while alive.any():
        n = len(hashes) - GRAM + 1
        if n <= 0:
            return []
        # A gram is alive if all of it lies in one piece.
        inside = (piece[:n] == piece[GRAM - 1 :]) & alive[:n] & alive[GRAM - 1 :]
        at = np.flatnonzero(inside)
        grams = piece[at] * FACTOR
        for k in range(GRAM):
            grams = mix(grams + hashes[at + k])
        order = np.argsort(grams, kind="stable")
        equal = grams[order][1:] == grams[order][:-1]
        twice = np.zeros(len(at), bool)
        twice[order[1:][equal]] = True
        twice[order[:-1][equal]] = True
        marks = np.zeros(len(hashes) + 1, np.int64)
        marks[at[twice]] += 1
        marks[at[twice] + GRAM] -= 1
        covered = np.cumsum(marks[:-1]) > 0
        edge = np.flatnonzero(np.diff(np.concatenate(([0], covered, [0]))) | np.concatenate(([1], piece[1:] != piece[:-1], [1])))
        # Parts between edges are covered as a whole or not at all.
        begin, end = edge[:-1], edge[1:]
        keep = covered[begin] & (end - begin >= LEAST)
        after = np.repeat(keep, end - begin)
        if (after == alive).all():
            return [(int(of[a]), int(a), int(b)) for a, b in zip(begin[keep], end[keep])]
        alive = after
        piece = np.repeat(np.arange(len(begin), dtype=np.uint64), end - begin)
    return []


def text_runs(texts: list[str | None]) -> tuple[list[list[bytes]], list[list[tuple[int, int, int]]]]:
    """The words of each text and its runs."""
    words = [(t or "").encode().split() for t in texts]
    hashes, counts = word_hashes(texts, lower=False)
    first = np.cumsum(counts) - counts
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for text, begin, end in stretches(hashes, counts):
        begin, end = begin - int(first[text]), end - int(first[text])
        numbers: dict[bytes, int] = {}
        coded = [numbers.setdefault(w, len(numbers)) for w in words[text][begin:end]]
        found[text] += [(begin + s, n, p) for s, n, p in runs_of(coded)]
    return words, found


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without the repetitions in runs, joined by one space."""
    if runs:
        keep = np.ones(len(words), bool)
        for start, length, period in runs:
            keep[start + period : start + length] = False
        words = [words[i] for i in np.flatnonzero(keep)]
    return b" ".join(words)


def find_runs(docs: DataFrame) -> DataFrame:
    """``docs`` with n_words, runs (array of start, length, period, in order) and
    collapsed (the text without repetitions)."""
    made = ("n_words", "runs", "collapsed")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in batched(batches, "text"):
            words, found = text_runs(texts)
            numbers = np.array([r for own in found for r in own], np.int64).reshape(-1, 3)
            fields = [pa.array(numbers[:, i]) for i in range(3)]
            offsets = np.cumsum([0, *(len(own) for own in found)], dtype=np.int32)
            columns = [batch.column(f.name) for f in kept]
            columns.append(pa.array([len(w) for w in words], pa.int64()))
            columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(fields, fields=list(RUN_TYPE))))
            columns.append(pa.array([collapsed(w, r).decode() for w, r in zip(words, found)], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in kept] + list(made))

    kept = [f for f in docs.schema.fields if f.name not in made]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    result = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return docs.mapInArrow(find, f"{schema}, {result}")
