"""Repair of conversations' structure by weighted CYK parsing over spans of turns.

A repaired conversation is empty, or a system turn at most and then pairs of a user's and an
assistant's turn. Turns are kept, given another role, or deleted, and empty turns are
inserted; the cheapest edits are found, and of equally cheap ones those whose initials come
first by ASCII.

The grammar is in Chomsky normal form. Its nonterminals ``p>q`` are the pairs of states of
the automaton for ``(s?(ua)+)?``: what takes it from p to q. A turn is a terminal with one
rule for each edit; every ``p>q`` has the rules ``p>r r>q``; insertions are rules for the
empty span, closed over each other and taken into each cell on both sides. A cell holds
the least (cost, audit) of one nonterminal over a span.

Cells are combined bottom-up by span length. As nonterminals are pairs of states, all
splits of a span give one minimum, so a single split is looked at, in the middle. (Audits
of equal cost over one span never begin with each other: the longer one would have
insertions more and cost more. So the least audit of a span is put together from
the least ones of its parts.) Spans of up to ``BLOCK`` turns are parsed in one go; their cells
are combined ``BLOCK`` at a time, by conversation and place, until one is left. So a
conversation of any length is spread over tasks, and no group has more than
``BLOCK`` rows.

Defined cases: nulls in role and text count as one space, rows without an id are one conversation, rows
without a turn come first; rows of one turn are ordered by role and text; a role that
begins with none of s, u, a (or is empty) is no legal one; repeated rows are duplicates; an
empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tremorline.llm.common import running_start, written

#: Turns, and cells, that are parsed in one go.
BLOCK = 64
#: Rows that a task hands on at a time, and blocks whose cells a task remembers.
ROWS, REMEMBERED = 10_000, 50_000

# What an edit costs, and that of keeping a truncated turn in any role.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
# States and their steps (system, user, assistant) of (s?(ua)+)?, and the pairs of
# initials that may stand side by side.
STEPS = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ACCEPTED = (0, 3)
LEGAL = ("su", "ua", "au")
_BLANKS = " \t\n\x0b\x0c\r"

# A turn's terminal: its initial; in upper case if truncated, as a digit if it must go.
_SOUND, _CUT, _GONE = "suao", "SUAO", "0123"

Cell = dict[tuple[int, int], tuple[int, str]]


def combine(left: Cell, right: Cell) -> Cell:
    """The cell of two spans side by side."""
    out: Cell = {}
    for (p, r), (cost, audit) in left.items():
        for (s, q), (more, rest) in right.items():
            if r == s:
                made = (cost + more, audit + rest)
                if (p, q) not in out or made < out[p, q]:
                    out[p, q] = made
    return out


def _insertions() -> Cell:
    """The empty span: nothing, or any number of insertions."""
    cell: Cell = {(p, p): (0, "") for p in range(4)}
    one = {(p, q): (INSERT, "I") for (p, turn), q in STEPS.items() if turn in "ua"}
    while True:
        longer = combine(cell, one)
        better = cell | {k: v for k, v in longer.items() if k not in cell or v < cell[k]}
        if better == cell:
            return cell
        cell = better


EMPTY = _insertions()


@lru_cache(maxsize=None)
def terminal(symbol: str) -> Cell:
    """The cell of one turn, insertions around it included."""
    edits: Cell = {(p, p): (DELETE, "D") for p in range(4)}
    if symbol not in _GONE:
        extra = TRUNCATED if symbol in _CUT else 0
        initial = symbol.lower()
        for (p, turn), q in STEPS.items():
            if turn == initial:
                edits[p, q] = (KEEP + extra, "K")
            elif turn in "ua":
                edits[p, q] = (REROLE + extra, "R")
    return combine(combine(EMPTY, edits), EMPTY)


def parse(cells: list[Cell]) -> Cell:
    """The cell of spans side by side, from cells of spans twice as long each time."""
    if not cells:
        return EMPTY
    while len(cells) > 1:
        longer = [combine(a, b) for a, b in zip(cells[::2], cells[1::2])]
        cells = longer + cells[len(longer) * 2 :]
    return cells[0]


def best(cell: Cell) -> tuple[int, str]:
    """Cost and audit of the cheapest repair of a whole conversation."""
    return min(cell[0, q] for q in ACCEPTED if (0, q) in cell)


def _initials(word: str) -> str:
    return word.lower().translate(str.maketrans(_GONE, _SOUND))


def _illegal(initials: str) -> int:
    return sum(initials[i : i + 2] not in LEGAL for i in range(len(initials) - 1))


@lru_cache(maxsize=REMEMBERED)
def _block(word: str) -> tuple:
    return _fields(_initials(word), _illegal(_initials(word)), parse([terminal(c) for c in word]))


def _fields(ends: str, illegal: int, cell: Cell) -> tuple:
    keys = [p * 4 + q for p, q in cell]
    costs, audits = zip(*cell.values())
    return ends[0] + ends[-1], illegal, keys, list(costs), list(audits)


_CELL = "ends string, illegal long, keys array<int>, costs array<long>, audits array<string>"
_TYPES = [pa.string(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.string())]


def _with_cells(rows: DataFrame, column: str, of) -> DataFrame:
    """``rows`` (conv, block, ``column``) with the cell that ``of`` gives for each."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [of(value) for value in batch.column(2).to_pylist()]
            fields = list(zip(*made)) or [()] * 5
            arrays = [pa.array(field, kind) for field, kind in zip(fields, _TYPES)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], names=names)

    names = ["conv", "block", "ends", "illegal", "keys", "costs", "audits"]
    return rows.select("conv", "block", column).mapInArrow(add, f"conv string, block long, {_CELL}")


def _joined(parts: list[dict]) -> tuple:
    """The cell of blocks side by side."""
    cells = [
        {divmod(k, 4): (c, a) for k, c, a in zip(p["keys"], p["costs"], p["audits"])} for p in parts
    ]
    ends = "".join(p["ends"] for p in parts)
    between = sum(ends[i : i + 2] not in LEGAL for i in range(1, len(ends) - 1, 2))
    return _fields(ends, between + sum(p["illegal"] for p in parts), parse(cells))


def key_of(conv_id: Column) -> Column:
    """A conversation's id as text that is never null."""
    return F.when(conv_id.isNull(), "").otherwise(F.concat(F.lit(":"), conv_id.cast("string")))


def numbered(rows: DataFrame) -> DataFrame:
    """conv, turn, role, text and place (from 0) of each turn in its conversation."""
    space = F.lit(" ")
    turns = rows.select(
        key_of(F.col("conv_id")).alias("conv"), "turn",
        F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"),
        F.lit(1).alias("one"), F.monotonically_increasing_id().alias("copy"),
    )
    # Rows alike in all else may come in any order; the copy only spreads them over tasks.
    turns = running_start(turns, ["conv"], ["turn", "role", "text", "copy"], "one")
    return turns.select("conv", "turn", "role", "text", F.col("start").alias("place"))


def with_faults(turns: DataFrame) -> DataFrame:
    """conv, place, turn, initial and the first fault (or null) of numbered turns."""
    last = F.right(F.rtrim("text", F.lit(_BLANKS)), F.lit(1))
    first = turns.groupBy("conv", "role", F.sha2("text", 256).alias("hash")).agg(F.min("place").alias("place"))
    seen = turns.select("conv", "place", "turn", F.left("role", F.lit(1)).alias("initial"), last.alias("last"))
    seen = seen.join(first.select("conv", "place", F.lit(True).alias("first")), ["conv", "place"], "left")
    fault = (
        F.when(F.col("last") == "", "blank")
        .when(F.col("first").isNull(), "duplicate")
        .when(~F.col("last").isin(".", "!", "?"), "truncated")
    )
    return seen.select("conv", "place", "turn", "initial", fault.alias("fault"))


def summarised(faults: DataFrame) -> DataFrame:
    """Per conv: gaps, blank, duplicate, truncated, illegal, cost, audit."""
    kind = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("o")
    symbol = (
        F.when(F.col("fault").isin("blank", "duplicate"), F.translate(kind, _SOUND, _GONE))
        .when(F.col("fault") == "truncated", F.upper(kind))
        .otherwise(kind)
    )
    blocks = faults.groupBy("conv", F.floor(F.col("place") / BLOCK).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("place", symbol.alias("symbol")))).alias("symbols"),
        *[F.count_if(F.col("fault") == name).alias(name) for name in ("blank", "duplicate", "truncated")],
        F.max("place").alias("last"),
    )
    word = F.array_join(F.transform("symbols", lambda s: s["symbol"]), "")
    blocks = written(blocks.withColumn("word", word).drop("symbols"), "spans")
    cells = _with_cells(blocks, "word", _block)
    longest = (blocks.agg(F.max("block")).first()[0] or 0) + 1
    while longest > 1:
        cells = written(cells, "cells")
        upper = cells.groupBy("conv", F.floor(F.col("block") / BLOCK).alias("block")).agg(
            F.sort_array(F.collect_list(F.struct("block", "ends", "illegal", "keys", "costs", "audits"))).alias("parts")
        )
        cells = _with_cells(upper, "parts", _joined)
        longest = -(-longest // BLOCK)

    # A key of 0 to 3 begins in the first state.
    whole = F.arrays_zip("keys", "costs", "audits")
    ends = F.filter(whole, lambda c: c["keys"].isin(*ACCEPTED))
    least = F.array_min(F.transform(ends, lambda c: F.struct(c["costs"], c["audits"])))
    parsed = cells.select("conv", "illegal", least["costs"].alias("cost"), least["audits"].alias("audit"))

    counts = blocks.groupBy("conv").agg(*[F.sum(n).alias(n) for n in ("blank", "duplicate", "truncated")])
    turns = faults.groupBy("conv", "turn").agg(F.lit(1).alias("one")).groupBy("conv")
    turns = turns.agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps")
    )
    return parsed.join(counts, "conv").join(turns, "conv")


def edits(summary: DataFrame) -> DataFrame:
    """Each letter of the audits that leaves a turn: conv, place of the turn it is for (null for an
    insertion), edit, position in the repaired conversation, and the role there (null: a
    system turn, which is kept)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for conv, audit in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                # Pairs make an even number; one more is a system turn at the beginning.
                system = (len(audit) - audit.count("D")) % 2
                place = position = 0
                for letter in audit:
                    if letter != "D":
                        turn = position - system
                        role = None if turn < 0 else ("user", "assistant")[turn % 2]
                        rows.append((conv, None if letter == "I" else place, letter, position, role))
                        position += 1
                    place += letter != "I"
                    if len(rows) >= ROWS:
                        yield made(rows)
                        rows = []
            yield made(rows)

    def made(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * 5
        types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string()]
        arrays = [pa.array(column, kind) for column, kind in zip(columns, types)]
        return pa.RecordBatch.from_arrays(arrays, names=["conv", "place", "edit", "position", "new_role"])

    schema = "conv string, place long, edit string, position long, new_role string"
    return summary.select("conv", "audit").mapInArrow(read, schema)


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The summary of each conversation, and the turns of the repaired ones: conv, position,
    role, text, edit. ``conv`` is the id by ``key_of``."""
    turns = written(numbered(rows), "turns")
    summary = written(summarised(with_faults(turns)), "repairs")
    done = edits(summary)
    role = F.when(F.col("edit") == "R", F.col("new_role")).otherwise(F.col("role"))
    kept = turns.join(done, ["conv", "place"]).select("conv", "position", role.alias("role"), "text", "edit")
    inserted = done.where("edit = 'I'").select(
        "conv", "position", F.col("new_role").alias("role"), F.lit("").alias("text"), "edit"
    )
    return summary, kept.union(inserted)
