"""Repair of conversations against all edits, and against plain Python over whole tables."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tremorline.llm import queries, repair

WORD = re.compile(r"[^\x20\x09-\x0D]")
PATTERN = re.compile(r"(s?(ua)+)?")


def terminals(rows):
    """Symbols of (role, text) rows, and how many faults of each kind there are."""
    seen, symbols, counts = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}
    for role, text in rows:
        kind = "suao".find(role[:1]) if role[:1] in list("sua") else 3
        signs = WORD.findall(text)
        if not signs:
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        else:
            fault = None if signs[-1] in ".!?" else "truncated"
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        symbols += ("SUAO" if fault == "truncated" else "0123" if fault else "suao")[kind]
    return symbols, counts


def all_edits(symbols, most=3):
    """The least (cost, audit) over all edits with at most ``most`` insertions."""
    found = []
    options = [[("D", "", 2)] if c in "0123" else
               [("D", "", 2), ("R", "u", 1 + 5 * c.isupper()), ("R", "a", 1 + 5 * c.isupper())]
               + ([("K", c.lower(), 5 * c.isupper())] if c.lower() in "sua" else [])
               for c in symbols]
    for chosen in itertools.product(*options):
        for n in range(most + 1):
            for places in itertools.combinations_with_replacement(range(len(symbols) + 1), n):
                for roles in itertools.product("ua", repeat=n):
                    steps = []
                    for i in range(len(symbols) + 1):
                        steps += [("I", r, 5) for p, r in zip(places, roles) if p == i]
                        steps += [chosen[i]] if i < len(symbols) else []
                    if PATTERN.fullmatch("".join(s[1] for s in steps)):
                        found.append((sum(s[2] for s in steps), "".join(s[0] for s in steps)))
    return min(found)


def plain_repair(symbols):
    """The least (cost, audit), turn by turn from the left: states with insertions between."""

    def inserted(states):
        while True:
            after = dict(states)
            for (p, turn), q in repair.STEPS.items():
                if turn in "ua" and p in after:
                    made = (after[p][0] + 5, after[p][1] + "I")
                    after[q] = min(after.get(q, made), made)
            if after == states:
                return states
            states = after

    states = inserted({0: (0, "")})
    for c in symbols:
        after = {}
        for p, (cost, audit) in states.items():
            steps = [(p, 2, "D")]
            if c not in "0123":
                extra = 5 * c.isupper()
                for (a, turn), q in repair.STEPS.items():
                    if a == p and turn == c.lower():
                        steps.append((q, extra, "K"))
                    elif a == p and turn in "ua":
                        steps.append((q, 1 + extra, "R"))
            for q, more, letter in steps:
                made = (cost + more, audit + letter)
                after[q] = min(after.get(q, made), made)
        states = inserted(after)
    return min(states[q] for q in (0, 3) if q in states)


def plain_result(rows):
    """The columns of the query for the (turn, role, text) rows of one conversation, in order."""
    symbols, counts = terminals([r[1:] for r in rows])
    cost, audit = plain_repair(symbols)
    turns = {r[0] for r in rows if r[0] is not None}
    initials = ["x" if r[1][:1] not in list("sua") else r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    lines, at, system = [], 0, (len(audit) - audit.count("D")) % 2
    for letter in audit:
        role = ("user", "assistant")[(len(lines) - system) % 2]
        if letter == "I":
            lines.append(f"{role}:")
        else:
            if letter == "K":
                lines.append(f"{rows[at][1]}:{rows[at][2]}")
            elif letter == "R":
                lines.append(f"{role}:{rows[at][2]}")
            at += 1
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    text = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return (gaps, *counts.values(), illegal, cost, audit, text)


def plain_damage(rows):
    """(conv_id, turn, role, text) rows after damage, by conversation and in order."""
    found = {}
    for conv, turn, role, text in rows:
        own = found.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind:
            text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
            own += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    for own in found.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    return found


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def assert_like_plain(answer, rows):
    found = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in answer.collect()}
    expected = {conv: plain_result(own) for conv, own in plain_damage(rows).items()}
    assert found == expected
    return found


def test_cells_against_all_edits():
    draw = random.Random(3)
    for _ in range(150):
        symbols = "".join(draw.choices("suaoSUAO012", k=draw.randrange(4)))
        cell = repair.parse([repair.terminal(c) for c in symbols])
        assert repair.best(cell) == all_edits(symbols) == plain_repair(symbols), symbols


def test_every_split_gives_the_same_cell():
    draw = random.Random(4)
    for _ in range(20):
        symbols = draw.choices("suaoSUAO0123", k=9)
        chart = {(i, i + 1): repair.terminal(c) for i, c in enumerate(symbols)}
        for n in range(2, len(symbols) + 1):
            for i in range(len(symbols) - n + 1):
                cells = [repair.combine(chart[i, k], chart[k, i + n]) for k in range(i + 1, i + n)]
                assert all(c == cells[0] for c in cells)
                chart[i, i + n] = cells[0]
        assert chart[0, len(symbols)] == repair.parse([repair.terminal(c) for c in symbols])


def test_query_on_the_table(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert_like_plain(queries.op12_interval_repair(spark, sf_dir), rows)


SCHEMA = "conv_id long, turn long, role string, text string, conv string, place int, cost string"


def odd_rows():
    draw = random.Random(5)
    texts = ["Yes.", "no", "", " \n", "What? ", None, "x" * 40_000 + "!", "Ünï。", "a\nb."]
    roles = ["system", "user", "assistant", "tool", "", None, "User"]
    rows = [
        (draw.choice([None, 1, 2, 3, 4]), draw.choice([None, *range(40)]), draw.choice(roles), draw.choice(texts))
        for _ in range(300)
    ]
    # A long conversation, of several blocks of blocks, with repeated rows.
    rows += [(9, i // 2, draw.choice(roles[:4]), f"Turn {draw.randrange(150)}{draw.choice('.?x')}") for i in range(700)]
    return rows + rows[:40]


@pytest.mark.parametrize("block", [4, 64])
def test_odd_rows_and_long_conversations(spark, tmp_path, monkeypatch, block):
    monkeypatch.setattr(repair, "BLOCK", block)
    rows = odd_rows()
    frame = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(5)
    frame.write.parquet(f"{tmp_path}/conversations.parquet")
    found = assert_like_plain(queries.op12_interval_repair(spark, str(tmp_path)), rows)
    assert None in found


def test_repaired_turns_follow_the_pattern(spark):
    rows = spark.createDataFrame(odd_rows(), "conv_id long, turn long, role string, text string")
    summary, turns = repair.repair(rows)
    own = turns.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("position", "role"))).alias("r"))
    for row in own.collect():
        assert [r.position for r in row.r] == list(range(len(row.r)))
        assert PATTERN.fullmatch("".join(r.role[0] for r in row.r))
    assert summary.count() == rows.select("conv_id").distinct().count()


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    assert queries.op12_interval_repair(spark, str(tmp_path)).collect() == []


def test_a_conversation_that_loses_all_rows(spark, tmp_path):
    gone = [(i, 0, "user", "Hi.") for i in range(200) if zlib.crc32(f"{i}:0".encode()) % 20 == 0]
    assert gone
    frame = spark.createDataFrame(gone, "conv_id long, turn long, role string, text string")
    frame.write.parquet(f"{tmp_path}/conversations.parquet")
    empty = hashlib.sha256(b"").hexdigest()
    rows = queries.op12_interval_repair(spark, str(tmp_path)).collect()
    assert {tuple(r)[1:] for r in rows} == {(0, 0, 0, 0, 0, 0, "", empty)} and len(rows) == len(gone)
