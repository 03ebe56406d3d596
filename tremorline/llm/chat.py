"""Chat formatting: who speaks in a plain transcript, by a hidden Markov model.

A transcript is a run of lines. The hidden state of a line is its speaker's role and
whether the line begins a turn. What is seen of a line is its speaker marker (of
several spellings, or none), whether a blank line precedes it, whether it is the first
one, and whether it reads like a short question. Transition and emission
probabilities are counts over transcripts whose roles are known. The Viterbi path gives
each line its role, and each run of lines becomes one turn in canonical form: the
marker of its first line is taken off, and all else stays, blank lines too.

A transcript is cut into segments of line numbers. Each segment gives the best score
from any state before it to any state at its end; the chain of these small matrices
fixes the states at the borders, and then segments are decoded side by side. So the
lines of one huge transcript are never in one task.

Defined cases: null texts are empty; blank lines (none but spaces) are no lines, but are
seen by the next one and stand in a turn's text as empty lines, those before its first
line apart; rows of blank lines only are not there; rows without a turn come after the numbered
turns of their transcript, by role and text, each as a turn of its own; rows without an id make one transcript of their own; repeated rows are repeated
lines; without known roles all states are equally likely; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tremorline.llm.common import remainder, running_start, written

ROLES = ("system", "user", "assistant")
STATES = 2 * len(ROLES)  # role * 2 + (1 if the line continues a turn)
#: Line numbers: as many for each turn as an array can have elements, so turns never mix; and
#: turns in a segment.
LINES, TURNS = 1 << 31, 256
# Words that name a role in speaker markers.
NAMES = {
    "system": "system|instruction|instructions|context",
    "user": "user|human|customer|question|q",
    "assistant": "assistant|ai|bot|model|answer|a",
}
_OPEN, _CLOSE = r"(?i)^\s*(?:#+\s*)?[\[<*|]*(?:", r")(?:[\]>*|]+\s*:?|\s*:)\s*"
_DASH = r"^\s*[-–—>]\s+"
MARKS = 5
OBSERVATIONS = MARKS * 2 * 2 * 2


def _marker(role: str) -> str:
    return _OPEN + NAMES[role] + _CLOSE


_ANY = _OPEN + "|".join(NAMES.values()) + _CLOSE + "|" + _DASH


def _floor(number: Column, by: int) -> Column:
    """``number`` divided by ``by`` and rounded down, in whole numbers."""
    return ((number - F.pmod(number, F.lit(by))) / F.lit(by)).cast("long")


def observation(line: Column, after_blank: Column, first: Column) -> Column:
    """What is seen of a line, as a number below ``OBSERVATIONS``."""
    mark = F.lit(0)
    for i, role in reversed(list(enumerate(ROLES))):
        mark = F.when(line.rlike(_marker(role)), i + 1).otherwise(mark)
    mark = F.when((mark == 0) & line.rlike(_DASH), MARKS - 1).otherwise(mark)
    asks = line.rlike(r"\?\s*$") & (F.length(line) < 200)
    return ((mark * 2 + after_blank.cast("int")) * 2 + first.cast("int")) * 2 + asks.cast("int")


def transcript_lines(rows: DataFrame, id_column: str, number: Column, text: Column, keep: list[str]) -> DataFrame:
    """Non-blank lines: id, line_no, line, seen and the columns ``keep``. ``number`` orders
    the rows of a transcript; a row may hold many lines."""
    text = F.coalesce(text, F.lit(""))
    lines = F.split(text, "\n")
    end = F.size(F.split(F.rtrim(text, F.lit(" \n")), "\n")) - 1
    each = rows.select(
        F.col(id_column).alias("id"), number.cast("long").alias("number"), *keep,
        end.alias("end"), (F.size(lines) - 1 - end).alias("rest"),
        F.posexplode(
            F.transform(
                lines,
                lambda x, i: F.struct(
                    x.alias("line"),
                    F.coalesce(F.trim(F.get(lines, i - 1)) == "", F.lit(False)).alias("after_blank"),
                ),
            )
        ).alias("at", "part"),
    )
    each = each.where(F.trim("part.line") != "")
    # The blank lines that end a row stay with its last line.
    line = F.when(F.col("at") == F.col("end"), F.concat("part.line", F.repeat(F.lit("\n"), F.col("rest"))))
    first = (F.col("number") == 0) & (F.col("at") == 0)
    return each.select(
        "id", (F.col("number") * LINES + F.col("at")).alias("line_no"), line.otherwise(F.col("part.line")).alias("line"),
        observation(F.col("part.line"), F.col("part.after_blank"), first).alias("seen"), *keep,
    )


def fit(lines: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log probabilities of first states, transitions and emissions, from ``lines`` with
    role and turn. Counts by state are all that comes to the driver."""
    role = F.array_position(F.array(*map(F.lit, ROLES)), F.col("role")) - 1
    order = Window.partitionBy("id", "segment").orderBy("line_no")
    known = lines.where(F.col("role").isin(*ROLES)).withColumn(
        "segment", _floor(F.col("line_no"), LINES * TURNS)
    )
    same = F.coalesce(F.lag("turn").over(order) == F.col("turn"), F.lit(False))
    known = known.withColumn("state", (role * 2 + same.cast("int")).cast("int"))
    known = known.withColumn("before", F.coalesce(F.lag("state").over(order), F.lit(-1)))
    first, moves, shown = np.ones(STATES), np.ones((STATES, STATES)), np.full((STATES, OBSERVATIONS), 0.1)
    for row in known.groupBy("before", "state", "seen").count().collect():
        if row.before < 0:
            first[row.state] += row["count"]
        else:
            moves[row.before, row.state] += row["count"]
        shown[row.state, row.seen] += row["count"]
    # A turn goes on in its own role only, and nothing begins in the middle of a turn.
    for a in range(STATES):
        for b in range(1, STATES, 2):
            if a // 2 != b // 2:
                moves[a, b] = 1e-12
    first[1::2] = 1e-12
    return tuple(np.log(x / x.sum(axis=-1, keepdims=True)) for x in (first, moves, shown))


def _pass(moves: np.ndarray, shown: np.ndarray, seen: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, list]:
    """Best scores at the end for each row of scores before, and the best steps back."""
    back = []
    for s in seen:
        reached = score[:, :, None] + moves
        back.append(reached.argmax(axis=1))
        score = reached.max(axis=1) + shown[:, s]
    return score, back


def decode(lines: DataFrame, model: tuple[np.ndarray, np.ndarray, np.ndarray]) -> DataFrame:
    """``lines`` (id, line_no, line, seen) with state, by the Viterbi path of each transcript."""
    first, moves, shown = model
    start = np.full((STATES + 1, STATES + 1), -np.inf)
    start[:STATES, :STATES], start[STATES, :STATES] = moves, first  # the last state: before it all
    emit = np.vstack((shown, np.full((1, OBSERVATIONS), -np.inf)))
    apart = np.where(np.eye(STATES + 1, dtype=bool), 0.0, -np.inf)
    rows = lines.withColumn("segment", _floor(F.col("line_no"), LINES * TURNS))

    def across(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("line_no", kind="stable")
        score, _ = _pass(start, emit, part["seen"].to_numpy(), apart)
        return pd.DataFrame({"id": [key[0]], "segment": [key[1]], "best": [score.reshape(-1).tolist()]})

    def chain(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("segment")
        score, back = apart[STATES], []
        for matrix in part["best"]:
            reached = score[:, None] + np.array(matrix).reshape(STATES + 1, STATES + 1)
            back.append(reached.argmax(axis=0))
            score = reached.max(axis=0)
        ends = [int(score.argmax())]
        for step in reversed(back):
            ends.append(int(step[ends[-1]]))
        ends.reverse()
        return pd.DataFrame({"id": key[0], "segment": part["segment"], "before": ends[:-1], "after": ends[1:]})

    def inside(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("line_no", kind="stable")
        before, state = int(part["before"].iloc[0]), int(part["after"].iloc[0])
        _, back = _pass(start, emit, part["seen"].to_numpy(), apart[[before]])
        states = []
        for step in reversed(back):
            states.append(state)
            state = int(step[0, state])
        return part.assign(state=states[::-1])[["id", "line_no", "line", "segment", "state"]]

    ids = dict(lines.dtypes)["id"]
    best = rows.groupBy("id", "segment").applyInPandas(across, f"id {ids}, segment long, best array<double>")
    ends = best.groupBy("id").applyInPandas(chain, f"id {ids}, segment long, before int, after int")
    met = rows.withColumnRenamed("id", "own").join(
        ends.withColumnRenamed("segment", "of"), F.col("own").eqNullSafe(F.col("id")) & (F.col("segment") == F.col("of"))
    )
    met = met.select("id", "segment", "line_no", "line", "seen", "before", "after")
    return met.groupBy("id", "segment").applyInPandas(
        inside, f"id {ids}, line_no long, line string, segment long, state int"
    )


def render(decoded: DataFrame) -> DataFrame:
    """id, turn, role, text and rendered: one row for each recovered turn."""
    decoded = written(decoded, "decoded")
    begins = (F.col("state") % 2 == 0).cast("long")
    per = decoded.groupBy("id", "segment").agg(F.sum(begins).alias("n"))
    earlier = Window.partitionBy("id").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(F.col("id").alias("own"), F.col("segment").alias("of"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    met = decoded.join(per, F.col("id").eqNullSafe(F.col("own")) & (F.col("segment") == F.col("of")))
    order = Window.partitionBy("id", "segment").orderBy("line_no")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    previous = F.lag("line_no").over(order)
    numbered = met.withColumn("turn", F.col("offset") + F.sum(begins).over(so_far) - 1)
    # Lines of one row are as far apart as their numbers; before a row's first line stand
    # the blank lines that begin the row.
    same = F.coalesce(_floor(previous, LINES) == _floor(F.col("line_no"), LINES), F.lit(False))
    breaks = F.when(same, F.greatest(F.col("line_no") - previous, F.lit(1)))
    breaks = breaks.otherwise(F.pmod("line_no", F.lit(LINES)) + 1)
    numbered = numbered.withColumn("breaks", breaks.cast("int"))
    goes_on = F.col("state") % 2
    said = F.when(goes_on == 0, F.regexp_replace("line", _ANY, ""))
    said = said.otherwise(F.concat(F.repeat(F.lit("\n"), F.col("breaks")), "line"))
    part = F.struct("line_no", goes_on.alias("goes_on"), said.alias("said"))
    role = F.element_at(F.array(*map(F.lit, ROLES)), (F.floor(F.col("state") / 2) + 1).cast("int"))
    turns = numbered.groupBy("id", "turn").agg(
        F.min(role).alias("role"),
        F.array_join(F.transform(F.sort_array(F.collect_list(part)), lambda x: x["said"]), "").alias("text"),
    )
    return turns.withColumn("rendered", F.concat(F.lit("<|"), "role", F.lit("|>\n"), "text", F.lit("\n<|end|>\n")))


def in_order(conversations: DataFrame) -> DataFrame:
    """``conversations`` with a number for every turn: rows without one get those after
    the last of their transcript, in the order of role and text."""
    number = F.col("turn").cast("long")
    known = conversations.where("turn is not null").withColumn("turn", number)
    last = known.groupBy(F.col("conv_id").alias("own")).agg((F.max("turn") + 1).alias("from"))
    # Ids as keys that are not null, for the running count.
    late = conversations.where("turn is null").withColumn("none", F.isnull("conv_id"))
    late = late.withColumn("key", F.coalesce(F.col("conv_id").cast("string"), F.lit("")))
    late = running_start(late.withColumn("one", F.lit(1)), ["none", "key"], ["role", "text"], "one")
    late = late.join(last, F.col("conv_id").eqNullSafe(F.col("own")), "left")
    late = late.withColumn("turn", F.coalesce("from", F.lit(0)) + F.col("start"))
    return known.unionByName(late.select(known.columns))


def as_transcripts(conversations: DataFrame) -> DataFrame:
    """Lines of plain transcripts of known conversations, with role and turn kept. Four
    ways to mark speakers, one of which names nobody, go by the hash of the id."""
    conversations = in_order(conversations.select("conv_id", "turn", "role", "text"))
    style = F.pmod(F.xxhash64("conv_id"), F.lit(4))
    named = [
        F.concat(F.initcap("role"), F.lit(": ")),
        F.concat(F.lit("### "), F.initcap("role"), F.lit(":\n")),
        F.concat(F.lit("["), F.col("role"), F.lit("] ")),
    ]
    mark = F.lit("\n- ")
    for i, spelled in enumerate(named):
        mark = F.when(style == i, spelled).otherwise(mark)
    text = F.concat(F.coalesce(mark, F.lit("")), F.coalesce("text", F.lit("")))
    return transcript_lines(conversations, "conv_id", F.col("turn"), text, ["role", "turn"])


def format_conversations(conversations: DataFrame, modulus: int = 4, held: int = 2) -> DataFrame:
    """Transcripts of all conversations, parsed and rendered. Roles are learned from those
    outside the held-out fold, and not looked at otherwise."""
    lines = as_transcripts(conversations)
    model = fit(lines.where(~remainder("id", modulus).isin(held, -1)))
    return render(decode(lines.select("id", "line_no", "line", "seen"), model)).withColumnRenamed("id", "conv_id")
