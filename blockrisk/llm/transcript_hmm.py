"""Chat formatting: roles of transcript lines by a hidden Markov model, then canonical turns.

The hidden states are the three roles, each as the first line of a turn ("opens") or a later one
("inside"). A line shows the model its speaker marker (``User:``, ``### Assistant``, ``<|system|>``,
an unknown name, or none) and whether it asks, whether it is a list, heading or code, and whether it is short.
The most likely path by Viterbi gives every line its role; neighbouring turns of one role are one.
Rendered lines, concatenated in order, are ``<|role|>\\ncontent<|end|>\\n`` for every turn, without
the markers.

Rows are dealt and sorted by ranges of (conversation, turn), so a conversation of any length is
spread over tasks. A task decodes the conversations that lie within it; of the two that may go on
in a neighbour it sends one score matrix (best path from each state to each state). The matrices
of a conversation are multiplied in order, which fixes the states at the borders, and the parts
are decoded between them. A task thus never holds more than its range.

Cases: a null or empty text is one empty line; a null conversation id is a conversation of its
own (all such rows together); ties in (conversation, turn) follow each other in the order of
their texts; equal path scores take the earlier state in ``STATES``; an empty table gives no
rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blockrisk.llm.frames import shuffle_partitions, written

ROLES = ["system", "user", "assistant"]
STATES = [(role, place) for role in ROLES for place in ("opens", "inside")]
#: Names of speakers, by role.
NAMES = {
    "system": "system|instructions?|context",
    "user": "user|human|customer|question|prompter|q|me",
    "assistant": "assistant|ai|bot|chatbot|agent|answer|response|model|a",
}
_OPENING = r"^\s*(?:#{1,6}\s+|\*\*|<\|?|\[)?\s*(?:%s)\s*(?:\*\*)?\s*(?:[:]|\|>|\]\s*:?|>|\*\*\s*:?)\s*(?:\*\*)?\s*"
NO_MARKER, OTHER = 0, 4

#: Model parameters as probabilities; the rows of MARKERS are none, system, user, assistant, other.
MARKER_RIGHT, MARKER_MISSING, MARKER_OTHER = 0.80, 0.12, 0.06
ASKS = {"system": 0.05, "user": 0.40, "assistant": 0.15}
LISTS = {"system": 0.10, "user": 0.05, "assistant": 0.25}
SHORT = {"system": 0.20, "user": 0.40, "assistant": 0.20}
START = {"system": 0.15, "user": 0.75, "assistant": 0.10}
GO_ON = 0.60
NEXT = {
    "system": {"system": 0.02, "user": 0.93, "assistant": 0.05},
    "user": {"system": 0.02, "user": 0.03, "assistant": 0.95},
    "assistant": {"system": 0.02, "user": 0.95, "assistant": 0.03},
}

RESULT = "conv_id long, turn long, line int, role string, opens boolean, rendered string"
_LINES = "conv_id long, turn long, line int, content string, seen int, part int, side int, row long, role string, opens boolean, first boolean, ends boolean"


def model() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logarithms: (start[state], moves[state, state], emissions[observation, state]); 40 observations."""
    n = len(STATES)
    start, moves, out = np.full(n, -np.inf), np.full((n, n), -np.inf), np.zeros((40, n))
    for i, (role, place) in enumerate(STATES):
        if place == "opens":
            start[i] = np.log(START[role])
        for j, (other, there) in enumerate(STATES):
            if there == "opens":
                moves[i, j] = np.log((1 - GO_ON) * NEXT[role][other])
            elif other == role:
                moves[i, j] = np.log(GO_ON)
        for seen in range(40):
            marker, asks, lists, short = seen // 8, seen // 4 % 2, seen // 2 % 2, seen % 2
            if place == "inside":
                p = 0.97 if marker == NO_MARKER else 0.02 if marker == OTHER else 0.01 / 3
            elif marker in (NO_MARKER, OTHER):
                p = MARKER_MISSING if marker == NO_MARKER else MARKER_OTHER
            else:
                p = MARKER_RIGHT if ROLES[marker - 1] == role else (1 - MARKER_RIGHT - MARKER_MISSING - MARKER_OTHER) / 2
            for flag, table in ((asks, ASKS), (lists, LISTS), (short, SHORT)):
                p *= table[role] if flag else 1 - table[role]
            out[seen, i] = np.log(p)
    return start, moves, out


def observed(line: Column) -> tuple[Column, Column]:
    """(observation number, content without the marker) of a line."""
    low = F.lower(line)
    marker, content = F.lit(NO_MARKER), line
    for number, role in enumerate(ROLES, 1):
        pattern = "(?i)" + _OPENING % NAMES[role]
        found = low.rlike(pattern)
        marker, content = F.when(found, F.lit(number)).otherwise(marker), F.when(found, F.regexp_replace(line, pattern, "")).otherwise(content)
    other = "^[A-Z][A-Za-z_]{1,20}:\\s+"
    marker = F.when((marker == NO_MARKER) & line.rlike(other), F.lit(OTHER)).otherwise(marker)
    asks, lists, short = content.rlike(r"\?\s*$"), content.rlike(r"^\s*([-*+]\s|\d+[.)]\s|#{1,6}\s|```|    )"), F.length(content) < 60
    return (marker * 8 + asks.cast("int") * 4 + lists.cast("int") * 2 + short.cast("int")).cast("int"), content


def transfer(seen: np.ndarray, entries: np.ndarray, moves: np.ndarray, out: np.ndarray) -> np.ndarray:
    """Best score from each way into the first line to each state at the last one."""
    best = entries + out[seen[0]]
    for s in seen[1:]:
        best = (best[:, :, None] + moves[None]).max(1) + out[s]
    return best


def viterbi(seen: np.ndarray, before: np.ndarray, moves: np.ndarray, out: np.ndarray, last: int | None = None) -> np.ndarray:
    """Most likely states; ``before`` scores the first line's states, ``last`` fixes the final one."""
    score, back = before + out[seen[0]], np.zeros((len(seen), len(before)), np.int8)
    for k in range(1, len(seen)):
        paths = score[:, None] + moves
        back[k] = paths.argmax(0)
        score = paths.max(0) + out[seen[k]]
    path = np.zeros(len(seen), np.int64)
    path[-1] = int(score.argmax()) if last is None else last
    for k in range(len(seen) - 1, 0, -1):
        path[k - 1] = back[k, path[k]]
    return path


def _decided(path: np.ndarray, before: int | None) -> tuple[list[str], np.ndarray]:
    """(roles, whether a canonical turn opens): neighbouring turns of one role are one."""
    roles = [STATES[s][0] for s in path]
    earlier = [None if before is None else STATES[before][0], *roles[:-1]]
    return roles, np.array([r != e for r, e in zip(roles, earlier)])


def _lines(turns: DataFrame) -> DataFrame:
    whole = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    dealt = whole.repartitionByRange(shuffle_partitions(turns.sparkSession), "conv_id", "turn", F.xxhash64("text")).sortWithinPartitions("conv_id", "turn", "text")
    split = dealt.select("conv_id", "turn", F.posexplode(F.split("text", "\r\n|\n|\r")).alias("line", "raw"))
    seen, content = observed(F.col("raw"))
    return split.select("conv_id", "turn", "line", content.alias("content"), seen.alias("seen"))


def _within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Decodes runs that begin and end inside this task; the first and last run stay open (side 0 and 1)."""
    from pyspark import TaskContext

    part, held = TaskContext.get().partitionId(), [b for b in batches if b.num_rows]
    if not held:
        return
    rows = pa.Table.from_batches(held).combine_chunks()
    start, moves, out = model()
    conv = rows.column("conv_id").fill_null(-(1 << 63)).to_numpy()
    seen, n = rows.column("seen").to_numpy(), rows.num_rows
    bounds = np.append(np.where(np.append(True, conv[1:] != conv[:-1]))[0], n)
    side, roles = np.full(n, -1, np.int32), np.full(n, None, object)
    opens, begins, ends = (np.zeros(n, bool) for _ in range(3))
    for number, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
        if number in (0, len(bounds) - 2):
            side[a:b] = int(number > 0)
        else:
            roles[a:b], opens[a:b] = _decided(viterbi(seen[a:b], start, moves, out), None)
            begins[a] = ends[b - 1] = True
    added = [np.full(n, part, np.int32), side, np.arange(n), pa.array(roles, pa.string()), opens, begins, ends]
    columns = [*rows.columns, *(pa.array(x) for x in added)]
    yield from pa.table(columns, names=[c.split()[0] for c in _LINES.split(", ")]).to_batches()


def _summarise(run: pd.DataFrame) -> pd.DataFrame:
    run = run.sort_values("row")
    start, moves, out = model()
    # the first row of the scores is the way in at the start of a conversation
    scores = transfer(run["seen"].to_numpy(), np.vstack([start, moves]), moves, out)
    conv = pd.array([run["conv_id"].iloc[0]], dtype="Int64")
    return pd.DataFrame({"conv_id": conv, "part": [run["part"].iloc[0]], "side": [run["side"].iloc[0]], "scores": [scores.reshape(-1)]})


def _borders(runs: pd.DataFrame) -> pd.DataFrame:
    """State before the first line (-1: none) and at the last line of each run of one conversation."""
    runs = runs.sort_values(["part", "side"])
    matrices = [np.array(s).reshape(-1, len(STATES)) for s in runs["scores"]]
    score, back = matrices[0][0], []
    for m in matrices[1:]:
        paths = score[:, None] + m[1:]
        back.append(paths.argmax(0))
        score = paths.max(0)
    states = [int(score.argmax())]
    for b in reversed(back):
        states.append(int(b[states[-1]]))
    states.reverse()
    ends = [False] * (len(states) - 1) + [True]
    return pd.DataFrame({"part": runs["part"].to_numpy(), "side": runs["side"].to_numpy(), "before": [-1, *states[:-1]], "last": states, "final": ends})


def _between(run: pd.DataFrame) -> pd.DataFrame:
    run = run.sort_values("row")
    start, moves, out = model()
    before, last, final = int(run["before"].iloc[0]), int(run["last"].iloc[0]), bool(run["final"].iloc[0])
    path = viterbi(run["seen"].to_numpy(), start if before < 0 else moves[before], moves, out, last)
    roles, opens = _decided(path, None if before < 0 else before)
    begins, ends = np.zeros(len(run), bool), np.zeros(len(run), bool)
    begins[0], ends[-1] = before < 0, final
    return run.assign(role=roles, opens=opens, first=begins, ends=ends)[[c.split()[0] for c in _LINES.split(", ")]]


def format_transcripts(turns: DataFrame) -> DataFrame:
    """conv_id, turn, line, role, opens, rendered for every line of (conv_id, turn, text)."""
    lines = written(_lines(turns).mapInArrow(_within, _LINES), "transcript-lines")
    loose = lines.where("side >= 0")
    runs = loose.groupBy("part", "side").applyInPandas(_summarise, "conv_id long, part int, side int, scores array<double>")
    borders = runs.groupBy("conv_id").applyInPandas(_borders, "part int, side int, before int, last int, final boolean")
    solved = loose.join(borders, ["part", "side"]).groupBy("part", "side").applyInPandas(_between, _LINES)
    both = lines.where("side < 0").unionByName(solved)
    # a turn is closed where the next one opens, the last one at the end of its conversation
    opening = F.concat(F.when(F.col("first"), F.lit("")).otherwise(F.lit("<|end|>\n")), F.lit("<|"), F.col("role"), F.lit("|>\n"))
    rendered = F.concat(F.when(F.col("opens"), opening).otherwise(F.lit("\n")), "content", F.when(F.col("ends"), F.lit("<|end|>\n")).otherwise(F.lit("")))
    return both.select("conv_id", "turn", "line", "role", "opens", rendered.alias("rendered"))
