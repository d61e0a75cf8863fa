"""Chat formatting with minimum-cost role repair.

A legal conversation is an optional system turn, then user and assistant turns in
alternation beginning with user; it ends after an assistant turn. Turns as
stored break this in many ways. Dynamic programming over the automaton of the
last turn's role chooses, for each stored turn, the cheapest mix of

* keep: the role is legal here (0);
* merge: the text is appended to the turn before (``MERGE``; with a relabel if the roles differ);
* relabel: the turn gets a legal role (``RELABEL``);
* insert: empty turns of legal roles go before it, or at the end (``INSERT`` each).

Ties go to fewer turns. One turn's effect is a 4 x 4 min-plus matrix, and
matrices multiply: a conversation can be cut anywhere. Turns are range-sorted and
dealt in chunks of bounded size; chunks give the matrices of the conversations
at their edges, these are solved for the state at every cut, and then each chunk
chooses its own repairs. No conversation, whatever its length, is gathered.

The result is a row for each segment of the rendered conversation: a stored turn
or an inserted one. A conversation's text is its segments' ``rendered`` in the order of
(out_turn, segment); ``render`` joins them for conversations that fit in a row.

Defined cases: turns are ordered by ``turn`` (nulls first), then role, then a hash
of the text; a null or unknown role must be relabelled or merged; null text is
empty; repeated rows are separate turns; a null ``conv_id`` is a conversation of
its own; an empty table gives an empty result; other columns are ignored. The
markers ``<|`` and ``|>`` inside texts are spaced apart, so no text can open a turn.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstream.llm.common import Scratch, ready

ROLES = ("system", "user", "assistant")
MERGE, INSERT, RELABEL = 2, 3, 4
CHUNK_TURNS = 4096
#: Text of a chunk, unless one turn is longer.
CHUNK_BYTES = 8 << 20

START = 0  # states: nothing yet, then the last turn's role as 1 + its index
LEGAL = {0: (1, 2), 1: (2,), 2: (3,), 3: (2,)}
FINAL = 3
_FAR = np.int64(1) << 60
#: Costs are counted in this unit; the rest of a number counts turns.
_UNIT = 1 << 40


def _insertions() -> dict[tuple[int, int], tuple[int, ...]]:
    """The shortest run of turns that leads from one state to another (first by state number)."""
    best: dict[tuple[int, int], tuple[int, ...]] = {}
    for s in range(4):
        front = [(s, ())]
        while front:
            following = []
            for at, path in front:
                if (s, at) not in best:
                    best[s, at] = path
                    following += [(q, (*path, q)) for q in LEGAL[at]]
            front = following
    return best


INSERTIONS = _insertions()


def _step(role: int, s: int, t: int):
    """Cheapest way over a stored turn of ``role`` (0: unknown) from state s to t: (cost, inserted states, op)."""
    options = []
    for q in range(4):
        if (s, q) not in INSERTIONS:
            continue
        path = INSERTIONS[s, q]
        base = len(path) * (INSERT * _UNIT + 1)
        if t in LEGAL[q]:
            same = role == t
            options.append((base + 1 + (0 if same else RELABEL * _UNIT), len(path), path, "keep" if same else "relabel"))
        if t == q != START:
            options.append((base + (MERGE + (0 if role == t else RELABEL)) * _UNIT, len(path), path, "merge"))
    if not options:
        return None
    cost, _, path, op = min(options, key=lambda o: (o[0], o[1]))
    return cost, path, op


STEPS = {(r, s, t): _step(r, s, t) for r, s, t in itertools.product(range(4), range(4), range(4))}
#: Min-plus matrix of a stored turn, by role.
MATRICES = np.array([[[STEPS[r, s, t][0] if STEPS[r, s, t] else _FAR for t in range(4)] for s in range(4)]
                     for r in range(4)], np.int64)
END_COST = np.array([len(INSERTIONS[s, FINAL]) * (INSERT * _UNIT + 1) if s != START else 0 for s in range(4)], np.int64)


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum((a[..., :, None] + b[None, ...]).min(axis=-2), _FAR)


def role_codes(roles) -> np.ndarray:
    return np.array([ROLES.index(r) + 1 if r in ROLES else 0 for r in roles], np.int64)


def chunk_matrix(codes: np.ndarray) -> np.ndarray:
    out = MATRICES[codes[0]]
    for c in codes[1:]:
        out = _times(out, MATRICES[c])
    return out


def solve_pieces(matrices: np.ndarray) -> tuple[list[int], list[int]]:
    """Entry state of each piece of one conversation and, last, the final state; turns before each piece."""
    costs = [np.array([0, _FAR, _FAR, _FAR], np.int64)]
    for m in matrices:
        costs.append(np.minimum((costs[-1][:, None] + m).min(axis=0), _FAR))
    states = [int((costs[-1] + END_COST).argmin())]
    for k in range(len(matrices) - 1, -1, -1):
        states.append(int((costs[k] + matrices[k][:, states[-1]]).argmin()))
    states.reverse()
    before = [0]
    for k, m in enumerate(matrices):
        before.append(before[-1] + int(m[states[k], states[k + 1]] % _UNIT))
    return states, before


def repair(codes: np.ndarray, entry: int, leave: int) -> list[tuple[int, tuple[int, ...], str, int]]:
    """For each stored turn: cost, inserted states, operation and the state after it."""
    n = len(codes)
    cost = np.full(4, _FAR)
    cost[entry] = 0
    back = np.zeros((n, 4), np.int8)
    for i, c in enumerate(codes):
        total = cost[:, None] + MATRICES[c]
        back[i] = total.argmin(axis=0)
        cost = np.minimum(total.min(axis=0), _FAR)
    out, t = [], leave
    for i in range(n - 1, -1, -1):
        s = int(back[i][t])
        c, path, op = STEPS[int(codes[i]), s, t]
        out.append((c // _UNIT, path, op, t))
        t = s
    return out[::-1]


# ---------------------------------------------------------------- Spark steps

def _number(batches: Iterator[pa.RecordBatch], chunk_turns: int) -> Iterator[pa.RecordBatch]:
    """Rows with their partition, number and chunk: a chunk ends after ``chunk_turns`` turns or ``CHUNK_BYTES`` of text."""
    part, seq, chunk, turns, size = TaskContext.get().partitionId(), 0, 0, 0, 0
    for batch in batches:
        n, chunks = batch.num_rows, []
        for length in pc.binary_length(batch.column("text")).to_pylist():
            if turns and (turns >= chunk_turns or size + (length or 0) > CHUNK_BYTES):
                chunk, turns, size = chunk + 1, 0, 0
            chunks.append(chunk)
            turns, size = turns + 1, size + (length or 0)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(n, part, np.int32)),
                                          pa.array(np.arange(seq, seq + n)), pa.array(chunks, pa.int64())],
                                         names=[*batch.schema.names, "part", "seq", "chunk"])
        seq += n


_EDGE_SCHEMA = "conv_id string, part int, chunk long, first boolean, matrix array<long>"
_STATE_SCHEMA = "part int, chunk long, first boolean, entry int, leave int, base long, last boolean"
SEGMENT_SCHEMA = ("conv_id string, out_turn long, segment long, turn long, role string, op string, cost int, "
                  "rendered string")


def _pieces(rows: pd.DataFrame) -> list[tuple[int, int]]:
    conv = rows["conv_id"].fillna("").to_numpy()
    null = rows["conv_id"].isna().to_numpy()
    cut = np.flatnonzero(np.append(True, (conv[1:] != conv[:-1]) | (null[1:] != null[:-1])))
    return list(zip(cut, [*cut[1:], len(rows)]))


def _edges(rows: pd.DataFrame) -> pd.DataFrame:
    """Matrices of the first and the last conversation of a chunk; inner ones are whole."""
    rows = rows.sort_values("seq")
    pieces, out = _pieces(rows), []
    codes = role_codes(rows["role"])
    for k in sorted({0, len(pieces) - 1}):
        a, b = pieces[k]
        out.append((rows["conv_id"].iloc[a], rows["part"].iloc[0], rows["chunk"].iloc[0], k == 0,
                    chunk_matrix(codes[a:b]).ravel().tolist()))
    return pd.DataFrame(out, columns=["conv_id", "part", "chunk", "first", "matrix"])


def _states(rows: pd.DataFrame) -> pd.DataFrame:
    """One conversation's pieces: the states at its cuts."""
    rows = rows.sort_values(["part", "chunk", "first"], ascending=[True, True, False])
    states, before = solve_pieces(np.array(rows["matrix"].tolist(), np.int64).reshape(-1, 4, 4))
    return pd.DataFrame({"part": rows["part"].to_numpy(), "chunk": rows["chunk"].to_numpy(), "first": rows["first"].to_numpy(),
                         "entry": states[:-1], "leave": states[1:], "base": before[:-1],
                         "last": np.arange(len(rows)) == len(rows) - 1})


def _clean(text: str | None) -> str:
    return (text or "").replace("<|", "< |").replace("|>", "| >")


def _header(state: int) -> str:
    return f"<|im_start|>{ROLES[state - 1]}\n"


_FOOTER = "<|im_end|>\n"


def render_piece(conv_id, codes, texts, turns, segments, entry: int, leave: int, base: int, last: bool) -> list[tuple]:
    """Segment rows of one piece of a conversation."""
    out, at, state = [], base, entry
    for i, (cost, path, op, after) in enumerate(repair(codes, entry, leave)):
        for q in path:
            at += 1
            out.append((conv_id, at - 1, segments[i], None, ROLES[q - 1], "insert", INSERT,
                        (_FOOTER if state else "") + _header(q)))
            state = q
        if op == "merge":
            shown = "\n" + _clean(texts[i])
        else:
            shown = (_FOOTER if state else "") + _header(after) + _clean(texts[i])
            at += 1
        out.append((conv_id, at - 1, segments[i], turns[i], ROLES[after - 1], op, cost - len(path) * INSERT, shown))
        state = after
    if last:
        end = segments[-1] if len(segments) else 0
        for q in INSERTIONS[state, FINAL] if state else ():
            at += 1
            out.append((conv_id, at - 1, end, None, ROLES[q - 1], "insert", INSERT, _FOOTER + _header(q)))
        out[-1] = (*out[-1][:-1], out[-1][-1] + _FOOTER)
    return out


def _segments(rows: pd.DataFrame) -> pd.DataFrame:
    """Repair one chunk; the states of its first and last conversation come with the rows."""
    rows = rows.sort_values("seq")
    pieces, out = _pieces(rows), []
    codes = role_codes(rows["role"])
    texts, turns = rows["text"].tolist(), [None if pd.isna(t) else int(t) for t in rows["turn"]]
    place = (rows["part"].astype(np.int64) * (1 << 40) + rows["seq"]).tolist()
    for k, (a, b) in enumerate(pieces):
        if k in (0, len(pieces) - 1):
            side = "f" if k == 0 else "l"
            entry, leave, base, last = (rows[f"{side}_{c}"].iloc[0] for c in ("entry", "leave", "base", "last"))
        else:
            (entry, leave), (base, _) = solve_pieces(chunk_matrix(codes[a:b])[None])
            last = True
        out += render_piece(rows["conv_id"].iloc[a], codes[a:b], texts[a:b], turns[a:b], place[a:b],
                            int(entry), int(leave), int(base), bool(last))
    result = pd.DataFrame(out, columns=["conv_id", "out_turn", "segment", "turn", "role", "op", "cost", "rendered"])
    result["turn"] = result["turn"].astype("Int64")
    return result


def repair_conversations(turns: DataFrame, chunk_turns: int = CHUNK_TURNS) -> DataFrame:
    """(conv_id, out_turn, segment, turn, role, op, cost, rendered), a row for each segment.

    ``out_turn`` numbers the repaired turns of a conversation from 0; ``segment`` orders the
    segments of a turn; ``turn`` is the stored turn (null for an inserted one).
    """
    spark = ready(turns.sparkSession)
    scratch = Scratch(spark, "chat")
    rows = turns.select(F.col("conv_id").cast("string").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        "role", "text")
    # conv_id keeps its own order for numbers: the sort key is only a grouping.
    order = [F.col("conv_id"), F.col("turn"), F.col("role"), F.xxhash64("text")]
    numbered = rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        lambda b: _number(b, chunk_turns), "conv_id string, turn long, role string, text string, part int, seq long, chunk long")
    numbered = scratch.table(numbered, "turns")

    edges = numbered.select("conv_id", "role", "part", "seq", "chunk").groupBy("part", "chunk") \
        .applyInPandas(_edges, _EDGE_SCHEMA)
    edges = scratch.table(edges, "edges")
    states = edges.groupBy("conv_id").applyInPandas(_states, _STATE_SCHEMA)
    side = lambda first, p: states.where(F.col("first") == F.lit(first)).select(
        F.col("part"), F.col("chunk"), *[F.col(c).alias(f"{p}_{c}") for c in ("entry", "leave", "base", "last")])
    # A chunk with a single conversation has its states as the first.
    known = scratch.table(side(True, "f").join(side(False, "l"), ["part", "chunk"], "left"), "states")
    dealt = numbered.join(known, ["part", "chunk"])
    return dealt.groupBy("part", "chunk").applyInPandas(_segments, SEGMENT_SCHEMA) \
        .withColumn("conv_id", F.col("conv_id").cast(turns.schema["conv_id"].dataType))


def render(segments: DataFrame) -> DataFrame:
    """(conv_id, n_turns, cost, text): whole conversations, for those that fit in a row."""
    parts = F.array_sort(F.collect_list(F.struct("out_turn", "segment", "rendered")))
    return segments.groupBy("conv_id").agg(
        (F.max("out_turn") + 1).alias("n_turns"), F.sum("cost").alias("cost"),
        F.array_join(F.transform(parts, lambda p: p["rendered"]), "").alias("text"))
