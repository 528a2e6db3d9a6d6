"""Chat formatting: the cheapest repair of a conversation's roles to a legal sequence of turns, and its rendering."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knotwork.llm.common import ship
from knotwork.session import written

ROLES = ("system", "user", "assistant")
#: States of the automaton: nothing yet, or the role of the last turn.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
#: Legal next turns: one system turn may open, then user and assistant take turns.
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
FINAL = (ASSISTANT,)  # training examples end with an answer
MERGE, INSERT, RELABEL = 1, 2, 3
FAR = 10**9
SEGMENT = 16_384  # rows of the ordered table that one task repairs at a time
OTHER = "other"
HEADERS = {SYSTEM: "<|system|>\n", USER: "<|user|>\n", ASSISTANT: "<|assistant|>\n"}
END = "<|end|>\n"

Step = tuple[tuple[int, ...], int, bool]  # empty turns put before, role of the turn, merged into the turn before


@lru_cache(maxsize=8)
def ways(role: str) -> dict[tuple[int, int], tuple[int, Step]]:
    """(state before, state after) -> the cheapest way to take one input turn of that role, ties to fewer and earlier changes.

    Before the turn at most two empty turns are put in: more can never help, as
    each state is reached from each other by at most two. Then the turn, under its
    own role or relabelled, is a new turn or is merged into one of the same role.
    """
    own = ROLES.index(role) + 1 if role in ROLES else None
    found: dict[tuple[int, int], tuple[int, Step]] = {}

    def offer(before: int, after: int, cost: int, step: Step) -> None:
        old = found.get((before, after))
        if old is None or (cost, step) < old:
            found[before, after] = (cost, step)

    for before in range(STATES):
        for empty in [(), *((a,) for a in NEXT[before]), *((a, b) for a in NEXT[before] for b in NEXT[a])]:
            state = empty[-1] if empty else before
            for label in (SYSTEM, USER, ASSISTANT):
                cost = INSERT * len(empty) + (0 if label == own else RELABEL)
                if label in NEXT[state]:
                    offer(before, label, cost, (empty, label, False))
                if label == state and not empty:
                    offer(before, label, cost + MERGE, (empty, label, True))
    return found


@lru_cache(maxsize=8)
def matrix(role: str) -> np.ndarray:
    out = np.full((STATES, STATES), FAR, dtype=np.int64)
    for (before, after), (cost, _) in ways(role).items():
        out[before, after] = cost
    return out


def closing(state: int) -> tuple[int, tuple[int, ...]]:
    """Cost and empty turns that lead from a state to a final one."""
    if state in FINAL or state == START:  # a conversation without turns stays empty
        return 0, ()
    return min((INSERT * len(p), p) for p in [(a,) for a in NEXT[state] if a in FINAL] + [(a, b) for a in NEXT[state] for b in NEXT[a] if b in FINAL])


def compose(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Costs of one stretch after another."""
    return np.minimum((a[:, :, None] + b[None, :, :]).min(axis=1), FAR)


@lru_cache(maxsize=100_000)
def stretch(roles: tuple[str, ...]) -> np.ndarray:
    """Cheapest costs from each state to each state over a short run of turns."""
    out = matrix(roles[0])
    for role in roles[1:]:
        out = compose(out, matrix(role))
    return out


def costs(roles: list[str]) -> np.ndarray:
    """Costs over any run, in pieces that recur."""
    out = None
    for i in range(0, len(roles), 8):
        piece = stretch(tuple(roles[i : i + 8]))
        out = piece if out is None else compose(out, piece)
    return out


def steps(roles: list[str], entry: int, leave: int) -> list[Step]:
    """The cheapest steps from one state to another by dynamic programming; ties to the smaller state."""
    best, back = {entry: 0}, []
    for role in roles:
        new: dict[int, tuple[int, int]] = {}
        for (before, after), (cost, _) in ways(role).items():
            if before in best and (after not in new or (best[before] + cost, before) < new[after]):
                new[after] = (best[before] + cost, before)
        back.append({after: before for after, (_, before) in new.items()})
        best = {after: cost for after, (cost, _) in new.items()}
    out, state = [], leave
    for role, came in zip(reversed(roles), reversed(back)):
        out.append(ways(role)[came[state], state][1])
        state = came[state]
    return out[::-1]


@lru_cache(maxsize=100_000)
def _steps(roles: tuple[str, ...], entry: int, leave: int) -> tuple[Step, ...]:
    return tuple(steps(list(roles), entry, leave))


def ordered(turns: DataFrame) -> DataFrame:
    """The rows in the order of conversation and turn, in segments of bounded size: ``(segment, place, ...)``.

    Ranges of the whole order are dealt to tasks, so a long conversation is
    spread over many. Null turns come first, equal turns follow by role and text.
    """
    # Roles are trimmed and lower-cased; what is not known is named alike.
    role = F.lower(F.trim(F.col("role")))
    rows = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.when(role.isin(*ROLES), role).otherwise(F.lit(OTHER)).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text"),
    ).withColumn("mix", F.xxhash64("role", "text"))
    keys = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("mix").asc()]
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("place", F.monotonically_increasing_id())
    part, at = F.shiftright("place", 33), F.col("place").bitwiseAND(F.lit((1 << 33) - 1))
    return written(rows.withColumn("segment", F.shiftleft(part, 20) + F.floor(at / SEGMENT)).drop("mix"), "turns")


def repair(turns: DataFrame) -> DataFrame:
    """One row per input turn: ``(conv_id, place, turn, role, new_role, merged, inserted, cost, rendered)``.

    ``rendered`` is the turn's share of the text, with empty turns before it and,
    on the last turn, those after it; a conversation's shares, joined by
    ``place``, are its rendering. ``inserted`` counts empty turns, ``cost`` is
    that of the whole conversation. A merged turn continues the one before after a line break.

    The automaton has four states, so a segment of a conversation is a 4 x 4
    table of costs; tables of the segments give the best states at their bounds,
    and each segment is then repaired by itself. Only one row per segment of a
    conversation is brought together, never its turns. Null conversation ids are
    one conversation, null and unknown roles must be relabelled, null texts are
    empty, repeated rows are turns of their own, an empty table gives no rows.
    """
    ship(turns.sparkSession)
    rows = ordered(turns)

    def measure(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("place", kind="stable")
        out = []
        for conv, part in group.groupby("conv_id", dropna=False, sort=False):
            out.append((conv, int(part["segment"].iloc[0]), costs(part["role"].tolist()).ravel().tolist()))
        return pd.DataFrame(out, columns=["conv_id", "segment", "table"]).astype({"conv_id": "Int64"})

    tables = rows.select("segment", "place", "conv_id", "role").groupBy("segment").applyInPandas(
        measure, "conv_id bigint, segment bigint, table array<bigint>"
    )

    def chain(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("segment")
        tables = [np.array(t, dtype=np.int64).reshape(STATES, STATES) for t in group["table"]]
        best, back = np.full(STATES, FAR, dtype=np.int64), []
        best[START] = 0
        for table in tables:
            total = best[:, None] + table
            back.append(total.argmin(axis=0))
            best = np.minimum(total.min(axis=0), FAR)
        close = [closing(s) for s in range(STATES)]
        leave = min(range(STATES), key=lambda s: (best[s] + close[s][0], s))
        cost, states = int(best[leave] + close[leave][0]), [leave]
        for came in reversed(back):
            states.append(int(came[states[-1]]))
        states = states[::-1]
        return pd.DataFrame({
            "conv_id": group["conv_id"].astype("Int64"), "segment": group["segment"], "entry": states[:-1], "leave": states[1:],
            "cost": cost, "last": [False] * (len(group) - 1) + [True],
        })

    ends = written(
        tables.groupBy("conv_id").applyInPandas(chain, "conv_id bigint, segment bigint, entry int, leave int, cost bigint, last boolean"), "bounds"
    )

    def rewrite(turns_of: pd.DataFrame, bounds: pd.DataFrame) -> pd.DataFrame:
        turns_of = turns_of.sort_values("place", kind="stable")
        known = {None if pd.isna(b.conv_id) else int(b.conv_id): b for b in bounds.itertuples()}
        out = []
        for conv, part in turns_of.groupby("conv_id", dropna=False, sort=False):
            bound = known[None if pd.isna(conv) else int(conv)]
            roles = part["role"].tolist()
            find = _steps if len(roles) <= 64 else steps
            taken = find(tuple(roles), int(bound.entry), int(bound.leave))
            open_turn = bound.entry != START
            for i, (row, (empty, label, merged)) in enumerate(zip(part.itertuples(), taken)):
                text = []
                if merged:
                    text.append("\n")
                else:
                    if open_turn:
                        text.append(END)
                    text += [HEADERS[e] + END for e in empty]
                    text.append(HEADERS[label])
                text.append(row.text)
                open_turn, inserted = True, len(empty)
                if bound.last and i == len(roles) - 1:
                    after = closing(int(bound.leave))[1]
                    text += [END, *(HEADERS[e] + END for e in after)]
                    inserted += len(after)
                out.append((conv, row.place, row.turn, row.role, ROLES[label - 1], merged, inserted, bound.cost, "".join(text)))
        names = ["conv_id", "place", "turn", "role", "new_role", "merged", "inserted", "cost", "rendered"]
        return pd.DataFrame(out, columns=names).astype({"conv_id": "Int64", "turn": "Int64"})

    return rows.groupBy("segment").cogroup(ends.groupBy("segment")).applyInPandas(
        rewrite,
        "conv_id bigint, place bigint, turn bigint, role string, new_role string, merged boolean, inserted int, cost bigint, rendered string",
    )
