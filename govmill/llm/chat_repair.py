"""Chat formatting by minimum-cost role repair: dynamic programming over an automaton of legal turns, then rendering.

Legal is an optional system turn, then user and assistant by turns, ending with the assistant. A turn may keep its role (cost
0), change it (RELABEL), be merged into the turn before (MERGE, and RELABEL if the roles differ), and an empty turn may be put in
(INSERT). The cheapest repair of each conversation is taken.

A conversation may be of any length. Rows are sorted by range, so a long one is spread over many tasks, and cut into blocks of
at most BLOCK turns. The best cost of a block from each state to each state is a 4 x 4 matrix; a conversation joins the
matrices of its blocks, which fixes the states at their edges; then each block is repaired by itself. The result has a row
per turn or inserted turn, not a string per conversation: the pieces of a conversation in the order of `place` are its rendering.

Defined results: a null or unknown role costs RELABEL whatever it becomes; a null text is empty; turns are ordered by turn (nulls
first), then role and text; repeated rows are turns of their own; rows without conversation id are one conversation.
Equally cheap repairs: the one that keeps more of the earlier states in the order start, system, user, assistant.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from govmill.llm.shared import cut, runs, small_enough, width

RELABEL, MERGE, INSERT = 2, 1, 3
BLOCK = 2048
SEND_BOUND = 200_000
START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = ("", "system", "user", "assistant")
#: States that may follow each state.
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
FAR = 1 << 40


def steps(role: int) -> list[tuple[int, int, int, str, int]]:
    """(from, to, cost, action, inserted state or -1) for a turn of a role (0: unknown)."""
    out = []
    for q in range(4):
        if q != START:
            same = role == q
            out.append((q, q, MERGE + (0 if same else RELABEL), "merge", -1))
        for to in NEXT[q]:
            out.append((q, to, 0 if role == to else RELABEL, "keep" if role == to else "relabel", -1))
            for then in NEXT[to]:
                out.append((q, then, INSERT + (0 if role == then else RELABEL), "keep" if role == then else "relabel", to))
    return out


STEPS = [steps(r) for r in range(4)]
#: What it costs to end in each state: the turns that are still missing.
ENDING = (2 * INSERT, 2 * INSERT, INSERT, 0)


def _matrices() -> np.ndarray:
    out = np.full((4, 4, 4), FAR, np.int64)
    for r in range(4):
        for q, to, cost, *_ in STEPS[r]:
            out[r, q, to] = min(out[r, q, to], cost)
    return out


MATRIX = _matrices()


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Best costs over two stretches, one after the other."""
    return np.minimum((a[:, :, None] + b[None]).min(axis=1), FAR)


def block_matrix(roles: np.ndarray) -> np.ndarray:
    total = np.where(np.eye(4, dtype=bool), 0, FAR)
    for r in roles.tolist():
        total = product(total, MATRIX[r])
    return total


def edges(matrices: list[np.ndarray]) -> list[tuple[int, int]]:
    """State before and after each block of the cheapest repair of a conversation."""
    cost = [np.array([0, FAR, FAR, FAR])]
    for m in matrices:
        cost.append(np.minimum((cost[-1][:, None] + m).min(axis=0), FAR))
    state = int((cost[-1] + np.array(ENDING)).argmin())
    out = []
    for k in range(len(matrices) - 1, -1, -1):
        before = int((cost[k] + matrices[k][:, state]).argmin())
        out.append((before, state))
        state = before
    return out[::-1]


def repair(roles: list[int], first: int, last: int) -> list[tuple[int, str, int]]:
    """(state, action, inserted state or -1) of each turn on the cheapest way from one state to another."""
    cost = [[FAR] * 4 for _ in range(len(roles) + 1)]
    cost[0][first] = 0
    for k, r in enumerate(roles):
        for q, to, c, *_ in STEPS[r]:
            if cost[k][q] + c < cost[k + 1][to]:
                cost[k + 1][to] = cost[k][q] + c
    out, state = [], last
    for k in range(len(roles) - 1, -1, -1):
        q, to, c, action, put = next(s for s in STEPS[roles[k]] if s[1] == state and cost[k][s[0]] + s[2] == cost[k + 1][state])
        out.append((state, action, put))
        state = q
    return out[::-1]


def blocks(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Turns in order, with the number of their partition and block, and their place in it."""
    name = F.lower(F.trim(F.col(f"`{role}`").cast("string")))
    code = F.when(name == "system", 1).when(name == "user", 2).when(name == "assistant", 3).otherwise(0).cast("int")
    rows = df.select(F.coalesce(F.concat(F.lit("="), F.col(f"`{conv}`").cast("string")), F.lit("")).alias("conv"), F.col(f"`{conv}`").alias("id"),
                     F.col(f"`{turn}`").cast("bigint").alias("turn"), code.alias("role"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
                     F.monotonically_increasing_id().alias("row"))
    order = ["conv", "turn", "role", "text", "row"]
    rows = rows.repartitionByRange(width(df.sparkSession), *order).sortWithinPartitions(*order).drop("row").withColumn("part", F.spark_partition_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, place, last = -1, 0, None
        for batch in batches:
            number, at = np.empty(batch.num_rows, np.int64), np.empty(batch.num_rows, np.int64)
            for i, key in enumerate(batch.column("conv").to_pylist()):
                if key != last or place == BLOCK:
                    block, place, last = block + 1, 0, key
                number[i], at[i] = block, place
                place += 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(number), pa.array(at)], names=[*batch.schema.names, "block", "at"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return cut(rows.mapInArrow(run, f"{kinds}, block bigint, at bigint"))


def plans(turns: DataFrame) -> DataFrame:
    """(part, block, before, after, first, ends) of each block: its edge states, its first place, whether it ends the conversation."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, ["part", "block"]):
            m = block_matrix(group.column("role").to_numpy())
            yield pa.RecordBatch.from_arrays([pa.array([group.column("conv")[0].as_py()]), pa.array([group.column("part")[0].as_py()], pa.int64()),
                                              pa.array([group.column("block")[0].as_py()]), pa.array([group.num_rows]), pa.array([m.ravel().tolist()])],
                                             names=["conv", "part", "block", "n", "m"])

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, ["conv"]):
            n = group.column("n").to_numpy()
            states = edges([np.array(x).reshape(4, 4) for x in group.column("m").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [group.column("part").combine_chunks(), group.column("block").combine_chunks(), pa.array([a for a, _ in states]), pa.array([b for _, b in states]),
                 pa.array(np.cumsum(n) - n), pa.array([k + 1 == len(states) for k in range(len(states))])],
                names=["part", "block", "before", "after", "first", "ends"])

    ordered = turns.select("conv", "role", F.col("part").cast("bigint").alias("part"), "block", "at").sortWithinPartitions("part", "block", "at")
    weighed = ordered.mapInArrow(weigh, "conv string, part bigint, block bigint, n bigint, m array<bigint>")
    dealt = weighed.repartition(width(turns.sparkSession), "conv").sortWithinPartitions("conv", "part", "block")
    return cut(dealt.mapInArrow(settle, "part bigint, block bigint, before bigint, after bigint, first bigint, ends boolean"))


def head(state: int) -> str:
    return f"<|{ROLES[state]}|>\n"


END = "<|end|>\n"


def repaired(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, place, turn, role, action, piece): the pieces of a conversation in order are its rendering.

    action: keep, relabel, merge or insert (turn is null then). A piece that opens a turn starts with its head and, unless it is
    the first, with the end of the turn before; the last piece closes its turn.
    """
    turns = blocks(df, conv, turn, role, text)
    plan = plans(turns)
    if small_enough(plan, SEND_BOUND):
        plan = F.broadcast(plan)
    joined = turns.withColumn("part", F.col("part").cast("bigint")).join(plan, ["part", "block"]).sortWithinPartitions("part", "block", "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, ["part", "block"]):
            before, after, first, ends = (group.column(c)[0].as_py() for c in ("before", "after", "first", "ends"))
            path = repair(group.column("role").to_pylist(), before, after)
            ids, numbers, texts = (group.column(c).to_pylist() for c in ("id", "turn", "text"))
            out: list[tuple] = []
            state = before
            for k, (to, action, put) in enumerate(path):
                place = 4 * (first + k)
                if put >= 0:
                    out.append((ids[k], place, None, ROLES[put], "insert", (END if state != START else "") + head(put)))
                    state = put
                lead = "\n" if action == "merge" else (END if state != START else "") + head(to)
                out.append((ids[k], place + 1, numbers[k], ROLES[to], action, lead + texts[k]))
                state = to
            if ends:
                place = 4 * (first + len(path) - 1)
                for extra in range(2):
                    if state != ASSISTANT:
                        state = NEXT[state][-1]
                        out.append((ids[0], place + 2 + extra, None, ROLES[state], "insert", END + head(state)))
                *rest, piece = out[-1]
                out[-1] = (*rest, piece + END)
            columns = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (group.schema.field("id").type, pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()), strict=True)],
                                             names=["id", "place", "turn", "role", "action", "piece"])

    kind = turns.schema["id"].dataType.simpleString()
    out = joined.mapInArrow(run, f"id {kind}, place bigint, turn bigint, role string, action string, piece string")
    return out.withColumnRenamed("id", conv)
