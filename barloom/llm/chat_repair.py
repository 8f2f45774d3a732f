"""Chat formatting with minimum-cost role repair.

A conversation is legal if it is an optional system turn followed by user and
assistant turns that alternate and start with a user turn.  A dynamic programme
over the automaton of legal turns chooses, for every given turn, whether to keep
its role, relabel it, or merge it into the turn before, and where to insert an
empty turn, at the least total cost; the repaired sequence is then rendered.

The automaton has four states (nothing yet, system, user, assistant), so the best costs
over a block of turns form a 4 x 4 matrix, and matrices chain by (min, +).  Conversations
are cut into blocks of ``block_turns`` turns inside the ranges that a sort by
conversation and turn deals out.  A first pass makes the matrices and their product for
each part (a conversation's blocks in one range); the chain over a conversation's parts
(at most one per range) fixes the states at their borders; a second pass solves and
renders every part on its own.  No task holds more of a conversation than one range.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import grouped_batches, small_batches, staged

START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = ("", "system", "user", "assistant")
STEPS = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
INF = 1 << 40

#: Costs of the repairs (per turn).  A relabelled turn keeps its text but changes its
#: speaker (a little dearer to system); an inserted turn is empty; a merge joins a
#: turn to the one before.
COSTS = {"merge": 2, "relabel": 5, "relabel_unknown": 1, "to_system": 1, "insert": 4, "merge_system": 6}


def edges(role: str, empty: bool, costs: dict[str, int]) -> list[tuple[int, int, int, str, tuple[int, ...]]]:
    """Moves for one turn: (state before, state after, cost, action, inserted empty turns).

    The order breaks ties: keep before merge before relabel before insert.
    A turn of unknown role relabels at a small cost.  An empty turn may merge into
    any turn before it at the cost of a merge.
    """
    known = role in ROLES[1:]

    def change(to: int) -> int:
        if ROLES[to] == role:
            return 0
        return costs["relabel" if known else "relabel_unknown"] + costs["to_system"] * (to == SYSTEM)

    out = []
    for s in range(4):
        for t in STEPS[s]:
            out.append((s, t, change(t), "keep" if ROLES[t] == role else "relabel", ()))
        if s != START:  # into the turn before, whose role it then has
            price = costs["merge_system"] if s == SYSTEM and role != "system" else costs["merge"]
            out.append((s, s, price if empty else price + change(s), "merge", ()))
        for skip in STEPS[s]:
            for t in STEPS[skip]:
                if skip != SYSTEM:
                    out.append((s, t, costs["insert"] + change(t), "keep" if ROLES[t] == role else "relabel", (skip,)))
    rank = {"keep": 0, "merge": 1, "relabel": 2}
    return sorted(out, key=lambda e: (e[2], len(e[4]), rank[e[3]], e[0], e[1]))


def _moves(costs: dict[str, int]):
    memory: dict[tuple[str, bool], list] = {}

    def of(role: str | None, empty: bool) -> list:
        r = (role or "").strip().lower()
        r = r if r in ROLES[1:] else "?"
        if (r, empty) not in memory:
            memory[r, empty] = edges(r, empty, costs)
        return memory[r, empty]

    return of


def block_matrix(turns: list[tuple[str | None, bool]], of) -> list[list[int]]:
    """Least cost from each state before a block to each state after it."""
    m = [[0 if i == j else INF for j in range(4)] for i in range(4)]
    for role, empty in turns:
        new = [[INF] * 4 for _ in range(4)]
        for s, t, c, _, _ in of(role, empty):
            for i in range(4):
                if m[i][s] + c < new[i][t]:
                    new[i][t] = m[i][s] + c
        m = new
    return m


def solve(turns: list[tuple[str | None, bool]], first: int, last: int, of) -> list[tuple[int, int, str, tuple[int, ...]]]:
    """(state before, state after, action, inserted) of each turn on a least-cost path from ``first`` to ``last``."""
    best = [[INF] * 4]
    best[0][first] = 0
    via: list[list] = []
    for role, empty in turns:
        row, by = [INF] * 4, [None] * 4
        for e in of(role, empty):
            c = best[-1][e[0]] + e[2]
            if c < row[e[1]]:
                row[e[1]], by[e[1]] = c, e
        best.append(row)
        via.append(by)
    path, state = [], last
    for by in reversed(via):
        e = by[state]
        path.append((e[0], e[1], e[3], e[4]))
        state = e[0]
    return path[::-1]


def chain(matrices: list[list[list[int]]], first: int = START, last: int | None = None) -> tuple[list[tuple[int, int]], int]:
    """States (before, after) of every block on the cheapest way through all of them (to ``last``, or any), and its cost."""
    best, via = [0 if s == first else INF for s in range(4)], []
    for m in matrices:
        cost = [[best[s] + m[s][t] for s in range(4)] for t in range(4)]
        via.append([int(np.argmin(c)) for c in cost])
        best = [min(c) for c in cost]
    state = int(np.argmin(best)) if last is None else last
    total, out = best[state], []
    for by in reversed(via):
        out.append((by[state], state))
        state = by[state]
    return out[::-1], total


def times(a: list[list[int]], b: list[list[int]]) -> list[list[int]]:
    """(min, +) product: least costs over two runs of turns in turn."""
    return [[min(a[i][k] + b[k][j] for k in range(4)) for j in range(4)] for i in range(4)]


def _to_blocks(block_turns: int, costs: dict[str, int]):
    """Sorted turns of a range to a row per block (turns, matrix), and after the blocks of
    each part a row with their product and number (turns null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = _moves(costs)
        part, whole, blocks, types = 0, None, 0, None
        out = {"conv": [], "part": [], "turns": [], "matrix": [], "n": []}

        def emit(conv, turns, m, n):
            for k, v in zip(out, (conv, part, turns, [c for row in m for c in row], n)):
                out[k].append(v)

        def batch():
            got = pa.RecordBatch.from_arrays([pa.array(out["conv"], types[0]), pa.array(out["part"], pa.int64()),
                                              pa.array(out["turns"], types[1]), pa.array(out["matrix"], pa.list_(pa.int64())),
                                              pa.array(out["n"], pa.int64())], names=list(out))
            for v in out.values():
                v.clear()
            return got

        conv = None
        for t in grouped_runs(batches, block_turns):
            types = (t.schema.field("conv").type, pa.list_(pa.struct([t.schema.field(k) for k in ("turn", "role", "text")])))
            rows = t.to_pylist()
            if whole is not None and rows[0]["conv"] != conv:
                emit(conv, None, whole, blocks)
                part, whole, blocks = part + 1, None, 0
            conv = rows[0]["conv"]
            m = block_matrix([(r["role"], not (r["text"] or "").strip()) for r in rows], of)
            whole, blocks = m if whole is None else times(whole, m), blocks + 1
            emit(conv, [{k: r[k] for k in ("turn", "role", "text")} for r in rows], m, blocks - 1)
            if len(out["conv"]) >= 256:
                yield batch()
        if whole is not None:
            emit(conv, None, whole, blocks)
            yield batch()

    return run


def grouped_runs(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    """Runs of at most ``most`` rows of one conversation, in order."""
    held: list[pa.RecordBatch] = []
    n = 0
    for b in batches:
        conv = b.column(b.schema.get_field_index("conv"))
        values = conv.to_pylist()
        lo = 0
        for hi in range(1, len(values) + 1):
            if hi == len(values) or values[hi] != values[lo] or n + hi - lo == most:
                if held and held[-1].column(0)[0].as_py() != values[lo]:
                    yield pa.Table.from_batches(held)
                    held, n = [], 0
                held.append(b.slice(lo, hi - lo))
                n += hi - lo
                if n >= most:
                    yield pa.Table.from_batches(held)
                    held, n = [], 0
                lo = hi
    if held:
        yield pa.Table.from_batches(held)


def _chain_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts sorted by conversation to their border states, the cost, the blocks before, and whether the last."""
    for t in grouped_batches(batches, "ck"):
        out = {k: [] for k in ("part", "first", "last", "cost", "before", "ends")}
        rows, lo = t.to_pylist(), 0
        for hi in range(1, len(rows) + 1):
            if hi < len(rows) and (rows[hi]["ck"], rows[hi]["conv"]) == (rows[lo]["ck"], rows[lo]["conv"]):
                continue
            own = rows[lo:hi]
            states, total = chain([[r["matrix"][i:i + 4] for i in (0, 4, 8, 12)] for r in own])
            before = 0
            for r, (s, e) in zip(own, states):
                for k, v in zip(out, (r["part"], s, e, total, before, r is own[-1])):
                    out[k].append(v)
                before += r["n"]
            lo = hi
        types = {"first": pa.int32(), "last": pa.int32(), "ends": pa.bool_()}
        yield pa.RecordBatch.from_arrays([pa.array(v, types.get(k, pa.int64())) for k, v in out.items()], names=list(out))


def _render(conv_type: pa.DataType, costs: dict[str, int], block_turns: int, open_tag: str, close_tag: str, joiner: str):
    def fragments(turns: list[dict], path: list, ends: bool) -> Iterator[tuple]:
        for i, (t, (s, e, action, skipped)) in enumerate(zip(turns, path)):
            text = t["text"] or ""
            if action == "merge":
                body = joiner + text if text else ""
            else:
                empty = "".join(open_tag.format(role=ROLES[x]) + close_tag for x in skipped)
                body = (close_tag if s != START else "") + empty + open_tag.format(role=ROLES[e]) + text
            if ends and i == len(turns) - 1:
                body += close_tag
            yield t["turn"], t["role"], ROLES[e], action, len(skipped), body

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = _moves(costs)
        names = ("conv", "seq", "turn", "given_role", "role", "action", "inserted", "cost", "fragment")
        for t in grouped_batches(batches, "part"):
            types = {"conv": conv_type, "seq": pa.int64(), "inserted": pa.int32(), "cost": pa.int64(),
                     "turn": t.schema.field("turns").type.value_type.field("turn").type}
            out = {k: [] for k in names}
            border, own = None, []

            def close():
                if border is None:
                    return
                path = [[r["matrix"][i:i + 4] for i in (0, 4, 8, 12)] for r in own]
                for r, (s, e) in zip(own, chain(path, border["first"], border["last"])[0]):
                    moves = solve([(x["role"], not (x["text"] or "").strip()) for x in r["turns"]], s, e, of)
                    nth = border["before"] + r["n"]
                    done = border["ends"] and r is own[-1]
                    for i, f in enumerate(fragments(r["turns"], moves, done)):
                        for k, v in zip(names, (r["conv"], nth * block_turns + i, *f[:5], border["cost"], f[5])):
                            out[k].append(v)

            for r in t.to_pylist():
                if r["turns"] is None:  # the part's border states sort before its blocks
                    close()
                    border, own = r, []
                else:
                    own.append(r)
            close()
            yield pa.RecordBatch.from_arrays([pa.array(v, types.get(k, pa.string())) for k, v in out.items()], names=list(out))

    return run


def repair(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
           costs: dict[str, int] | None = None, block_turns: int = 64,
           open_tag: str = "<|{role}|>\n", close_tag: str = "<|end|>\n", joiner: str = "\n") -> DataFrame:
    """One row per given turn: conv_id, seq, turn, given_role, role, action, inserted, cost, fragment.

    ``fragment`` is the turn's part of the rendering: it closes the turn before,
    writes inserted empty turns, and opens this one (a merged turn only adds its
    text); the fragments of a conversation in ``seq`` order are its rendering.
    ``cost`` is the conversation's least total cost.  Turns are ordered by turn number (null first),
    then role and text, so ties and repeated rows have a fixed order and each
    is a turn of its own.  A null or unknown role may be relabelled cheaply, a null
    text is empty, rows of a null conversation form one conversation.  Extra
    columns are ignored; a table without rows gives none.
    """
    costs = COSTS | (costs or {})
    small_batches(turns.sparkSession)
    rows = turns.select(F.isnull(conv_col).alias("none"), F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
                        F.col(role_col).cast("string").alias("role"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("h"))
    order = ["none", "conv", "turn", "role", "h"]
    ck, tk = turns.schema[conv_col].dataType.simpleString(), turns.schema[turn_col].dataType.simpleString()
    made = staged(
        rows.repartitionByRange(*order).sortWithinPartitions(*order, "text").select("conv", "turn", "role", "text")
        .mapInArrow(_to_blocks(block_turns, costs),
                    f"conv {ck}, part long, turns array<struct<turn:{tk},role:string,text:string>>, matrix array<bigint>, n long")
        .withColumn("part", F.shiftleft(F.spark_partition_id().cast("long"), 33) + F.col("part")), "blocks")
    parts = (made.where(F.col("turns").isNull())
             .select(F.xxhash64(F.isnull("conv"), "conv").alias("ck"), "conv", "part", "matrix", "n"))
    borders = (parts.repartition("ck").sortWithinPartitions("ck", "conv", "part")
               .mapInArrow(_chain_parts, "part long, first int, last int, cost long, before long, ends boolean"))
    blocks = made.where(F.col("turns").isNotNull())
    both = (blocks.withColumns({k: F.lit(None).cast(v) for k, v in
                                (("first", "int"), ("last", "int"), ("cost", "long"), ("before", "long"), ("ends", "boolean"))})
            .unionByName(borders.withColumn("n", F.lit(-1).cast("long")), allowMissingColumns=True))
    return (both.repartition("part").sortWithinPartitions("part", "n")
            .mapInArrow(_render(_arrow_type(turns, conv_col), costs, block_turns, open_tag, close_tag, joiner),
                        f"conv {ck}, seq long, turn {tk}, given_role string, role string, action string, inserted int, cost long, fragment string")
            .withColumnRenamed("conv", "conv_id"))


def _arrow_type(df: DataFrame, col: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[col].dataType)


def render(repaired: DataFrame) -> DataFrame:
    """(conv_id, text, cost): the rendering of conversations short enough for one row."""
    parts: Column = F.array_sort(F.collect_list(F.struct("seq", "fragment")))
    return repaired.groupBy("conv_id").agg(F.array_join(F.transform(parts, lambda p: p["fragment"]), "").alias("text"),
                                           F.max("cost").alias("cost"))
