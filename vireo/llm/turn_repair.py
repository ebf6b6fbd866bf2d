"""Conversation structure repair at least cost, by run-length dynamic programming.

A row is a symbol: its role's initial and its fault.  The four states of
``(s?(ua)+)?`` (nothing yet, after s, u and a) and the edits make a min-plus
transition matrix of each symbol.  Equal consecutive symbols are one run, and
a run is advanced through cached binary powers of its matrix.  Conversations
are cut into blocks of bounded size: blocks become matrices side by side, a
conversation's few block matrices give the costs at every block's end, and
then all blocks unroll their edits side by side for each state they may start
in.  So no task holds a whole conversation, however long it is.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vireo.llm.common import Scratch

REROLE, DELETE, INSERT, CUT_OFF = 1, 2, 5, 5
BLANKS = " \t\n\x0b\x0c\r"
#: Bits of a row's position inside its block: 4,096 rows at most.
BLOCK = 12
#: States: nothing yet, after s, after u, after a.
START, S, U, A = range(4)
#: The only state that a user or assistant turn leads to, and the turn.
NEXT, TURN = (U, U, A, U), ("user", "user", "assistant", "user")
#: Where keeping a row of an initial leads.
KEEPS = {("s", START): S, ("u", START): U, ("u", S): U, ("u", A): U, ("a", U): A}
#: The cost of what cannot be.
FAR = 1 << 60
#: Costs from each state at the conversation's end: inserts that complete it.
END = (0, 2 * INSERT, INSERT, 0)
FAULTS = ("ok", "blank", "duplicate", "truncated")


def _row_edits(symbol: int) -> list[list[tuple[int, str, int]]]:
    """(cost, edit, next state) of the edits that take the row, for every state.  A symbol is 4 * fault + place of the initial in "sua?"."""
    initial, fault = "sua?"[symbol & 3], FAULTS[symbol >> 2]
    extra = CUT_OFF if fault == "truncated" else 0
    out = []
    for q in range(4):
        edits = [(DELETE, "D", q)]
        if fault not in ("blank", "duplicate"):
            if (initial, q) in KEEPS:
                edits.append((extra, "K", KEEPS[initial, q]))
            edits.append((REROLE + extra, "R", NEXT[q]))
        out.append(edits)
    return out


def _times(a: tuple, b: tuple) -> tuple:
    """Min-plus product of a matrix and a matrix, as tuples of rows."""
    return tuple(tuple(min(FAR, *(a[i][k] + b[k][j] for k in range(4))) for j in range(4)) for i in range(4))


def _on(a: tuple, v: tuple) -> tuple:
    return tuple(min(a[i][k] + v[k] for k in range(4)) for i in range(4))


UNIT = tuple(tuple(0 if i == j else FAR for j in range(4)) for i in range(4))


@lru_cache(maxsize=None)
def power(symbol: int, bit: int) -> tuple:
    """The transition matrix of 2 ** bit rows of the symbol, inserts before each of them included."""
    if bit:
        half = power(symbol, bit - 1)
        return _times(half, half)
    step = [[FAR] * 4 for _ in range(4)]
    for q in range(4):
        at, paid = q, 0
        for _ in range(4):  # up to three inserts reach every state that can be reached
            for cost, _edit, to in _row_edits(symbol)[at]:
                step[q][to] = min(step[q][to], paid + cost)
            at, paid = NEXT[at], paid + INSERT
    return tuple(map(tuple, step))


def runs(symbols: bytes) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for x in symbols:
        if out and out[-1][0] == x:
            out[-1] = (x, out[-1][1] + 1)
        else:
            out.append((x, 1))
    return out


def matrix(symbols: bytes) -> tuple:
    """The transition matrix of a block."""
    out = UNIT
    for symbol, n in reversed(runs(symbols)):
        for bit in range(n.bit_length()):
            if n >> bit & 1:
                out = _times(power(symbol, bit), out)
    return out


@lru_cache(maxsize=1 << 16)
def _step(symbol: int, after: tuple) -> tuple[tuple, int, tuple]:
    """From costs after a row (least 0): costs before it (least 0), what was taken off, and for every state (edits, next state), ASCII-least."""
    before = _on(power(symbol, 0), after)
    least, moves = min(before), []
    for q in range(4):
        at, edits = q, ""
        while True:
            fits = {e: to for cost, e, to in _row_edits(symbol)[at] if cost + after[to] == before[at]}
            if "D" in fits:
                moves.append((edits + "D", fits["D"]))
                break
            if INSERT + before[NEXT[at]] == before[at]:
                edits, at = edits + "I", NEXT[at]
                continue
            edit = min(fits)
            moves.append((edits + edit, fits[edit]))
            break
    return tuple(x - least for x in before), least, tuple(moves)


def unroll(symbols: bytes, after: tuple, last: bool) -> list[tuple[str, int]]:
    """(edits, end state) of a block for each start state, given the costs from the block's end; ``last`` completes the conversation there."""
    least = min(after)
    costs, steps = tuple(x - least for x in after), []
    for symbol, n in reversed(runs(symbols)):
        for _ in range(n):
            costs, _, moves = _step(symbol, costs)
            steps.append(moves)
    out = []
    for q in range(4):
        at, edits = q, []
        for moves in reversed(steps):
            part, at = moves[at]
            edits.append(part)
        while last and END[at]:
            edits.append("I")
            at = NEXT[at]
        out.append(("".join(edits), at))
    return out


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [[x for row in matrix(bytes(s)) for x in row] for s in batch.column("symbols").to_pylist()]
        yield batch.append_column("m", pa.array(rows, pa.list_(pa.int64())))


def _costs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each conversation's blocks in order: the costs from their ends, and the costs from its start."""
    for batch in batches:
        out = []
        for blocks in batch.column("ms").to_pylist():
            v, ends = END, []
            for m in reversed(blocks):
                ends.append(list(v))
                v = _on(tuple(tuple(m[4 * i:4 * i + 4]) for i in range(4)), v)
            out.append([*reversed(ends), list(v)])
        yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("ids"), pa.array(out, pa.list_(pa.list_(pa.int64())))], ["conv", "ids", "costs"])


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [unroll(bytes(s), tuple(v), last) for s, v, last in zip(*(batch.column(c).to_pylist() for c in ("symbols", "after", "last")))]
        out = [batch.column("conv"), batch.column("block"), pa.array([[e for e, _ in x] for x in found], pa.list_(pa.string())), pa.array([[q for _, q in x] for x in found], pa.list_(pa.int32()))]
        yield pa.RecordBatch.from_arrays(out, ["conv", "block", "edits", "ends"])


def _spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for every edit of the blocks: the position of the row it takes or stands before, and the turn it makes."""
    for batch in batches:
        source, i, edit, row, turned = [], [], [], [], []
        for k, (symbols, edits, start, begin) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("symbols", "edits", "start", "begin")))):
            at, taken = start, 0
            for j, e in enumerate(edits):
                turned.append(TURN[at] if e in "IR" else None)
                row.append(begin + taken)
                if e in "IR":
                    at = NEXT[at]
                elif e == "K":
                    at = KEEPS["sua?"[symbols[taken] & 3], at]
                taken += e != "I"
                source.append(k)
                i.append(j)
                edit.append(e)
        source = pa.array(source, pa.int64())
        out = [batch.column("conv").take(source), batch.column("block").take(source), pa.array(i, pa.int32()), pa.array(edit, pa.string()), pa.array(row, pa.int64()), pa.array(turned, pa.string())]
        yield pa.RecordBatch.from_arrays(out, ["conv", "block", "i", "edit", "row", "turned"])


def _beside(left: DataFrame, right: DataFrame, *keys: str, how: str = "inner") -> DataFrame:
    """Join on conversation and ``keys``, null conversations equal; the left's key columns stay."""
    own = {c: f"own_{c}" for c in ("conv", *keys)}
    both = left.join(right.withColumnsRenamed(own), [F.col(c).eqNullSafe(F.col(o)) for c, o in own.items()], how)
    return both.drop(*own.values())


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Conversations with faults, by crc32(``conv:turn``) modulo 20: 0 drops a row, 1 empties its text, 2 removes ``.!?`` from it, 3 repeats the row, 4 makes it a user's.

    Nulls count as one space in the checksum, role and text; columns other than the four go.
    """
    said = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv, turn, role, text)]
    kind = F.crc32(F.concat_ws(":", said[0], said[1]).cast("binary")) % 20
    rows = rows.select(F.col(conv), F.col(turn), said[2].alias(role), said[3].alias(text), kind.alias("kind")).filter("kind != 0")
    new_text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(F.col(text))
    rows = rows.select(conv, turn, F.when(F.col("kind") == 4, "user").otherwise(F.col(role)).alias(role), new_text.alias(text), F.explode(F.array_repeat(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy"))
    return rows.drop("copy")


def repair(rows: DataFrame, scratch: Scratch, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """The cheapest edits that give every conversation role initials ``(s?(ua)+)?``: (edits, conversations).

    Rows go by turn (nulls first), ties by role and text.  The first fault of
    a row counts: blank (no character but ASCII white space), duplicate (its
    role and text came before), truncated (its last such character is none of
    ``.!?``).  Keep costs 0, rerole to user or assistant 1, delete 2 (needed
    for blank and duplicate rows), insert an empty user or assistant turn 5;
    truncated rows that stay cost 5 more.  Of equally cheap edits the
    ASCII-least string of initials (D, I, K, R) counts.

    ``edits``: conv, at, edit, role, text, one row per edit; ``at`` orders
    them, role and text are those of the repaired turn (null for D).
    ``conversations``: conv, gaps (missing turn numbers between the first and
    the last), blank, duplicate, truncated, illegal (neighbours whose initials
    are not su, ua or au) and cost, for conversations that have rows.

    Null roles and texts must have been replaced; null conversations are one,
    null turns are in no gap; repeated rows are duplicates; an empty table
    gives two empty ones.  Other columns are ignored.  Jobs run when called.
    """
    rows = rows.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    # ranges keep a conversation's order across tasks, so that a long one need not be in one of them
    ordered = rows.repartitionByRange(F.col("conv"), F.col("turn").asc_nulls_first(), "role", "text").sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "role", "text")
    ordered = scratch.cut(ordered.withColumn("at", F.monotonically_increasing_id()), "turns")
    trimmed = F.rtrim(F.col("text"), F.lit(BLANKS))
    first = ordered.groupBy("conv", "role", "text").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("new"))
    fault = F.when(trimmed == "", 1).when(F.col("new").isNull(), 2).when(~F.right(trimmed, F.lit(1)).isin(".", "!", "?"), 3).otherwise(0)
    initial = F.substring("role", 1, 1)
    place = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    marked = ordered.join(first, "at", "left").select("conv", "turn", "at", fault.alias("fault"), place.alias("place"))
    block = F.shiftright("at", BLOCK)
    packed = F.array_sort(F.collect_list(F.struct("at", (F.col("fault") * 4 + F.col("place")).cast("short").alias("x"))))
    blocks = marked.groupBy("conv", block.alias("block")).agg(packed.alias("p"), *[F.count(F.when(F.col("fault") == k, 1)).alias(FAULTS[k]) for k in (1, 2, 3)])
    # two symbols as a number: su, ua and au are legal
    pair = lambda x, y: ~((x % 4) * 4 + y % 4).isin(1, 6, 9)
    bad = F.size(F.filter(F.zip_with(F.slice("p", 1, F.size("p") - 1), F.slice("p", 2, F.size("p")), lambda x, y: pair(x["x"], y["x"])), lambda b: b))
    blocks = blocks.select("conv", "block", "blank", "duplicate", "truncated", F.transform("p", lambda x: x["x"]).alias("symbols"),
                           F.get("p.at", F.lit(0)).alias("begin"), F.when(F.size("p") > 1, bad).otherwise(0).alias("bad"))
    blocks = scratch.cut(blocks.mapInArrow(_matrices, T.StructType([*blocks.schema.fields, T.StructField("m", T.ArrayType(T.LongType()))])), "blocks")
    listed = F.array_sort(F.collect_list(F.struct("block", "m", F.get("symbols", F.lit(0)).alias("head"), F.element_at("symbols", -1).alias("tail"))))
    whole = blocks.groupBy("conv").agg(listed.alias("b"), *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "bad")])
    seams = F.when(F.size("b") > 1, F.size(F.filter(F.zip_with(F.slice("b", 1, F.size("b") - 1), F.slice("b", 2, F.size("b")), lambda x, y: pair(x["tail"], y["head"])), lambda b: b))).otherwise(0)
    whole = scratch.cut(whole.select("conv", "blank", "duplicate", "truncated", (F.col("bad") + seams).cast("long").alias("illegal"), F.col("b.block").alias("ids"), F.col("b.m").alias("ms")), "whole")
    kind = T.StructType([whole.schema["conv"], whole.schema["ids"], T.StructField("costs", T.ArrayType(T.ArrayType(T.LongType())))])
    costs = scratch.cut(whole.select("conv", "ids", "ms").mapInArrow(_costs, kind), "costs")
    gaps = rows.filter("turn is not null").groupBy("conv").agg((F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"))
    # costs from a block's end, then the edits for every state in which it may start
    ends = costs.select("conv", F.posexplode("ids").alias("i", "block"), "costs").select("conv", "block", F.get("costs", F.col("i")).alias("after"), (F.size("costs") - 2 == F.col("i")).alias("last"))
    known = _beside(blocks.select("conv", "block", "symbols"), ends, "block")
    kind = T.StructType([known.schema["conv"], known.schema["block"], T.StructField("edits", T.ArrayType(T.StringType())), T.StructField("ends", T.ArrayType(T.IntegerType()))])
    unrolled = scratch.cut(known.mapInArrow(_edits, kind), "unrolled")
    # the state in which each block starts: the end states chained
    chain = unrolled.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("block", "ends"))).alias("b"))
    starts = F.aggregate("b", F.array(F.lit(START)), lambda seen, x: F.concat(seen, F.array(F.get(x["ends"], F.element_at(seen, -1)))))
    chain = chain.select("conv", F.posexplode("b.block").alias("i", "block"), starts.alias("starts")).select("conv", "block", F.get("starts", F.col("i")).alias("start"))
    chosen = _beside(unrolled, chain, "block").select("conv", "block", F.get("edits", F.col("start")).alias("edits"), "start")
    chosen = _beside(chosen, blocks.select("conv", "block", "begin", "symbols"), "block")
    each = chosen.mapInArrow(_spelled, T.StructType([chosen.schema["conv"], chosen.schema["block"], T.StructField("i", T.IntegerType()), T.StructField("edit", T.StringType()),
                                                     T.StructField("row", T.LongType()), T.StructField("turned", T.StringType())]))
    texts = ordered.select(F.col("at").alias("row"), F.col("role").alias("old_role"), "text")
    full = each.join(texts, (each["row"] == texts["row"]) & (each["edit"] != "I"), "left")
    full = full.select("conv", F.struct("block", "i").alias("at"), "edit", F.when(F.col("edit") == "K", F.col("old_role")).when(F.col("edit") != "D", F.col("turned")).alias("role"),
                       F.when(F.col("edit") == "I", "").when(F.col("edit") != "D", F.col("text")).alias("text"))
    totals = _beside(whole, costs.select("conv", F.get(F.element_at("costs", -1), F.lit(START)).alias("cost")))
    totals = _beside(totals, gaps, how="left")
    return full, totals.select("conv", F.coalesce("gaps", F.lit(0).cast("long")).alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost")
