"""Conversation structure repair (operator 12): the cheapest edits that leave `(s?(ua)+)?` as the initials of the roles.

Faults: a row is blank (no character but blanks), else a duplicate (its role and text were seen earlier in the conversation), else
truncated (its last character that isn't blank is none of `.!?`). Edits: K keeps a row (0), R gives it the role due (3), D deletes
it (4; blank rows and duplicates must go), I inserts an empty turn of the role due (3); a truncated row that stays adds 3. Of the
cheapest edits those count whose initials, in order, are least in ASCII.

Method: rank-compressed dynamic programming. A macro edit is a run of inserts and the edit of the next row. Its code (`K`, `IIR`,
`D` ...) is taken from a prefix-free set, so strings of as many codes are never one another's prefix, and two of them compare by
their first codes that differ. A layer (what is known after so many rows) therefore needs no strings: for each of the four
states of the role pattern it holds a cost, the rank of its string among the layer's strings, and a pointer to the parent state;
the next layer's ranks follow from (parent's rank, code). Costs are kept less the layer's least, so few layers are different and
each is worked out once. The audit string is read back from the pointers. (An insert right before a delete is never best: the
other order costs the same and is less in ASCII.)

Scale: equal rows are counted before anything else; rows are then dealt by ranges of (conversation, turn, role, text), not by
conversation, and cut into blocks of at most `BLOCK_ROWS` rows, so a conversation of any length is spread over tasks. A conversation that
lies in one block is solved there. Of others each block gives its table of least costs and ranks from any state to any state (32
numbers), and the tables of a conversation are combined in order, which yields each block's first and last state; then each block
reads back its own edits. One group holds 32 numbers for each 4096 rows of a conversation. Only a digest of a whole conversation
is serial, as SHA-256 is: its blocks pass through one task one after another, without being held.

Nulls and edges: conv_id null is a conversation of its own, and kept null; turn nulls come first; a null role or text is one space; rows of one turn are
taken by role, then by the first 64 characters of the text, then by a digest of it; a conversation without rows has zeros and empty strings; an
empty table gives no rows; other columns aren't read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import arrow_schema, keep, small_batches

BLOCK_ROWS, BLOCK_BYTES = 4096, 4 << 20
RETAG, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3
BLANKS = " \t\n\x0b\x0c\r"
LEGAL = ("su", "ua", "au")

# The pattern's states: nothing yet, system, user, assistant. DUE is the state (and role) that an insert leads to, ENDS the inserts to an end.
ROLES = ("", "system", "user", "assistant")
DUE = (2, 2, 3, 2)
ENDS = (0, 2, 1, 0)
INITIALS = "sua"
AFTER = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}
#: A row's kind: its initial's place in INITIALS (3: another), plus 4 where it is truncated; MUST_GO for blank rows and duplicates.
MUST_GO = 8
NEVER = 1 << 60


def _edits(kind: int) -> dict[tuple[int, int], tuple[int, str]]:
    """The cheapest macro edit of a row between two states, the least one in ASCII of equals. Three inserts lead where one does."""
    out = {(x, x): (DELETE, "D") for x in range(4)}
    late = CUT_OFF if kind & 4 else 0
    for x in range(4) if kind != MUST_GO else ():
        y = x
        for inserts in range(3):
            options = [(DUE[y], INSERT * inserts + RETAG + late, "I" * inserts + "R")]
            if kind % 4 < 3 and (to := AFTER.get((INITIALS[kind % 4], y))) is not None:
                options.append((to, INSERT * inserts + late, "I" * inserts + "K"))
            for to, cost, code in options:
                out[x, to] = min(out.get((x, to), (NEVER, "")), (cost, code))
            y = DUE[y]
    return out


EDITS = [_edits(kind) for kind in range(MUST_GO + 1)]
Layer = tuple[tuple[int, ...], tuple[int, ...]]


def entry(state: int) -> Layer:
    """The layer before any row, in which only one state is possible: costs and ranks by state."""
    return tuple(0 if x == state else NEVER for x in range(4)), tuple(range(4))


def _layer(found: list[tuple[int, int, int, object]]) -> tuple[Layer, int, tuple]:
    """The layer from (cost, parent's rank, parent, code) by state, with costs less the least one, that one, and (parent, code) by state."""
    least = min(f[0] for f in found)
    order = sorted(range(4), key=lambda y: (found[y][0] >= NEVER, found[y][1], found[y][3]))
    ranks = tuple(order.index(y) for y in range(4))
    return (tuple(min(NEVER, f[0] - least) if f[0] < NEVER else NEVER for f in found), ranks), least, tuple((f[2], f[3]) for f in found)


@cache
def advance(layer: Layer, kind: int) -> tuple[Layer, int, tuple]:
    """The layer after a row of this kind."""
    costs, ranks = layer
    none = (NEVER, 4, 0, "")
    found = [min(((costs[x] + c, ranks[x], x, code) for (x, to), (c, code) in EDITS[kind].items() if to == y and costs[x] < NEVER), default=none) for y in range(4)]
    return _layer(found)


def forward(kinds: list[int], layer: Layer) -> tuple[Layer, int, list[tuple]]:
    """The layer after rows of these kinds, what its costs are less by, and each layer's pointers."""
    total, trail = 0, []
    for kind in kinds:
        layer, least, back = advance(layer, kind)
        total += least
        trail.append(back)
    return layer, total, trail


def backward(trail: list[tuple], state: int) -> tuple[list, int]:
    """The code of each row on the way to a state, and the state it began with."""
    codes = []
    for back in reversed(trail):
        state, code = back[state]
        codes.append(code)
    return codes[::-1], state


def last_state(layer: Layer) -> tuple[int, int]:
    """The state to end in and the cost from there."""
    costs, ranks = layer
    cost, _, state = min((costs[x] + INSERT * ENDS[x], ranks[x], x) for x in range(4))
    return state, cost


def between_states(kinds: list[int]) -> tuple[list[int], list[int]]:
    """Least costs and ranks from each state to each state over these rows, 16 numbers each."""
    costs, ranks = [], []
    for x in range(4):
        layer, total, _ = forward(kinds, entry(x))
        costs += [c + total if c < NEVER else NEVER for c in layer[0]]
        ranks += layer[1]
    return costs, ranks


def through_blocks(tables: list[tuple[list[int], list[int]]]) -> tuple[list[tuple[int, int]], int]:
    """The first and last state of each block of a conversation, and the cost without copies' deletes."""
    layer, total, trail = entry(0), 0, []
    for costs, ranks in tables:
        none = (NEVER, 4, 0, 0)
        found = [min(((layer[0][x] + costs[4 * x + y], layer[1][x], x, ranks[4 * x + y]) for x in range(4) if layer[0][x] < NEVER and costs[4 * x + y] < NEVER), default=none) for y in range(4)]
        layer, least, back = _layer(found)
        total += least
        trail.append(back)
    state, cost = last_state(layer)
    ways = []
    for back in reversed(trail):
        ways.append((back[state][0], state))
        state = back[state][0]
    return ways[::-1], total + cost


def apply(rows: list[tuple[str, str, int, int]], state: int, codes: list[str], ends: bool, last: int) -> tuple[str, list[dict]]:
    """The audit string and the repaired turns of rows (role, text, copies, kind), edited from a state; with ends also the inserts at the end."""
    audit, turns = [], []
    for (role, text, copies, _), code in zip(rows, codes, strict=True):
        for edit in code:
            if edit == "K":
                state = AFTER[role[:1], state]
                turns.append({"role": role, "text": text})
            elif edit != "D":
                state = DUE[state]
                turns.append({"role": ROLES[state], "text": text if edit == "R" else ""})
        audit.append(code + "D" * (copies - 1))
    for _ in range(ENDS[last] if ends else 0):
        state = DUE[state]
        audit.append("I")
        turns.append({"role": ROLES[state], "text": ""})
    return "".join(audit), turns


ROW = T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType()), T.StructField("copies", T.LongType()), T.StructField("kind", T.IntegerType())])
TURN = T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
COUNTS = ["blank", "duplicate", "truncated", "illegal"]


def _block_schema(conv: T.DataType) -> T.StructType:
    long, many = T.LongType(), T.ArrayType(T.LongType())
    return T.StructType(
        [T.StructField("conv_id", conv), T.StructField("part", long), T.StructField("no", long), T.StructField("whole", T.BooleanType())]
        + [T.StructField(c, long) for c in [*COUNTS, "n_turns", "first_turn", "last_turn"]]
        + [T.StructField("first_initial", T.StringType()), T.StructField("last_initial", T.StringType()), T.StructField("extra", long), T.StructField("cost", long)]
        + [T.StructField("costs", many), T.StructField("ranks", many), T.StructField("rows", T.ArrayType(ROW)), T.StructField("audit", T.StringType()), T.StructField("turns", T.ArrayType(TURN))]
    )


class Block:
    """Rows of one conversation that lie next to each other in one partition."""

    def __init__(self, conv: object, no: int, first: bool):
        self.conv, self.no, self.first = conv, no, first
        self.rows: list[tuple[str, str, int, int]] = []
        self.turns: list[int] = []
        self.size = 0
        self.counts = dict.fromkeys(COUNTS, 0)
        self.initials: list[str] = []

    def add(self, turn: int | None, role: str, text: str, copies: int, seen: bool) -> None:
        if not copies:
            return
        bare = text.rstrip(BLANKS)
        blank, cut = not bare, bool(bare) and bare[-1] not in ".!?"
        initial = role[:1]
        kind = MUST_GO if blank or seen else (INITIALS.find(initial) % 4 if initial else 3) + 4 * cut
        self.rows.append((role, text, copies, kind))
        self.size += len(text)
        if turn is not None and (not self.turns or self.turns[-1] != turn):
            self.turns.append(turn)
        c = self.counts
        c["blank"] += copies if blank else 0
        c["duplicate"] += 0 if blank else copies if seen else copies - 1
        c["truncated"] += cut and not seen
        c["illegal"] += copies - 1 + (bool(self.initials) and self.initials[-1] + initial not in LEGAL)
        self.initials = [self.initials[0] if self.initials else initial, initial]

    def result(self, part: int, whole: bool) -> dict:
        kinds = [r[3] for r in self.rows]
        extra = DELETE * sum(r[2] - 1 for r in self.rows)
        turns, initials = self.turns or [None], self.initials or [None]
        out = {"conv_id": self.conv, "part": part, "no": self.no, "whole": whole, "n_turns": len(self.turns), "first_turn": turns[0], "last_turn": turns[-1], "first_initial": initials[0], "last_initial": initials[-1], "extra": extra} | self.counts
        if not whole:
            costs, ranks = between_states(kinds)
            rows = [dict(zip(("role", "text", "copies", "kind"), r, strict=True)) for r in self.rows]
            return out | {"cost": None, "costs": costs, "ranks": ranks, "rows": rows, "audit": None, "turns": None}
        layer, total, trail = forward(kinds, entry(0))
        state, cost = last_state(layer)
        audit, repaired = apply(self.rows, 0, backward(trail, state)[0], True, state)
        return out | {"cost": total + cost + extra, "costs": None, "ranks": None, "rows": None, "audit": audit, "turns": repaired}


def _blocks(rows: DataFrame, block_rows: int) -> DataFrame:
    """A row for each block of sorted rows; whole where it is surely all of its conversation."""
    schema = _block_schema(rows.schema["conv_id"].dataType)
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, now, done, size = TaskContext.get().partitionId(), None, [], 0

        def ready() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(done, schema=out)

        for batch in batches:
            for conv, turn, role, text, copies, seen in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("conv_id", "turn", "role", "text", "copies", "seen")), strict=True):
                other = now is None or conv != now.conv
                if other or len(now.rows) >= block_rows or now.size >= BLOCK_BYTES:
                    if now is not None:
                        done.append(now.result(part, other and now.first))
                        size += now.size
                        if len(done) >= 500 or size >= BLOCK_BYTES:
                            yield ready()
                            done, size = [], 0
                    now = Block(conv, now.no + 1 if now is not None else 0, other and now is not None)
                now.add(turn, role, text, copies, seen)
        if now is not None:
            done.append(now.result(part, False))
        yield ready()

    return rows.mapInArrow(run, schema)


def _combined(blocks: DataFrame) -> DataFrame:
    """For each block of conversations of more than one block: first and last state, whether it is the last block, and the conversation's numbers."""
    conv = blocks.schema["conv_id"].dataType
    long = T.LongType()
    names = ["part", "no", "from_state", "to_state", "last"]
    schema = T.StructType([T.StructField("conv_id", conv), *(T.StructField(c, long) for c in names), *(T.StructField(c, long) for c in ["cost_", "gaps_", *(f"{c}_" for c in COUNTS)])])

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["part", "no"], kind="stable")
        ways, cost = through_blocks([([int(v) for v in c], [int(v) for v in r]) for c, r in zip(pdf["costs"], pdf["ranks"], strict=True)])
        counts = {c: int(pdf[c].sum()) for c in COUNTS}
        distinct, before, turn, low = 0, None, None, None
        for n, first, last, a, z in zip(pdf["n_turns"], pdf["first_turn"], pdf["last_turn"], pdf["first_initial"], pdf["last_initial"], strict=True):
            if a is not None:
                counts["illegal"] += before is not None and before + a not in LEGAL
                before = z
            if n:
                distinct += int(n) - (turn is not None and int(first) == turn)
                low, turn = int(first) if low is None else low, int(last)
        gaps = turn - low + 1 - distinct if turn is not None else 0
        rows = [[pdf["conv_id"].iloc[0], p, n, x, y, i == len(ways) - 1, cost + int(pdf["extra"].sum()), gaps, *counts.values()] for i, (p, n, (x, y)) in enumerate(zip(pdf["part"], pdf["no"], ways, strict=True))]
        return pd.DataFrame(rows, columns=schema.names)

    small = blocks.select("conv_id", "part", "no", *COUNTS, "n_turns", F.coalesce("first_turn", F.lit(0)).alias("first_turn"), F.coalesce("last_turn", F.lit(0)).alias("last_turn"), "first_initial", "last_initial", "extra", "costs", "ranks")
    return small.groupBy("conv_id").applyInPandas(solve, schema)


def _read_back(blocks: DataFrame, states: DataFrame) -> DataFrame:
    """Audit string and turns of each block of the conversations that states tells of."""
    kept = [f for f in states.schema.fields if f.name.endswith("_")]
    schema = T.StructType([blocks.schema["conv_id"], blocks.schema["part"], blocks.schema["no"], *kept, T.StructField("audit", T.StringType()), T.StructField("turns", T.ArrayType(TURN))])
    out = arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                rows = [(x["role"], x["text"], x["copies"], x["kind"]) for x in r["rows"]]
                codes, _ = backward(forward([x[3] for x in rows], entry(r["from_state"]))[2], r["to_state"])
                audit, turns = apply(rows, r["from_state"], codes, bool(r["last"]), r["to_state"])
                yield pa.RecordBatch.from_pylist([{f.name: r.get(f.name) for f in schema} | {"audit": audit, "turns": turns}], schema=out)

    at = blocks.select("conv_id", "part", "no", "rows")
    same = F.expr("b.part = s.part AND b.no = s.no")  # a partition numbers its blocks, so no conv_id is needed
    return at.alias("b").join(states.drop("conv_id").alias("s"), same).select("b.conv_id", "b.part", "b.no", "b.rows", "from_state", "to_state", "last", *[f.name for f in kept]).mapInArrow(run, schema)


def repair(conversations: DataFrame, copies: str | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Repaired conversations: a row for each block of a conversation (most have one), ordered by part and no within it.

    Columns: conv_id, part, no, gaps, blank, duplicate, truncated, illegal and cost, which are the whole conversation's, and the block's audit and turns (role, text).
    copies names a column that says how often a row occurs (0: not at all, but its conversation exists).
    """
    spark = conversations.sparkSession
    small_batches(spark)
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), (F.col(copies) if copies else F.lit(1)).cast("long").alias("copies"))
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    rows = rows.withColumn("digest", F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "head", "digest")]
    rows = rows.withColumn("head", F.substring("text", 1, 64))
    # where a text comes at several turns all but its first are duplicates; the table of such texts is small, and joined by what AQE measures
    there = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    again = rows.filter("copies > 0").groupBy("conv_id", "digest").agg(F.min(there).alias("first"), F.count("*").alias("n")).filter("n > 1")
    seen = rows.alias("r").join(again.alias("a"), F.expr("r.conv_id <=> a.conv_id AND r.digest = a.digest"), "left")
    seen = seen.select("r.*", F.coalesce((F.col("r.turn").isNotNull() != F.col("a.first.known")) | (F.col("r.turn") != F.col("a.first.turn")), F.lit(False)).alias("seen"))
    ordered = seen.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "turn", "role", "text", "copies", "seen")
    blocks, _ = keep(_blocks(ordered, block_rows), "conversation-blocks")
    whole = blocks.filter("whole").select("conv_id", "part", "no", F.expr("coalesce(last_turn - first_turn + 1 - n_turns, 0)").alias("gaps"), *COUNTS, "cost", "audit", "turns")
    split = blocks.filter("NOT whole")
    read = _read_back(split, _combined(split))
    return whole.unionByName(read.select("conv_id", "part", "no", F.col("gaps_").alias("gaps"), *[F.col(f"{c}_").alias(c) for c in COUNTS], F.col("cost_").alias("cost"), "audit", "turns"))


def digests(repaired: DataFrame) -> DataFrame:
    """A row for each conversation: its numbers, audit string, and the SHA-256 of its `role:text` lines; blocks stream through in order."""
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    numbers = ["gaps", *COUNTS, "cost"]
    d = repaired.select("conv_id", "part", "no", *numbers, "audit", (F.size("turns") > 0).alias("some"), lines.alias("lines"))
    schema = T.StructType([d.schema["conv_id"], *(T.StructField(c, T.LongType()) for c in numbers), T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])
    out = arrow_schema(schema)

    def run(batches):
        now, audit, sha, begun = None, [], None, False

        def row() -> dict:
            return {"conv_id": now["conv_id"], **{c: now[c] for c in numbers}, "audit": "".join(audit), "repaired_sha256": sha.hexdigest()}

        for batch in batches:
            done = []
            for r in batch.to_pylist():
                if now is None or r["conv_id"] != now["conv_id"]:
                    if now is not None:
                        done.append(row())
                    now, audit, sha, begun = r, [], hashlib.sha256(), False
                audit.append(r["audit"])
                if r["some"]:
                    sha.update((("\n" if begun else "") + r["lines"]).encode())
                    begun = True
            yield pa.RecordBatch.from_pylist(done, schema=out)
        yield pa.RecordBatch.from_pylist([row()] if now is not None else [], schema=out)

    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "part", "no")]
    return d.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(run, schema)


def damaged(conversations: DataFrame) -> DataFrame:
    """conversations with faults chosen by a hash of conv_id and turn; copies says how often a row is there."""
    text, role = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")), F.coalesce("role", F.lit(" "))
    k = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    broken = F.when(k == 1, "").when(k == 2, F.regexp_replace(text("text"), "[.!?]", "")).otherwise(text("text"))
    return conversations.select("conv_id", "turn", F.when(k == 4, "user").otherwise(role).alias("role"), broken.alias("text"), F.when(k == 0, 0).when(k == 3, 2).otherwise(1).alias("copies"))
