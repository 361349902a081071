"""Repair of the structure of conversations by Hirschberg's divide-and-conquer (operator 12).

The rows of a conversation are kept, given another role or deleted, and empty
rows are inserted, so that the initials of the roles read ``(s?(ua)+)?`` at the
least cost. What has been read so far is one of four states (nothing, system,
user, assistant), so the cost of all ways to a place is a vector of four numbers.
A forward vector and a backward one meet in the middle of the rows; the state
that they cross in is chosen and both halves are solved alone, in linear space.

Of equally cheap edits the ASCII-least are wanted. The edits up to a row end with
that row's own letter, so none of them is the beginning of another, and the order
of the four least ones can be carried along as four ranks beside the costs. The
crossing is the cheapest state of the lowest rank.

Rows are sorted over the whole table by ranges, so a conversation that holds a
large part of them is cut into pieces, each in its own task. A piece is summed up
by its four by four costs and ranks, and is to the conversation what a row is to
the piece: the same search finds the states between pieces (of the few that reach
over the end of a range), and then each piece is solved alone. Only the hash over
a whole conversation has to read its texts in one row after another: one task
streams them, and holds none.

Defined cases: null roles and texts are read as one space; a row is blank if it
has nothing but ASCII blanks, a duplicate if an earlier row has its role and text,
and truncated if its last character that is no blank is not one of ``.!?``, in
this order; rows are in order of turn (null first), role and the hash of the
text, so the same rows give the same repair; a null identifier is a conversation
of its own; conversations without a row have an empty audit and the hash of the
empty text. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (
    ArrayType, BinaryType, BooleanType, IntegerType, LongType, StringType, StructField, StructType,
)

from tillwatch.llm.shared import BLANKS, staged

# The costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
ENDS = (".", "!", "?")
DAMAGES = 20

START, SYSTEM, USER, ASSISTANT = STATES = range(4)
#: The only role that may be inserted or given in each state, as the state it leads to.
FORCED = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
LEGAL_PAIRS = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
#: Insertions that complete what ends in a state.
TAILS = ("", "II", "I", "")
#: A row's code is the state of its initial (``START`` if it is none) and one of these.
SOUND, CUT, BLANK, DUPLICATE = 0, 4, 8, 12
NEVER = 10**15
ORDER = ("conv_id", "turn", "role", "_digest", "_uid")
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")

Element = tuple[list[list[int]], list[list[int]]]  # costs and ranks, by state before and state after


# ------------------------------------------------------------------ the search
def edits_of_row(code: int) -> tuple[Element, list[list[str]]]:
    """Costs, ranks and letters of the cheapest edits from each state before a row to each state after it."""
    initial, fault = code % 4, code - code % 4
    best: list[list[tuple[int, str]]] = [[(NEVER, "")] * 4 for _ in STATES]
    for before in STATES:
        state, letters, cost = before, "", 0
        for _ in range(3):  # a state would come again after more insertions
            ways = [(DELETE, "D", state)]
            if fault in (SOUND, CUT):
                own = TRUNCATED if fault == CUT else 0
                ways.append((REROLE + own, "R", FORCED[state]))
                if initial and (initial == FORCED[state] or (state, initial) == (START, SYSTEM)):
                    ways.append((own, "K", initial))
            for price, letter, after in ways:
                best[before][after] = min(best[before][after], (cost + price, letters + letter))
            state, letters, cost = FORCED[state], letters + "I", cost + INSERT
    ranks = [[sorted(row, key=lambda w: (w[0] >= NEVER, w[1])).index(w) for w in row] for row in best]
    return ([[w[0] for w in row] for row in best], ranks), [[w[1] for w in row] for row in best]


ROWS = [edits_of_row(code) for code in range(16)]
ROW_ELEMENTS = [element for element, _ in ROWS]
ROW_LETTERS = [letters for _, letters in ROWS]


def forward(elements: Sequence[Element], low: int, high: int, entry: int) -> tuple[list[int], list[int]]:
    """Costs from ``entry`` before element ``low`` to the states before ``high``, and the order of their edits."""
    costs, order = [NEVER] * 4, [0] * 4
    costs[entry] = 0
    for i in range(low, high):
        step, ranks = elements[i]
        reached = [(costs[s], order[s], step[s], ranks[s]) for s in STATES if costs[s] < NEVER]
        found = [min([(c + s[after], o, r[after]) for c, o, s, r in reached]) for after in STATES]
        costs = [min(f[0], NEVER) for f in found]
        for place, after in enumerate(sorted(STATES, key=lambda s: (found[s][0] >= NEVER, found[s][1:]))):
            order[after] = place
    return costs, order


def backward(elements: Sequence[Element], low: int, high: int, exit_state: int) -> list[int]:
    """Costs from the states before element ``low`` to ``exit_state`` before ``high``."""
    costs = [NEVER] * 4
    costs[exit_state] = 0
    for i in range(high - 1, low - 1, -1):
        step = elements[i][0]
        costs = [min(step[s][after] + costs[after] for after in STATES) for s in STATES]
    return costs


def crossings(elements: Sequence[Element], low: int, high: int, entry: int, exit_state: int) -> list[int]:
    """The states between the elements, by divide and conquer."""
    if high - low < 2:
        return []
    middle = (low + high) // 2
    costs, order = forward(elements, low, middle, entry)
    rest = backward(elements, middle, high, exit_state)
    state = min(STATES, key=lambda s: (costs[s] + rest[s], order[s]))
    return [*crossings(elements, low, middle, entry, state), state,
            *crossings(elements, middle, high, state, exit_state)]


def last_state(elements: Sequence[Element], entry: int = START) -> int:
    """The state that the cheapest edits end in, before insertions complete them."""
    costs, order = forward(elements, 0, len(elements), entry)
    return min(STATES, key=lambda s: (costs[s] + INSERT * len(TAILS[s]), order[s]))


def path(elements: Sequence[Element], entry: int, exit_state: int) -> list[int]:
    """The states before, between and after the elements."""
    return [entry, *crossings(elements, 0, len(elements), entry, exit_state), exit_state]


def audit(codes: bytes, entry: int = START, exit_state: int | None = None) -> tuple[str, int]:
    """Edits of a piece and their cost, without a tail; the last piece of a conversation chooses its own exit."""
    if not codes:
        return "", 0
    elements = [ROW_ELEMENTS[code] for code in codes]
    states = path(elements, entry, last_state(elements, entry) if exit_state is None else exit_state)
    steps = list(zip(codes, states, states[1:]))
    cost = sum(ROW_ELEMENTS[code][0][a][b] for code, a, b in steps)
    tail = TAILS[states[-1]] if exit_state is None else ""
    return "".join(ROW_LETTERS[code][a][b] for code, a, b in steps) + tail, cost + INSERT * len(tail)


def summed_up(codes: bytes) -> Element:
    """A piece as one element."""
    elements = [ROW_ELEMENTS[code] for code in codes]
    both = [forward(elements, 0, len(elements), entry) for entry in STATES]
    return [b[0] for b in both], [b[1] for b in both]


class Editor:
    """Follows the letters of an audit through the rows of one conversation."""

    def __init__(self) -> None:
        self.state, self.letters, self.at = START, "", 0

    def more(self, letters: str) -> None:
        self.letters, self.at = letters, 0

    def inserted(self) -> Iterator[tuple[str, str]]:
        while self.at < len(self.letters) and self.letters[self.at] == "I":
            self.at += 1
            self.state = FORCED[self.state]
            yield ROLES[self.state], ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        """The repaired rows up to and including this one."""
        yield from self.inserted()
        letter = self.letters[self.at]
        self.at += 1
        if letter == "K":
            self.state = INITIALS[role[0]]
            yield role, text
        elif letter == "R":
            self.state = FORCED[self.state]
            yield ROLES[self.state], text
        yield from self.inserted() if self.at_tail() else ()

    def at_tail(self) -> bool:
        return self.at < len(self.letters) and not self.letters[self.at:].strip("I")


# ------------------------------------------------------------------ Spark side
def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with planted faults, by the CRC of identifier and turn; ``_copy`` is 1 in a repeated row."""
    name = F.concat(*[F.coalesce(F.col(c).cast("string"), F.lit(" ")) if c else F.lit(":") for c in ("conv_id", "", "turn")])
    damage = F.crc32(name) % DAMAGES
    text = F.when(damage == 1, "").when(damage == 2, F.translate("text", "".join(ENDS), "")).otherwise(F.col("text"))
    return (
        conversations.filter(damage != 0)
        .select("conv_id", "turn", F.when(damage == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                F.explode(F.when(damage == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"))
        .drop("_copy")
    )


def initial_of(role: Column) -> Column:
    initial = F.substring(role, 1, 1)
    value = F.lit(START)
    for letter, state in INITIALS.items():
        value = F.when(initial == letter, F.lit(state)).otherwise(value)
    return value


def prepared(conversations: DataFrame) -> DataFrame:
    """Rows with all that they show by themselves, and a number to tell equal ones apart; written, so that it stays."""
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    held = F.rtrim(F.col("text"), F.lit(BLANKS))
    fault = F.when(held == "", BLANK).when(F.right(held, F.lit(1)).isin(*ENDS), SOUND).otherwise(CUT)
    return staged(rows.select(
        "*", F.sha2("text", 256).alias("_digest"), (initial_of(F.col("role")) + fault).cast("byte").alias("_code"),
        F.monotonically_increasing_id().alias("_uid")), "conversation_rows")


def coded(rows: DataFrame) -> DataFrame:
    """Narrow rows with the code of their role and first fault."""
    narrow = rows.select(*ORDER, "_code")
    # Null turns are the smallest, in structs as in the order of rows.
    firsts = narrow.groupBy("conv_id", "role", "_digest").agg(F.min(F.struct("turn", "_uid")).alias("_first"))
    marked = narrow.join(firsts.select(F.col("_first._uid").alias("_uid"), F.lit(True).alias("_is_first")), "_uid", "left")
    again = F.col("_is_first").isNull() & (F.col("_code") < BLANK)
    return marked.withColumn("_code", F.when(again, F.col("_code") % 4 + DUPLICATE).otherwise(F.col("_code")).cast("int"))


def differs(column: pa.Array) -> np.ndarray:
    """For each value but the first whether it differs from the one before, null being a value."""
    a, b = column[1:], column[:-1]
    unequal = pc.fill_null(pc.not_equal(a, b), False)
    return pc.or_(unequal, pc.xor(pc.is_null(a), pc.is_null(b))).to_numpy(zero_copy_only=False)


def pieces(rows: DataFrame, ranges: int | None = None) -> DataFrame:
    """Narrow rows as pieces of conversations: one for each conversation and range of the order."""
    key = rows.select(*ORDER).schema
    schema = StructType([
        *key.fields, StructField("_part", IntegerType()), StructField("_codes", BinaryType()),
        StructField("_edge", BooleanType()), StructField("_costs", ArrayType(LongType())),
        StructField("_ranks", ArrayType(LongType()))])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        head: pa.RecordBatch | None = None  # first row of the open piece
        codes = bytearray()
        seen = 0

        def made(heads: pa.RecordBatch, ends: list[bytes], edges: list[bool]) -> pa.RecordBatch:
            sums = [summed_up(c) if edge else ([], []) for c, edge in zip(ends, edges)]
            added = [[part] * len(ends), ends, edges, [sum(c, []) for c, _ in sums], [sum(r, []) for _, r in sums]]
            kinds = [pa.int32(), pa.binary(), pa.bool_(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays(
                [*heads.columns, *[pa.array(m, k) for m, k in zip(added, kinds)]], names=schema.fieldNames())

        for batch in batches:
            if not len(batch):
                continue
            places = batch.select(key.fieldNames())
            own = batch.column("_code").to_numpy().astype(np.uint8).tobytes()
            borders = (np.flatnonzero(differs(batch.column("conv_id"))) + 1).tolist()
            if head is not None and not places.column(0)[0].equals(head.column(0)[0]):
                borders.insert(0, 0)
            ended = [own[start:end] for start, end in zip([0, *borders], [*borders, len(own)])]
            if head is None:
                head = places.slice(0, 1)
            codes += ended[0]
            if borders:
                ended[0] = bytes(codes)
                starts = places.take(pa.array(borders))
                yield made(head, ended[:1], [seen == 0])
                if len(borders) > 1:
                    yield made(starts.slice(0, len(borders) - 1), ended[1:-1], [False] * (len(borders) - 1))
                seen += len(borders)
                head, codes = starts.slice(len(borders) - 1), bytearray(ended[-1])
        if head is not None:
            yield made(head, [bytes(codes)], [True])

    ordered = rows.repartitionByRange(*([ranges] if ranges else []), *ORDER).sortWithinPartitions(*ORDER)
    return ordered.select(*ORDER, "_code").mapInArrow(cut, schema)


def states_between(frame: pd.DataFrame) -> pd.DataFrame:
    """Entry and exit states of the pieces of one conversation, and the illegal pairs over their borders."""
    frame = frame.sort_values("_part")
    elements = [(np.reshape(c, (4, 4)).tolist(), np.reshape(r, (4, 4)).tolist())
                for c, r in zip(frame["_costs"], frame["_ranks"])]
    states = path(elements, START, last_state(elements))
    last = [code[-1] % 4 for code in frame["_codes"]]
    first = [code[0] % 4 for code in frame["_codes"]]
    illegal = [0, *[int(pair not in LEGAL_PAIRS) for pair in zip(last, first[1:])]]
    exits = [float(s) for s in states[1:-1]] + [None]  # the last piece ends as it likes, with its tail
    return pd.DataFrame({"_uid": frame["_uid"].values, "_entry": states[:-1], "_exit": pd.array(exits, "Int64"),
                         "_border": illegal})


def solved(cut: DataFrame) -> DataFrame:
    """Pieces with their audit, cost and counts."""
    edges = cut.filter("_edge")
    # A conversation that reaches over the end of a range has edge pieces alone; two in a range at most.
    known = edges.groupBy("conv_id").applyInPandas(
        lambda frame: states_between(frame), "_uid long, _entry int, _exit int, _border long")
    joined = cut.drop("_costs", "_ranks", "_edge").join(F.broadcast(known), "_uid", "left")
    names = joined.columns
    added = ("_audit", *COUNTS[1:])
    schema = StructType([*joined.schema.fields, StructField("_audit", StringType()),
                         *[StructField(c, LongType()) for c in COUNTS[1:]]])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = zip(*[batch.column(names.index(c)).to_pylist() for c in ("_codes", "_entry", "_exit", "_border")])
            made = []
            for codes, entry, exit_state, border in columns:
                letters, cost = audit(codes, entry or START, exit_state)
                faults = [c - c % 4 for c in codes]
                illegal = sum((a % 4, b % 4) not in LEGAL_PAIRS for a, b in zip(codes, codes[1:])) + (border or 0)
                made.append((letters, faults.count(BLANK), faults.count(DUPLICATE), faults.count(CUT), illegal, cost))
            if made:
                letters, *counts = zip(*made)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(letters, pa.string()), *[pa.array(c, pa.int64()) for c in counts]],
                    names=[*names, *added])

    return staged(joined.mapInArrow(solve, schema).drop("_codes"), "conversation_pieces")


def streamed(rows: DataFrame, found: DataFrame, put: Callable[[Iterator], Iterator], schema: StructType) -> DataFrame:
    """``put`` over the repaired rows (identifier, is first of its conversation, rows) of each task.

    The record of a piece comes right before its first row; texts pass by and are not held.
    """
    records = found.select(*ORDER, F.lit(0).alias("_kind"), F.col("_audit").alias("text"))
    texts = rows.select(*ORDER, F.lit(1).alias("_kind"), "text")
    together = records.unionByName(texts).repartition("conv_id").sortWithinPartitions(*ORDER, "_kind")

    def edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        editor, fresh, before = Editor(), True, None
        for batch in batches:
            ids = batch.column("conv_id")
            new = np.concatenate(([True], differs(ids))) if len(batch) else []
            columns = zip(ids, new, *[batch.column(c).to_pylist() for c in ("role", "_kind", "text")])
            for i, (conv, is_new, role, kind, text) in enumerate(columns):
                if is_new and (i or before is None or not conv.equals(before)):
                    editor, fresh = Editor(), True
                before = conv
                if kind == 0:
                    editor.more(text)
                else:
                    yield conv, fresh, list(editor.row(role, text))
                    fresh = False

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from put(edited(batches))

    return together.select("conv_id", "role", "_kind", "text").mapInArrow(run, schema)


def in_batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 4096, most_chars: int = 1 << 24) -> Iterator[pa.RecordBatch]:
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += len(row[-1])
        if len(held) >= size or chars >= most_chars:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in held], schema)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in held], schema)


def _schemas(id_field: StructField, *fields: StructField) -> tuple[StructType, pa.Schema]:
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = StructType([id_field, *fields])
    return schema, to_arrow_schema(schema)


def solve(conversations: DataFrame, ranges: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Prepared rows of ``conversations`` (conv_id, turn, role, text), and their pieces with audits."""
    rows = prepared(conversations)
    return rows, solved(staged(pieces(coded(rows), ranges), "conversation_cuts"))


def repaired(conversations: DataFrame, ranges: int | None = None) -> DataFrame:
    """The repaired conversations: (conv_id, place, role, text), places from 0."""
    rows, found = solve(conversations, ranges)
    schema, arrow = _schemas(rows.schema["conv_id"], StructField("place", LongType()), StructField("role", StringType()),
                             StructField("text", StringType()))

    def put(edited: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        def lines() -> Iterator[tuple]:
            place = 0
            for conv, fresh, kept in edited:
                place = 0 if fresh else place
                for role, text in kept:
                    yield conv.as_py(), place, role, text
                    place += 1

        yield from in_batches(lines(), arrow)

    return streamed(rows, found, put, schema)


def hashes(rows: DataFrame, found: DataFrame) -> DataFrame:
    """SHA-256 of each repaired conversation, as ``role:text`` lines."""
    schema, arrow = _schemas(rows.schema["conv_id"], StructField("repaired_sha256", StringType()))

    def put(edited: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        def sums() -> Iterator[tuple]:
            open_id, digest, empty = None, None, True
            for conv, fresh, kept in edited:
                if fresh:
                    if digest:
                        yield open_id.as_py(), digest.hexdigest()
                    open_id, digest, empty = conv, hashlib.sha256(), True
                for role, text in kept:
                    digest.update(f"{'' if empty else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
                    empty = False
            if digest:
                yield open_id.as_py(), digest.hexdigest()

        yield from in_batches(sums(), arrow)

    return streamed(rows, found, put, schema)


def report(conversations: DataFrame, identifiers: DataFrame, ranges: int | None = None) -> DataFrame:
    """Faults, audit and hash of each conversation; a row for each of ``identifiers`` (conv_id), too."""
    rows, found = solve(conversations, ranges)
    turns = rows.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps"))
    sums = found.groupBy("conv_id").agg(
        *[F.sum(c).alias(c) for c in COUNTS[1:]],
        # As long as the audit itself; one piece for almost all conversations.
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_part", "_audit"))), lambda p: p["_audit"]), "")
        .alias("audit"))
    parts = identifiers.select("conv_id").unionByName(turns, True).unionByName(sums, True).unionByName(
        hashes(rows, found), True)
    return parts.groupBy("conv_id").agg(
        *[F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in COUNTS],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
