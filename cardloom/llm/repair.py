"""Conversation structure repair.

The cheapest edits that give a conversation the order of roles ``(s?(ua)+)?``.
What is left to pay from a row on is a vector of costs, one per state of that
pattern; up to a constant only a few vectors occur. Method: for every block of
``BLOCK`` symbols and every such vector behind it a table holds the vector before
it and the constant, so a conversation is worked off block by block by lookup,
from its end. Then each block is expanded backward, and its edits are traced
forward: of the edits that keep the cost at its least the one with the smallest
initial is taken. An initial leads from a state to one state only, so the string
of initials is the least of all.

Rows become symbols of one byte in tasks over ranges of (conversation, turn), so a
conversation of any size is spread; what meets in one task are its packed symbols,
as many bytes as its ``audit`` has characters. The digest of the repaired text is
one SHA-256 over all of it, which has no parallel form: there the rows of a
conversation pass through one task in order, but as a stream, none is held. All
tasks hold at most an Arrow batch and one string of edits.

Cases: nulls in any column are one space (in the damage, too); a null ``conv_id``
is a conversation. Rows of one turn stand in the order of a digest of role and
text. Repeated rows are rows; from the second on they are duplicates. A
conversation none of whose rows is left, or that loses all of them by repair,
has the digest of the empty string. Roles other than those of the pattern are
never kept. Other columns are left out. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import product

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardloom.llm.common import CHUNK, arrow_schema, map_batches, record_batch, written

# fixed values: costs of the edits, and what a kept or changed truncated row adds
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
WHITE = " \t\n\x0b\f\r"

#: Symbols: a row that must go, the first letters of roles, the same of truncated rows, and what fills the last block up.
GONE, LETTERS, FILL = 0, "sua?", 9
BLOCK = 3
#: States of the pattern: nothing yet, after s, after u, after a. What a row with that letter leads to, what u or a leads to, and which of the two it is.
KEPT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
NEXT, NEXT_ROLE = (2, 2, 3, 2), ("user", "user", "assistant", "user")
#: Cost of the end in each state.
END = (0, 6, 3, 0)


def step(symbol: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """Costs before a row from those after it."""
    if symbol == FILL:
        return after
    costs = []
    for state in range(4):
        cost = DELETE + after[state]
        if symbol != GONE:
            more, letter = (TRUNCATED, LETTERS[symbol - 5]) if symbol > 4 else (0, LETTERS[symbol - 1])
            cost = min(cost, REROLE + more + after[NEXT[state]])
            if letter in KEPT[state]:
                cost = min(cost, KEEP + more + after[KEPT[state][letter]])
        costs.append(cost)
    for _ in range(2):  # a row may come after up to two inserted ones: more lead to a state already seen
        costs = [min(c, INSERT + costs[NEXT[state]]) for state, c in enumerate(costs)]
    return tuple(costs)


class Blocks:
    """Vectors that occur, less their least cost, and the transitions of single symbols and of whole blocks."""

    def __init__(self) -> None:
        self.vectors: list[tuple[int, ...]] = [END]
        number = {END: 0}
        self.single: list[list[tuple[int, int]]] = []
        for vector in self.vectors:  # grows while it is gone through
            row = []
            for symbol in range(FILL + 1):
                before = step(symbol, vector)
                least = min(before)
                before = tuple(c - least for c in before)
                if before not in number:
                    number[before] = len(self.vectors)
                    self.vectors.append(before)
                row.append((number[before], least))
            self.single.append(row)
        self.table: dict[bytes, list[tuple[int, int]]] = {
            bytes(block): [self.folded(block, v) for v in range(len(self.vectors))] for block in product(range(FILL + 1), repeat=BLOCK)
        }

    def folded(self, block: tuple[int, ...], vector: int) -> tuple[int, int]:
        total = 0
        for symbol in reversed(block):
            vector, cost = self.single[vector][symbol]
            total += cost
        return vector, total


@cache
def blocks() -> Blocks:
    return Blocks()


def least_edits(symbols: bytes) -> tuple[int, str]:
    """Least cost of the rows' symbols, and the initials of the edits."""
    tables = blocks()
    padded = symbols + bytes([FILL]) * (-len(symbols) % BLOCK)
    starts = range(0, len(padded), BLOCK)
    behind = bytearray(len(starts))  # the vector behind each block
    vector = total = 0
    for i in range(len(starts) - 1, -1, -1):
        behind[i] = vector
        vector, cost = tables.table[padded[i * BLOCK : i * BLOCK + BLOCK]][vector]
        total += cost
    total += tables.vectors[vector][0]

    out: list[str] = []
    state = 0
    for i, start in enumerate(starts):
        block = padded[start : start + BLOCK]
        costs, base = [tables.vectors[behind[i]]], 0
        for symbol in reversed(block):
            costs.append(step(symbol, costs[-1]))
        costs.reverse()
        for j, symbol in enumerate(block):
            if symbol != FILL:
                state = _traced(symbol, state, costs[j], costs[j + 1], out)
    while END[state]:
        out.append("I")
        state = NEXT[state]
    return total, "".join(out)


def _traced(symbol: int, state: int, before: tuple[int, ...], after: tuple[int, ...], out: list[str]) -> int:
    """State after a row; the initials of its edit, and of insertions before it, go to ``out``."""
    while True:
        cost = before[state]
        if cost == DELETE + after[state]:
            out.append("D")
            return state
        if cost == INSERT + before[NEXT[state]]:
            out.append("I")
            state = NEXT[state]
            continue
        more, letter = (TRUNCATED, LETTERS[symbol - 5]) if symbol > 4 else (0, LETTERS[symbol - 1])
        if letter in KEPT[state] and cost == KEEP + more + after[KEPT[state][letter]]:
            out.append("K")
            return KEPT[state][letter]
        out.append("R")
        return NEXT[state]


def _or_space(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` after the damage that a hash of conversation and turn deals out."""
    chance = F.crc32(F.concat(_or_space(F.col("conv_id")), F.lit(":"), _or_space(F.col("turn"))).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", _or_space(F.col("role")).alias("role"), _or_space(F.col("text")).alias("text"), chance.alias("chance")).where("chance <> 0")
    text = F.when(F.col("chance") == 1, "").when(F.col("chance") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("chance") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    rows = rows.select("conv_id", "turn", F.when(F.col("chance") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), copies.alias("copy"))
    return rows.drop("copy")


def _marked(rows: DataFrame) -> DataFrame:
    """Adds what a row is known by: ``key`` of role and text, ``letter``, ``blank``, ``truncated``."""
    ended = F.rtrim(F.col("text"), F.lit(WHITE))
    # the length parts role from text
    key = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    blank = ended == ""
    return rows.select(
        "conv_id", "turn", "role", "text", F.substring(key, 1, 16).alias("key"), F.substring("role", 1, 1).alias("letter"),
        blank.alias("blank"), (~blank & ~F.substring(ended, -1, 1).isin(".", "!", "?")).alias("truncated"),
    )


def _same(*columns: str) -> Column:
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return same


def _slices(marked: DataFrame) -> DataFrame:
    """Rows of a conversation, in order, packed per range: one row per conversation and partition that it reaches into."""
    units = marked.groupBy("conv_id", "turn", "key", "letter", "blank", "truncated").agg(F.count(F.lit(1)).alias("n"))
    units = written(units, "repair-rows")
    # nulls first, also in the minimum
    first = units.groupBy("conv_id", "key").agg(F.min(F.struct("turn")).alias("first")).select(
        F.col("conv_id").alias("_conv_id"), F.col("key").alias("_key"), F.col("first.turn").alias("_turn"), F.lit(True).alias("new")
    )
    # the turn is part of the join key: a text said at many turns is spread
    rows = units.join(first, _same("conv_id", "key", "turn"), "left").select(
        "conv_id", "turn", "key", "letter", "blank", "truncated", "n", F.coalesce("new", F.lit(False)).alias("new")
    )
    order = [F.col("conv_id"), F.col("turn"), F.col("key")]
    kind = dict(marked.dtypes)["conv_id"]
    turn_kind = dict(marked.dtypes)["turn"]
    schema = (
        f"conv_id {kind}, part int, symbols binary, blank long, duplicate long, truncated long, illegal long, "
        f"initial string, last string, turns long, low {turn_kind}, high {turn_kind}"
    )
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        current: _Slice | None = None
        done: list[tuple] = []
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK):
                for conv, turn, _, letter, blank, truncated, n, new in zip(*(c.to_pylist() for c in batch.slice(start, CHUNK).columns), strict=True):
                    if current is None or current.conv != conv:
                        if current is not None:
                            done.append(current.row(part))
                        current = _Slice(conv, letter, turn)
                    current.add(turn, letter, blank, truncated, n, new)
                if done:
                    yield record_batch(done, out)
                    done = []
        if current is not None:
            yield record_batch([current.row(part)], out)

    parts = int(marked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return map_batches(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order), run, schema)


class _Slice:
    def __init__(self, conv, letter: str, turn):
        self.conv, self.initial, self.low = conv, letter, turn
        self.symbols = bytearray()
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.last, self.high = None, None

    def add(self, turn, letter: str, blank: bool, truncated: bool, n: int, new: bool) -> None:
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low, self.high = (turn if self.low is None else self.low), turn
        if self.last is not None and self.last + letter not in LEGAL:
            self.illegal += 1
        if letter + letter not in LEGAL:
            self.illegal += n - 1
        self.last = letter
        if blank:
            self.blank += n
            self.symbols += bytes(n)
            return
        symbol = 1 + (LETTERS.index(letter) if letter in ("s", "u", "a") else 3)
        self.duplicate += n - new
        self.truncated += new and truncated
        self.symbols += bytes([symbol + 4 * truncated] if new else []) + bytes(n - new)

    def row(self, part: int) -> tuple:
        return (
            self.conv, part, bytes(self.symbols), self.blank, self.duplicate, self.truncated, self.illegal,
            self.initial, self.last, self.turns, self.low, self.high,
        )


LEGAL = ("su", "ua", "au")
_PLAN = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, edits string"


def _planned(slices: DataFrame) -> DataFrame:
    """One row per conversation: its counts, least cost and edits."""
    schema = f"conv_id {dict(slices.dtypes)['conv_id']}, {_PLAN}"
    out = arrow_schema(schema)

    def plan(parts: list[tuple]) -> tuple:
        cost, edits = least_edits(b"".join(p[2] for p in parts))
        counts = [sum(p[i] for p in parts) for i in range(3, 7)]
        distinct, low, high = 0, None, None
        for a, b in zip([None, *parts], parts):
            if a is not None:
                counts[3] += a[8] + b[7] not in LEGAL
            if b[10] is not None:
                distinct += b[9] - (b[10] == high)
                low, high = (b[10] if low is None else low), b[11]
        return parts[0][0], 0 if low is None else high - low + 1 - distinct, *counts, cost, edits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple] = []
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK):
                done = []
                for values in zip(*(c.to_pylist() for c in batch.slice(start, CHUNK).columns), strict=True):
                    if parts and parts[0][0] != values[0]:
                        done.append(plan(parts))
                        parts = []
                    parts.append(values)
                yield record_batch(done, out)
        if parts:
            yield record_batch([plan(parts)], out)

    # one row per conversation and range: few, and a byte per row of the conversation
    gathered = slices.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return map_batches(gathered, run, schema)


def repaired(conversations: DataFrame) -> DataFrame:
    """Counts of faults, least cost, edits and digest of the repaired text of each ``conv_id`` of ``conversations``."""
    source = conversations.select("conv_id", "turn", "role", "text")
    conv = dict(source.dtypes)["conv_id"]
    marked = _marked(damaged(source))
    plans = _planned(_slices(marked))
    nothing = {name: kind for name, kind in (field.split() for field in _PLAN.split(", "))}

    # a conversation's own row, its plan and then its rows, which pass by one after the other
    none = lambda names: [F.lit(None).cast(k).alias(n) for n, k in names.items()]
    rows = {"turn": dict(source.dtypes)["turn"], "key": "binary", "role": "string", "text": "string"}
    every = source.select("conv_id").distinct().select("conv_id", F.lit(0).alias("what"), *none(rows), *none(nothing))
    every = every.unionByName(plans.select("conv_id", F.lit(1).alias("what"), *none(rows), *nothing))
    # the text of blank rows is not needed
    every = every.unionByName(marked.select("conv_id", F.lit(2).alias("what"), "turn", "key", "role", F.when(F.col("blank"), "").otherwise(F.col("text")).alias("text"), *none(nothing)))
    streamed = every.repartition("conv_id").sortWithinPartitions("conv_id", "what", "turn", "key")
    schema = f"conv_id {conv}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    out = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: _Repair | None = None
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK):
                done = []
                for conv_id, what, _, _, role, text, *figures in zip(*(c.to_pylist() for c in batch.slice(start, CHUNK).columns), strict=True):
                    if what == 0:
                        if current is not None:
                            done.append(current.row())
                        current = _Repair(conv_id)
                    elif what == 1:
                        current.figures, current.edits = figures[:-1], figures[-1]
                    else:
                        current.add(role, text)
                yield record_batch(done, out)
        if current is not None:
            yield record_batch([current.row()], out)

    return map_batches(streamed, run, schema)


class _Repair:
    """Digest of a conversation's repaired text while its rows pass by."""

    def __init__(self, conv) -> None:
        self.conv, self.figures, self.edits = conv, [0] * 6, ""
        self.at, self.state, self.any = 0, 0, False
        self.digest = hashlib.sha256()

    def emit(self, role: str, text: str, state: int) -> None:
        self.digest.update(f"{chr(10) if self.any else ''}{role}:{text}".encode())
        self.any, self.state = True, state

    def inserted(self) -> None:
        while self.edits[self.at : self.at + 1] == "I":
            self.emit(NEXT_ROLE[self.state], "", NEXT[self.state])
            self.at += 1

    def add(self, role: str, text: str) -> None:
        self.inserted()
        edit = self.edits[self.at]
        self.at += 1
        if edit == "K":
            self.emit(role, text, KEPT[self.state][role[:1]])
        elif edit == "R":
            self.emit(NEXT_ROLE[self.state], text, NEXT[self.state])

    def row(self) -> tuple:
        self.inserted()
        return (self.conv, *self.figures, self.edits, self.digest.hexdigest())
