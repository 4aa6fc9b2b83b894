"""Repair of conversation structure: the cheapest edits that make roles alternate.

The rows of a conversation become a string of symbols (role initial and fault). Equal neighbours
are collapsed into runs, and a run advances the costs of the four states by the binary powers of
its min-plus transition; the choices are then unrolled row by row for the audit. Rows are dealt in
ranges of (conversation, turn), so one very long conversation spreads over many tasks: its blocks
are joined by scans over small matrices, and only those, not its texts, meet in one task.

Defined results: null roles and texts count as one blank; rows with the same turn are ordered by
a hash of role and text; a role without an initial fits nowhere, like one of another name; a null
conversation id is a conversation of its own; conversations without rows have an empty audit. Rows
may have further columns, which are ignored. Rows are told apart by (role, text) inside a block, and
by 128-bit digests of them between the blocks of one conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import groupby

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlab.llm.common import SPACE
from reviewlab.session import materialize

#: Costs of the edits; keeping is free, and a truncated row that stays costs TRUNCATED more.
DELETE, REROLE, INSERT, TRUNCATED = 4, 3, 3, 3
#: A block ends with this many rows or characters of text.
BLOCK_ROWS, BLOCK_CHARS = 4_000, 4 << 20

# States: nothing yet, behind the system row, behind a user row, behind an assistant row.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
NEVER = 1 << 60
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}
#: Where a user or assistant row leads, by state.
NEXT = (USER, USER, ASSISTANT, USER)
#: Symbol of a row that must go; the others are initials, in upper case if truncated.
GONE = "-"
Vector = tuple[int, int, int, int]
Matrix = tuple[Vector, Vector, Vector, Vector]


def symbol(initial: str, fault: str) -> str:
    if fault in ("blank", "duplicate"):
        return GONE
    known = initial if initial in ("s", "u", "a") else "x"
    return known.upper() if fault == "truncated" else known


def after_row(letter: str, state: int, sign: str) -> tuple[int, int] | None:
    """(cost, next state) of Delete, Keep or Rerole of a row with symbol ``sign``."""
    if letter == "D":
        return DELETE, state
    if sign == GONE:
        return None
    extra = TRUNCATED if sign.isupper() else 0
    if letter == "R":
        return REROLE + extra, NEXT[state]
    role = sign.lower()
    if role == "s":
        return (extra, SYSTEM) if state == EMPTY else None
    fits = role == ("a" if state == USER else "u")
    return (extra, NEXT[state]) if fits else None


def product(one: Matrix, other: Matrix) -> Matrix:
    """Min-plus product."""
    return tuple(
        tuple(min(min(one[i][k] + other[k][j] for k in STATES), NEVER) for j in STATES)
        for i in STATES
    )


def costs_before(matrix: Matrix, costs: Vector) -> Vector:
    return tuple(min(min(matrix[i][k] + costs[k] for k in STATES), NEVER) for i in STATES)


def unit() -> Matrix:
    return tuple(tuple(0 if i == j else NEVER for j in STATES) for i in STATES)


@cache
def insertions() -> Matrix:
    """Any number of inserted rows; two always suffice to reach every state that can be reached."""
    one = tuple(tuple(INSERT if NEXT[i] == j else NEVER for j in STATES) for i in STATES)
    either = tuple(tuple(min(a, b) for a, b in zip(*rows)) for rows in zip(unit(), one))
    return product(either, either)


@cache
def power(sign: str, exponent: int) -> Matrix:
    """Transition of 2 ** exponent rows with one symbol, insertions before each included."""
    if exponent:
        half = power(sign, exponent - 1)
        return product(half, half)
    edits = [[NEVER] * 4 for _ in STATES]
    for state in STATES:
        for letter in "DKR":
            if (step := after_row(letter, state, sign)) is not None:
                edits[state][step[1]] = min(edits[state][step[1]], step[0])
    return product(insertions(), tuple(tuple(row) for row in edits))


def runs_of(symbols: str) -> list[tuple[str, int]]:
    return [(sign, len(list(run))) for sign, run in groupby(symbols)]


def bits(n: int) -> Iterator[int]:
    return (k for k in range(n.bit_length()) if n >> k & 1)


def transition(symbols: str) -> Matrix:
    """Transition of a whole string of symbols."""
    whole = unit()
    for sign, length in runs_of(symbols):
        for k in bits(length):
            whole = product(whole, power(sign, k))
    return whole


@cache
def at_end() -> Vector:
    """Costs to finish behind the last row: only nothing, or an assistant row, may be last."""
    return costs_before(insertions(), (0, NEVER, NEVER, 0))


@cache
def choices(sign: str, after: Vector) -> tuple[tuple[str, int], ...]:
    """Per state the edits before and at a row, ASCII-least among the cheapest, and the state
    behind it; ``after`` are the costs behind the row, less their least."""
    before = costs_before(power(sign, 0), after)
    out = []
    for start in STATES:
        letters, state, done = "", start, before[start] >= NEVER
        while not done:
            rest = before[state]
            for letter in "DIKR":
                if letter == "I":
                    if INSERT + before[NEXT[state]] == rest:
                        letters, state = letters + "I", NEXT[state]
                        break
                    continue
                step = after_row(letter, state, sign)
                if step is not None and step[0] + after[step[1]] == rest:
                    letters, state, done = letters + letter, step[1], True
                    break
        out.append((letters, state))
    return tuple(out)


def less(costs: Vector, least: int) -> Vector:
    return tuple(c if c >= NEVER else c - least for c in costs)


def tables(symbols: str, after: Vector) -> list[tuple[tuple[str, int], ...]]:
    """The choices at every row. The costs behind a run come from its powers; those inside a run
    repeat after a few rows but for a constant, so almost every row is a look-up."""
    out: list = []
    for sign, length in reversed(runs_of(symbols)):
        costs = less(after, min(after))
        for _ in range(length):
            out.append(choices(sign, costs))
            costs = costs_before(power(sign, 0), costs)
            costs = less(costs, min(costs))
        for k in bits(length):
            after = costs_before(power(sign, k), after)
    return out[::-1]


def closing(state: int) -> str:
    """Rows inserted behind the last one."""
    letters = ""
    while at_end()[state]:
        letters, state = letters + "I", NEXT[state]
    return letters


def unrolled(symbols: str, after: Vector, state: int, last: bool) -> tuple[list[str], int]:
    """(edits before and at each row and, if ``last``, behind them; the state behind them)."""
    edits = []
    for table in tables(symbols, after):
        letters, state = table[state]
        edits.append(letters)
    if last:
        edits.append(closing(state))
    return edits, state


def edited(edits: list[str], state: int, roles: list[str], texts: list[str]) -> str:
    """The repaired rows as lines ``role:text``; ``state`` is that before the first row."""
    lines = []
    for row, letters in enumerate(edits):
        for letter in letters:
            if letter == "D":
                continue
            if letter == "K" and roles[row][:1] == "s":
                state = SYSTEM
            else:
                state = NEXT[state]
            if letter == "I":
                lines.append(f"{ROLE_OF[state]}:")
            elif letter == "K":
                lines.append(f"{roles[row]}:{texts[row]}")
            else:
                lines.append(f"{ROLE_OF[state]}:{texts[row]}")
    return "\n".join(lines)


def fault_of(text: str) -> str:
    """``blank``, ``truncated`` or nothing."""
    end = text.rstrip(SPACE)
    if not end:
        return "blank"
    return "" if end[-1] in ".!?" else "truncated"


def illegal_pairs(initials: list[str]) -> int:
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))


COUNTS = ["blank", "duplicate", "truncated", "illegal"]
BLOCKS = (
    "key string, conv_id long, part int, block int, closed boolean, "
    "roles array<string>, texts array<string>, turns array<long>, digests array<binary>, "
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired string"
)


class Block:
    """Consecutive rows of one conversation; rows that are not present only name it."""

    def __init__(self, key: str, conv_id: int | None, number: int):
        self.key, self.conv_id, self.number = key, conv_id, number
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.turns: list[int | None] = []
        self.chars = 0

    def add(self, turn: int | None, role: str, text: str) -> None:
        self.roles.append(role)
        self.texts.append(text)
        self.turns.append(turn)
        self.chars += len(role) + len(text)

    def full(self) -> bool:
        return len(self.roles) >= BLOCK_ROWS or self.chars >= BLOCK_CHARS

    def row(self, part: int) -> dict:
        return {"key": self.key, "conv_id": self.conv_id, "part": part, "block": self.number}

    def opened(self, part: int) -> dict:
        """For conversations that other blocks may continue."""
        digests = [digest(r, t) for r, t in zip(self.roles, self.texts)]
        rows = {"roles": self.roles, "texts": self.texts, "turns": self.turns, "digests": digests}
        return self.row(part) | {"closed": False} | rows

    def solved(self, part: int) -> dict:
        """For a conversation that is all here."""
        seen: set[tuple[str, str]] = set()
        faults = []
        for pair in zip(self.roles, self.texts):
            fault = fault_of(pair[1])
            faults.append("duplicate" if fault != "blank" and pair in seen else fault)
            seen.add(pair)
        initials = [role[:1] for role in self.roles]
        symbols = "".join(map(symbol, initials, faults))
        edits, _ = unrolled(symbols, at_end(), EMPTY, True)
        known = [turn for turn in self.turns if turn is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        counts = {name: faults.count(name) for name in COUNTS[:3]}
        return (
            self.row(part)
            | counts
            | {
                "closed": True,
                "gaps": gaps,
                "illegal": illegal_pairs(initials),
                "cost": costs_before(transition(symbols), at_end())[EMPTY],
                "audit": "".join(edits),
                "repaired": edited(edits, EMPTY, self.roles, self.texts),
            }
        )


def digest(role: str, text: str) -> bytes:
    return hashlib.blake2b(f"{role}\0{text}".encode(), digest_size=16).digest()


def batches_of(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += 100 + len(row.get("repaired") or "") + sum(map(len, row.get("texts") or []))
        if chars > BLOCK_CHARS:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def arrow_schema(ddl: str) -> pa.Schema:
    """Arrow fields of a flat DDL string."""
    kinds = {
        "string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(),
        "array<string>": pa.list_(pa.string()), "array<long>": pa.list_(pa.int64()),
        "array<binary>": pa.list_(pa.binary()),
    }
    return pa.schema([(n, kinds[k]) for n, k in (f.split(" ") for f in ddl.split(", "))])


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows into blocks. A conversation in the middle of the partition that fits one block
    is all here and solved at once; the first and the last may go on in another partition."""
    part = TaskContext.get().partitionId()

    def blocks() -> Iterator[dict]:
        block, first = None, True
        for batch in batches:
            for key, conv_id, present, turn, role, text in zip(
                *[batch.column(n).to_pylist() for n in ROWS]
            ):
                if block is None or key != block.key:
                    if block is not None:
                        whole = not first and block.number == 0
                        yield block.solved(part) if whole else block.opened(part)
                        first = False
                    block = Block(key, conv_id, 0)
                elif block.full():
                    yield block.opened(part)
                    block = Block(key, conv_id, block.number + 1)
                if present:
                    block.add(turn, role, text)
        if block is not None:
            yield block.opened(part)

    yield from batches_of(blocks(), arrow_schema(BLOCKS))


ROWS = ["key", "conv_id", "present", "turn", "role", "text"]
PLACE = ["key", "part", "block"]
STEPS = (
    "key string, conv_id long, part int, block int, symbols string, matrix array<long>, "
    "first_initial string, last_initial string, rows long, least long, most long, "
    "distinct long, blank long, duplicate long, truncated long, illegal long"
)


def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Symbols, transition and counts of open blocks, given what earlier blocks hold."""

    def rows() -> Iterator[dict]:
        for batch in batches:
            for row in batch.to_pylist():
                seen = set(row["known"] or [])
                faults = []
                for text, mark in zip(row["texts"], row["digests"]):
                    fault = fault_of(text)
                    faults.append("duplicate" if fault != "blank" and mark in seen else fault)
                    seen.add(mark)
                initials = [role[:1] for role in row["roles"]]
                symbols = "".join(map(symbol, initials, faults))
                turns = [t for t in row["turns"] if t is not None]
                yield {name: row[name] for name in ("key", "conv_id", "part", "block")} | {
                    "symbols": symbols,
                    "matrix": [cost for line in transition(symbols) for cost in line],
                    "first_initial": initials[0] if initials else None,
                    "last_initial": initials[-1] if initials else None,
                    "rows": len(initials),
                    "least": min(turns, default=None),
                    "most": max(turns, default=None),
                    "distinct": len(set(turns)),
                    "illegal": illegal_pairs(initials),
                    **{name: faults.count(name) for name in COUNTS[:3]},
                }

    yield from batches_of(rows(), arrow_schema(STEPS))


TOTALS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
ENDS = f"key string, part int, block int, after array<long>, last boolean, {TOTALS}"


def ends_of(blocks: pd.DataFrame) -> pd.DataFrame:
    """Costs behind each block of one conversation, and what its counts add up to."""
    blocks = blocks.sort_values(["part", "block"])
    after, costs = [], at_end()
    for flat in reversed(blocks["matrix"].tolist()):
        after.append(list(costs))
        costs = costs_before([[int(c) for c in flat[i : i + 4]] for i in (0, 4, 8, 12)], costs)
    filled = blocks[blocks["rows"] > 0]
    illegal = int(blocks["illegal"].sum())
    pairs = zip(filled["last_initial"], filled["first_initial"].iloc[1:])
    illegal += sum(a + b not in ("su", "ua", "au") for a, b in pairs)
    turned = blocks[blocks["distinct"] > 0]
    gaps = 0
    if len(turned):
        shared = sum(a == b for a, b in zip(turned["most"], turned["least"].iloc[1:]))
        distinct = int(turned["distinct"].sum()) - shared
        gaps = int(turned["most"].iloc[-1]) - int(turned["least"].iloc[0]) + 1 - distinct
    out = blocks[["key", "part", "block"]].assign(after=after[::-1], last=False)
    out.iloc[-1, out.columns.get_loc("last")] = True
    counts = {name: int(blocks[name].sum()) for name in COUNTS[:3]}
    return out.assign(gaps=gaps, **counts, illegal=illegal, cost=costs[EMPTY])


EXITS = "key string, part int, block int, exits array<long>"


def exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per state before an open block the state behind it."""

    def rows() -> Iterator[dict]:
        for batch in batches:
            for row in batch.to_pylist():
                after = tuple(row["after"])
                ends = [unrolled(row["symbols"], after, s, False)[1] for s in STATES]
                yield {name: row[name] for name in PLACE} | {"exits": ends}

    yield from batches_of(rows(), arrow_schema(EXITS))


def entries_of(blocks: pd.DataFrame) -> pd.DataFrame:
    """The state before each block of one conversation."""
    blocks = blocks.sort_values(["part", "block"])
    state, entries = EMPTY, []
    for following in blocks["exits"]:
        entries.append(state)
        state = int(following[state])
    return blocks[["key", "part", "block"]].assign(entry=entries)


PIECES = "key string, part int, block int, audit string, repaired string"


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audit and repaired rows of open blocks."""

    def rows() -> Iterator[dict]:
        for batch in batches:
            for row in batch.to_pylist():
                state = row["entry"]
                edits, _ = unrolled(row["symbols"], tuple(row["after"]), state, row["last"])
                yield {name: row[name] for name in PLACE} | {
                    "audit": "".join(edits),
                    "repaired": edited(edits, state, row["roles"], row["texts"]),
                }

    yield from batches_of(rows(), arrow_schema(PIECES))


TALLIES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
RESULT = ["key", "conv_id", *PLACE[1:], *TALLIES, "audit", "repaired"]


def repair(rows: DataFrame) -> DataFrame:
    """Repaired conversations in pieces: ``key, conv_id, part, block`` (a piece's place), the
    conversation's ``gaps, blank, duplicate, truncated, illegal, cost``, and the piece's ``audit``
    and ``repaired`` lines. Most conversations are one piece.

    ``rows`` holds conv_id, turn, role, text and, if some rows are there only to name their
    conversation, ``present``.
    """
    closed, opened = repaired(rows)
    return closed.unionByName(opened)


def repaired(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pieces of conversations that are one piece, and those of others."""
    present = F.col("present") if "present" in rows.columns else F.lit(True)
    role, text = (F.coalesce(F.col(name), F.lit(" ")) for name in ("role", "text"))
    shaped = rows.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("key"),
        F.col("conv_id").cast("long").alias("conv_id"),
        present.alias("present"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        text.alias("text"),
        F.xxhash64(role, text).alias("mark"),
        # Equal rows of one turn may part, too.
        F.monotonically_increasing_id().alias("number"),
    )
    order = ["key", F.asc_nulls_first("turn"), "mark", "number"]
    ordered = shaped.repartitionByRange(*order).sortWithinPartitions(*order).select(*ROWS)
    blocks = materialize(ordered.mapInArrow(pack, BLOCKS), "turn-blocks")
    opened = repair_open(blocks.where("not closed")).select(*RESULT)
    return blocks.where("closed").select(*RESULT), opened


def repair_open(blocks: DataFrame) -> DataFrame:
    """Conversations of several blocks: scans over their matrices and exits."""
    marks = blocks.select(*PLACE, F.explode(F.array_distinct("digests")).alias("mark"))
    place = F.struct("part", "block")
    first = F.min(place).over(Window.partitionBy("key", "mark"))
    known = marks.withColumn("first", first).where(place > F.col("first"))
    known = known.groupBy(*PLACE).agg(F.collect_list("mark").alias("known"))
    light = materialize(
        blocks.select("conv_id", *PLACE, "roles", "texts", "turns", "digests")
        .join(known, PLACE, "left")
        .mapInArrow(steps, STEPS),
        "turn-steps",
    )
    ends = light.drop("symbols").groupBy("key").applyInPandas(ends_of, ENDS)
    ends = materialize(ends, "turn-ends")
    placed = light.select(*PLACE, "symbols").join(ends, PLACE)
    entries = (
        placed.select(*PLACE, "symbols", "after")
        .mapInArrow(exits, EXITS)
        .groupBy("key")
        .applyInPandas(entries_of, "key string, part int, block int, entry int")
    )
    steered = placed.join(entries, PLACE)
    texts = blocks.select("conv_id", *PLACE, "roles", "texts").join(
        steered.select(*PLACE, "symbols", "after", "last", "entry"), PLACE
    )
    done = texts.select(*PLACE, "symbols", "after", "last", "entry", "roles", "texts")
    done = done.mapInArrow(pieces, PIECES)
    about = light.select("conv_id", *PLACE).join(ends.drop("after", "last"), PLACE)
    return done.join(about, PLACE)


DIGESTS = "key string, audit string, repaired_sha256 string"


def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole audits and digests from pieces in order; texts are read once and not kept."""

    def rows() -> Iterator[dict]:
        key, audit, running, empty = None, [], hashlib.sha256(), True
        for batch in batches:
            for row in batch.to_pylist():
                if row["key"] != key:
                    if key is not None:
                        digest = running.hexdigest()
                        yield {"key": key, "audit": "".join(audit), "repaired_sha256": digest}
                    key, audit, running, empty = row["key"], [], hashlib.sha256(), True
                audit.append(row["audit"])
                if row["repaired"]:
                    running.update(("" if empty else "\n").encode() + row["repaired"].encode())
                    empty = False
        if key is not None:
            digest = running.hexdigest()
            yield {"key": key, "audit": "".join(audit), "repaired_sha256": digest}

    yield from batches_of(rows(), arrow_schema(DIGESTS))


def summaries(rows: DataFrame) -> DataFrame:
    """One row per conversation: its counts, cost, audit and a digest of its repaired rows.

    Pieces of a longer conversation meet in order for the digest, which is a chain over all text.
    """
    closed, opened = repaired(rows)
    digest = F.sha2(F.col("repaired").cast("binary"), 256).alias("repaired_sha256")
    single = closed.select("conv_id", *TALLIES, "audit", digest)
    parts = materialize(opened, "repaired-turns")
    chained = (
        parts.select(*PLACE, "audit", "repaired")
        .repartition("key")
        .sortWithinPartitions(*PLACE)
        .select("key", "audit", "repaired")
        .mapInArrow(digests, DIGESTS)
    )
    about = parts.select("key", "conv_id", *TALLIES).dropDuplicates(["key"])
    return single.unionByName(chained.join(about, "key").select(*single.columns))


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with faults put in by the crc32 of ``conv_id:turn``; a dropped row stays as one that is
    not present, so that its conversation is known. Nulls count as one blank."""

    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(shown("text"), ".!?", ""))
    return rows.select(
        "conv_id",
        "turn",
        (kind != 0).alias("present"),
        F.when(kind == 4, "user").otherwise(shown("role")).alias("role"),
        text.otherwise(shown("text")).alias("text"),
        F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))),
    ).drop("col")
