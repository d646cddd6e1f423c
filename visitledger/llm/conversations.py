"""Repair of conversation structure by the cheapest edits, streamed turn by turn.

Rows are repartitioned by conversation and sorted by turn, role and text. A cost table over the four states of the role
pattern ``(s?(ua)+)?`` is carried from row to row and across Arrow batches; each row leaves one small number, the index
of its transition, as backpointer. Backpointers and turns of a conversation that outgrow ``SPILL`` bytes go to an unnamed
file of the task's own, which ends with the conversation, so memory does not grow with a conversation's texts. At the
end the backpointers are followed from the last row, and the repaired turns are hashed and emitted in order.

A row's first fault counts: blank (no character but white space), duplicate (role and text seen earlier in the
conversation), truncated (the last such character is not one of ``.!?``). Keep costs 0, Rerole to user or assistant 3,
Delete 4 (required for blank and duplicate rows), Insert of an empty turn 3; a truncated row that stays adds 3. Of the
cheapest edit strings the least in ASCII order is taken.

Defined results: a null role or text is one space; null conversations are one conversation; null turns come first; rows
of one turn follow by role, then text; a role counts by its first character, and an empty role has none and is never
kept; rows may repeat (copies are duplicates); a conversation without rows costs nothing; an empty table gives an empty
result; other columns are left aside, whatever their names.
"""

from __future__ import annotations

import array
import hashlib
import struct
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import named

#: Bytes that one conversation's turns, and its backpointers, may each hold in memory before they go to a file.
SPILL = 8_000_000
#: Rows and bytes of text after which output is handed on.
OUT_ROWS, OUT_BYTES = 5_000, 4_000_000

INSERT, REROLE, DELETE, UNFINISHED = 3, 3, 4, 3
INITIALS = "sua"
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
#: States of the pattern: nothing yet, after s, after u, after a. Per state the state after each initial that may follow.
FOLLOWS = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ENDS = (0, 3)
#: What an inserted or reroled turn is in each state.
FILLS = ("u", "u", "a", "u")
NAMES = {"u": "user", "a": "assistant"}
#: From any state the rest costs at most this much more than from any other: a kept s is deleted, two turns are inserted.
FAR = DELETE + 2 * INSERT

State = tuple[tuple[int | None, ...], tuple[int, ...]]
START: State = ((0, None, None, None), (0, 1, 2, 3))


class Transitions:
    """Every step of the cost table met so far. Costs are kept relative to the least, and a state that costs over ``FAR``
    more than it is given up, as nothing that follows can make up for that; so there are few.

    A state of the table has for each pattern state its cost and the rank of its edit string among the four. Strings
    end with the edit of the same row, inserts stand before the next one, so none is the start of another and ranks
    decide which of two longer strings comes first.
    """

    def __init__(self) -> None:
        self.index: dict[tuple[State, int], tuple[int, State, int]] = {}
        self.back: list[tuple[tuple[int, str] | None, ...]] = []

    def step(self, state: State, code: int) -> tuple[int, State, int]:
        """(index of the backpointers, next table, cost added to all of it) for a row of that code."""
        known = self.index.get((state, code))
        if known is None:
            known = self.index[state, code] = self._step(state, code)
        return known

    def _step(self, state: State, code: int) -> tuple[int, State, int]:
        costs, ranks = state
        initial, fault = divmod(code, 4)
        initial = INITIALS[initial] if initial < 3 else ""
        best: list[tuple | None] = [None] * 4
        for p in range(4):
            if costs[p] is None:
                continue
            at = p
            for m in range(3):
                before, cost = "I" * m, costs[p] + INSERT * m
                options = [("D", at, DELETE)]
                if fault not in (BLANK, DUPLICATE):
                    stays = UNFINISHED if fault == TRUNCATED else 0
                    options.append(("R", FOLLOWS[at][FILLS[at]], REROLE + stays))
                    if initial in FOLLOWS[at]:
                        options.append(("K", FOLLOWS[at][initial], stays))
                for edit, to, more in options:
                    found = (cost + more, ranks[p], before + edit, p)
                    if best[to] is None or found < best[to]:
                        best[to] = found
                at = FOLLOWS[at][FILLS[at]]
        least = min(b[0] for b in best if b)
        best = [b if b and b[0] <= least + FAR else None for b in best]
        order = sorted(range(4), key=lambda s: (best[s] is None, best[s] and best[s][1:3]))
        table = (tuple(b[0] - least if b else None for b in best), tuple(order.index(s) for s in range(4)))
        self.back.append(tuple((b[3], b[2]) if b else None for b in best))
        return len(self.back) - 1, table, least

    @staticmethod
    def end(state: State) -> tuple[int, int, int]:
        """(cost, pattern state, inserts) of the cheapest, then least end."""
        costs, ranks = state
        ends = []
        for p in range(4):
            at = p
            for m in range(3):
                if costs[p] is not None and at in ENDS:
                    ends.append((costs[p] + INSERT * m, ranks[p], "I" * m, p))
                at = FOLLOWS[at][FILLS[at]]
        cost, _, inserts, p = min(ends)
        return cost, p, len(inserts)


class Spool:
    """Bytes in order, in memory up to ``SPILL`` and then in an unnamed file of the task."""

    def __init__(self, limit: int) -> None:
        self.file = tempfile.SpooledTemporaryFile(max_size=limit)  # noqa: SIM115

    def backwards(self, size: int = 1 << 20) -> Iterator[bytes]:
        at = self.file.seek(0, 2)
        while at:
            start = max(0, at - size)
            self.file.seek(start)
            yield self.file.read(at - start)
            at = start


class Conversation:
    """Counts, cost table and spools of the conversation that is being read."""

    def __init__(self, key: object, steps: Transitions, limit: int = SPILL) -> None:
        self.key, self.steps = key, steps
        self.pointers, self.turns = Spool(limit), Spool(limit)
        self.state, self.cost, self.rows = START, 0, 0
        self.faults = [0, 0, 0, 0]
        self.illegal, self.last = 0, None
        self.low = self.high = None
        self.distinct = 0

    def add(self, turn: int | None, role: str, text: str, code: int) -> None:
        if turn is not None:
            self.distinct += turn != self.high
            self.low, self.high = (turn if self.low is None else self.low), turn
        initial = role[:1]
        if self.rows:
            self.illegal += self.last + initial not in ("su", "ua", "au")
        self.last = initial
        self.faults[code % 4] += 1
        number, self.state, more = self.steps.step(self.state, code)
        self.cost += more
        self.rows += 1
        self.pointers.file.write(struct.pack("<I", number))
        role_bytes, text_bytes = role.encode(), text.encode()
        self.turns.file.write(struct.pack("<II", len(role_bytes), len(text_bytes)) + role_bytes + text_bytes)

    def _edits(self) -> tuple[int, list[str] | str]:
        """Cost of the end, and the edit string."""
        cost, state, inserts = self.steps.end(self.state)
        parts, out = ["I" * inserts], bytearray()
        for block in self.pointers.backwards():
            for number in reversed(array.array("I", block)):
                state, edit = self.steps.back[number][state]
                parts.append(edit)
            if len(parts) > 1 << 16:  # letters instead of strings while a giant conversation is followed
                out += "".join(reversed(parts)).encode()[::-1]
                parts = []
        out += "".join(reversed(parts)).encode()[::-1]
        return cost, out[::-1].decode()

    def repaired(self, audit: str) -> Iterator[tuple[str, str, str]]:
        """(edit, role, text) of every edit in order; deleted rows as they were."""
        self.turns.file.seek(0)
        state = 0
        for edit in audit:
            if edit == "I":
                fill = FILLS[state]
                state = FOLLOWS[state][fill]
                yield edit, NAMES[fill], ""
                continue
            sizes = struct.unpack("<II", self.turns.file.read(8))
            role, text = (self.turns.file.read(n).decode() for n in sizes)
            if edit == "R":
                role = NAMES[FILLS[state]]
            if edit != "D":
                state = FOLLOWS[state][role[:1]]
            yield edit, role, text

    def report(self) -> tuple[dict, str]:
        end, audit = self._edits()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        return {"gaps": gaps, "blank": self.faults[BLANK], "duplicate": self.faults[DUPLICATE],
                "truncated": self.faults[TRUNCATED], "illegal": self.illegal, "cost": self.cost + end}, audit

    def close(self) -> None:
        self.pointers.file.close()
        self.turns.file.close()


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _prepared(rows: DataFrame, conv: str, turn: str, role: str, text: str, present: Column | None) -> DataFrame:
    """Rows by conversation in order, each with the code that the cost table needs. One shuffle."""
    there = F.lit(True) if present is None else F.coalesce(present, F.lit(False))
    plain = rows.select(
        named(conv).alias("conv"), named(turn).cast("long").alias("turn"),
        F.coalesce(named(role).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(named(text).cast("string"), F.lit(" ")).alias("text"), there.alias("there"))
    kept = F.col("there")
    plain = plain.select("conv", "there", *[F.when(kept, F.col(c)).alias(c) for c in ("turn", "role", "text")])
    same = Window.partitionBy("conv", "role", "text").orderBy("turn")
    last = F.substring(F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r")), -1, 1)
    fault = (F.when(F.trim(F.col("text"), F.lit(" \t\n\x0b\x0c\r")) == "", BLANK).when(F.col("earlier") > 1, DUPLICATE)
             .when(~last.isin(".", "!", "?"), TRUNCATED).otherwise(0))
    initial = F.substring("role", 1, 1)
    place = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    return (plain.repartition("conv").withColumn("earlier", F.row_number().over(same))
            .select("conv", "turn", "role", "text", F.when(kept, place * 4 + fault).alias("code"))
            .sortWithinPartitions("conv", "turn", "role", "text"))


def _stream(batches: Iterator[pa.RecordBatch], schema: pa.Schema, turns: bool, limit: int) -> Iterator[pa.RecordBatch]:
    steps = Transitions()
    columns: list[list] = [[] for _ in schema]
    held = 0

    def take(*values: object) -> None:
        for column, value in zip(columns, values, strict=True):
            column.append(value)

    def handed() -> pa.RecordBatch:
        nonlocal held
        batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
        for column in columns:
            column.clear()
        held = 0
        return batch

    def ended(one: Conversation) -> Iterator[pa.RecordBatch]:
        nonlocal held
        counts, audit = one.report()
        digest, first = hashlib.sha256(), True
        for place, (edit, role, text) in enumerate(one.repaired(audit)):
            if turns:
                take(one.key, place, edit, role, text)
                held += len(text)
                if held > OUT_BYTES or len(columns[0]) >= OUT_ROWS:
                    yield handed()
            elif edit != "D":
                digest.update((("" if first else "\n") + f"{role}:{text}").encode())
                first = False
        if not turns:
            take(one.key, *[counts[c] for c in COUNTS], audit, digest.hexdigest())
            held += len(audit)
            if held > OUT_BYTES or len(columns[0]) >= OUT_ROWS:
                yield handed()
        one.close()

    one: Conversation | None = None
    for batch in batches:
        for key, turn, role, text, code in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if one is None or key != one.key:
                if one is not None:
                    yield from ended(one)
                one = Conversation(key, steps, limit)
            if code is not None:
                one.add(turn, role, text, code)
    if one is not None:
        yield from ended(one)
    if columns[0]:
        yield handed()


def _run(prepared: DataFrame, conv: str, fields: str, turns: bool, limit: int) -> DataFrame:
    kind = T.StructType([T.StructField(conv, prepared.schema["conv"].dataType), *T.StructType.fromDDL(fields)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        return _stream(batches, to_arrow_schema(kind), turns, limit)

    return prepared.mapInArrow(run, kind)


def reports(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
            present: Column | None = None, spill: int = SPILL) -> DataFrame:
    """One row for each conversation: gaps in the turns, faults, illegal neighbours, cost, edit string and the SHA-256 of
    the repaired turns (``role:text``, joined by newlines).

    Rows for which ``present`` is not true only name their conversation.
    """
    fields = ", ".join(f"{c} long" for c in COUNTS) + ", audit string, repaired_sha256 string"
    return _run(_prepared(rows, conv, turn, role, text, present), conv, fields, turns=False, limit=spill)


def repaired(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
             present: Column | None = None, spill: int = SPILL) -> DataFrame:
    """One row for each edit of each conversation: its place, its initial, role and text. Deleted rows have edit D."""
    fields = "place long, edit string, role string, text string"
    return _run(_prepared(rows, conv, turn, role, text, present), conv, fields, turns=True, limit=spill)
