"""Conversation structure repair: rows stream by conversation and turn, and a dynamic programme finds the cheapest edits.

Rows are dealt by conversation and sorted by turn inside each task; mapInPandas then carries the
programme's state from Arrow batch to Arrow batch, so a conversation may span any number of them.
The state is four costs (what the repaired roles are so far) and the order of the four edit strings.
Each row leaves four back-pointers of a byte. As soon as the paths of all live states meet, the
rows before are decided and leave memory; where they don't meet for HELD_BYTES, pointers and texts
go to a scratch file of the task, which is gone with it.

A repaired conversation has role initials `(s?(ua)+)?`. Keeping a row costs 0, giving it the role
user or assistant 3, deleting it 4, inserting an empty row of user or assistant 3; a truncated row
that stays adds 3. Blank rows and repeats must go. Of equally cheap repairs the one whose edit
initials (D, I, K, R) are least in ASCII is taken; the initials fix everything else.

A null conv_id is a conversation of its own; null turns come first; rows of the same turn are
taken by role and text; a null role or text is one space; an empty role counts as no known one.
A table without rows gives no rows. conv_id may be of any type that survives a cast to string,
turn of any integer type. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import tempfile
from collections.abc import Callable, Iterator
from functools import cache

import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from thermocline.llm.rows import BATCH_ROWS, own_memory

#: Costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Undecided texts and pointers held in a worker's memory before they go to the scratch file.
HELD_BYTES = 8_000_000
#: Rows between two looks for the point where all live paths meet.
LOOK = 256

START, SYSTEM, USER, ASSISTANT = range(4)
#: Where the next user or assistant row leads; its role follows from the state.
_ONWARD = (USER, USER, ASSISTANT, USER)
_ROLE = ("user", "user", "assistant", "user")
_BLANK = "^[\\x20\\x09-\\x0D]*\\z"
_TRUNCATED = "[^.!?\\x20\\x09-\\x0D][\\x20\\x09-\\x0D]*\\z"
_LEGAL = {"su", "ua", "au"}
_INF = 1 << 60
_OPS = "DKR"
_BACK_BLOCK = 1 << 16


def _kept(state: int, initial: str) -> int | None:
    """The state after a row of this role initial is kept, None where it can't be."""
    if initial == "s":
        return SYSTEM if state == START else None
    return _ONWARD[state] if initial and initial == _ROLE[state][0] else None


@cache
def _choices(initial: str, must_go: bool, truncated: bool) -> tuple[tuple[int, int, int, str, int], ...]:
    """(old state, new state, cost, edit initials, pointer) of every way to treat a row, up to two inserts before it included."""
    found = []
    for old in range(4):
        state, cost = old, 0
        for inserts in range(3):
            ways = [("D", state, DELETE)]
            if not must_go:
                stays = TRUNCATED if truncated else 0
                if (new := _kept(state, initial)) is not None:
                    ways.append(("K", new, stays))
                ways.append(("R", _ONWARD[state], REROLE + stays))
            for op, new, price in ways:
                found.append((old, new, cost + price, "I" * inserts + op, old | inserts << 2 | _OPS.index(op) << 4))
            state, cost = _ONWARD[state], cost + INSERT
    return tuple(found)


@cache
def _step(costs: tuple[int, ...], order: tuple[int, ...], initial: str, must_go: bool, truncated: bool):
    """Costs above the least, order of the edit strings and pointers after a row, and what the least cost grew by.

    Strings of different states at the same row end in its own edit, so none is a beginning of
    another and their order decides whatever follows. The costs differ by a few edits at most, so
    there are few distinct steps and all are remembered.
    """
    best: list[tuple | None] = [None] * 4
    for old, new, price, letters, pointer in _choices(initial, must_go, truncated):
        if costs[old] < _INF:
            way = (costs[old] + price, order[old], letters, pointer)
            if best[new] is None or way < best[new]:
                best[new] = way
    live = [s for s in range(4) if best[s] is not None]
    least = min(best[s][0] for s in live)
    ranks = {s: k for k, s in enumerate(sorted(live, key=lambda s: best[s][1:3]))}
    return (
        tuple(best[s][0] - least if s in ranks else _INF for s in range(4)),
        tuple(ranks.get(s, 9) for s in range(4)),
        bytes(best[s][3] if s in ranks else 255 for s in range(4)),
        least,
    )


class _Undecided:
    """Pointers and texts of rows whose edits aren't decided yet; beyond HELD_BYTES in a scratch file."""

    def __init__(self, held_bytes: int):
        self.limit = held_bytes
        self.pointers = self.texts = None
        self.clear()

    def clear(self) -> None:
        for f in (self.pointers, self.texts):
            if f is not None:
                f.close()
        self.pointers = tempfile.SpooledTemporaryFile(max_size=self.limit)
        self.texts = tempfile.SpooledTemporaryFile(max_size=self.limit)
        self.rows = 0

    def add(self, pointer: bytes, role: str, text: str) -> None:
        r, t = role.encode(), text.encode()
        self.pointers.write(pointer)
        self.texts.write(struct.pack("<II", len(r), len(t)) + r + t)
        self.rows += 1

    def backward(self) -> Iterator[tuple[int, bytes]]:
        """(row, its pointers), last row first."""
        end = self.rows
        while end:
            start = max(0, end - _BACK_BLOCK)
            self.pointers.seek(4 * start)
            block = self.pointers.read(4 * (end - start))
            for k in range(end - start - 1, -1, -1):
                yield start + k, block[4 * k : 4 * k + 4]
            end = start
        self.pointers.seek(0, 2)

    def forward(self) -> Iterator[tuple[str, str]]:
        self.texts.seek(0)
        for _ in range(self.rows):
            r, t = struct.unpack("<II", self.texts.read(8))
            yield self.texts.read(r).decode(), self.texts.read(t).decode()

    def drop_first(self, n: int) -> None:
        """Forget the first n rows."""
        keep = _Undecided(self.limit)
        self.pointers.seek(4 * n)
        rows = self.forward()
        for _ in range(n):
            next(rows)
        for role, text in rows:
            keep.add(self.pointers.read(4), role, text)
        self.pointers.close()
        self.texts.close()
        self.pointers, self.texts, self.rows = keep.pointers, keep.texts, keep.rows


class Repair:
    """One conversation, row by row; edits are given to `emit(edit, role, text)` in order as soon as they are decided."""

    def __init__(self, emit: Callable[[str, str, str], None], held_bytes: int = HELD_BYTES):
        self.emit = emit
        self.state, self.order = (0, _INF, _INF, _INF), (0, 9, 9, 9)
        self.least = 0
        self.at = START  # state before the first undecided row
        self.undecided = _Undecided(held_bytes)
        self.look = LOOK

    def row(self, role: str, text: str, must_go: bool, truncated: bool) -> None:
        self.state, self.order, pointer, grown = _step(self.state, self.order, role[:1] if role[:1] in "sua" else "", must_go, truncated)
        self.least += grown
        self.undecided.add(pointer, role, text)
        if self.undecided.rows >= self.look:
            self._settle()

    def _settle(self) -> None:
        """Give out the rows before the point where the paths of all live states meet."""
        paths = {s for s in range(4) if self.state[s] < _INF}
        for k, pointers in self.undecided.backward():
            if len(paths) == 1:
                self._give(k + 1, paths.pop())
                self.undecided.drop_first(k + 1)
                break
            paths = {pointers[s] & 3 for s in paths}
        # a look costs the rows still held: later ones come at doubling lengths
        self.look = max(LOOK, 2 * self.undecided.rows)

    def _give(self, n: int, last: int) -> None:
        """The edits of the first n undecided rows, the state after them being last."""
        edits, state = bytearray(n), last
        for k, pointers in self.undecided.backward():
            if k < n:
                edits[k] = pointers[state]
                state = pointers[state] & 3
        state = self.at
        for code, (role, text) in zip(edits, self.undecided.forward()):
            for _ in range(code >> 2 & 3):
                self.emit("I", _ROLE[state], "")
                state = _ONWARD[state]
            op = _OPS[code >> 4]
            if op == "K":
                state = _kept(state, role[:1])
            elif op == "R":
                role, state = _ROLE[state], _ONWARD[state]
            self.emit(op, role, text)
        self.at = state

    def end(self) -> int:
        """Decide the rest; the cost of the repair."""
        # rows missing at the end: from each state so many inserts make the roles whole
        ends = [(self.state[s] + INSERT * n, self.order[s], s, n) for s, n in ((START, 0), (SYSTEM, 2), (USER, 1), (ASSISTANT, 0)) if self.state[s] < _INF]
        cost, _, last, inserts = min(ends)
        self._give(self.undecided.rows, last)
        for _ in range(inserts):
            self.emit("I", _ROLE[self.at], "")
            self.at = _ONWARD[self.at]
        self.undecided.clear()
        return self.least + cost


def _prepared(turns: DataFrame) -> DataFrame:
    """Rows in streaming order: dealt by conversation, sorted by turn, repeats and other faults marked. Everything here spills."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    gone = F.col("dropped") if "dropped" in turns.columns else F.lit(False)
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), gone.alias("gone")).repartition("conv_id")
    # a repeat is told by the digest of its text, in the partitioning that is there
    same = Window.partitionBy("conv_id", "gone", "role", F.sha2("text", 256)).orderBy("turn")
    rows = rows.withColumn("repeat", F.row_number().over(same) > 1)
    blank = F.col("text").rlike(_BLANK)
    fault = F.when(F.col("gone"), "").when(blank, "blank").when(F.col("repeat"), "duplicate").when(F.col("text").rlike(_TRUNCATED), "truncated").otherwise("")
    # null keys have a mark of their own: pandas has no null for integers
    return rows.sortWithinPartitions("conv_id", "turn", "role", "text").select(
        F.col("conv_id").isNull().alias("none"), F.col("conv_id").cast("string").alias("conv"), F.col("turn").cast("string").alias("turn"), "role", "text", "gone", fault.alias("fault")
    )


class _Report:
    """Counts of a conversation's faults while its rows pass, and the repair."""

    def __init__(self, emit: Callable[[str, str, str], None], held_bytes: int):
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal = self.turns = 0
        self.first = self.turn = self.initial = None
        self.repair = Repair(emit, held_bytes)

    def row(self, turn: str | None, role: str, text: str, fault: str) -> None:
        if turn is not None and (turn := int(turn)) != self.turn:
            self.first = turn if self.first is None else self.first
            self.turn, self.turns = turn, self.turns + 1
        if self.initial is not None and self.initial + role[:1] not in _LEGAL:
            self.illegal += 1
        self.initial = role[:1]
        if fault:
            self.faults[fault] += 1
        self.repair.row(role, text, fault in ("blank", "duplicate"), fault == "truncated")

    @property
    def gaps(self) -> int:
        return 0 if self.first is None else self.turn - self.first + 1 - self.turns


def _conversations(batches: Iterator[pd.DataFrame], begin: Callable[[str | None], _Report], finish: Callable[[str | None, _Report], None]) -> Iterator[None]:
    """Carry one conversation's state across batches; yields after each batch."""
    key, now = None, None
    for batch in batches:
        for none, conv, turn, role, text, gone, fault in zip(*(batch[c] for c in ("none", "conv", "turn", "role", "text", "gone", "fault"))):
            conv = None if none else conv
            if now is None or (none, conv) != key:
                if now is not None:
                    finish(key[1], now)
                key, now = (none, conv), begin(conv)
            if not gone:
                now.row(turn, role, text, fault)
        yield
    if now is not None:
        finish(key[1], now)
        yield


def _mapped(turns: DataFrame, run: Callable, schema: str) -> DataFrame:
    out = _prepared(turns).mapInPandas(run, f"conv string, {schema}")
    kind = turns.schema["conv_id"].dataType
    return out.select(F.col("conv").cast(kind).alias("conv_id"), *(c for c in out.columns if c != "conv"))


def reports(turns: DataFrame, held_bytes: int = HELD_BYTES) -> DataFrame:
    """One row per conv_id: gaps, blank, duplicate, truncated, illegal, cost, audit and the SHA-256 of the repaired `role:text`, newline-joined.

    The digest is taken while rows are decided, so no conversation is ever held whole. A row with
    `dropped` true only names its conversation: one without other rows has zeros and an empty audit.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own_memory(__name__)
        done: list[tuple] = []
        made: dict[int, tuple] = {}

        def begin(conv):
            digest, audit, begun = hashlib.sha256(), bytearray(), [False]

            def emit(edit: str, role: str, text: str) -> None:
                audit.extend(edit.encode())
                if edit != "D":
                    digest.update((f"\n{role}:{text}" if begun[0] else f"{role}:{text}").encode())
                    begun[0] = True

            report = _Report(emit, held_bytes)
            made[id(report)] = (digest, audit)
            return report

        def finish(conv, report):
            cost = report.repair.end()
            digest, audit = made.pop(id(report))
            f = report.faults
            done.append((conv, report.gaps, f["blank"], f["duplicate"], f["truncated"], report.illegal, cost, audit.decode(), digest.hexdigest()))

        for _ in _conversations(batches, begin, finish):
            if done:
                yield pd.DataFrame(done, columns=["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"])
                done.clear()

    return _mapped(turns, run, "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")


def edits(turns: DataFrame, held_bytes: int = HELD_BYTES) -> DataFrame:
    """Every edit as a row: conv_id, place (from 0), edit (K, R, D, I), role and text after it. The repaired conversation is the rows whose edit isn't D, by place."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own_memory(__name__)
        done: list[tuple] = []

        def begin(conv):
            place = [0]

            def emit(edit: str, role: str, text: str) -> None:
                done.append((conv, place[0], edit, role, text))
                place[0] += 1

            return _Report(emit, held_bytes)

        for _ in _conversations(batches, begin, lambda conv, report: report.repair.end()):
            for start in range(0, len(done), BATCH_ROWS):
                yield pd.DataFrame(done[start : start + BATCH_ROWS], columns=["conv", "place", "edit", "role", "text"])
            done.clear()

    return _mapped(turns, run, "place long, edit string, role string, text string")


def damage(turns: DataFrame) -> DataFrame:
    """Damaged conversations: crc32 of `conv_id:turn` mod 20 drops a row (0), empties its text (1), takes its `[.!?]` out (2), repeats it (3) or makes it the user's (4). Nulls count as one space. Dropped rows stay as marks of their conversation."""
    of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    lot = F.crc32(F.concat(of("conv_id"), F.lit(":"), of("turn"))) % 20
    text = F.when(lot.isin(0, 1), "").when(lot == 2, F.regexp_replace(of("text"), "[.!?]", "")).otherwise(of("text"))
    times = F.when(lot == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = turns.select("conv_id", "turn", F.when(lot == 4, "user").otherwise(of("role")).alias("role"), text.alias("text"), (lot == 0).alias("dropped"), times.alias("__times"))
    return rows.withColumn("__times", F.explode("__times")).drop("__times")
