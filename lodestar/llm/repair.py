"""Conversation structure repair as secondary-sorted streaming.

Rows are dealt out by conversation once, sorted by turn, and a
``mapInPandas`` step walks them with the state of a small dynamic program
that outlives Arrow batches.  A repaired conversation has role initials
``(s?(ua)+)?``; four states follow that pattern:

    0 nothing yet      1 after the system row      2 after a user      3 after an assistant

States 0 and 3 may end.  A row is kept (K), gets another role (R) or is
deleted (D); rows are inserted (I) before it or at the end.  For every state
the cheapest edits so far are known by their cost, by their order among the
other states' edits (for ties), by a running SHA-256 of the repaired rows and
by one byte a row that points back; so no text is held, and a batch may end
anywhere.  No best edit string is a prefix of another one (each has one
letter for every row read and ends with such a letter), so ties are decided
by the order of the states before and the letters after.

The bytes of a conversation longer than ``block`` rows leave the task as rows
of a written table in the shared folder; a second sorted stream walks these
blocks backwards.  What a task holds is thus a batch and a block.  A hash of
one conversation's rows in order can't be split, so a giant conversation is
one task's stream; it is sorted with spilling and read once.

Null roles and texts count as one space.  Rows are ordered by turn (nulls
first), role, text; rows equal in all of these are each other's duplicates.
Null conversation ids are one conversation.  A row of a dropped turn keeps
its conversation in the result.  Empty tables give no rows; other columns are
not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.llm.shared import written

#: Rows of a conversation whose back pointers a task holds (4 bytes each).
BLOCK = 1 << 18
KEEP, RENAME, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Costs this far above the least can't become the least again: two inserts and a rename reach any useful state.
FAR = 40
NONE, BLANK, DUPLICATE, CUT = 0, 1, 2, 3
SPACE = r"\x20\x09-\x0D"


# ------------------------------------------------------------------ faults

def damage(rows: DataFrame) -> DataFrame:
    """``conv``, ``turn``, ``role``, ``text`` after the fixed damage; a dropped row stays as one that is not ``here``.

    By crc32(``conv_id:turn``) % 20: 0 drops the row, 1 empties its text, 2
    takes its ``.!?``, 3 repeats it, 4 makes it a user's.  ``conv`` is ``=`` and
    the id, empty for a null id.
    """
    named = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    text = F.coalesce("text", F.lit(" "))
    draw = F.col("draw")
    return (rows.select(F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("conv"), F.col("turn").cast("long").alias("turn"),
                        F.coalesce("role", F.lit(" ")).alias("role"), text.alias("text"), (F.crc32(named) % 20).alias("draw"))
            .select("conv", "turn", F.when(draw == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(draw == 1, "").when(draw == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
                    (draw != 0).alias("here"), F.explode(F.when(draw == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))).drop("col"))


def in_order(rows: DataFrame) -> DataFrame:
    """Rows by conversation and turn, each with its first fault: blank, duplicate (role and text seen before) or cut."""
    laid = rows.repartition("conv")
    turn = F.asc_nulls_first("turn")
    seen = laid.withColumn("nth", F.row_number().over(Window.partitionBy("conv", "here", "role", "text").orderBy(turn)))
    fault = (F.when(~F.col("text").rlike(f"[^{SPACE}]"), BLANK).when(F.col("nth") > 1, DUPLICATE)
             .when(F.col("text").rlike(rf"[^{SPACE}.!?][{SPACE}]*\z"), CUT).otherwise(NONE))
    return (seen.withColumn("fault", fault).sortWithinPartitions("conv", turn, "role", "text", "nth")
            .select("conv", F.coalesce("turn", F.lit(0).cast("long")).alias("turn"), F.col("turn").isNotNull().alias("placed"), "role", "text", "fault", "here"))


# ------------------------------------------------------------------ the program

def _after_insert(state: int) -> int:
    return 3 if state == 2 else 2


def _edits(state: int, initial: str, fault: int) -> Iterator[tuple[str, int, int]]:
    """(letter, cost, next state) of what a state can do with a row."""
    yield "D", DELETE, state
    if fault in (BLANK, DUPLICATE):
        return
    more = TRUNCATED if fault == CUT else 0
    if (initial, state) == ("s", 0):
        yield "K", KEEP + more, 1
    if (initial == "a") if state == 2 else (initial == "u"):
        yield "K", KEEP + more, _after_insert(state)
    yield "R", RENAME + more, _after_insert(state)


class Program:
    """Steps between (costs, order) pairs of the four states; each is worked out once and kept."""

    #: Costs above the least and places in the order of the best edits; None for a state that can't be best.
    START = ((0, None, None, None), (0, None, None, None))
    INITIALS = {"s": "s", "u": "u", "a": "a"}

    def __init__(self):
        self.known: dict = {}

    def step(self, at: tuple, initial: str, fault: int) -> tuple:
        """(next pair, rise of the least cost, back pointers, moves) for a row; a move is (state, before, inserts, letter)."""
        key = (at, self.INITIALS.get(initial, "x"), fault)
        found = self.known.get(key)
        if found is None:
            found = self.known[key] = self._step(*key)
        return found

    @staticmethod
    def _step(at: tuple, initial: str, fault: int) -> tuple:
        costs, order = at
        best: dict = {}
        for before in range(4):
            if costs[before] is None:
                continue
            state, cost = before, costs[before]
            for inserts in range(3):
                for letter, more, to in _edits(state, initial, fault):
                    rank = (cost + more, order[before], "I" * inserts + letter)
                    if to not in best or rank < best[to][0]:
                        best[to] = (rank, before, inserts, letter)
                state, cost = _after_insert(state), cost + INSERT
        least = min(b[0][0] for b in best.values())
        best = {to: b for to, b in best.items() if b[0][0] <= least + FAR}
        places = {to: i for i, to in enumerate(sorted(best, key=lambda t: best[t][0][1:]))}
        pair = (tuple(best[t][0][0] - least if t in best else None for t in range(4)), tuple(places.get(t) for t in range(4)))
        pointers = bytes(best[t][1] | best[t][2] << 2 | "DKR".index(best[t][3]) << 4 if t in best else 255 for t in range(4))
        return pair, least, pointers, [(t, b, i, letter) for t, (_, b, i, letter) in sorted(best.items())]

    @staticmethod
    def close(at: tuple) -> tuple[int, int, int]:
        """(state, inserts, cost above the least) of the best end."""
        costs, order = at
        ends = [(costs[s] + INSERT * i, order[s], i, s) for s, i in ((0, 0), (1, 2), (2, 1), (3, 0)) if costs[s] is not None]
        cost, _, inserts, state = min(ends)
        return state, inserts, cost


def walk_back(pointers: bytes, state: int) -> tuple[str, int]:
    """Letters of a block of back pointers that ends in ``state``, and the state before the block."""
    out = []
    for i in range(len(pointers) - 4, -1, -4):
        p = pointers[i + state]
        out.append("DKR"[p >> 4])
        out.append("I" * (p >> 2 & 3))
        state = p & 3
    return "".join(reversed(out)), state


def _pieces(state: int, inserts: int, letter: str, role: str, text: str) -> tuple[list[str], int]:
    """The repaired rows that a move adds after ``state``."""
    out = []
    for _ in range(inserts):
        out.append("assistant:" if state == 2 else "user:")
        state = _after_insert(state)
    if letter == "K":
        out.append(f"{role}:{text}")
    elif letter == "R":
        out.append(("assistant:" if state == 2 else "user:") + text)
    return out, state


class _Conversation:
    """What is carried of a conversation from row to row."""

    def __init__(self, conv: str):
        self.conv, self.at, self.cost, self.back, self.seq = conv, Program.START, 0, bytearray(), 0
        self.hashes = [hashlib.sha256(), None, None, None]
        self.faults = [0, 0, 0, 0]
        self.illegal, self.last = 0, None
        self.turns, self.low, self.high = 0, None, None

    def add(self, program: Program, turn: int, placed: bool, role: str, text: str, fault: int) -> None:
        initial = role[:1]
        if self.last is not None and self.last + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.last = initial
        self.faults[fault] += 1
        if placed:
            if self.low is None:
                self.low = turn
            if turn != self.high:
                self.turns, self.high = self.turns + 1, turn
        self.at, rise, pointers, moves = program.step(self.at, initial, fault)
        self.cost += rise
        self.back += pointers
        hashes = [None] * 4
        for to, before, inserts, letter in moves:
            hashes[to] = self._hashed(before, inserts, letter, role, text)
        self.hashes = hashes

    def _hashed(self, before: int, inserts: int, letter: str, role: str, text: str):
        pieces, _ = _pieces(before, inserts, letter, role, text)
        base = self.hashes[before]
        if not pieces:
            return base
        out = base.copy()
        out.update((("\n" if before else "") + "\n".join(pieces)).encode())
        return out

    def spill(self) -> dict:
        row = {"conv": self.conv, "seq": self.seq, "pointers": bytes(self.back)}
        self.seq, self.back = self.seq + 1, bytearray()
        return row

    def end(self) -> list[dict]:
        state, inserts, more = Program.close(self.at)
        digest = self._hashed(state, inserts, "", "", "").hexdigest()
        row = {"conv": self.conv, "state": state, "tail": "I" * inserts, "cost": self.cost + more, "repaired_sha256": digest,
               "gaps": 0 if self.low is None else min(self.high - self.low + 1 - self.turns, 2**63 - 1),
               "blank": self.faults[BLANK], "duplicate": self.faults[DUPLICATE], "truncated": self.faults[CUT], "illegal": self.illegal}
        if not self.seq:
            row["audit"] = walk_back(self.back, state)[0] + row["tail"]
            return [row]
        return [self.spill(), row] if self.back else [row]


STREAM = ("conv string, seq long, pointers binary, state int, tail string, gaps long, blank long, duplicate long, truncated long, illegal long, "
          "cost long, audit string, repaired_sha256 string")
_NAMES = [c.split()[0] for c in STREAM.split(", ")]


def _frame(rows: list[dict]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=_NAMES, dtype=object)
    return out.where(out.notna(), None)


def _stream(block: int):
    def run(batches):
        program, now = Program(), None
        for batch in batches:
            out = []
            for conv, turn, placed, role, text, fault, here in zip(*[batch[c].to_list() for c in batch.columns]):
                if now is None or conv != now.conv:
                    if now is not None:
                        out.extend(now.end())
                    now = _Conversation(conv)
                if here:
                    now.add(program, turn, placed, role, text, fault)
                    if len(now.back) >= 4 * block:
                        out.append(now.spill())
            if out:
                yield _frame(out)
        if now is not None:
            yield _frame(now.end())
    return run


def _trace(batches):
    """Blocks from the last to the first, after the row that holds the end state, as blocks of letters."""
    conv = state = None
    for batch in batches:
        out = []
        for name, seq, pointers, end in zip(*[batch[c].to_list() for c in ("conv", "seq", "pointers", "state")]):
            if pointers is None:
                conv, state = name, int(end)
                continue
            assert name == conv
            letters, state = walk_back(pointers, state)
            out.append((name, int(seq), letters))
        if out:
            yield pd.DataFrame(out, columns=["conv", "seq", "letters"])


def repair(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """The cheapest repair of each conversation of ``rows`` (``conv``, ``turn``, ``role``, ``text``, ``here``).

    Returns ``conv``, the counts of faults, the cost, the edits' letters and the hash of the repaired rows.
    """
    stream = written(in_order(rows).mapInPandas(_stream(block), STREAM), "repair")
    columns = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    whole = stream.filter("pointers is null and audit is not null").select(*columns)
    giant = stream.filter("audit is null")
    if giant.isEmpty():
        return whole
    letters = (giant.select("conv", "seq", "pointers", "state").repartition("conv").sortWithinPartitions("conv", F.desc_nulls_first("seq"))
               .mapInPandas(_trace, "conv string, seq long, letters string"))
    joined = letters.groupBy("conv").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "letters"))), lambda s: s["letters"]), "").alias("body"))
    ends = giant.filter("pointers is null").join(joined, "conv").withColumn("audit", F.concat("body", "tail"))
    return whole.unionByName(ends.select(*columns))


def repair_conversations(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """Damage and repair of every conversation; ``conv_id`` keeps its type."""
    kind = conversations.schema["conv_id"].dataType
    fixed = repair(damage(conversations), block)
    conv = F.when(F.col("conv") != "", F.expr("substring(conv, 2)")).cast(kind)
    return fixed.select(conv.alias("conv_id"), *[c for c in fixed.columns if c != "conv"])
