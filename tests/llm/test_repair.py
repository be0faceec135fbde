import functools
import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import types as T

from lodestar.llm.repair import Program, repair, repair_conversations, walk_back

ROWS = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
                     T.StructField("text", T.StringType())])
SPACES = " \t\n\x0b\x0c\r"
END = re.compile(r"(s?(ua)+)?\Z")


def damaged(rows):
    """{conv_id: rows after damage in order}, by the contract's words."""
    out = {}
    for conv, turn, role, text in rows:
        mine = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if draw == 1:
            text = ""
        elif draw == 2:
            text = re.sub("[.!?]", "", text)
        elif draw == 4:
            role = "user"
        mine.extend([(turn, role, text)] * (0 if draw == 0 else 2 if draw == 3 else 1))
    for mine in out.values():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    return out


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        shown = text.rstrip(SPACES)
        out.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def plain_repair(rows):
    """Every edit string by plain recursion over (row, roles so far as a state), the least of (cost, letters)."""
    marks = faults(rows)

    def ok(pattern_state, initial):
        return {"": initial in "su", "s": initial == "u", "u": initial == "a", "a": initial == "u"}[pattern_state] and initial != ""

    @functools.cache
    def best(i, state, inserts):
        options = []
        if i == len(rows) and state in ("", "a"):
            options.append((0, "", ()))
        if inserts < 2:
            for name in ("user", "assistant"):
                if ok(state, name[0]):
                    cost, letters, kept = best(i, name[0], inserts + 1)
                    options.append((cost + 5, "I" + letters, (name + ":",) + kept))
        if i < len(rows):
            _, role, text = rows[i]
            cost, letters, kept = best(i + 1, state, 0)
            options.append((cost + 2, "D" + letters, kept))
            if marks[i] not in ("blank", "duplicate"):
                more = 5 if marks[i] == "truncated" else 0
                for letter, price, name in (("K", 0, role), ("R", 1, "user"), ("R", 1, "assistant")):
                    if ok(state, name[:1]) and not (letter == "R" and name == role):
                        cost, letters, kept = best(i + 1, name[0], 0)
                        options.append((cost + price + more, letter + letters, (f"{name}:{text}",) + kept))
        return min(options, key=lambda o: o[:2]) if options else (10**9, "", ())

    return best(0, "", 0)


def expected(rows):
    marks, turns = faults(rows), {r[0] for r in rows if r[0] is not None}
    cost, audit, kept = plain_repair(tuple(rows))
    pairs = [a[1][:1] + b[1][:1] for a, b in itertools.pairwise(rows)]
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, marks.count("blank"), marks.count("duplicate"), marks.count("truncated"),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(kept).encode()).hexdigest())


def got(df):
    return {r["conv_id"]: (r["gaps"], r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["cost"], r["audit"], r["repaired_sha256"]) for r in df.collect()}


def random_rows(n, seed, longest=9):
    r = random.Random(seed)
    texts = ["Well done.", "Is it?", "cut off", "", " \t", "Yes!", "é. \n", "no end \x0b", "漢字。", "a.b", None]
    roles = ["user"] * 4 + ["assistant"] * 4 + ["system"] * 2 + ["tool", "", None, "User", "sys"]
    out = []
    for conv in range(n):
        turn = r.randint(-3, 3)
        for _ in range(r.randint(1, longest)):
            out.append((conv, turn if r.random() > 0.05 else None, r.choice(roles), r.choice(texts[:3] if r.random() < 0.6 else texts)))
            turn += r.choice([0, 1, 1, 1, 1, 2, 5])
    return out


@pytest.mark.parametrize("block", [1 << 18, 1, 3])
def test_equals_plain_recursion(spark, block):
    """Also with blocks of one and of three rows, so that every conversation is spilled and traced back."""
    rows = random_rows(300, 5) + [(None, 1, "user", "Hi."), (None, None, None, None), (None, 2, "assistant", "Yes."), (10**15 + 1, 2**62, "user", "x.")]
    r = random.Random(1)
    want = {conv: expected(mine) for conv, mine in damaged(rows).items()}
    r.shuffle(rows)
    assert got(repair_conversations(spark.createDataFrame(rows, ROWS).repartition(5), block)) == want


def test_all_short_conversations_of_plain_rows(spark):
    """Every sequence of up to three rows of each role and kind, by the streamed step and by recursion."""
    kinds = [(role, text) for role in ("user", "assistant", "system", "x") for text in ("Fine.", "cut", "")]
    program = Program()
    for n in range(4):
        for rows in itertools.product(kinds, repeat=n):
            rows = tuple((i, role, f"{i} {text}" if text else text) for i, (role, text) in enumerate(rows))
            at, cost, back = Program.START, 0, b""
            for (_, role, _), mark in zip(rows, faults(rows)):
                at, rise, pointers, _ = program.step(at, role[0], {None: 0, "blank": 1, "duplicate": 2, "truncated": 3}[mark])
                cost, back = cost + rise, back + pointers
            state, inserts, more = Program.close(at)
            assert (cost + more, walk_back(back, state)[0] + "I" * inserts) == plain_repair(rows)[:2], rows
    assert len(program.known) < 3000  # the program has few states, however many rows it sees


def test_giant_conversation_across_batches(spark):
    """40,000 rows of one conversation: many Arrow batches and blocks, few program states."""
    r = random.Random(9)
    rows = [(1, i, r.choice(["user", "assistant", "system"]), f"row {i}" + r.choice([".", "", "!"])) for i in range(40_000)]
    df = spark.createDataFrame(rows, ROWS).repartition(7)
    a, b = got(repair_conversations(df)), got(repair_conversations(df, block=1000))
    assert a == b and len(a[1][6].replace("I", "")) == sum(len(v) for v in damaged(rows).values())
    letters, mine = a[1][6], damaged(rows)[1]
    state, cost, kept, at, marks = "", 0, [], 0, faults(mine)
    for x in letters:  # the letters alone give the repaired rows, their cost and their hash
        name = "assistant" if state == "u" else "user"
        if x == "I":
            cost, state = cost + 5, name[0]
            kept.append(name + ":")
            continue
        _, role, text = mine[at]
        if x == "D":
            cost += 2
        else:
            name = role if x == "K" else name
            cost, state = cost + (x == "R") + 5 * (marks[at] == "truncated"), name[0]
            kept.append(f"{name}:{text}")
        at += 1
    assert END.match("".join(k[0] for k in kept)) and cost == a[1][5]
    assert hashlib.sha256("\n".join(kept).encode()).hexdigest() == a[1][7]


def test_dropped_empty_and_clashing(spark):
    dropped = next(c for c in range(10**6) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(dropped, 0, "user", "Hi.")], ROWS).selectExpr("*", "1 conv", "2 fault", "3 here", "4 draw", "5 seq")
    assert got(repair_conversations(df)) == {dropped: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert repair_conversations(spark.createDataFrame([], ROWS)).collect() == []
    long = "word " * 400_000
    rows = [(3, 1, "user", long + "."), (3, 2, "assistant", long + "!")]
    assert got(repair_conversations(spark.createDataFrame(rows, ROWS)))[3] == expected(damaged(rows)[3])


def test_rows_without_damage(spark):
    rows = [("a", 1, "assistant", "Hello.", True), ("a", 2, "user", "Hi.", True), ("a", 3, "assistant", "Well.", True)]
    r = repair(spark.createDataFrame(rows, "conv string, turn long, role string, text string, here boolean")).first()
    assert (r["cost"], r["audit"], r["illegal"]) == (2, "DKK", 0)
