import functools
import hashlib
import itertools
import random
import re
import zlib

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from visitledger.llm import conversations
from visitledger.llm.queries import QUERIES, damaged_conversations

PATTERN = re.compile("(s?(ua)+)?")
NAMES = {"u": "user", "a": "assistant"}


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        said = text.strip(" \t\n\x0b\x0c\r")
        if not said:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if said[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def all_edits(rows):
    """(cost, edits, repaired turns) of the best of every combination, two inserts at most in each place."""
    inserts = [i for n in range(3) for i in itertools.product("ua", repeat=n)]
    per_row = []
    for (_, role, text), fault in zip(rows, faults(rows), strict=True):
        more = 3 * (fault == "truncated")
        options = [(4, "D", "", None)]
        if fault not in ("blank", "duplicate"):
            options += [(more, "K", role[:1], (role, text))] if role else []
            options += [(3 + more, "R", i, (NAMES[i], text)) for i in "ua"]
        per_row.append([(3 * len(ins) + c, "I" * len(ins) + e, "".join(ins) + i, [(NAMES[x], "") for x in ins] + ([t] if t else []))
                        for ins in inserts for c, e, i, t in options])
    tail = [(3 * len(ins), "I" * len(ins), "".join(ins), [(NAMES[x], "") for x in ins]) for ins in inserts]
    best = None
    for parts in itertools.product(*per_row, tail):
        if PATTERN.fullmatch("".join(p[2] for p in parts)):
            found = (sum(p[0] for p in parts), "".join(p[1] for p in parts), [t for p in parts for t in p[3]])
            best = min(best or found, found, key=lambda f: f[:2])
    return best


def backwards(rows):
    """The same from the last row on: the least string of the cheapest ways to go on."""
    marks = faults(rows)
    wanted = {"": "su", "s": "u", "u": "a", "a": "u"}

    @functools.cache
    def go(i, last, inserts):
        options = [(0, "", ())] if i == len(rows) and last in ("", "a") else []
        fill = "a" if last == "u" else "u"
        if inserts < 2:
            cost, edits, turns = go(i, fill, inserts + 1)
            options.append((cost + 3, "I" + edits, ((NAMES[fill], ""), *turns)))
        if i < len(rows):
            _, role, text = rows[i]
            cost, edits, turns = go(i + 1, last, 0)
            options.append((cost + 4, "D" + edits, turns))
            if marks[i] not in ("blank", "duplicate"):
                more = 3 * (marks[i] == "truncated")
                if role[:1] and role[:1] in wanted[last]:
                    cost, edits, turns = go(i + 1, role[:1], 0)
                    options.append((cost + more, "K" + edits, ((role, text), *turns)))
                cost, edits, turns = go(i + 1, fill, 0)
                options.append((cost + more + 3, "R" + edits, ((NAMES[fill], text), *turns)))
        return min(options, default=(10 ** 9, "", ()))

    return go(0, "", 0)


def expected(rows, best=None):
    """What the report says of rows (turn, role, text) in order."""
    if not rows:
        return 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()
    cost, edits, turns = best or backwards(rows)
    marks = faults(rows)
    known = [t for t, _, _ in rows if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    said = "\n".join(f"{r}:{t}" for r, t in turns)
    return (gaps, marks.count("blank"), marks.count("duplicate"), marks.count("truncated"), illegal, cost, edits,
            hashlib.sha256(said.encode()).hexdigest())


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def random_rows(rng, n):
    return in_order([(rng.choice([None, *range(6)]), rng.choice(["user", "assistant", "system", "tool", " ", ""]),
                      rng.choice(["a.", "b!", "c", "d? ", " \n", "", "é."])) for _ in range(n)])


def fed(rows, limit):
    one = conversations.Conversation(1, conversations.Transitions(), limit)
    for (turn, role, text), fault in zip(rows, faults(rows), strict=True):
        code = "sua".find(role[:1]) % 4 if role else 3
        one.add(turn, role, text, code * 4 + ["", "blank", "duplicate", "truncated"].index(fault))
    counts, audit = one.report()
    said = "\n".join(f"{r}:{t}" for e, r, t in one.repaired(audit) if e != "D")
    one.close()
    return *counts.values(), audit, hashlib.sha256(said.encode()).hexdigest()


def test_cheapest_then_least_edits():
    rng = random.Random(2)
    for _ in range(150):
        rows = random_rows(rng, rng.randint(1, 2))
        assert all_edits(rows)[:2] == backwards(rows)[:2]
    for _ in range(1500):
        rows = random_rows(rng, rng.randint(1, 12))
        assert fed(rows, rng.choice([0, 40, 10 ** 6])) == expected(rows), rows


def test_giant_conversation_spills():
    one = conversations.Conversation(1, conversations.Transitions(), 1000)
    for i in range(100_000):
        one.add(i, "user" if i % 3 else "assistant", f"t{i}.", 4 if i % 3 else 8)
    assert one.turns.file._rolled and one.pointers.file._rolled
    counts, audit = one.report()
    assert len(one.steps.back) < 200 and sum(e != "I" for e in audit) == 100_000
    initials = "".join(r[0] for e, r, _ in one.repaired(audit) if e != "D")
    assert PATTERN.fullmatch(initials) and counts["cost"] == 3 * audit.count("I") + 3 * audit.count("R") + 4 * audit.count("D")
    one.close()


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, code string, there string, earlier string")


def test_frames(spark):
    rng = random.Random(4)
    groups = {key: random_rows(rng, rng.randint(1, 9)) for key in (None, 1, 2, 3, 4)}
    rows = [(k, t, r, x, "x", "y", "z") for k, g in groups.items() for t, r, x in g]
    rng.shuffle(rows)
    rows += [(7, 1, None, None, "x", "y", "z")]
    groups[7] = [(1, " ", " ")]
    df = frame(spark, rows)
    got = {r[0]: tuple(r)[1:] for r in conversations.reports(df).collect()}
    assert got == {k: expected(g) for k, g in groups.items()}
    assert {r[0]: tuple(r)[1:] for r in conversations.reports(df, spill=0).collect()} == got
    for key, mine in itertools.groupby(conversations.repaired(df).sort("conv_id", "place").collect(), lambda r: r.conv_id):
        mine = list(mine)
        assert [r.place for r in mine] == list(range(len(mine)))
        said = "\n".join(f"{r.role}:{r.text}" for r in mine if r.edit != "D")
        assert "".join(r.edit for r in mine) == got[key][6]
        assert hashlib.sha256(said.encode()).hexdigest() == got[key][7]
    assert conversations.reports(df.limit(0)).count() == 0
    gone = conversations.reports(df, present=F.lit(None)).collect()
    assert {r.conv_id for r in gone} == set(groups) and {tuple(r)[1:] for r in gone} == {expected([])}


def damaged(rows):
    out = {}
    for conv, turn, role, text in rows:
        mine = out.setdefault(conv, [])
        part = [" " if v is None else v for v in (conv, turn, role, text)]
        kind = zlib.crc32(f"{part[0]}:{part[1]}".encode()) % 20
        role, text = part[2:]
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        mine += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return {k: in_order(v) for k, v in out.items()}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_op11(spark, sf):
    path = f"/root/testdata/{sf}"
    table = pq.read_table(f"{path}/conversations.parquet", columns=["conv_id", "turn", "role", "text"])
    want = {k: expected(v) for k, v in damaged(zip(*[c.to_pylist() for c in table.columns], strict=True)).items()}
    got = QUERIES["op11_conversation_repair"](spark, path).collect()
    assert len(got) == len(want) and {r[0]: tuple(r)[1:] for r in got} == want
    assert any(w[1] for w in want.values()) and any("I" in w[6] for w in want.values())


def test_damage_of_nulls(spark):
    rows = [(None if i % 3 == 0 else i, None if i % 4 == 0 else i, None if i % 5 == 0 else "user", None if i % 7 == 0 else "so. ")
            for i in range(120)]
    df = damaged_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r[0]: tuple(r)[1:] for r in conversations.reports(df, present=F.col("present")).collect()}
    assert got == {k: expected(v) for k, v in damaged(rows).items()}
