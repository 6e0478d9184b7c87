"""Conversation repair against a plain search over edit sequences, and odd rows."""

import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest

from transitlake.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string, key string, rank int, letter string, cost int, node string"
SPACE = " \t\n\x0b\x0c\r"


def turns_of(spark, rows):
    return spark.createDataFrame([(*r, "k", 1, "x", 2, "n") for r in rows], SCHEMA)


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        show = lambda v: " " if v is None else str(v)
        act = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        role, text = show(role), show(text)
        if act == 0:
            continue
        if act == 1:
            text = ""
        if act == 2:
            text = re.sub("[.!?]", "", text)
        if act == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if act == 3 else 1)
    return out


def cheapest(rows):
    """rows: (role, text, fault).  Least (cost, audit), with the lines that it leaves."""
    queue, seen = [(0, "", 0, "", ())], set()
    while queue:
        cost, audit, at, roles, lines = heapq.heappop(queue)
        if (at, roles) in seen:
            continue
        seen.add((at, roles))
        if at == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            return cost, audit, "\n".join(lines)

        def push(extra, edit, role, text, ahead, kept):
            more = roles + (role[:1] if kept else "")
            if not kept or (role and re.fullmatch("s?(ua)*u?", more)):
                heapq.heappush(queue, (cost + extra, audit + edit, at + ahead, more, (*lines, f"{role}:{text}") if kept else lines))

        for name in ("user", "assistant"):
            push(2, "I", name, "", 0, True)
        if at < len(rows):
            role, text, fault = rows[at]
            push(3, "D", "", "", 1, False)
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                push(extra, "K", role, text, 1, True)
                for name in ("user", "assistant"):
                    push(2 + extra, "R", name, text, 1, True)


def brute(rows):
    everyone = {r[0] for r in rows}
    kept = damaged(rows)
    out = []
    for conv in everyone:
        mine = sorted((r for r in kept if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        faults, seen = [], set()
        for _, _, role, text in mine:
            body = text.strip(SPACE)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else None if body[-1] in ".!?" else "truncated"
            seen.add((role, text))
            faults.append((role, text, fault))
        numbers = {r[1] for r in mine} - {None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        pairs = [a[2][:1] + b[2][:1] for a, b in itertools.pairwise(mine)]
        cost, audit, text = cheapest(faults)
        n = [sum(f[2] == name for f in faults) for name in ("blank", "duplicate", "truncated")]
        out.append((conv, gaps, *n, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("block", [2, 256])
def test_random_conversations(spark, block):
    rng = random.Random(7)
    texts = ["Fine.", "Fine.", "cut off", "why? ", " \n", "", "Good! ok", None]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "umpire", "", "User", None]
    rows = [(conv, turn, rng.choice(roles), rng.choice(texts) if rng.random() < 0.5 else f"Text {conv} {turn}.") for conv in range(120) for turn in range(rng.randrange(1, 8))]
    assert rows_of(repair.repair(turns_of(spark, rows), block)) == brute(rows)


def test_odd_rows(spark):
    rows = [
        (None, None, None, None), (None, 1, "user", "Hello."), (None, 1, "user", "Hello."), (7, None, "user", "a."), (7, None, "assistant", None),
        (7, 5, "system", "s."), (7, 5, "assistant", "x" * 100_000), (7, 5, "user", "zwölf"), (8, 10**12, "", ""), (9, -3, "user", "Only."),
    ]
    rows += [(10, t, "user" if t % 2 == 0 else "assistant", f"Turn {t}.") for t in range(40)]
    assert rows_of(repair.repair(turns_of(spark, rows), 8)) == brute(rows)
    assert repair.repair(turns_of(spark, rows).limit(0)).count() == 0


def test_conversation_of_dropped_rows_alone(spark):
    turn = next(t for t in itertools.count() if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    got = rows_of(repair.repair(turns_of(spark, [(1, turn, "user", "Gone.")])))
    assert got == [(1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_nodes_are_shared(spark):
    """Many conversations of one signature are one node; a common end of different ones is shared."""
    rows = [(c, t, "user" if t % 2 == 0 else "assistant", f"Turn {c} {t}.") for c in range(50) for t in range(4 + c % 2)]
    blocks = repair.blocks_of(repair.signed(turns_of(spark, rows).select("conv_id", "turn", "role", "text").selectExpr("string(conv_id) key", "turn", "role", "text")), 2)
    assert {(r.key, r.cost, r.audit) for r in repair.automaton(blocks).collect()} == {
        (str(c), 0 if c % 2 == 0 else 2, "KKKK" if c % 2 == 0 else "KKKKKI") for c in range(50)
    }


def test_query_over_the_table(spark, sf_small):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(repair.query(spark, sf_small)) == brute(rows)
