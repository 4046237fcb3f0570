"""Conversation repair against a search over all edits by cost and letters."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib

import pyarrow.parquet as pq
import pytest

from larder.llm import queries, repair

SF = "/root/testdata/sf0.001"
SOUND = re.compile(r"(s?(ua)+)?")
PREFIX = re.compile(r"(s?(ua)*u?)?")


def slow_repair(rows):
    """Least (cost, letters, lines) by trying edit sequences in the order of cost and letters."""
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, letters, i, roles, lines = heapq.heappop(heap)
        if i == len(rows) and SOUND.fullmatch(roles):
            return cost, letters, list(lines)
        if (i, roles) in seen:
            continue
        seen.add((i, roles))
        nexts = []
        if roles.count("u") + roles.count("a") <= 2 * len(rows):
            nexts += [(5, "I", i, r[0], f"{r}:") for r in ("user", "assistant")]
        if i < len(rows):
            role, text, fault = rows[i]
            nexts.append((2, "D", i + 1, "", None))
            if fault not in ("blank", "duplicate"):
                more = 5 * (fault == "truncated")
                if role[:1] in ("s", "u", "a"):
                    nexts.append((more, "K", i + 1, role[0], f"{role}:{text}"))
                nexts += [(more + 1, "R", i + 1, r[0], f"{r}:{text}") for r in ("user", "assistant")]
        for c, letter, j, initial, line in nexts:
            if PREFIX.fullmatch(roles + initial):
                heapq.heappush(heap, (cost + c, letters + letter, j, roles + initial, lines if line is None else (*lines, line)))


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        name = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(name.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def slow_row(rows):
    """The expected columns of one conversation of (conv, turn, role, text)."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
    seen, marked = set(), []
    for _, _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"
        seen.add((role, text))
        marked.append((role, text, fault))
    turns = [t for _, t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:], strict=False))
    cost, letters, lines = slow_repair(marked)
    counts = tuple(sum(f == x for _, _, f in marked) for x in repair.FAULTS)
    return (gaps, *counts, illegal, cost, letters, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def conversation(rnd, conv, n):
    say = lambda: rnd.choice(["Yes.", "No!", "so", "Why? ", "  ", "", "Well. Then", "Thanks.\n", "a b c."]) + rnd.choice(["", f" {rnd.random()}."])
    return [(conv, i + rnd.choice([0, 0, 0, 1]), rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", ""]), say()) for i in range(n)]


def expected(rows, keys):
    return {k: slow_row([r for r in rows if r[0] == k]) for k in keys}


def found(spark, rows, known=None):
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    ids = None if known is None else spark.createDataFrame([(k,) for k in known], "conv_id bigint")
    return {r[0]: tuple(r)[1:] for r in repair.repair_conversations(frame, ids).collect()}


def test_random_conversations(spark):
    rnd = random.Random(4)
    rows = [r for conv in range(250) for r in conversation(rnd, conv, rnd.randint(0, 7))]
    assert found(spark, rows, range(250)) == expected(rows, range(250))


@pytest.mark.parametrize("block", [1, 2, 3])
def test_blocks_give_what_one_search_gives(spark, monkeypatch, block):
    monkeypatch.setattr(repair, "BLOCK", block)
    rnd = random.Random(block)
    for conv in range(120):
        rows = conversation(rnd, conv, rnd.randint(1, 8))
        rows.sort(key=lambda r: (r[1], r[2].encode(), r[3].encode()))
        talk, seen, marked = repair.Conversation(conv), set(), []
        for _, turn, role, text in rows:
            bare = text.strip()
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated"
            seen.add((role, text))
            talk.add(turn, role, text, fault)
        assert talk.result()[1:] == slow_row(rows)


def test_odd_rows(spark):
    rows = [
        (None, None, None, None), (None, 2, "user", "Hi."), (1, None, "user", "Hi."), (1, 1, "assistant", "Yo."), (1, 1, "assistant", "Yo."),
        (2, 5, "user", None), (3, 0, "", "No role."), (4, 0, "user", "x" * 200_000 + "."), (4, 9, "assistant", "y"), (5, 0, "user", "A."),
        (5, 0, "assistant", "A."), (5, 3, "user", "A."), (5, 3, "assistant", "A."),
    ]
    plain = [tuple(" " if i > 1 and x is None else x for i, x in enumerate(r)) for r in rows]
    keys = [None, 1, 2, 3, 4, 5, 6]
    assert found(spark, rows, keys) == expected(plain, keys)
    assert found(spark, rows, keys)[6] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert found(spark, rows[:0]) == {}


def test_extra_columns(spark):
    from pyspark.sql import functions as F

    frame = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "assistant", "Yo")], "conv_id bigint, turn bigint, role string, text string")
    clash = frame.select("*", *(F.lit("own").alias(c) for c in ("fault", "real", "cost", "audit", "kind", "copy")))
    assert repair.repair_conversations(clash).collect() == repair.repair_conversations(frame).collect()


def test_long_conversation_in_time(spark):
    """One conversation of 20,000 rows beside a short one: a system row or a missing answer now and then."""
    rows = [(1, i, "user" if i % 2 == 0 or i % 97 == 0 else "assistant", f"Row {i}.") for i in range(20_000)] + [(2, 0, "user", "Hi.")]
    got = found(spark, rows)
    assert got[1][5] == sum(i % 97 == 0 and i % 2 == 1 for i in range(20_000)) and len(got[1][6]) == 20_000
    assert got[2][5:7] == (2, "D")


def test_query_against_brute_force(spark):
    rows = [tuple(r.values()) for r in pq.read_table(f"{SF}/conversations.parquet", columns=["conv_id", "turn", "role", "text"]).to_pylist()]
    got = {r[0]: tuple(r)[1:] for r in queries.op13_conversation_repair(spark, SF).collect()}
    assert got == expected(damaged(rows), {r[0] for r in rows})
    assert any(v[5] for v in got.values())
