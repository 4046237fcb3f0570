"""Repair of the turn structure of conversations by depth-first branch and bound.

A conversation is sound if its roles are an optional system turn and then user and assistant in turn, ending with the
assistant. Edits keep a row, give it another role, delete it, or insert an empty row. The search goes down
the rows with an explicit stack. A node is the number of rows passed and the state of the role pattern; it is cut off
when the least cost behind it (the suffix bound) cannot beat the incumbent, the best whole repair so far,
by cost or, at equal cost, by the order of the edits' letters; or when its table entry holds a
better prefix. When the stack is empty the incumbent is proved best.

Of two prefixes at one node with equal cost none begins with the other (further letters would be inserts,
which cost), so the one that is less stays less whatever follows: the table may drop the other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import BATCH_ROWS, arrow_map

RENAME, DELETE, INSERT, CUT_SHORT = 1, 2, 5, 5
FAULTS = ("blank", "duplicate", "truncated")
#: Rows that are searched at once; longer conversations go on from the best prefix of every state.
BLOCK = 256
#: state -> initial -> next state: nothing yet, after the system turn, after a user, after an assistant
STEPS = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ENDS = (0, 3)
FAR = 1 << 60
ROLE = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
KNOWN = frozenset("sua")


def _bounds(rows: list[tuple[str, str]], ends: tuple[int, ...]) -> list[list[int]]:
    """For every number of rows passed and every state, the least cost of reaching one of ``ends``."""
    bound = [[FAR] * 4 for _ in range(len(rows) + 1)]
    for state in ends:
        bound[-1][state] = 0
    for i in range(len(rows), -1, -1):
        here = bound[i]
        if i < len(rows):
            after = bound[i + 1]
            for state in range(4):
                here[state] = min([cost + after[to] for _, to, cost in _row_edits(rows[i], state)])
        # inserts: a user and an assistant turn lead to each other, and a user turn follows the other states
        here[2] = min(here[2], INSERT + here[3])
        here[3] = min(here[3], INSERT + here[2])
        for state in (0, 1):
            here[state] = min(here[state], INSERT + here[2])
    return bound


@cache
def _row_edits(row: tuple[str, str], state: int) -> list[tuple[str, int, int]]:
    """(letter, next state, cost) of the edits of one row (initial, fault), by letter; other initials are one."""
    initial, fault = row
    edits = [("D", state, DELETE)]
    if fault in ("blank", "duplicate"):
        return edits
    extra = CUT_SHORT if fault == "truncated" else 0
    if initial in STEPS[state]:
        edits.append(("K", STEPS[state][initial], extra))
    edits += [("R", to, RENAME + extra) for new, to in STEPS[state].items() if new != "s"]
    return edits


def search(rows: list[tuple[str, str]], start: int, ends: tuple[int, ...]) -> tuple[int, str] | None:
    """The least (cost, letters) that leads ``rows`` from the state ``start`` to one of ``ends``; None if no edits do."""
    bound = _bounds(rows, ends)
    if bound[0][start] >= FAR:
        return None
    best = (FAR, "")
    table: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, start, 0, "")]
    while stack:
        i, state, cost, letters = stack.pop()
        least = cost + bound[i][state]
        if least > best[0] or least == best[0] and letters > best[1][: len(letters)]:
            continue
        known = table.get((i, state))
        if known is not None and known <= (cost, letters):
            continue
        table[i, state] = (cost, letters)
        if i == len(rows) and state in ends:
            best = min(best, (cost, letters))
        moves = [("I", i, to, INSERT) for initial, to in STEPS[state].items() if initial != "s"]
        if i < len(rows):
            moves += [(letter, i + 1, to, c) for letter, to, c in _row_edits(rows[i], state)]
        # the most promising is taken from the stack first: least bound, then least letter
        moves.sort(key=lambda m: (m[3] + bound[m[1]][m[2]], m[0]), reverse=True)
        stack.extend((n, to, cost + c, letters + letter) for letter, n, to, c in moves if bound[n][to] < FAR)
    return best


def rebuilt(rows: list[tuple[str, str]], texts: list[tuple[str, str]], start: int, letters: str) -> list[str]:
    """The lines ``role:text`` that the edits leave of (role, text) rows, beginning in the state ``start``."""
    out, state, i = [], start, 0
    for letter in letters:
        if letter == "D":
            i += 1
            continue
        if letter == "K":
            initial, line = rows[i][0], f"{texts[i][0]}:{texts[i][1]}"
        else:
            initial = "a" if state == 2 else "u"
            line = f"{ROLE[initial]}:{texts[i][1] if letter == 'R' else ''}"
        out.append(line)
        state = STEPS[state][initial]
        i += letter != "I"
    return out


@dataclass
class _Path:
    """The best prefix that ends in one state: its digest is kept instead of its rows."""

    cost: int = 0
    letters: str = ""
    digest: object = field(default_factory=hashlib.sha256)
    empty: bool = True


class Conversation:
    """The rows of one conversation in order, read once; at most ``BLOCK`` of them are held."""

    def __init__(self, key):
        self.key = key
        self.counts = dict.fromkeys(FAULTS, 0)
        self.illegal = 0
        self.turns: tuple | None = None  # least, greatest, distinct
        self.last: str | None = None
        self.paths: dict[int, _Path] = {0: _Path()}
        self.rows: list[tuple[str, str]] = []
        self.texts: list[tuple[str, str]] = []

    def add(self, turn: int | None, role: str, text: str, fault: str) -> None:
        if len(self.rows) == BLOCK:
            self._advance(range(4))
        if turn is not None:
            low, high, many = self.turns or (turn, None, 0)
            self.turns = (low, turn, many + (turn != high))
        if fault:
            self.counts[fault] += 1
        initial = role[:1]
        if self.last is not None and self.last + initial not in LEGAL:
            self.illegal += 1
        self.last = initial
        self.rows.append((initial if initial in KNOWN else "", fault))
        self.texts.append((role, text))

    def _advance(self, ends) -> None:
        """Search the rows held, from every state that a path is in to every state of ``ends``."""
        found: dict[int, tuple] = {}
        for start, path in self.paths.items():
            for end in ends:
                got = search(self.rows, start, (end,))
                if got:
                    new = (path.cost + got[0], path.letters + got[1], start, got[1])
                    if end not in found or new[:2] < found[end][:2]:
                        found[end] = new
        after = {}
        for end, (cost, letters, start, edits) in found.items():
            old = self.paths[start]
            lines = rebuilt(self.rows, self.texts, start, edits)
            digest, empty = old.digest.copy(), old.empty
            if lines:
                digest.update((("" if empty else "\n") + "\n".join(lines)).encode("utf-8", "surrogatepass"))
                empty = False
            after[end] = _Path(cost, letters, digest, empty)
        self.paths, self.rows, self.texts = after, [], []

    def result(self) -> tuple:
        self._advance(ENDS)
        best = min((self.paths[s] for s in self.paths), key=lambda p: (p.cost, p.letters))
        low, high, many = self.turns or (0, -1, 0)
        counts = tuple(self.counts[f] for f in FAULTS)
        return (self.key, high - low + 1 - many, *counts, self.illegal, best.cost, best.letters, best.digest.hexdigest())


OUT = ("gaps", *FAULTS, "illegal", "cost", "audit", "repaired_sha256")


def _repair_pass(key_type: pa.DataType):
    types = [key_type, *[pa.int64()] * 6, pa.string(), pa.string()]

    def batch_of(done: list[tuple]) -> pa.RecordBatch:
        columns = zip(*done, strict=True) if done else [[] for _ in types]
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], ["conv_id", *OUT])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: Conversation | None = None
        before = None  # the last row; equal rows of one turn lie next to each other
        done: list[tuple] = []
        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("conv_id", "turn", "role", "text", "fault", "real")]
            for key, turn, role, text, fault, real in zip(*columns, strict=True):
                if now is None or now.key != key:
                    if now is not None:
                        done.append(now.result())
                    now, before = Conversation(key), None
                    if len(done) >= BATCH_ROWS:
                        yield batch_of(done)
                        done = []
                if not real:
                    continue
                if not fault or fault == "truncated":
                    fault = "duplicate" if before == (turn, role, text) else fault
                before = (turn, role, text)
                now.add(turn, role, text, fault)
        if now is not None:
            done.append(now.result())
        yield batch_of(done)

    return run


def _digest(*parts: Column) -> Column:
    """Equal only for equal parts (but for collisions of SHA-256)."""
    return F.sha2(F.concat(*(x for p in parts for x in (F.length(p).cast("string"), F.lit(":"), p))), 256)


def faults(rows: DataFrame) -> DataFrame:
    """``rows(conv_id, turn, role, text)`` with ``fault``: blank, duplicate of an earlier turn, truncated or empty.

    Repeats within one turn are left to the pass that reads the rows in order, where they lie next to each
    other. Role and text that occur in several turns are few beside all rows: the planner picks the join
    by their size, and a text that a third of all rows have is one row of theirs.
    """
    bare = F.rtrim(F.translate("text", "\t\n\x0b\x0c\r", "     "))
    marked = rows.withColumn("__said", _digest(F.col("role"), F.col("text")))
    seen = marked.where(bare != "").groupBy(F.col("conv_id").alias("__conv"), F.col("__said").alias("__text"))
    seen = seen.agg(F.min("turn").alias("__first"), F.max("turn").alias("__last"), F.max(F.col("turn").isNull()).alias("__unknown"))
    seen = seen.where("__first < __last OR (__unknown AND __first IS NOT NULL)").drop("__last")
    joined = marked.join(seen, F.col("conv_id").eqNullSafe(F.col("__conv")) & (F.col("__said") == F.col("__text")), "left")
    fault = (
        F.when(bare == "", "blank")
        .when((F.col("turn") > F.col("__first")) | (F.col("__unknown") & F.col("turn").isNotNull()), "duplicate")
        .when(F.right(bare, F.lit(1)).isin(".", "!", "?"), "")
        .otherwise("truncated")
    )
    return joined.select("conv_id", "turn", "role", "text", fault.alias("fault"))


def repair_conversations(rows: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """One row per conversation of ``rows(conv_id, turn, role, text)``, and of ``known(conv_id)``.

    Columns: conv_id, the counts gaps, blank, duplicate, truncated and illegal, the least cost, audit (the letters of
    the edits: Keep, Rename, Delete, Insert) and repaired_sha256, the digest of the repaired lines
    ``role:text``. Rows are read by turn (unknown ones first), role and text. A null role or text counts as one
    space; a null conv_id is a conversation of its own; a conversation without rows has zeros and empty
    texts; repeated rows are duplicates; an empty table gives an empty result; other columns are not read.

    Rows are sorted within their partition and read in a stream, of which ``BLOCK`` rows and at most four prefixes
    are held, so a conversation of any length takes bounded memory (its letters aside). Its digest runs over
    all its text in order, so one conversation is read by one task.
    """
    key = rows.schema["conv_id"].dataType
    plain = rows.select("conv_id", "turn", *(F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")))
    marked = faults(plain).withColumn("real", F.lit(True))
    if known is not None:
        none = [F.lit(None).cast(rows.schema["turn"].dataType), F.lit(""), F.lit(""), F.lit(""), F.lit(False)]
        marked = marked.union(known.select("conv_id").distinct().select("conv_id", *none))
    dealt = marked.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("real"), "turn", "role", "text")
    from pyspark.sql.pandas.types import to_arrow_type

    numbers = ", ".join(f"{c} bigint" for c in OUT[:6])
    schema = f"conv_id {key.simpleString()}, {numbers}, audit string, repaired_sha256 string"
    return arrow_map(dealt, _repair_pass(to_arrow_type(key)), schema)
