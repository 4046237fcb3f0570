"""Periodic runs of words by maximal pairs over the LCP-interval tree.

A run of period q and length L is a stretch of words that repeats itself after q words, at least twice, and that
no word on either side continues. Its starts i and i + q agree on exactly L - q >= q words and have different
words to their left: they are a maximal pair whose distance is at most the length that they share. The converse
holds as well, so no pair needs to be extended. Only neighbouring starts of an interval have to be
looked at: were there another start of the shared words between i and i + q, the run had a smaller period.

Of a run of at least ``least`` words the pair shares at least half as many. So only words that start a
repeated sequence of that many words enter the suffix order, and the tree has no shallower intervals.
"""

from __future__ import annotations

from bisect import insort
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from larder.llm.common import arrow_map, by_blocks

LEAST = 12
MIX = np.uint64(0x9E3779B97F4A7C15)


def _rank(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Dense ranks of the pairs (a, b)."""
    return np.unique(a.astype(np.int64) * (int(b.max()) + 1) + b, return_inverse=True)[1]


def _repeated(ids: np.ndarray, texts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose next ``size`` words occur again in the same text, and up to ``size`` positions behind each;
    and their ranks by text and these words.

    A table of hash counts leaves out nearly all others; the rest is compared word by word. The positions
    behind are those that decide the order of two repeats where these end. ``ids`` has ``size`` more words
    than ``texts``.
    """
    mixed = texts.astype(np.uint64)
    for j in range(size):
        mixed = mixed * MIX + ids[j : len(texts) + j].astype(np.uint64)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * MIX
    bits = max(10, int(4 * len(texts)).bit_length())
    slot = (mixed >> np.uint64(64 - bits)).astype(np.int64)
    often = np.flatnonzero(np.bincount(slot, minlength=1 << bits)[slot] > 1)
    near = np.zeros(len(texts) + size, bool)
    for j in range(size + 1):
        near[often + j] = True
    at = np.flatnonzero(near[: len(texts)])
    if not len(at):
        return at, at
    rank = texts[at]
    for j in range(size):
        rank = _rank(rank, ids[at + j])
    return at, rank


def _suffix_order(at: np.ndarray, rank: np.ndarray, n: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The positions ``at`` in an order of their suffixes, by doubling; and whether each shares ``size`` words
    with the one before it."""
    order = at[np.argsort(rank, kind="stable")]
    sorted_rank = np.sort(rank)
    same = np.append(False, sorted_rank[1:] == sorted_rank[:-1])[: len(order)]
    slots = np.arange(len(order))
    place = np.arange(n, 2 * n + 1)  # every position that is not in ``at`` differs from all others
    place[order] = np.maximum.accumulate(np.where(same, 0, slots))
    joined, reach = same.copy(), size
    while joined.any():
        open_ = joined | np.append(joined[1:], False)
        act = slots[open_]
        pos = order[act]
        key = place[pos] * (2 * n + 2) + place[np.minimum(pos + reach, n)]
        by = np.argsort(key, kind="stable")
        order[act] = pos[by]
        key = key[by]
        first = np.append(True, key[1:] != key[:-1])
        place[order[act]] = np.maximum.accumulate(np.where(first, act, 0))
        joined[act] = ~first
        reach *= 2
    return order, same


def _shared(ids: list[int], at: list[int], before: dict[int, int], size: int) -> dict[int, int]:
    """For each position the number of words that it shares with ``before`` it in the suffix order."""
    out, last, known = {}, -2, 0
    for i in at:
        j = before.get(i, -1)
        if j < 0:
            last = -2
            continue
        known = max(known - 1, size) if i == last + 1 else size
        while ids[i + known] == ids[j + known]:
            known += 1
        out[i], last = known, i
    return out


class _Runs:
    """Runs found while the intervals of the tree are closed from the deepest up."""

    def __init__(self, left: list[int], least: int):
        self.left, self.least, self.found = left, least, []

    def _pair(self, a: int, b: int, depth: int) -> None:
        if b - a <= depth and b - a + depth >= self.least and self.left[a] != self.left[b]:
            self.found.append((a, b - a + depth, b - a))

    def close(self, children: list[list[int]], depth: int) -> list[int]:
        """The starts of an interval from those of its children, in text order; each start's class is the word
        to its left, and new neighbours of different classes are tested."""
        if len(children) == 2 and len(children[0]) == len(children[1]) == 1:
            a, b = sorted(children[0] + children[1])
            self._pair(a, b, depth)
            return [a, b]
        large = max(range(len(children)), key=lambda c: len(children[c]))
        starts = children[large]
        owner = {x: c for c, child in enumerate(children) if c != large for x in child}
        if len(owner) == 1:
            insort(starts, next(iter(owner)))
        else:
            starts.extend(owner)
            starts.sort()
        for x, c in owner.items():
            i = bisect_left(starts, x)
            if i and starts[i - 1] not in owner:
                self._pair(starts[i - 1], x, depth)
            if i + 1 < len(starts) and owner.get(starts[i + 1]) != c:
                self._pair(x, starts[i + 1], depth)
        return starts


def maximal_runs(ids: np.ndarray, texts: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Rows (start, length, period) of all runs of at least ``least`` words, by start, then period.

    ``ids`` are the words of several texts, each text followed by an id that occurs nowhere else; ``texts``
    gives the number of the text for each of them.
    """
    size = max(1, (least + 1) // 2)
    ids = np.append(ids, ids.max(initial=0) + 1 + np.arange(size))
    at, rank = _repeated(ids, texts, size)
    order, same = _suffix_order(at, rank, len(texts), size)
    before = dict(zip(order[same].tolist(), order[np.flatnonzero(same) - 1].tolist(), strict=True))
    shared = _shared(ids.tolist(), at.tolist(), before, size)
    runs = _Runs([-1, *ids[:-1].tolist()], least)
    stack: list[tuple[int, list[list[int]]]] = []
    now: list[int] = []
    for x in [*order.tolist(), None]:
        depth = shared.get(x, 0)  # none for the first start of a group
        while stack and stack[-1][0] > depth:
            deep, children = stack.pop()
            children.append(now)
            now = runs.close(children, deep)
        if stack and stack[-1][0] == depth:
            stack[-1][1].append(now)
        elif depth:
            stack.append((depth, [now]))
        now = [x]
    return np.array(sorted((a, n, q) for a, n, q in runs.found), np.int64).reshape(-1, 3)


#: Gives the words of a text by number, to be read in place of it: (doc_id, number of words) -> numbers or None.
Rewrite = Callable[[int | None, int], np.ndarray | None]


def runs_of_texts(doc_ids: list, texts: list[bytes | None], least: int = LEAST, rewrite: Rewrite | None = None) -> list[tuple]:
    """(n_words, runs, collapsed words) of every text; words are parted by spaces and the characters 9 to 13."""
    words = [(t or b"").split() for t in texts]
    flat = pa.array([w for some in words for w in some], pa.binary()).dictionary_encode().indices.to_numpy()
    sizes = np.array([len(some) for some in words], np.int64)
    ids = np.empty(len(flat) + len(texts), np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    ends = starts + sizes
    ids[ends] = len(flat) + 1 + np.arange(len(texts))
    inside = np.ones(len(ids), bool)
    inside[ends] = False
    ids[inside] = flat
    if rewrite:
        for k, key in enumerate(doc_ids):
            read = rewrite(key, int(sizes[k])) if sizes[k] else None
            if read is not None:
                ids[starts[k] : ends[k]] = ids[starts[k] + read]
                words[k] = [words[k][i] for i in read.tolist()]
    found = maximal_runs(ids, np.repeat(np.arange(len(texts)), sizes + 1), least)
    # a word is dropped if any run holds it after its first period
    depth = np.zeros(len(ids) + 1, np.int64)
    np.add.at(depth, found[:, 0] + found[:, 2], 1)
    np.add.at(depth, found[:, 0] + found[:, 1], -1)
    kept = np.cumsum(depth[:-1]) == 0
    cuts = np.searchsorted(found[:, 0], np.append(starts, len(ids)))
    out = []
    for k, some in enumerate(words):
        rows = found[cuts[k] : cuts[k + 1]] - np.array([starts[k], 0, 0])
        if len(rows):
            some = [w for w, keep in zip(some, kept[starts[k] : ends[k]].tolist(), strict=True) if keep]
        out.append((int(sizes[k]), rows, b" ".join(some)))
    return out


def _runs_pass(least: int, rewrite: Rewrite | None):
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_blocks(batches, "text"):
            texts = batch["text"].cast(pa.binary()).to_pylist()
            out = runs_of_texts(batch["doc_id"].to_pylist(), texts, least, rewrite)
            sizes = [len(rows) for _, rows, _ in out]
            flat = np.concatenate([rows for _, rows, _ in out])
            runs = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(flat[:, c])) for c in range(3)], fields=list(run_type))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"], pa.array([n for n, _, _ in out], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), runs),
                    pa.array([c for _, _, c in out], pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "n_words", "runs", "collapsed"],
            )

    return run


def periodic_runs(docs: DataFrame, least: int = LEAST, rewrite: Rewrite | None = None) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) for every row of ``docs(doc_id, text)``; no shuffle.

    ``runs`` lists (start, length, period) of all runs of at least ``least`` words by start, then period, where start
    is a word number and period the smallest one; ``collapsed`` holds the words that no run repeats, with one
    space between. ``rewrite`` may give other words of the text to be read in its place. A null, empty or blank
    text has no words, no runs and an empty ``collapsed``; repeated rows and null ids are rows like any other; an
    empty table gives an empty result; other columns are not read. One text is read in one task, in time that
    grows a little faster than its length (sorting), whatever its repeats.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    return arrow_map(docs.select("doc_id", "text"), _runs_pass(least, rewrite), schema)
