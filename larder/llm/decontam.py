"""Benchmark decontamination: one Aho-Corasick automaton over the windows of all benchmark items.

Texts are normalised byte by byte (A-Z to a-z, every other ASCII character that is no letter or digit to a
space), so a position in the normalised text is a position in the original. A window is 13 consecutive
words of an item, or all words of a shorter item.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.llm.common import arrow_map, by_blocks, cut, lower_ascii

WORDS = 13
#: Words of items in one automaton: about 150 MB in a worker. Of more items the hits are gathered block by block.
BLOCK_WORDS = 100_000
WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(FOLD).split()


def windows(words: list[bytes], size: int) -> list[bytes]:
    if not words:
        return []
    return [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]


class Scanner:
    """The automaton of one block of items. ``items`` are pairs (item_id, text)."""

    def __init__(self, items: list[tuple], size: int):
        import ahocorasick

        owners: dict[str, set] = {}
        for item, text in items:
            for window in windows(words_of(text), size):
                owners.setdefault(f" {window.decode('latin-1')} ", set()).add(item)
        self.automaton = ahocorasick.Automaton()
        for window, who in owners.items():
            self.automaton.add_word(window, (len(window), who))
        self.empty = not owners
        if owners:
            self.automaton.make_automaton()

    def scan(self, text: str | None) -> tuple[int, list[tuple[int, int]], set]:
        """Words of the text, runs [first, last) of hit words, items with occurring windows."""
        folded = (text or "").encode("utf-8", "surrogatepass").translate(FOLD)
        words = folded.split()
        if self.empty or not words:
            return len(words), [], set()
        line = f" {b' '.join(words).decode('latin-1')} "
        found, who = [], set()
        for end, (length, owners) in self.automaton.iter(line):
            found.append((end - length + 1, end))
            who |= owners
        if not found:
            return len(words), [], who
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        begins = np.cumsum(sizes + 1) - sizes - 1
        first = np.searchsorted(begins, [a for a, _ in found])
        last = np.searchsorted(begins, [b for _, b in found])
        return len(words), merge_runs(zip(first.tolist(), last.tolist(), strict=True)), who


def merge_runs(runs) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def to_offsets(text: str, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs of words as [start, end) code points of the original text."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    inside = np.concatenate([[False], np.frombuffer(bytes(raw).translate(FOLD), np.uint8) != 32, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    points = np.append(0, np.cumsum((raw & 0xC0) != 0x80))  # code points before each byte
    return [(int(points[starts[a]]), int(points[ends[b - 1]])) for a, b in runs]


@lru_cache(maxsize=1)
def _scanner(key: str, items: tuple, size: int) -> Scanner:
    return Scanner(list(items), size)


def _hits_of(scanner: Scanner, text: str | None) -> tuple[int, list[dict], list[str]]:
    n, hit, who = scanner.scan(text)
    offsets = to_offsets(text, hit) if hit else []
    runs = [{"a": a, "b": b, "start": s, "end": e} for (a, b), (s, e) in zip(hit, offsets, strict=True)]
    return n, runs, sorted(str(x) for x in who if x is not None)


def _scan_pass(shared, key: str, size: int, text_column: str):
    """Every row with what the block finds in its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(key, shared.value, size)
        for batch in by_blocks(batches, text_column):
            counts, runs, items = zip(*(_hits_of(scanner, t) for t in batch[text_column].to_pylist()), strict=True)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(counts, pa.int64()), pa.array(runs, RUNS), pa.array(items, pa.list_(pa.string()))],
                [*batch.schema.names, "__n", "__runs", "__items"],
            )

    return run


def _block_pass(shared, key: str, size: int):
    """(__id, __version, __runs, __items) of the rows with a hit alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(key, shared.value, size)
        for batch in by_blocks(batches, "text"):
            found = [(i, *_hits_of(scanner, t)[1:]) for i, t in enumerate(batch["text"].to_pylist())]
            found = [x for x in found if x[1]]
            at = pa.array([i for i, _, _ in found], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch["__id"].take(at), batch["__version"].take(at), pa.array([r for _, r, _ in found], RUNS),
                    pa.array([x for _, _, x in found], pa.list_(pa.string())),
                ],
                ["__id", "__version", "__runs", "__items"],
            )

    return run


def _joined_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The runs of all blocks as one list of runs that do not touch."""
    for batch in batches:
        out = []
        for runs in batch["__runs"].to_pylist():
            starts, ends = {r["a"]: r["start"] for r in runs}, {r["b"]: r["end"] for r in runs}
            out.append([{"a": a, "b": b, "start": starts[a], "end": ends[b]} for a, b in merge_runs((r["a"], r["b"]) for r in runs)])
        at = batch.schema.get_field_index("__runs")
        yield batch.set_column(at, "__runs", pa.array(out, RUNS))


RUNS = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64()), ("start", pa.int64()), ("end", pa.int64())]))
SOME = "array<struct<a:bigint,b:bigint,start:bigint,end:bigint>>"


def _blocks(benchmark: DataFrame, most: int) -> Iterator[tuple]:
    """Items in blocks of about ``most`` words; one block is on the driver at a time."""
    held, words = [], 0
    for row in benchmark.select("item_id", "text").toLocalIterator():
        n = len(words_of(row.text))
        if held and words + n > most:
            yield tuple(held)
            held, words = [], 0
        held.append((row.item_id, row.text))
        words += n
    yield tuple(held)


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, size: int = WORDS, block_words: int = BLOCK_WORDS, prefix: str = ""
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_hit``, ``items``, ``spans`` and ``contaminated`` added.

    ``prefix`` goes before these five names; columns of ``docs`` that have the same names are replaced.

    Every whole text is scanned by one automaton, without a shuffle, as long as the benchmark has no more than
    ``block_words`` words, which bounds the automaton. A larger one is scanned for in blocks, one broadcast at
    a time; what is kept of a block are the runs and items of the rows with a hit, and only these are
    shuffled: rows with one ``doc_id`` and text have the same.
    ``spans`` are [start, end) code points of the original text that are hit; ``items`` the ids, as
    strings in string order, of items with an occurring window. Contaminated: at least one word in
    twenty is hit. Null and empty texts have no words; null items or texts without words have no window; a
    null ``item_id`` marks words but is not listed. All other columns, and repeated rows, stay as they are.
    """
    added = [prefix + c for c in ("n_words", "n_hit", "items", "spans", "contaminated")]
    names = [c for c in docs.columns if c not in added]
    # a position as name: other columns of the input may have any name
    rows = docs.select(*(F.col(f"`{c}`").alias(f"__c{i}") for i, c in enumerate(names)))
    text_column = f"__c{names.index('text')}"
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema), "__n bigint", f"__runs {SOME}", "__items array<string>"])
    blocks = _blocks(benchmark, block_words)
    block, following = next(blocks), next(blocks, None)

    def shared(block: tuple) -> tuple:
        key = hashlib.sha256(repr((block, size)).encode("utf-8", "surrogatepass")).hexdigest()
        return docs.sparkSession.sparkContext.broadcast(block), key, size

    if following is None:
        rows = arrow_map(rows, _scan_pass(*shared(block), text_column), schema)
    else:
        keyed = docs.select(F.col("doc_id").alias("__id"), F.xxhash64("text").alias("__version"), "text")
        kind = docs.schema["doc_id"].dataType.simpleString()
        found = None
        while block is not None:
            part = arrow_map(keyed, _block_pass(*shared(block)), f"__id {kind}, __version bigint, __runs {SOME}, __items array<string>")
            part = cut(part, "hits")
            found = part if found is None else found.union(part)
            block, following = following, next(blocks, None)
        whole = found.groupBy("__id", "__version").agg(
            F.array_distinct(F.flatten(F.collect_set("__runs"))).alias("__runs"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("__items")))).alias("__items")
        )
        whole = arrow_map(whole, _joined_pass, whole.schema)
        count = F.regexp_count(lower_ascii(F.coalesce(text_column, F.lit(""))), F.lit(WORD_PATTERN))
        same = F.col(f"__c{names.index('doc_id')}").eqNullSafe(F.col("__id")) & (F.xxhash64(text_column) == F.col("__version"))
        rows = rows.join(whole, same, "left").select(
            *rows.columns, count.cast("bigint").alias("__n"), F.coalesce("__runs", F.array().cast(SOME)).alias("__runs"),
            F.coalesce("__items", F.array().cast("array<string>")).alias("__items"),
        )
    hit = F.aggregate("__runs", F.lit(0).cast("bigint"), lambda s, r: s + r["b"] - r["a"])
    spans = F.transform("__runs", lambda r: F.struct(r["start"].alias("start"), r["end"].alias("end")))
    found = [F.col("__n"), hit, F.col("__items"), spans, (hit > 0) & (20 * hit >= F.col("__n"))]
    return rows.select(
        *(F.col(f"__c{i}").alias(c) for i, c in enumerate(names)),
        *(column.alias(c) for column, c in zip(found, added, strict=True)),
    )
