"""Token ids of whole documents in ORC files, and reading them back.

The files hold one row per document in ascending ``doc_id`` order: ``doc_id``, ``ids`` (ARRAY<INT>, stored
as integer run-length encoded streams), ``n_tokens``, ``part`` (the range of doc_ids that it belongs to) and
``offset`` (ids of the same range before it); a range may be one file or several. Row
indexes and a Bloom filter on ``doc_id`` let a reader skip stripes and row groups; stripes are the unit of
parallel reads.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder.llm.common import arrow_map, by_blocks, cut
from larder.llm.ragged import PieceIds, flattened

END_ID = 0
#: A full stop or comma that does not follow a letter or digit of a fixed, old range.
LOOSE_MARK = re.compile(r"[.,](?=[ \n])(?<![0-9A-Za-zÀ-ÖØ-öø-ɏ][.,])")
CUT = "\x00"
#: Distinct pieces that a worker remembers, about 250 bytes each.
PIECES = 1_000_000


def cut_texts(texts: list[str], loose: list[bool]) -> pa.ListArray:
    """Pieces of the texts, cut where the pre-tokeniser of a byte-level BPE always cuts.

    These are: before a single space between non-space characters, around a line end between such
    characters, and, in texts that are not ``loose``, between a letter or digit and the full stop or comma
    that ends a word. The cuts are right if ``regular`` holds for every piece.
    """
    whole = pa.array(texts, pa.large_string())
    marked = pc.replace_substring(whole, " ", CUT + " ")
    ends = pc.replace_substring(pc.replace_substring(marked, "." + CUT, CUT + "." + CUT), "," + CUT, CUT + "," + CUT)
    ends = pc.replace_substring(ends, ".\n", CUT + ".\n")
    marked = pc.if_else(pa.array(loose), marked, ends) if any(loose) else ends
    return pc.split_pattern(pc.replace_substring(marked, "\n", CUT + "\n" + CUT), CUT)


def regular(piece: str) -> bool:
    core = piece[1:] if piece[:1] == " " else piece
    blank = not core or core[0].isspace() or core[-1].isspace()
    return piece == "\n" or not blank and CUT not in piece


@cache
def _pieces(path: str) -> tuple[PieceIds, Callable]:
    from tokenizers import Tokenizer

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a task per core
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    (tab,) = tokenizer.encode("\t", add_special_tokens=False).ids

    def whole(texts: list[str]) -> list[list[int]]:
        return [x.ids for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(pieces: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Many pieces in one text, with tabs between, which are tokens of their own there."""
        alone = [p for p in pieces if "\t" in p or p == "\n"]
        plain = [p for p in pieces if "\t" not in p and p != "\n"]
        joined = ["\t".join(plain[i : i + 500]) for i in range(0, len(plain), 500)]
        ids, sizes = [], []
        for some in whole(joined):
            some = np.array(some, np.int32)
            ends = np.flatnonzero(some == tab)
            sizes.append(np.diff(np.concatenate([[-1], ends, [len(some)]])) - 1)
            ids.append(some[some != tab])
        rest, rest_sizes = flattened(whole(alone))
        return plain + alone, np.concatenate([*ids, rest]), np.concatenate([*sizes, rest_sizes])

    return PieceIds(encode, PIECES, regular), whole


def encode_texts(texts: list[str | None], path: str) -> list[np.ndarray]:
    """Ids of every whole text as the tokenizers library gives them; a null text is empty.

    The library encodes each distinct piece of ``cut_text`` once, and a text that has an irregular
    piece in one go.
    """
    pieces, whole = _pieces(path)
    odd = [bool(t) and CUT in t for t in texts]
    fit = ["" if o else t or "" for t, o in zip(texts, odd, strict=True)]
    out = pieces.ids(cut_texts(fit, [LOOSE_MARK.search(t) is not None for t in fit]))
    out = [None if o or not t else x for t, o, x in zip(texts, odd, out, strict=True)]
    alone = [i for i, ids in enumerate(out) if ids is None]
    for i, ids in zip(alone, whole([texts[i] or "" for i in alone]), strict=True):
        out[i] = np.array(ids, np.int32)
    return out


def _encode_pass(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, part = 0, TaskContext.get().partitionId()
        for batch in by_blocks(batches, "text", 4_000_000):
            lists = [np.append(x, end_id) for x in encode_texts(batch["text"].to_pylist(), path)]
            sizes = np.fromiter(map(len, lists), np.int64, len(lists))
            ends = np.cumsum(sizes)
            ids = pa.ListArray.from_arrays(
                pa.array(np.append(0, ends).astype(np.int32)),
                pa.array(np.concatenate(lists).astype(np.int32)),
            )
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], ids, pa.array(sizes), pa.array(np.full(len(sizes), part, np.int32)), pa.array(before + ends - sizes)],
                ["doc_id", "ids", "n_tokens", "part", "offset"],
            )
            before += int(ends[-1])

    return run


def write_token_files(docs: DataFrame, out: str, path: str, end_id: int = END_ID) -> None:
    """Encode ``docs(doc_id, text)`` and write them to the folder ``out`` as ORC.

    The texts are dealt by ranges of ``doc_id`` and sorted before they are encoded, so every file holds
    rows of one range, in order; all rows with one ``doc_id``, or with none, are in one range. A null text is an empty document (only the end id); rows that repeat a
    ``doc_id`` are all written, in the order of their texts; rows with a null ``doc_id`` come first;
    an empty table writes an empty folder. Other columns are not read.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    encoded = arrow_map(rows, _encode_pass(path, end_id), f"doc_id {kind}, ids array<int>, n_tokens bigint, part int, offset bigint")
    (
        encoded.write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .option("orc.row.index.stride", "1000")
        .option("orc.stripe.size", str(32 << 20))
        .option("orc.compress", "zstd")
        .orc(out)
    )


def read_token_files(spark: SparkSession, folder: str, where: Column | None = None) -> DataFrame:
    """(doc_id, ids, n_tokens, start): ``start`` counts the ids of all documents before.

    A condition on ``doc_id`` reaches the ORC reader, which skips stripes by their statistics and Bloom
    filters. The starts come from one total per range, for which no ids are read.
    """
    files = spark.read.orc(folder)
    totals = files.groupBy("part").agg(
        F.max(F.col("offset") + F.col("n_tokens")).alias("total"),
        F.min("doc_id").alias("least"),
        F.max(F.col("doc_id").isNull()).alias("unknown"),
    )
    before = F.sum("total").over(
        Window.orderBy(F.desc("unknown"), "least").rowsBetween(Window.unboundedPreceding, -1)
    )
    # written, so that the planner knows how small it is and need not shuffle the ids for the join
    bases = cut(totals.select("part", F.coalesce(before, F.lit(0)).alias("base")), "bases")
    rows = files if where is None else files.where(where)
    return rows.join(bases, "part").select(
        "doc_id", "ids", "n_tokens", (F.col("base") + F.col("offset")).alias("start")
    )


def _checksum_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch["ids"]
        ends = ids.offsets.to_numpy()
        raw = memoryview(ids.values.to_numpy(zero_copy_only=False).astype("<u4")).cast("B")
        sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["start"], pa.array(np.diff(ends).astype(np.int64)), pa.array(sums, pa.int64())],
            ["doc_id", "start", "n_tokens", "ids_crc32"],
        )


def checksums(rows: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of rows that ``read_token_files`` gave."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    return arrow_map(rows.select("doc_id", "start", "ids"), _checksum_pass, f"doc_id {kind}, start bigint, n_tokens bigint, ids_crc32 bigint"
    )
