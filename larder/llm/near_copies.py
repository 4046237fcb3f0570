"""SimHash near-copies by deletion-variant signatures.

A 64-bit fingerprint is cut into two segments. Of two fingerprints that differ in at most two bits, one segment
differs in at most one, so the two segments are equal or become equal when one bit is deleted. The variants
with one bit deleted are indexed and joined on equality; the distance is then verified. A segment that very
many fingerprints share is not joined so: a second wildcard splits its fingerprints into groups of at most
four, whose members are all linked, so the work stays in proportion to the rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import arrow_map, by_blocks, cut
from larder.llm.graph import components

SHINGLE = 3
MAX_BITS = 2
SEED = 42
#: Fingerprints with one segment that are compared pair by pair; above it, a second wildcard divides them.
PAIRWISE = 48
WORD = re.compile(r"[^ \t-\r]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_hashes(text: str | None, size: int = SHINGLE) -> np.ndarray:
    from xxhash import xxh64_intdigest

    raw = (text or "").translate(LOWER) if text and not text.isascii() else (text or "").lower()
    words = WORD.findall(raw)
    if len(words) > size:
        shingles = map(" ".join, zip(*(words[i:] for i in range(size)), strict=False))
    else:
        shingles = [" ".join(words)] if words else []
    return np.fromiter((xxh64_intdigest(s.encode("utf-8", "surrogatepass"), SEED) for s in shingles), np.uint64)


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """Bit i is set if it is set in over half of the shingles' hashes; zero without a word."""
    hashes = shingle_hashes(text, size)
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 1 << 16):
        part = hashes[start : start + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def _fingerprint_pass(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_blocks(batches, "text"):
            prints = np.array([fingerprint(t, size) for t in batch["text"].to_pylist()], np.uint64)
            names = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([*(batch[n] for n in names), pa.array(prints.view(np.int64))], [*names, "fp"])

    return run


def fingerprints(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) per row of ``docs``; no shuffle."""
    return _fingerprints(docs.select("doc_id", "text"), size)


def _fingerprints(docs: DataFrame, size: int) -> DataFrame:
    """The columns of ``docs`` with ``fp`` in place of the text."""
    kept = [f"{f.name} {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != "text"]
    return arrow_map(docs, _fingerprint_pass(size), ", ".join([*kept, "fp bigint"]))


def _bit(position: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), position)


def _without(value: Column, position: Column) -> Column:
    return value.bitwiseAND(F.bitwise_not(_bit(position)))


def _segments(prints: DataFrame) -> DataFrame:
    """(part, value, other, fp): both halves of every fingerprint, each with the other half."""
    low, high = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("fp", 32)
    parts = F.array(F.struct(F.lit(0).alias("part"), low.alias("value"), high.alias("other")), F.struct(F.lit(1).alias("part"), high.alias("value"), low.alias("other")))
    return prints.select("fp", F.explode(parts).alias("p")).select("p.*", "fp")


def _key(part: Column, value: Column) -> Column:
    return value + F.shiftleft(part.cast("bigint"), 32)


def near_pairs(prints: DataFrame) -> DataFrame:
    """Links (a, b) between the distinct fingerprints ``prints(fp)``.

    Of two segments that differ in one bit, one becomes the other by deleting a set bit. So every segment is
    filed as it is, and once for each set bit without it, and the segments as they are look themselves
    up among both kinds. Every two fingerprints with at most two differing bits are linked directly,
    or, under a segment that more than ``PAIRWISE`` fingerprints have, both to a third one near both.
    """
    exact = _segments(prints)
    bits = F.filter(F.sequence(F.lit(0), F.lit(31)), lambda i: F.col("value").bitwiseAND(_bit(i)) != 0)
    deleted = exact.select("part", "value", "other", "fp", F.explode(bits).alias("bit"))
    deleted = deleted.select(_key(F.col("part"), _without(F.col("value"), F.col("bit"))).alias("key"), "other", "fp", "bit")
    exact = exact.select(_key(F.col("part"), F.col("value")).alias("key"), "other", "fp")
    crowded = cut(exact.groupBy("key").count().where(F.col("count") > PAIRWISE).select("key"), "crowded")

    filed = exact.select("key", "fp").union(deleted.select("key", "fp")).select("key", F.col("fp").alias("b"))
    few = exact.join(crowded, "key", "left_anti").select("key", F.col("fp").alias("a"))
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS
    pairs = few.join(filed, "key").where((F.col("a") != F.col("b")) & close).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return pairs.union(_second_wildcard(exact.join(crowded, "key"), deleted.join(crowded, "key"))).distinct()


def _second_wildcard(exact: DataFrame, deleted: DataFrame) -> DataFrame:
    """Links under segments that very many fingerprints have.

    Two that share the segment are near if their other halves differ in two bits at most: they share a variant
    of it with two wildcards. One that has the segment but for a further bit is near if the other halves
    differ in one bit at most: they share a variant with one wildcard. Each group of equal variants leaves
    two bits of the fingerprint open, so it has at most four members, all near one another.
    """
    spots, other = F.sequence(F.lit(0), F.lit(31)), F.col("other")
    both = F.expr("filter(flatten(transform(sequence(0, 31), i -> transform(sequence(0, 31), j -> struct(i, j)))), p -> p.i < p.j)")
    none = F.lit(-1)
    shared = exact.select("key", "other", "fp", F.explode(both).alias("p")).select(
        "key", none.alias("bit"), F.col("p.i").alias("i"), F.col("p.j").alias("j"), _without(_without(other, F.col("p.i")), F.col("p.j")).alias("rest"), "fp"
    )
    unset = F.filter(spots, lambda i: F.col("key").bitwiseAND(_bit(i)) == 0)
    mine = exact.select("key", "other", "fp", F.explode(unset).alias("bit"))
    one = mine.union(deleted.select("key", "other", "fp", "bit")).select("*", F.explode(spots).alias("i"))
    one = one.select("key", "bit", "i", none.alias("j"), _without(other, F.col("i")).alias("rest"), "fp")
    groups = shared.union(one).groupBy("key", "bit", "i", "j", "rest").agg(F.collect_set("fp").alias("fps")).where(F.size("fps") > 1)
    return groups.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a <> b")


def near_copies(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs(doc_id, text)``.

    Equal fingerprints are one node whatever their number; ``component_id`` is the least doc_id that is
    reachable over links of at most two differing bits. Null, empty and blank texts have the fingerprint
    zero, which is linked like any other; repeated rows stay; a null ``doc_id`` is the least only
    where a component has no other; an empty table gives an empty result. Other columns are not read.
    """
    prints = cut(fingerprints(docs, size), "fingerprints")
    nodes = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "nodes")
    roots = components(near_pairs(nodes.select("fp")))
    held = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least"
    )
    least = held.groupBy("root").agg(F.min("least").alias("component_id"))
    of = held.join(least, "root").select("fp", "component_id")
    return prints.join(of, "fp").select("doc_id", "fp", "component_id")


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def keep_one_of_each(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """One row of ``docs`` for every component: the least by doc_id, unknown ones last, then by the text's hash.

    Rows that repeat a doc_id and text are one document, of which one row stays. The texts are dealt by
    doc_id and hash, of which no value is frequent, and not by fingerprint.
    """
    version = F.xxhash64("text")
    prints = cut(_fingerprints(docs.select("doc_id", version.alias("version"), "text"), size), "fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "version")
    nodes = cut(prints.groupBy("fp").agg(F.min(order).alias("first")), "nodes")
    roots = components(near_pairs(nodes.select("fp"))).withColumnRenamed("node", "fp")
    kept = nodes.join(roots, "fp", "left").groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("first").alias("first"))
    kept = kept.select(F.col("first.doc_id").alias("__kept"), F.col("first.version").alias("__hash"))
    same = F.col("doc_id").eqNullSafe(F.col("__kept")) & (F.col("__version") == F.col("__hash"))
    rows = docs.withColumn("__version", version).join(kept, same, "left_semi")
    return rows.dropDuplicates(["doc_id", "__version"]).drop("__version")
