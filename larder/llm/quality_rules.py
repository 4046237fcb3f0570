"""Quality rules whose cutoffs are chosen with a guarantee on false rejections.

A rule rejects a document when a measure of its text exceeds a cutoff. Candidate cutoffs are fixed before
any label is seen. Within a stratum (the documents of one language) and a rule they are tested from the
loosest to the strictest: with ``k`` of the ``n`` labelled good documents beyond a cutoff, the exact binomial
tail P(X <= k | n, limit) is the p-value of "the rule rejects more than ``limit`` of the good documents".
The walk stops at the first p-value above its level, so the order needs no correction; the number of strata
and rules does, and each (stratum, rule) gets its share of the error probability. Shares of the limit add
up as well: all rules together reject at most ``limit`` of the good documents of every stratum, at once for
all strata with probability 1 - ``error``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import arrow_map, by_blocks, cut

WORD = re.compile(r"[^ \t-\r]+")
#: Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
REPEAT_PERCENT = 50

#: Limit on false rejections by all rules together, and the probability that any stratum exceeds it.
LIMIT = 0.05
ERROR = 0.05
#: Rule -> candidate cutoffs, from the loosest to the strictest.
CUTOFFS = {
    "symbols_per_char": (0.5, 0.3, 0.2, 0.15, 0.1, 0.08, 0.06, 0.05, 0.04, 0.03, 0.02, 0.01, 0.005),
    "duplicate_lines_per_line": (0.9, 0.7, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1, 0.05, 0.02),
    "repeated_words_per_word": (0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.08, 0.06, 0.04),
    "chars_per_word": (20.0, 16.0, 14.0, 12.0, 10.0, 9.0, 8.0, 7.5, 7.0),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def count_text(text: str | None) -> tuple[int, ...]:
    """The counts of ``COUNTS`` for one whole text; a null text has none of anything."""
    text = text or ""
    words = WORD.findall(text)
    symbols = sum(map(text.count, SYMBOLS))
    seen, lines, duplicates = set(), 0, 0
    for line in text.split("\n"):
        if WORD.search(line):
            lines += 1
            duplicates += line in seen
            seen.add(line)
    chars = len("".join(words))
    return len(words), chars, symbols, lines, duplicates, repeated_words(words)


def repeated_words(words: list[str]) -> int:
    """Words that lie in a 3-word window found twice or more."""
    if len(words) < 4:
        return 0
    index: dict[str, int] = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, len(words))
    if len(index) >= 1 << 21:  # three ids no longer fit one integer
        pairs = np.unique(ids[:-1] * len(index) + ids[1:], return_inverse=True)[1]
        keys = pairs[:-1].astype(np.int64) * len(index) + ids[2:]
    else:
        keys = (ids[:-2] << 42) | (ids[1:-1] << 21) | ids[2:]
    ordered = np.sort(keys)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return 0
    again = twice[np.minimum(np.searchsorted(twice, keys), len(twice) - 1)] == keys
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + len(again)] |= again
    return int(covered.sum())


def _count_pass(keep: int, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_blocks(batches, text, 1_000_000):
            counts = list(zip(*map(count_text, batch[text].to_pylist()), strict=True))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(keep)), *(pa.array(c, pa.int64()) for c in counts)],
                [*batch.schema.names[:keep], *COUNTS],
            )

    return run


def with_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` of ``df`` under the names c0, c1, ..., and the counts of its ``text``; no shuffle."""
    needed = columns if "text" in columns else [*columns, "text"]
    rows = df.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(needed)))
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[: len(columns)]]
    schema = ", ".join([*fields, *(f"{c} bigint" for c in COUNTS)])
    return arrow_map(rows, _count_pass(len(columns), f"c{needed.index('text')}"), schema)


def measures() -> dict[str, Column]:
    def ratio(a: str, b: str) -> Column:
        return F.col(a) / F.greatest(F.col(b), F.lit(1))

    return {
        "symbols_per_char": ratio("n_symbols", "word_chars"),
        "duplicate_lines_per_line": ratio("n_dup_lines", "n_lines"),
        "repeated_words_per_word": ratio("n_repeat_words", "n_words"),
        "chars_per_word": ratio("word_chars", "n_words"),
    }


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial with ``n`` trials of probability ``p``."""
    if k >= n or n == 0:
        return 1.0
    if p <= 0 or p >= 1:
        return float(p <= 0)
    log = lambda i: (
        math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)
    )
    return min(1.0, math.fsum(math.exp(log(i)) for i in range(k + 1)))


def select_cutoffs(counts: dict, limit: float = LIMIT, error: float = ERROR) -> dict:
    """{(stratum, rule): cutoff} of ``counts`` {(stratum, rule): (n, [good documents beyond each cutoff])}.

    A (stratum, rule) of which no cutoff passes its test is left out and rejects nothing.
    """
    strata = {s for s, _ in counts}
    level = error / max(1, len(strata) * len(CUTOFFS))
    chosen = {}
    for (stratum, rule), (n, beyond) in counts.items():
        for cutoff, k in zip(CUTOFFS[rule], beyond, strict=True):
            if binomial_tail(k, n, limit / len(CUTOFFS)) > level:
                break
            chosen[stratum, rule] = cutoff
    return chosen


def calibrate(counted: DataFrame, labels: DataFrame, limit: float = LIMIT, error: float = ERROR) -> dict:
    """Cutoffs from all labelled good documents that pass the base rules.

    ``counted`` has doc_id, stratum and the counts; ``labels`` doc_id and quality. The driver gets one
    row of counts for each language with labelled documents, and one for documents without a language.
    Labels that are null, or whose documents are absent, count for nothing; several labels of one
    document count as the least of them.
    """
    good = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id").agg(F.min("quality").alias("quality"))
        .where("quality = 1").select("doc_id")
    )
    held = counted.where(~base_failed()).join(good, "doc_id").select("stratum", *(v.alias(k) for k, v in measures().items()))
    beyond = [F.sum((F.col(r) > c).cast("long")).alias(f"{r}_{i}") for r, cs in CUTOFFS.items() for i, c in enumerate(cs)]
    by_stratum = held.groupBy("stratum").agg(F.count("*").alias("n"), *beyond)
    counts = {}
    for row in by_stratum.collect():
        for rule, cutoffs in CUTOFFS.items():
            counts[(int(row.stratum is not None), row.stratum), rule] = (row.n, [row[f"{rule}_{i}"] for i in range(len(cutoffs))])
    return select_cutoffs(counts, limit, error)


def rejected_by(cutoffs: dict) -> Column:
    """Names of the rules that reject a counted row; its ``stratum`` column says which cutoffs hold.

    A stratum without a cutoff for a rule, labelled or not, is not rejected by it.
    """
    fired = []
    for rule, measure in measures().items():
        own = {name: float(c) for ((kind, name), r), c in sorted(cutoffs.items(), key=str) if r == rule and kind == 1}
        limits = F.lit(cutoffs.get(((0, None), rule))).cast("double")
        if own:
            by_name = F.create_map(*(F.lit(x) for pair in own.items() for x in pair))
            limits = F.when(F.col("stratum").isNull(), limits).otherwise(by_name[F.col("stratum")])
        else:
            limits = F.when(F.col("stratum").isNull(), limits)
        fired.append(F.when(measure > limits, F.lit(rule)))
    return F.array_compact(F.array(*fired))


def judge_documents(docs: DataFrame, labels: DataFrame, limit: float = LIMIT, error: float = ERROR) -> DataFrame:
    """One row per document: doc_id, the counts, base_failed, rules that fired, kept.

    Every whole text is counted once, without a shuffle; the counts are written to the shared folder and
    read twice, to choose the cutoffs and to judge. Null and empty texts have no words and fail the base
    rules; repeated rows are judged alike; without labels no rule fires; an empty table gives an empty
    result. Further columns of ``docs`` are not read.
    """
    counted = with_counts(docs, ["doc_id", "lang"]).withColumnsRenamed({"c0": "doc_id", "c1": "stratum"})
    counted = cut(counted, "counts")
    return _verdict(counted, calibrate(counted, labels, limit, error))


def _verdict(counted: DataFrame, cutoffs: dict) -> DataFrame:
    return (
        counted.withColumn("base_failed", base_failed())
        .withColumn("rules", rejected_by(cutoffs))
        .withColumn("kept", ~F.col("base_failed") & (F.size("rules") == 0))
    )


def keep_good(docs: DataFrame, labels: DataFrame, limit: float = LIMIT, error: float = ERROR) -> DataFrame:
    """The rows of ``docs`` that ``judge_documents`` keeps, with all their columns.

    Texts are counted twice, once for the cutoffs and once to filter in place: no text is shuffled.
    """
    counted = with_counts(docs, ["doc_id", "lang"]).withColumnsRenamed({"c0": "doc_id", "c1": "stratum"})
    counted = cut(counted, "counts")
    cutoffs = calibrate(counted, labels, limit, error)
    names = [*docs.columns, "lang"]
    judged = _verdict(with_counts(docs, names).withColumnRenamed(f"c{len(names) - 1}", "stratum"), cutoffs)
    return judged.where("kept").select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)))
