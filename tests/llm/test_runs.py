"""Periodic runs against a search that tries every period."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from larder.llm import queries, runs

SF = "/root/testdata/sf0.001"


def slow_runs(words, least=12):
    """Every period, every stretch of words that equal the word one period on."""
    known = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    found = {}
    for q in range(1, len(words) // 2 + 1):
        equal = np.concatenate([[0], ids[:-q] == ids[q:], [0]]).astype(np.int8)
        change = np.flatnonzero(np.diff(equal))
        for i, j in zip(change[::2].tolist(), change[1::2].tolist(), strict=True):
            if j - i + q >= max(least, 2 * q):
                found.setdefault((i, j - i + q), q)  # the smallest period comes first
    return sorted((i, n, q) for (i, n), q in found.items())


def slow_collapsed(words, rows):
    gone = {i for a, n, q in rows for i in range(a + q, a + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def ascii_words(text):
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.mark.parametrize("least", [1, 2, 5, 12])
def test_every_run_of_random_texts(least):
    rnd = random.Random(least)
    for _ in range(150):
        texts = []
        for _ in range(rnd.randint(1, 5)):
            words = rnd.choices("abcd"[: rnd.randint(1, 4)], k=rnd.randint(0, 70))
            if words and rnd.random() < 0.6:
                a, p = rnd.randrange(len(words)), rnd.randint(1, 9)
                words = words[:a] + [words[a + (i - a) % p] if a + (i - a) % p < i else words[i] for i in range(a, len(words))]
            texts.append(" ".join(words).encode())
        for text, (n, rows, collapsed) in zip(texts, runs.runs_of_texts([0] * len(texts), texts, least), strict=True):
            words = text.decode().split()
            want = slow_runs(words, least)
            assert (n, [tuple(r) for r in rows.tolist()]) == (len(words), want)
            assert collapsed.decode() == slow_collapsed(words, want)


def test_long_texts_end(spark):
    line = "one line that many pages have in their footer "
    rows = [(1, "word " * 100_000), (2, "a b " * 60_000), (3, "".join(line + f"{i} " for i in range(15_000))), (4, "x" * 300_000)]
    got = {r["doc_id"]: r for r in runs.periodic_runs(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert [tuple(r) for r in got[1]["runs"]] == [(0, 100_000, 1)] and got[1]["collapsed"] == "word"
    assert [tuple(r) for r in got[2]["runs"]] == [(0, 120_000, 2)] and got[2]["collapsed"] == "a b"
    assert got[3]["runs"] == [] and got[4]["n_words"] == 1


def test_messy_rows(messy, messy_rows, nothing):
    want = []
    for key, text, _ in messy_rows:
        words = ascii_words(text)
        rows = slow_runs(words, 4)
        want.append((key, len(rows), slow_collapsed(words, rows), len(words)))
    plain = runs.periodic_runs(messy, 4).select("doc_id", F.size("runs").alias("r"), "collapsed", "n_words").collect()
    assert sorted(map(str, map(tuple, plain))) == sorted(map(str, want))
    assert runs.periodic_runs(nothing).count() == 0


def test_query_against_brute_force(spark):
    """Every document of the smallest table, damaged as the query damages it."""
    got = {r["doc_id"]: r for r in queries.op12_periodic_runs(spark, SF).collect()}
    docs = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    assert len(got) == len(docs)
    some = 0
    for d in docs:
        words = ascii_words(d["text"])
        n, h = len(words), zlib.crc32(str(d["doc_id"]).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        row = got[d["doc_id"]]
        want = slow_runs(words)
        some += len(want)
        top = max(want, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        assert row["n_runs"] == len(want)
        assert (row["start"], row["length"], row["period"]) == (top or (None, None, None))
        assert row["exponent_milli"] == (top and 1000 * top[1] // top[2])
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        assert row["runs_sha256"] == digest("".join("%d,%d,%d\n" % r for r in want))
        assert row["collapsed_sha256"] == digest(slow_collapsed(words, want))
    assert some > 10
