"""Benchmark passages in every document, long ones too, in time in proportion to the text."""

from __future__ import annotations

import re
from collections import defaultdict

import corpus_pipeline
from larder.llm import decontam, queries
from tests.llm.test_operators import sha

SF = "/root/testdata/sf0.001"


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def windows(items, size=13):
    """{length: {window: items}}"""
    index = defaultdict(lambda: defaultdict(set))
    for item, text in items:
        own = words_of(text)
        for i in range(max(1, len(own) - size + 1) if own else 0):
            index[len(own[i : i + size])][tuple(own[i : i + size])].add(item)
    return index


def all_hits(text, index):
    have, hit, found = words_of(text), set(), set()
    for n, known in index.items():
        for j in range(len(have) - n + 1):
            if items := known.get(tuple(have[j : j + n])):
                hit |= set(range(j, j + n))
                found |= items
    return len(have), len(hit), sorted(str(x) for x in found if x is not None)


def test_every_document(spark):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs, index = spark.read.parquet(f"{SF}/documents.parquet"), windows(items)
    texts = {r.doc_id: r.text for r in docs.collect()}
    want = {d: all_hits(t, index) for d, t in texts.items()}
    assert any(len(t) >= 6000 for t in texts.values())
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in queries.op9_decontamination(spark, SF).collect()}
    assert got == {d: (n, hit, len(found), sha(",".join(found))) for d, (n, hit, found) in want.items()}
    kept = {r.doc_id for r in corpus_pipeline.benchmark(spark, docs, SF).select("doc_id").collect()}
    assert kept == {d for d, (n, hit, _) in want.items() if not (hit > 0 and 20 * hit >= n)}


def test_passage_in_a_long_document(spark):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    long = " ".join(texts)[:60_000].split(" ")
    passage = max((t for _, t in items if t), key=len)
    table = [(1, " ".join(long)), (2, " ".join([*long, passage])), (3, " ".join([*long[:5000], passage, *long[5000:]]))]
    found = decontam.find_contamination(spark.createDataFrame(table, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    got, index = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in found.collect()}, windows(items)
    assert got == {d: all_hits(t, index) for d, t in table} and got[2][1] > got[1][1] and got[3][1] > got[1][1]
