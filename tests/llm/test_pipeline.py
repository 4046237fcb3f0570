"""The stages, each on what the one before it kept, against plain versions."""

from __future__ import annotations

import corpus_pipeline
from larder.llm import queries
from larder.llm.common import cut
from tests.llm.test_operators import rows, slow_components, slow_dropped, slow_fingerprint, slow_hits

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, cut(stage(spark, docs, SF), "test-stage")
        kept[name] = docs
        if name == "quality":
            good = {r.doc_id for r in queries.op1_quality_rules(spark, SF).collect() if r.kept}
            assert rows(docs) == rows(before.where(before.doc_id.isin(list(good)))) and 0 < docs.count() < before.count()
        elif name == "lines":
            table = [(r.doc_id, r.text) for r in before.collect()]
            gone = slow_dropped(table)
            want = [(d, "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone.get((d, t), ()))) for d, t in table]
            assert rows(docs, "doc_id", "text") == sorted(want, key=str) and any(gone.values())
            assert all(r.n_chars == len(r.text) for r in docs.collect())
        elif name == "copies":
            of = slow_components([(r.doc_id, slow_fingerprint(r.text)) for r in before.collect()])
            assert {r.doc_id for r in docs.collect()} == set(of.values()) and docs.count() == len(set(of.values()))
        elif name == "benchmark":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            gone = {r.doc_id for r in before.collect()} - {r.doc_id for r in docs.collect()}
            for r in before.where(before.doc_id.isin(list(gone)) | (before.n_chars < 600)).collect():
                n, hit, _, _ = slow_hits(r.text, items)
                assert (r.doc_id in gone) == (hit > 0 and 20 * hit >= n)
        if name != "encoding":
            assert docs.columns == columns
    assert docs.count() == kept["benchmark"].count()


def test_stages_with_messy_tables(spark, messy, nothing):
    for start in (messy, nothing):
        docs = start
        for name, stage in corpus_pipeline.STAGES:
            docs = cut(stage(spark, docs, SF), "test-stage")
            if name != "encoding":
                assert docs.columns == messy.columns
                assert all(r.items == "own items" for r in docs.collect())
