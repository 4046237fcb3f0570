"""The copies stage on repeated and null doc_ids: one row of each component."""

from __future__ import annotations

import xxhash

from larder.llm import near_copies
from tests.llm.test_operators import rows, slow_components, slow_fingerprint


def test_one_row_of_each_component(spark, messy_rows, words):
    table = [(d, t) for d, t, _ in messy_rows]
    table += [(500, words[30]), (400, words[31]), (500, words[31]), (None, words[32]), (None, words[32].upper()), (None, words[33]), (7, words[34]), (7, words[35])]
    prints = [slow_fingerprint(t) for _, t in table]
    nodes = slow_components(list(enumerate(prints)))
    signed = lambda t: 42 if t is None else ((h := xxhash.xxh64_intdigest(t.encode(), 42)) + (1 << 63)) % (1 << 64) - (1 << 63)
    order = lambda i: (table[i][0] is None, table[i][0] or 0, signed(table[i][1]))
    groups = {}
    for i in range(len(table)):
        groups.setdefault(nodes[i, prints[i]], []).append(i)
    want = [table[min(some, key=order)] for some in groups.values()]
    got = near_copies.keep_one_of_each(spark.createDataFrame(table, "doc_id bigint, text string"))
    assert rows(got) == sorted(want, key=str)
