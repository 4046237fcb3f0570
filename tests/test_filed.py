"""Stores in buckets and generations: only what a batch touches is read and written."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from larder import storage
from larder.operators import maintain, report
from larder.operators.filed import file_tables, read_filed, upsert_filed
from larder.operators.upsert import Tables, upsert_recipes

BATCH = "arrival int, source string, name string, url string, description string, ingredients array<string>, recipeCategory array<string>"


def tables(spark, n=200):
    e = spark.createDataFrame
    recipes = e([(f"r{i}", "s", "old", f"n{i}", f"u{i}", 1) for i in range(n)], "id string, source string, description string, name string, original_url string, publisher_id long")
    lines = e([(f"r{i}", 0, f"line {i}") for i in range(n)] + [("gone", 0, "stays")], "recipe_id string, position int, name string")
    return Tables(e([(1, "s")], "id long, name string"), recipes, lines, e([("c1", "soup")], "id string, name string"), e([("c1", "r1")], "category_id string, recipe_id string"))


def files(spark, root, part):
    return {b: storage.names_in(spark, f"{root}/{part}/{b}") for b in storage.names_in(spark, f"{root}/{part}") if b.startswith("bucket=")}


def shown(t):
    kept = lambda df, *c: sorted(map(str, df.select(*c).collect()))
    return (
        kept(t.recipes, "id", "name", "description", "original_url"), kept(t.ingredients, "recipe_id", "position", "name"),
        kept(t.categories, "id", "name"), kept(t.categorizations, "category_id", "recipe_id"),
    )


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    t, root = tables(spark), str(tmp_path / "t")
    rows = [(1, "s", "n3", "u3", "new", ["1 egg"], ["soup"]), (2, "s", "x", "ux", "d", ["rice", "salt"], ["soup", "pie"]), (3, "other", "y", "uy", "d", ["z"], [])]
    batch = spark.createDataFrame(rows, BATCH)
    file_tables(t, root, buckets=16)
    before = {p: files(spark, root, p) for p in ("recipes", "ingredients")}
    want = shown(upsert_recipes(t, batch, ["arrival"]))
    touched = upsert_filed(spark, root, t.publishers, batch, ["arrival"], buckets=16)
    assert 1 <= len(touched) <= 2
    for part, was in before.items():
        now = files(spark, root, part)
        assert {b for b in now if now[b] != was.get(b)} == {f"bucket={b}" for b in touched}
    assert shown(read_filed(spark, root, t.publishers)) == want
    upsert_filed(spark, root, t.publishers, batch, ["arrival"], buckets=16)  # the same batch again
    assert shown(read_filed(spark, root, t.publishers)) == want
    assert upsert_filed(spark, root, t.publishers, batch.where("source = 'other'"), ["arrival"], buckets=16) == []


ITEM = "_id string, ts timestamp, name string, source string, url string, ingredients array<string>"


def test_second_clean_up_writes_nothing(spark, tmp_path):
    store = str(tmp_path / "s")
    item = lambda i, name: (str(i), None, name, "s", f"http://u/{i}", ["1 egg"])
    maintain.add_batch(spark.createDataFrame([item(1, " a  b "), item(2, "fine"), item(3, "  ")], ITEM), store, 0)
    maintain.add_batch(spark.createDataFrame([item(4, "<b>x</b>")], ITEM), store, 1)
    written, changes, invalid = maintain.cleanup_stale(spark, store, ITEM, "one")
    assert written == ["batch=0", "batch=1"]
    assert {(r._id, r.field, r.new) for r in changes.collect()} >= {("1", "name", "a b"), ("4", "name", "x")}
    assert [r._id for r in invalid.collect()] == ["3"]
    names = lambda: {r._id: r.name for r in maintain.read_generations(spark, store, ITEM).collect()}
    assert names() == {"1": "a b", "2": "fine", "3": "  ", "4": "x"}
    places = {b: storage.names_in(spark, f"{store}/{b}") for b in ("batch=0", "batch=1")}
    assert places == {"batch=0": ["gen=1-one"], "batch=1": ["gen=1-one"]}
    assert maintain.cleanup_stale(spark, store, ITEM, "one")[0] == []
    maintain.add_batch(spark.createDataFrame([item(5, " y ")], ITEM), store, 2)
    assert maintain.cleanup_stale(spark, store, ITEM, "one")[0] == ["batch=2"]
    assert maintain.cleanup_stale(spark, store, ITEM, "two")[0] == ["batch=0", "batch=1", "batch=2"]
    assert names() == {"1": "a b", "2": "fine", "3": "  ", "4": "x", "5": "y"}
    assert len(maintain.rules_digest()) == 12


def test_report_from_counts(spark):
    day = dt.datetime(2024, 1, 31)
    rows = spark.range(5000).select(
        F.when(F.col("id") % 7 != 0, F.concat(F.lit("s"), F.col("id") % 3)).alias("source"),
        F.when(F.col("id") % 11 != 0, F.lit(day) - F.make_dt_interval(F.lit(0), F.col("id").cast("int"))).alias("ts"),
    )
    parts = [report.daily_counts(rows.where(F.col("ts").isNull())), report.daily_counts(rows.where("ts IS NOT NULL"))]
    got = report.report_from_counts(parts[0].union(parts[1]), day).collect()
    assert sorted(map(str, got)) == sorted(map(str, report.source_report(rows, day).collect()))
    assert sorted(map(str, report.report_from_counts(report.merge_counts(parts[0].union(parts[1])), day).collect())) == sorted(map(str, got))
    with pytest.raises(ValueError, match="start of one"):
        report.report_from_counts(parts[0], dt.datetime(2024, 1, 31, 1))
