"""Store, relational and clean-up operators on small inputs, with hot keys and replays."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from larder.operators import maintain, quality, report
from larder.operators.upsert import Tables, insert_if_absent, upsert_recipes
from larder.schema import RECIPE_FIELDS, RECIPE_SCHEMA
from larder.sources import sinks
from larder.sources.pages import read_html_folder, read_store
from larder.streaming.ingest import stream_upsert
from larder.streaming.stored import read_stored

ITEM = "arrival long, source string, name string, url string, ingredients array<string>"


def test_schema_has_all_fields():
    assert len(RECIPE_FIELDS) == len(set(RECIPE_FIELDS)) == 33
    assert len(RECIPE_SCHEMA) == 33


def test_valid_and_rejected_make_the_input(spark):
    df = spark.createDataFrame(
        [(1, None, None, "u", ["x"]), (2, "s", "", "u", ["x"]), (3, "s", "n", "u", []), (4, "s", "n", "u", ["x"])], ITEM
    )
    valid, rejected = quality.split_valid(df)
    assert [r.arrival for r in valid.collect()] == [4]
    assert {r.arrival: r.reason for r in rejected.collect()} == {
        1: "Missing 'source'", 2: "Missing 'name'", 3: "Missing 'ingredients'"
    }


def test_dedupe_keeps_first_under_a_hot_key(spark):
    hot = spark.range(20_000).select(
        (F.lit(30_000) - F.col("id")).alias("arrival"), F.lit("s").alias("source"),
        F.when(F.col("id") % 3 == 0, "ab").otherwise(F.concat(F.lit("n"), F.col("id").cast("string"))).alias("name"),
        F.when(F.col("id") % 3 == 0, "c").otherwise("u").alias("url"), F.array(F.lit("x")).alias("ingredients"),
    )
    collide = spark.createDataFrame([(1, "s", "a", "bc", ["x"])], ITEM)
    got = quality.dedupe_session(hot.unionByName(collide), ["arrival"])
    assert got.count() == 20_000 - 6_667 + 1
    # equal concatenations count as the same record
    assert [r.arrival for r in got.filter("name in ('ab', 'a')").collect()] == [1]


def test_insert_if_absent(spark):
    store = spark.createDataFrame([("u1",)], "url string")
    batch = spark.createDataFrame([("u1", 1), ("u2", 3), ("u2", 2), ("u3", 4)], "url string, arrival int")
    new, rejected = insert_if_absent(store, batch, ["arrival"])
    assert sorted(map(tuple, new.collect())) == [("u2", 2), ("u3", 4)]
    assert sorted(map(tuple, rejected.collect())) == [("u1", "in_store", 1), ("u2", "in_batch", 1)]


def _tables(spark):
    e = spark.createDataFrame
    return Tables(
        e([(1, "s")], "id long, name string"),
        e([("r1", "s", "old", "n", "u", 1, "me")], "id string, source string, description string, name string, original_url string, publisher_id long, author string"),
        e([("r1", 0, "gone"), ("r9", 0, "stays")], "recipe_id string, position int, name string"),
        e([("c1", "soup")], "id string, name string"),
        e([("c1", "r1")], "category_id string, recipe_id string"),
    )


BATCH = "arrival int, source string, name string, url string, description string, creator string, ingredients array<string>, recipeCategory array<string>"


def test_upsert(spark):
    rows = [
        (1, "s", "n", "u", "new", "you", ["1 egg", "salt"], ["pie"]),
        (2, "s", "n2", "u2", "d2", "x", ["rice"], ["soup", "pie", "soup"]),
        (3, "nobody", "n3", "u3", "d3", "x", ["rice"], ["cake"]),
        (4, "s", "n2", "u2", "later", "x", ["none"], ["none"]),
    ]
    t = upsert_recipes(_tables(spark), spark.createDataFrame(rows, BATCH), ["arrival"])
    recipes = {r.name: r for r in t.recipes.collect()}
    assert set(recipes) == {"n", "n2"}
    # an update copies only columns named like their field; the author column stays
    assert (recipes["n"].description, recipes["n"].author, recipes["n"].valid_recipe) == ("new", "me", None)
    assert (recipes["n2"].author, recipes["n2"].valid_recipe, recipes["n2"].pins) == ("x", True, 0)
    new = recipes["n2"].id
    assert sorted(map(tuple, t.ingredients.collect())) == sorted(
        [("r1", 0, "1 egg"), ("r1", 1, "salt"), ("r9", 0, "stays"), (new, 0, "rice")]
    )
    names = {r.id: r.name for r in t.categories.collect()}
    assert sorted(names.values()) == ["pie", "soup"]
    links = {(names[r.category_id], r.recipe_id) for r in t.categorizations.collect()}
    assert links == {("soup", "r1"), ("soup", new), ("pie", new)}
    every = upsert_recipes(_tables(spark), spark.createDataFrame(rows, BATCH), ["arrival"], columns="all")
    assert every.recipes.filter("name = 'n'").first().author == "you"


def test_cleanup(spark):
    rows = [("1", "s", " n ", "u", ["<b>1 egg</b>", "Ingredients:"]), ("2", "s", "m", "v", ["Ingredient"])]
    store = spark.createDataFrame(rows, "_id string, source string, name string, url string, ingredients array<string>")
    store = store.withColumn("ts", F.lit(dt.datetime(2024, 1, 1)))
    changes, invalid, same = maintain.cleanup(store)
    assert {(r._id, r.field) for r in changes.collect()} == {("1", "name"), ("1", "ingredients"), ("2", "ingredients")}
    assert [tuple(r) for r in invalid.collect()] == [("2", "Missing 'ingredients'")]
    assert same is store
    _, _, new = maintain.cleanup(store, update=True)
    got = {r._id: (r.name, r.ingredients) for r in new.collect()}
    assert got == {"1": ("n", ["1 egg"]), "2": ("m", ["Ingredient"])}
    again, _, _ = maintain.cleanup(new.filter("_id = '1'"))
    assert again.isEmpty()


def test_report_windows(spark):
    as_of = dt.datetime(2024, 1, 31)
    rows = [("a", as_of - dt.timedelta(days=d)) for d in (0, 1, 7, 8, 31)] + [(None, as_of)]
    store = spark.createDataFrame(rows, "source string, ts timestamp")
    got = {(r.days, r.source): r.total for r in report.source_report(store, as_of).collect()}
    assert got == {
        (1, "a"): 2, (7, "a"): 3, (30, "a"): 4, (0, "a"): 5, (1, None): 1, (7, None): 1, (30, None): 1, (0, None): 1
    }
    totals = report.with_total(report.source_report(store, as_of)).filter("is_total").collect()
    assert {r.days: r.total for r in totals} == {1: 3, 7: 4, 30: 5, 0: 6}


def test_files(spark, tmp_path):
    site = tmp_path / "html" / "food"
    site.mkdir(parents=True)
    (site / "a.html").write_text("<p>one\n<p>two")
    (site / "b.txt").write_text("no")
    r = read_html_folder(spark, str(tmp_path / "html")).collect()
    assert [(x.source, x.file, x.url, x.html) for x in r] == [("food", "a.html", "http://example.org", "<p>one\n<p>two")]
    df = spark.createDataFrame([("1", "n", ["x"])], "_id string, name string, ingredients array<string>")
    when = dt.datetime(2024, 2, 1, 12, 30, 5)
    path = sinks.export_json(df, str(tmp_path), when)
    assert path.endswith("/20240201-123005")
    assert read_store(spark, path, "json").first().ingredients == ["x"]
    assert sinks.snapshot(df, str(tmp_path), when).endswith("/20240201-123005-dump")


def test_replayed_batch_changes_nothing(spark, tmp_path):
    src, store = f"{tmp_path}/in", f"{tmp_path}/store"
    spark.createDataFrame([("u1", 1), ("u1", 2), ("u2", 3), (None, 4)], "url string, arrival int").write.parquet(src)
    stream = spark.readStream.schema("url string, arrival int").parquet(src)
    for checkpoint in ("a", "b"):  # a new checkpoint replays the first batch
        stream_upsert(stream, store, f"{tmp_path}/{checkpoint}", ["arrival"]).awaitTermination()
        rows = read_stored(spark, store, "url string, arrival int").collect()
        assert {(r.url, r.arrival) for r in rows} >= {("u1", 1), ("u2", 3)} and len([r for r in rows if r.url]) == 2


def test_other_checkpoint_keeps_stored_rows(spark, tmp_path):
    for name, url in (("a", "u1"), ("b", "u2")):
        spark.createDataFrame([(url, 1)], "url string, arrival int").write.parquet(f"{tmp_path}/{name}")
        stream = spark.readStream.schema("url string, arrival int").parquet(f"{tmp_path}/{name}")
        stream_upsert(stream, f"{tmp_path}/store", f"{tmp_path}/check-{name}", ["arrival"]).awaitTermination()
    assert {r.url for r in read_stored(spark, f"{tmp_path}/store", "url string, arrival int").collect()} == {"u1", "u2"}


def test_ingest_time(spark):
    store = spark.createDataFrame([("u1",)], "url string")
    batch = spark.createDataFrame([("u1", 1), ("u2", 2)], "url string, arrival int")
    new, _ = insert_if_absent(store, batch, ["arrival"], ts=F.lit("2024-01-01").cast("timestamp"))
    assert [(r.url, r.ts) for r in new.collect()] == [("u2", dt.datetime(2024, 1, 1))]


def test_change_list_has_values_that_go(spark):
    store = spark.createDataFrame([("1", None, "n", "s", "yesterday", "2 months")], "_id string, ts timestamp, name string, source string, datePublished string, cookTime string")
    assert {(r.field, r.old, r.new) for r in maintain.field_diff(store).collect()} == {("datePublished", "yesterday", None), ("cookTime", "2 months", None)}


def test_sites_by_host(spark):
    from larder.sources.pages import with_source

    urls = ["http://a.com/x", "https://www.a.com", "http://deep.b.a.com/", "http://xa.com/", "no url", None]
    pages = spark.createDataFrame([(u,) for u in urls], "url string")
    found = with_source(pages, {"one": ["A.com"], "two": ["b.a.com"]}).collect()
    assert [r.source for r in found] == ["one", "one", "two", None, None, None]


def test_narrow_keys_before_wide_rows(spark):
    """No sort of records: only key and order are aggregated, and rows come back by key and order."""
    items = spark.range(1000).select(
        F.col("id").alias("arrival"), F.lit("s").alias("source"), F.concat(F.lit("n"), F.col("id") % 10).alias("name"),
        F.lit("u").alias("url"), F.array(F.lit("x")).alias("ingredients"),
    )
    first = quality.dedupe_session(items, ["arrival"])
    assert sorted(r.arrival for r in first.collect()) == list(range(10))
    assert "SortAggregate" not in first._jdf.queryExecution().toString()


def test_repeated_names_count_once(spark):
    """Publishers, categories and stored recipes that share a name or match key: the least id."""
    t = _tables(spark)
    e = spark.createDataFrame
    twice = Tables(
        e([(1, "s"), (2, "s")], "id long, name string"),
        t.recipes.unionByName(t.recipes.withColumn("id", F.lit("r9"))),
        t.ingredients,
        e([("c2", "soup"), ("c1", "soup")], "id string, name string"),
        t.categorizations,
    )
    batch = e(
        [(1, "s", "n", "u", ["a"], ["soup"]), (2, "s", "other", "v", ["b"], ["soup"])],
        "arrival long, source string, name string, url string, ingredients array<string>, recipeCategory array<string>",
    )
    out = upsert_recipes(twice, batch, ["arrival"])
    new = out.recipes.filter("name = 'other'").collect()
    assert len(new) == 1 and new[0].publisher_id == 1 and out.recipes.count() == 3
    assert [(r.category_id, r.recipe_id) for r in out.categorizations.filter("category_id in ('c1', 'c2')").collect() if r.recipe_id == new[0].id] == [("c1", new[0].id)]
    assert {r.recipe_id for r in out.ingredients.filter("name in ('a', 'b')").collect()} == {"r1", new[0].id}


def test_one_sitemap_file_is_read_by_many_tasks(spark, tmp_path):
    """50,000 entries on one line, entities and odd tags among them; every entry once, whatever the ranges."""
    from larder.sources.feeds import sitemap_file_entries

    urls = [f"http://a.com/{i}?x=1&y={i}" for i in range(50_000)]
    body = "".join(f'<url><loc>\n {u.replace("&", "&amp;")} </loc><image:image><image:loc>no</image:loc></image:image></url>' for u in urls)
    (tmp_path / "map.xml").write_text(f'<?xml version="1.0"?><urlset xmlns="x">{body}</urlset>')
    (tmp_path / "index.xml").write_text('<sitemapindex>\n<sitemap a="b">\n<loc>http://a.com/map.xml</loc>\n</sitemap></sitemapindex>')
    (tmp_path / "broken.xml").write_text("<urlset><url><loc>http://a.com/open")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 200_000)
    try:
        found = sitemap_file_entries(spark, str(tmp_path))
        assert found.rdd.getNumPartitions() > 10
        rows = found.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(r.loc for r in rows if r.kind == "url" and r.file.endswith("map.xml")) == sorted(urls)
    assert [(r.loc, r.file.rsplit("/", 1)[1]) for r in rows if r.kind == "sitemap"] == [("http://a.com/map.xml", "index.xml")]
