"""Queries over validation, de-duplication, the store, the relational model and clean-up."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from larder.operators import maintain as MT
from larder.operators import quality as Q
from larder.operators.filed import file_tables, read_filed, upsert_filed
from larder.operators.upsert import MATCH_KEYS, Tables, insert_if_absent, upsert_recipes
from larder.queries import query
from larder.queries.tables import (
    ITEMS_SQL,
    STORE_SQL,
    VALID_SQL,
    _t,
    batch_items,
    raw_items,
    stored_items,
    table,
)
from larder.sources import sinks
from larder.sources.pages import read_store
from larder.schema import RECIPE_FIELDS
from larder.storage import fresh_folder

REASON_SQL = """CASE WHEN source IS NULL OR source = '' THEN 'Missing ''source''' WHEN name IS NULL OR name = '' THEN 'Missing ''name'''
  WHEN url IS NULL OR url = '' THEN 'Missing ''url''' WHEN len(ingredients) = 0 THEN 'Missing ''ingredients''' END"""


@query(f"WITH {ITEMS_SQL} SELECT arrival, {REASON_SQL} AS reason FROM items")
def q_reject_reason(spark, sf):
    return Q.with_reject_reason(raw_items(spark, sf)).select("arrival", "reason")


@query(
    f"""WITH {ITEMS_SQL} SELECT {REASON_SQL} AS reason, count(*) AS n FROM items GROUP BY 1"""
)
def q_split_valid(spark, sf):
    valid, rejected = Q.split_valid(raw_items(spark, sf))
    both = valid.select(F.lit(None).cast("string").alias("reason")).unionAll(rejected.select("reason"))
    return both.groupBy("reason").agg(F.count("*").alias("n"))


@query(
    f"""WITH {ITEMS_SQL}, {VALID_SQL} SELECT arrival, source, url, image, md5(array_to_string(ingredients, chr(10))) AS lines FROM (
        SELECT *, row_number() OVER (PARTITION BY md5(name || url) ORDER BY arrival) AS k FROM valid) t WHERE k = 1"""
)
def q_dedupe_session(spark, sf):
    valid, _ = Q.split_valid(raw_items(spark, sf))
    first = Q.dedupe_session(valid, ["arrival"])
    return first.select(
        "arrival", "source", "url", "image", F.md5(F.array_join("ingredients", "\n")).alias("lines")
    )


@query(
    f"""WITH {ITEMS_SQL} SELECT arrival, 'name missing' AS rule FROM items WHERE name = ''
        UNION ALL SELECT arrival, 'ingredients missing' FROM items WHERE len(ingredients) = 0
        UNION ALL SELECT arrival, 'url missing' FROM items WHERE url IS NULL
        UNION ALL SELECT arrival, 'image not absolute' FROM items WHERE image LIKE '//%'"""
)
def q_contract(spark, sf):
    return Q.contract_violations(raw_items(spark, sf), "arrival")


def _publishers(spark, sf):
    """Publishers are the suppliers that have a like-numbered source."""
    s = table(spark, sf, "supplier")
    return s.select(
        F.col("s_suppkey").alias("id"), _t("src", F.col("s_suppkey") * 3).alias("name")
    )


PUBLISHERS_SQL = "publishers AS (SELECT s_suppkey AS id, 'src' || CAST(s_suppkey * 3 AS VARCHAR) AS name FROM supplier)"


@query(
    f"""WITH {ITEMS_SQL}, {PUBLISHERS_SQL} SELECT arrival, source, source IS NOT NULL AND source IN (SELECT name FROM publishers) AS known FROM items"""
)
def q_known_publishers(spark, sf):
    known, skipped = Q.known_publishers(raw_items(spark, sf), _publishers(spark, sf))
    return known.select("arrival", "source", F.lit(True).alias("known")).unionAll(
        skipped.select("arrival", "source", F.lit(False).alias("known"))
    )


# --- document store -----------------------------------------------------------------------

IN_STORE = "kept AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY arrival) AS k FROM store WHERE url IS NOT NULL) t WHERE k = 1)"


def _unique_store(spark, sf):
    store = stored_items(spark, sf).filter("url IS NOT NULL")
    return Q.keep_first(store, F.col("url"), ["arrival"])


@query(
    f"""WITH {STORE_SQL}, {IN_STORE} SELECT arrival, url, description FROM (
        SELECT *, row_number() OVER (PARTITION BY url ORDER BY arrival) AS k FROM batch WHERE url IS NOT NULL) b
        WHERE k = 1 AND url NOT IN (SELECT url FROM kept)"""
)
def q_insert_if_absent(spark, sf):
    batch = batch_items(spark, sf).filter("url IS NOT NULL")
    new, _ = insert_if_absent(_unique_store(spark, sf), batch, ["arrival"])
    return new.select("arrival", "url", "description")


@query(
    f"""WITH {STORE_SQL}, {IN_STORE} SELECT url, CASE WHEN stored THEN 'in_store' ELSE 'in_batch' END AS reason,
        CASE WHEN stored THEN n ELSE n - 1 END AS refused FROM (
          SELECT url, count(*) AS n, url IN (SELECT url FROM kept) AS stored FROM batch WHERE url IS NOT NULL GROUP BY 1) b
        WHERE stored OR n > 1"""
)
def q_insert_rejected(spark, sf):
    batch = batch_items(spark, sf).filter("url IS NOT NULL")
    _, rejected = insert_if_absent(_unique_store(spark, sf), batch, ["arrival"])
    return rejected


# --- relational model ---------------------------------------------------------------------

# Stored recipes are those the store would have created; ids are text numbers.
RELATIONAL_SQL = f"""{STORE_SQL}, {PUBLISHERS_SQL},
old_recipes AS (
  SELECT 'r' || CAST(arrival AS VARCHAR) AS id, s.source, description, s.name, url AS original_url, p.id AS publisher_id, ingredients, image,
    row_number() OVER (PARTITION BY s.name, url, p.id ORDER BY arrival) AS k
  FROM store s JOIN publishers p ON s.source = p.name WHERE s.name <> '' AND url IS NOT NULL AND len(ingredients) > 0
),
recipes AS (SELECT * FROM old_recipes WHERE k = 1),
incoming AS (
  SELECT * FROM (SELECT b.*, p.id AS publisher_id, row_number() OVER (PARTITION BY b.name, url, p.id ORDER BY arrival) AS k
    FROM batch b JOIN publishers p ON b.source = p.name WHERE b.name <> '' AND url IS NOT NULL AND len(ingredients) > 0) t WHERE k = 1
),
touched AS (
  SELECT i.*, r.id AS old_id,
    coalesce(r.id, md5(concat_ws(chr(31), i.name, i.url, CAST(i.publisher_id AS VARCHAR)))) AS recipe_id
  FROM incoming i LEFT JOIN recipes r ON r.name = i.name AND r.original_url = i.url AND r.publisher_id = i.publisher_id
),
categories AS (SELECT n_name AS id, CASE WHEN n_nationkey = 0 THEN 'en' WHEN n_nationkey = 1 THEN 'de' ELSE n_name END AS name FROM nation)"""


def _stored_tables(spark, sf):
    """(tables, valid batch)"""
    publishers = _publishers(spark, sf)
    valid, _ = Q.split_valid(stored_items(spark, sf))
    rows = valid.join(
        publishers.select(F.col("id").alias("publisher_id"), F.col("name").alias("p")),
        F.col("source") == F.col("p"),
    )
    old = Q.keep_first(
        rows.select(
            _t("r", F.col("arrival")).alias("id"), "arrival", "source", "description", "name",
            F.col("url").alias("original_url"), F.col("image").alias("original_photo_url"),
            "publisher_id", "ingredients",
        ),
        [F.col(k) for k in MATCH_KEYS],
        ["arrival"],
    )
    n = F.col("n_nationkey")
    categories = table(spark, sf, "nation").select(
        F.col("n_name").alias("id"),
        F.when(n == 0, "en").when(n == 1, "de").otherwise(F.col("n_name")).alias("name"),
    )
    ingredients = old.select(
        F.col("id").alias("recipe_id"), F.posexplode("ingredients").alias("position", "name")
    )
    links = spark.createDataFrame([], "category_id string, recipe_id string")
    tables = Tables(publishers, old.drop("arrival", "ingredients"), ingredients, categories, links)
    batch, _ = Q.split_valid(batch_items(spark, sf))
    return tables, batch


def _relational(spark, sf):
    tables, batch = _stored_tables(spark, sf)
    return upsert_recipes(tables, batch, ["arrival"])


def _filed(spark, sf):
    """The same upsert in place, into tables filed in buckets, and once more: the second run changes nothing."""
    tables, batch = _stored_tables(spark, sf)
    root = fresh_folder(spark, "filed")
    file_tables(tables, root, buckets=8)
    for _ in range(2):
        upsert_filed(spark, root, tables.publishers, batch, ["arrival"], buckets=8)
    return read_filed(spark, root, tables.publishers)


@query(
    f"""WITH {RELATIONAL_SQL} SELECT r.id, r.source, coalesce('changed ' || t.lang, r.description) AS description, r.name, r.original_url,
        r.image AS original_photo_url, r.publisher_id, CAST(NULL AS BOOLEAN) AS valid_recipe, CAST(NULL AS INTEGER) AS pins
        FROM recipes r LEFT JOIN touched t ON t.old_id = r.id
        UNION ALL SELECT recipe_id, source, description, name, url, image, publisher_id, true, 0 FROM touched WHERE old_id IS NULL"""
)
def q_upsert_recipes(spark, sf):
    return _relational(spark, sf).recipes.select(
        "id", "source", "description", "name", "original_url", "original_photo_url", "publisher_id", "valid_recipe", "pins"
    )


@query(
    f"""WITH {RELATIONAL_SQL}, all_rows AS (
          SELECT id AS recipe_id, ingredients FROM recipes WHERE id NOT IN (SELECT recipe_id FROM touched)
          UNION ALL SELECT recipe_id, ingredients FROM touched)
        SELECT recipe_id, CAST(unnest(range(0, CAST(len(ingredients) AS BIGINT))) AS INTEGER) AS position, unnest(ingredients) AS name FROM all_rows"""
)
def q_upsert_ingredients(spark, sf):
    return _relational(spark, sf).ingredients.select("recipe_id", "position", "name")


@query(
    f"""WITH {RELATIONAL_SQL} SELECT id, name FROM categories
        UNION ALL SELECT DISTINCT md5(lang), lang FROM touched WHERE lang NOT IN (SELECT name FROM categories)"""
)
def q_upsert_categories(spark, sf):
    return _relational(spark, sf).categories


@query(
    f"""WITH {RELATIONAL_SQL}, c AS (SELECT id, name FROM categories
        UNION ALL SELECT DISTINCT md5(lang), lang FROM touched WHERE lang NOT IN (SELECT name FROM categories))
        SELECT c.id AS category_id, recipe_id FROM touched JOIN c ON c.name = lang WHERE old_id IS NULL"""
)
def q_upsert_links(spark, sf):
    return _relational(spark, sf).categorizations


FILED_COUNTS_SQL = """, c AS (SELECT id, name FROM categories
        UNION ALL SELECT DISTINCT md5(lang), lang FROM touched WHERE lang NOT IN (SELECT name FROM categories)),
      links AS (SELECT c.id, recipe_id FROM touched JOIN c ON c.name = lang WHERE old_id IS NULL)"""


@query(
    f"""WITH {RELATIONAL_SQL}{FILED_COUNTS_SQL}, all_rows AS (
          SELECT id, name, original_url, description, publisher_id, ingredients, false AS created FROM recipes WHERE id NOT IN (SELECT recipe_id FROM touched)
          UNION ALL SELECT recipe_id, name, url, 'changed ' || lang, publisher_id, ingredients, old_id IS NULL FROM touched)
        SELECT a.id, a.name, original_url, coalesce(a.description, '') AS description, publisher_id,
          (SELECT string_agg(x, '|' ORDER BY x) FROM unnest(ingredients) t(x)) AS ingredients,
          (SELECT count(*) FROM links l WHERE l.recipe_id = a.id) AS n_links, (SELECT count(*) FROM c) AS n_categories
        FROM all_rows a"""
)
def q_upsert_filed(spark, sf):
    t = _filed(spark, sf)
    lines = t.ingredients.groupBy("recipe_id").agg(F.array_join(F.array_sort(F.collect_list("name")), "|").alias("ingredients"))
    links = t.categorizations.groupBy("recipe_id").agg(F.count("*").alias("n_links"))
    rows = t.recipes.join(lines, t.recipes["id"] == lines["recipe_id"], "left").drop("recipe_id")
    rows = rows.join(links, rows["id"] == links["recipe_id"], "left")
    return rows.select(
        "id", "name", "original_url", F.coalesce("description", F.lit("")).alias("description"), "publisher_id", "ingredients",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.lit(t.categories.count()).cast("bigint").alias("n_categories"),
    )


# --- clean-up -----------------------------------------------------------------------------

CLEAN_LINES = "list_filter(list_transform(ingredients, lambda x: trim(regexp_replace(x, '[ \\n\\t]+', ' ', 'g'))), lambda x: NOT contains(lower(x), 'ingredient'))"
CLEAN_NAME = "trim(regexp_replace(name, '[ \\n\\t]+', ' ', 'g'))"


@query(
    f"""WITH {STORE_SQL} SELECT id AS _id, nullif({CLEAN_NAME}, '') AS name, trim(regexp_replace(regexp_replace(description, '</?b>', '', 'g'), '[ \\t]+', ' ', 'g')) AS description,
        array_to_string({CLEAN_LINES}, chr(10)) AS lines, url, image FROM store"""
)
def q_renormalize(spark, sf):
    return MT.renormalize(stored_items(spark, sf)).select(
        "_id", "name", "description", F.array_join("ingredients", "\n").alias("lines"), "url", "image"
    )


@query(
    f"""WITH {STORE_SQL} SELECT id AS _id, source, 'description' AS field, description AS old,
          trim(regexp_replace(regexp_replace(description, '</?b>', '', 'g'), '[ \\t]+', ' ', 'g')) AS "new" FROM store WHERE contains(description, '<b>')
        UNION ALL SELECT id, source, 'name', name, nullif({CLEAN_NAME}, '') FROM store
          WHERE name IS NOT NULL AND nullif({CLEAN_NAME}, '') IS DISTINCT FROM name
        UNION ALL SELECT id, source, 'ingredients', md5(array_to_string(ingredients, chr(10))), md5(array_to_string({CLEAN_LINES}, chr(10)))
          FROM store WHERE ingredients <> {CLEAN_LINES}"""
)
def q_field_diff(spark, sf):
    diff = MT.field_diff(stored_items(spark, sf))

    def shown(side):
        lines = F.array_join(F.from_json(side, "array<string>"), "\n")
        return F.when(F.col("field") == "ingredients", F.md5(lines)).otherwise(F.col(side)).alias(side)

    return diff.select("_id", "source", "field", shown("old"), shown("new"))


NEW_REASON = REASON_SQL.replace("len(ingredients)", f"len({CLEAN_LINES})")


@query(f"WITH {STORE_SQL} SELECT id AS _id, {NEW_REASON} AS reason FROM store WHERE {NEW_REASON} IS NOT NULL")
def q_cleanup_invalid(spark, sf):
    return MT.cleanup(stored_items(spark, sf))[1]


@query(
    f"""WITH {STORE_SQL} SELECT id AS _id, url, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, CASE WHEN {NEW_REASON} IS NULL THEN {CLEAN_NAME} ELSE name END AS name,
        CASE WHEN {NEW_REASON} IS NULL THEN trim(regexp_replace(regexp_replace(description, '</?b>', '', 'g'), '[ \\t]+', ' ', 'g')) ELSE description END AS description,
        CAST(CASE WHEN {NEW_REASON} IS NULL THEN len({CLEAN_LINES}) ELSE len(ingredients) END AS BIGINT) AS n_lines FROM store"""
)
def q_cleanup_store(spark, sf):
    _, _, new = MT.cleanup(stored_items(spark, sf), update=True)
    return new.select(
        "_id", "url", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), "name", "description",
        F.size("ingredients").cast("long").alias("n_lines"),
    )


@query(
    f"""WITH {STORE_SQL} SELECT id AS _id, url, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, CASE WHEN {NEW_REASON} IS NULL THEN {CLEAN_NAME} ELSE name END AS name,
        CASE WHEN {NEW_REASON} IS NULL THEN trim(regexp_replace(regexp_replace(description, '</?b>', '', 'g'), '[ \\t]+', ' ', 'g')) ELSE description END AS description,
        CAST(CASE WHEN {NEW_REASON} IS NULL THEN len({CLEAN_LINES}) ELSE len(ingredients) END AS BIGINT) AS n_lines FROM store"""
)
def q_cleanup_stale(spark, sf):
    """The store in three batches, cleaned in place when two of them are there and again when the third has come."""
    items = stored_items(spark, sf)
    part, folder = F.pmod(F.xxhash64("_id"), F.lit(3)), fresh_folder(spark, "batches")
    for n in range(3):
        MT.add_batch(items.filter(part == n), folder, n)
        if n:
            MT.cleanup_stale(spark, folder, items.schema)
    return MT.read_generations(spark, folder, items.schema).select(
        "_id", "url", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), "name", "description",
        F.size("ingredients").cast("long").alias("n_lines"),
    )


# --- sinks --------------------------------------------------------------------------------


def _document(spark, sf):
    items = stored_items(spark, sf).withColumn("ts", F.col("ts").cast("timestamp"))
    have = set(items.columns)
    return items.select(
        "_id",
        *[F.col(f) if f in have else F.lit(None).cast("array<string>" if f == "recipeCategory" else "string").alias(f) for f in RECIPE_FIELDS],
        "ts",
    )


ROUND_TRIP = f"WITH {STORE_SQL} SELECT id AS _id, source, name, url, array_to_string(ingredients, chr(10)) AS lines FROM store"


def _shown(store):
    return store.select("_id", "source", "name", "url", F.array_join("ingredients", "\n").alias("lines"))


@query(ROUND_TRIP)
def q_export_roundtrip(spark, sf):
    path = sinks.export_json(_document(spark, sf), _fresh(spark), dt.datetime(2024, 2, 1, 12, 30))
    return _shown(read_store(spark, path, "json"))


@query(ROUND_TRIP)
def q_snapshot(spark, sf):
    path = sinks.snapshot(_document(spark, sf), _fresh(spark), dt.datetime(2024, 2, 1, 12, 30))
    return _shown(read_store(spark, path))


def _fresh(spark):
    return fresh_folder(spark, "store")
