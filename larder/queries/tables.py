"""Inputs of the registered queries, derived by Spark from the given tables.

The given pages carry no recipe markup, so recipe pages are rendered from orders, their
lines and parts; raw items, stores and batches come from documents, feeds and sitemaps
from page URLs. Every row of the given tables is used; the variations (missing fields,
shapes, statuses) change values and never leave rows out. Each table has its SQL twin for
the checking side, which never sees HTML or XML.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# Tasks per core over rows that cost much work.
SHARES = 4


def spread(df: DataFrame, key: str) -> DataFrame:
    """Small rows that each cost much work (rendering, shredding): several shares for every core, so that a
    slow task, or a number of tasks that the cores do not divide, leaves few of them idle.

    Real page tables need no such step: their size gives them enough partitions.
    """
    spark = df.sparkSession
    n = max(
        SHARES * spark.sparkContext.defaultParallelism,
        int(spark.conf.get("spark.sql.shuffle.partitions")),
    )
    # hashed once more: a plain key would count as done by the join before, whose shuffle
    # the adaptive planner may then read as one partition
    return df.repartition(n, F.xxhash64(key))


# --- raw items from documents -------------------------------------------------------------

SECOND_VISIT = 1_000_000_000

ITEMS_SQL = """
items AS (
  SELECT doc_id + visit * 1000000000 AS arrival, visit,
    CASE WHEN doc_id % 29 = 0 THEN NULL ELSE source END AS source,
    CASE WHEN doc_id % 17 = 0 THEN '' ELSE split_part(text, chr(10), 1) END AS name,
    CASE WHEN doc_id % 19 = 0 THEN NULL
         ELSE 'http://' || source || '.example.com/' || CAST(doc_id % 400 AS VARCHAR) END AS url,
    CASE WHEN doc_id % 13 = 0 THEN '//img.example.com/' || CAST(doc_id AS VARCHAR) || '.jpg'
         ELSE 'http://img.example.com/' || CAST(doc_id AS VARCHAR) || '.jpg' END AS image,
    CASE WHEN doc_id % 23 = 0 THEN CAST([] AS VARCHAR[])
         ELSE list_concat(
           list_concat(
             CASE WHEN doc_id % 3 = 0 THEN ['Ingredients:'] ELSE CAST([] AS VARCHAR[]) END,
             CASE WHEN doc_id % 5 = 0 THEN ['For the sauce:'] ELSE CAST([] AS VARCHAR[]) END),
           string_split(text, chr(10))) END AS ingredients,
    TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(doc_id + visit * 1440 AS INTEGER)) AS ts,
    doc_id, lang, text
  FROM documents, (VALUES (0), (1)) v(visit)
)"""


def raw_items(spark: SparkSession, sf: str) -> DataFrame:
    """Every document visited twice, the second time a day later."""
    d = table(spark, sf, "documents").withColumn(
        "visit", F.explode(F.array(F.lit(0), F.lit(1)))
    )
    k = F.col("doc_id")
    none = F.expr("cast(array() as array<string>)")
    extra = F.concat(
        F.when(k % 3 == 0, F.array(F.lit("Ingredients:"))).otherwise(none),
        F.when(k % 5 == 0, F.array(F.lit("For the sauce:"))).otherwise(none),
    )
    lines = F.split("text", "\n", -1)
    return d.select(
        (k + F.col("visit").cast("long") * SECOND_VISIT).alias("arrival"),
        "visit",
        F.when(k % 29 != 0, F.col("source")).alias("source"),
        F.when(k % 17 == 0, "").otherwise(F.get(lines, F.lit(0))).alias("name"),
        F.when(
            k % 19 != 0,
            F.concat(F.lit("http://"), "source", F.lit(".example.com/"), (k % 400).cast("string")),
        ).alias("url"),
        F.concat(
            F.when(k % 13 == 0, "//img.example.com/").otherwise("http://img.example.com/"),
            k.cast("string"),
            F.lit(".jpg"),
        ).alias("image"),
        F.when(k % 23 == 0, none).otherwise(F.concat(extra, lines)).alias("ingredients"),
        (
            F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
            + F.make_dt_interval(F.lit(0), F.lit(0), (k + F.col("visit") * 1440).cast("int"))
        ).alias("ts"),
        "doc_id",
        "lang",
        "text",
    )


VALID_SQL = """
valid AS (
  SELECT * FROM items WHERE source IS NOT NULL AND name <> '' AND url IS NOT NULL AND len(ingredients) > 0
)"""


# --- recipe pages from orders -------------------------------------------------------------

ORDERS_SQL = """
lines AS (
  SELECT l_orderkey, string_agg(x, '|' ORDER BY x) AS bag,
         string_agg(DISTINCT x, '|' ORDER BY x) AS distinct_bag, count(*) AS n
  FROM (SELECT l_orderkey, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || ' ' || p_name AS x
        FROM lineitem JOIN part ON l_partkey = p_partkey) t
  GROUP BY 1
),
o AS (
  SELECT o_orderkey AS page_id, o_custkey, o_orderstatus, o_orderpriority, o_orderdate,
    strftime(o_orderdate, '%Y-%m-%d') AS day, coalesce(n, 0) AS n,
    coalesce(bag, '') AS bag, coalesce(distinct_bag, '') AS distinct_bag,
    CAST(o_orderkey AS VARCHAR) AS key,
    CASE WHEN o_custkey % 11 <> 0 THEN 'Order ' || CAST(o_orderkey AS VARCHAR) END AS name,
    CASE WHEN o_custkey % 11 <> 0 THEN 'Order' END AS first_name,
    'PT' || CAST(o_custkey % 50 + 5 AS VARCHAR) || 'M' AS prep,
    'PT' || CAST(o_orderkey % 3 + 1 AS VARCHAR) || 'H30M' AS cook,
    CAST(coalesce(n, 0) AS VARCHAR) || ' servings' AS yield,
    'Status ' || o_orderstatus || ' order' AS description,
    CASE WHEN o_orderstatus = 'O' THEN 'http://og.example.com/b/' || CAST(o_orderkey AS VARCHAR) || '.jpg' END AS og_image,
    CASE WHEN o_orderstatus = 'F' THEN '//img.example.com/' || CAST(o_orderkey AS VARCHAR) || '.jpg'
         WHEN o_orderstatus = 'O' THEN 'http://img.example.com/' || CAST(o_orderkey AS VARCHAR) || '.jpg' END AS img
  FROM orders LEFT JOIN lines ON l_orderkey = o_orderkey
)"""


def orders_with_lines(spark: SparkSession, sf: str) -> DataFrame:
    """One row per order with its (few) lines as (quantity, part name), in a fixed order."""
    item = table(spark, sf, "lineitem").join(
        table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey")
    )
    lines = item.groupBy("l_orderkey").agg(
        F.array_sort(
            F.collect_list(
                F.struct(
                    "l_linenumber",
                    "l_partkey",
                    "l_extendedprice",
                    F.col("l_quantity").cast("long").cast("string").alias("qty"),
                    F.col("p_name").alias("part"),
                )
            )
        ).alias("lines")
    )
    none = F.expr("cast(array() as array<struct<l_linenumber: int, l_partkey: bigint, l_extendedprice: double, qty: string, part: string>>)")
    return spread(
        table(spark, sf, "orders")
        .join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .withColumn("lines", F.coalesce("lines", none))
        .drop("l_orderkey"),
        "o_orderkey",
    )


def _t(*parts) -> Column:
    """Concatenate literals and columns to a text."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


KEY = F.col
SOURCES = {
    "schema_org": ("food", "1-URGENT"),
    "data_vocabulary": ("tastykitchen", "2-HIGH"),
    "hrecipe": ("paninihappy", "3-MEDIUM"),
    "lower": ("tasteofhome", "4-NOT SPECIFIED"),
    "site": ("loveandoliveoil", "5-LOW"),
}


def _render(shape: str) -> Column:
    key, date = F.col("o_orderkey"), F.col("o_orderdate")
    status, category = F.col("o_orderstatus"), F.col("o_orderpriority")
    named = F.col("o_custkey") % 11 != 0
    title = _t("Order <b>", key, "</b>")
    prep = F.col("o_custkey") % 50 + 5
    cook = key % 3 + 1
    servings = _t(F.size("lines"), " servings")
    day = F.date_format(date, "yyyy-MM-dd")
    og = F.when(
        status == "O",
        _t('<meta property="og:image" content="http://og.example.com/a/', key, '.jpg">'
           '<meta property="og:image" content="http://og.example.com/b/', key, '.jpg">'),
    ).otherwise("")
    src = F.when(status == "F", _t("//img.example.com/", key, ".jpg")).when(
        status == "O", _t("http://img.example.com/", key, ".jpg")
    )

    def name(open_tag: str, close: str = "</h1>") -> Column:
        return F.when(named, _t(open_tag, title, close)).otherwise("")

    def image(attributes: str) -> Column:
        return F.when(src.isNotNull(), _t("<img ", attributes, ' src="', src, '">')).otherwise("")

    def rows(fn) -> Column:
        return F.array_join(F.transform("lines", fn), "")

    text = lambda x: F.concat(x["qty"], F.lit(" "), x["part"])
    head = _t(
        '<!DOCTYPE html><html><head><meta charset="utf-8"><title>Page ', key, "</title>", og,
        '<meta property="og:url" content="http://www.example.com/og/', key, '">',
        '<meta name="description" content="About ', key, '"></head><body><nav><ul><li><a href="/">Home</a>'
        '<li><a href="/all?page=2">All &amp; more</a></ul></nav>',
    )
    foot = _t("<!-- end --><footer><p>&copy; example</footer></body></html>")
    about = _t("Status <i>", status, "</i> order")
    if shape == "schema_org":
        body = _t(
            '<div itemscope itemtype="http://schema.org/Recipe">', name('<h1 itemprop="name">'),
            image('itemprop="image"'), '<div itemprop="description">', about, "</div>",
            '<time itemprop="prepTime" datetime="PT', prep, 'M">', prep, " min</time>",
            '<meta itemprop="cookTime" content="PT', cook, 'H30M">',
            '<span itemprop="recipeYield">', servings, "</span>",
            '<meta itemprop="datePublished" content="', day, '">',
            '<span itemprop="recipeCategory">', category, "</span>",
            '<div itemprop="nutrition" itemscope itemtype="http://schema.org/NutritionInformation">',
            '<span itemprop="calories">', prep, " calories</span></div>",
            '<div itemprop="aggregateRating" itemscope itemtype="http://schema.org/AggregateRating">',
            'Rated <b itemprop="ratingValue">', cook, "</b></div><ul>",
            rows(lambda x: _t('<li itemprop="ingredients">', text(x))), "</ul></div>",
        )
    elif shape == "data_vocabulary":
        body = _t(
            '<article itemscope itemtype="http://data-vocabulary.org/Recipe">',
            name('<h1 itemprop="name">'), image('itemprop="photo"'),
            '<p itemprop="summary">', about, "</p>",
            '<time itemprop="prepTime" datetime="PT', prep, 'M">soon</time>',
            '<time itemprop="cookTime" datetime="PT', cook, 'H30M">later</time>',
            '<span itemprop="yield">', servings, "</span>",
            '<time itemprop="published" datetime="', day, '">then</time>',
            '<span itemprop="recipeType">', category, "</span>",
            '<div itemprop="nutrition" itemscope itemtype="http://data-vocabulary.org/Nutrition">',
            '<span itemprop="calories">', prep, " calories</span></div><ul>",
            rows(lambda x: _t(
                '<li itemprop="ingredient" itemscope itemtype="http://data-vocabulary.org/RecipeIngredient">'
                '<span itemprop="amount">', x["qty"], '</span> x <span itemprop="name">', x["part"], "</span></li>")),
            "</ul></article>",
        )
    elif shape == "hrecipe":
        body = _t(
            '<div class="post hrecipe">', name('<h2 class="entry fn">', "</h2>"), image('class="photo"'),
            '<p class="summary">', about, '</p><p>Prep: <span class="preptime">', prep, " minutes</span>"
            '<p>Cook: <span class="cooktime">', cook, " hour 30 minutes</span>",
            '<p>Yield: <span class="yield">', servings, "</span><ul>",
            rows(lambda x: _t('<li class="line ingredient">', x["qty"], " <b>", x["part"], "</b>")),
            "</ul></div>",
        )
    elif shape == "lower":
        body = _t(
            '<div itemscope itemtype="http://schema.org/recipe">', name('<h1 itemprop="name">'),
            image('itemprop="image"'), '<p itemprop="description">', about, "</p>",
            '<meta itemprop="prepTime" content="PT', prep, 'M">',
            '<meta itemprop="cookTime" content="PT', cook, 'H30M">',
            '<span itemprop="recipeYield">', servings, "</span>",
            '<div itemprop="author" itemscope><span itemprop="name">Someone</span></div><ul>',
            rows(lambda x: _t('<li itemprop="ingredients">', text(x), "</li>")), "</ul></div>",
        )
    else:
        body = _t(
            '<blockquote class="recipe hrecipe">', name('<h2 class="fn">', "</h2>"), image('class="photo"'),
            '<div class="summary"><p>Status ', status, " order</p></div>",
            '<span class="preptime">', prep, ' minutes</span><span class="cooktime">', cook,
            ' hour 30 minutes</span><span class="yield">', servings, '</span><div class="ingredient">',
            rows(lambda x: _t("<p>", text(x))), "</div></blockquote>",
        )
    return F.concat(head, body, foot)


def page_url(source: Column) -> Column:
    return _t("http://www.", source, ".com/recipe/", F.col("o_orderkey"))


def recipe_pages(spark: SparkSession, sf: str, shape: str) -> DataFrame:
    """All orders as pages of one shape: (page_id, url, source, html)."""
    source = F.lit(SOURCES[shape][0])
    return orders_with_lines(spark, sf).select(
        F.col("o_orderkey").alias("page_id"),
        page_url(source).alias("url"),
        source.alias("source"),
        _render(shape).alias("html"),
    )


def mixed_pages(spark: SparkSession, sf: str) -> DataFrame:
    """All orders as pages, the shape given by the order priority."""
    source, html = F, F
    for shape, (site, priority) in SOURCES.items():
        here = F.col("o_orderpriority") == priority
        source = source.when(here, site)
        html = html.when(here, _render(shape))
    return orders_with_lines(spark, sf).select(
        F.col("o_orderkey").alias("page_id"),
        page_url(source).alias("url"),
        source.alias("source"),
        html.alias("html"),
    )


def bag(col: str = "ingredients") -> Column:
    """A list as one sorted text, for comparison."""
    return F.coalesce(F.array_join(F.array_sort(col), "|"), F.lit(""))


# --- store and batch from documents -------------------------------------------------------

STORE_SQL = (
    ITEMS_SQL
    + """,
dated AS (SELECT *, CASE WHEN doc_id % 7 = 0 THEN '  ' || lang || CHR(9) || ' <b>note</b> ' ELSE lang END AS description FROM items),
store AS (
  SELECT CAST(doc_id AS VARCHAR) AS id, arrival, source, name, url, image, description, ingredients, ts FROM dated WHERE visit = 0
),
batch AS (
  SELECT arrival, source, name,
    CASE WHEN doc_id % 2 = 0 THEN url ELSE replace(url, '.example.com/', '.example.com/new/') END AS url,
    image, 'changed ' || lang AS description, ingredients, ts, lang FROM dated WHERE visit = 1
)"""
)


def _described(spark: SparkSession, sf: str) -> DataFrame:
    note = F.concat(F.lit("  "), "lang", F.lit("\t <b>note</b> "))
    return raw_items(spark, sf).withColumn(
        "description", F.when(F.col("doc_id") % 7 == 0, note).otherwise(F.col("lang"))
    )


def stored_items(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's first visit as a stored record (_id, fields, ts)."""
    return _described(spark, sf).filter("visit = 0").select(
        F.col("doc_id").cast("string").alias("_id"),
        "arrival", "source", "name", "url", "image", "description", "ingredients", "ts",
    )


def batch_items(spark: SparkSession, sf: str) -> DataFrame:
    """Every document's second visit with a new description; half of the URLs are new."""
    moved = F.replace(F.col("url"), F.lit(".example.com/"), F.lit(".example.com/new/"))
    return _described(spark, sf).filter("visit = 1").select(
        "arrival", "source", "name",
        F.when(F.col("doc_id") % 2 == 0, F.col("url")).otherwise(moved).alias("url"),
        "image", F.concat(F.lit("changed "), "lang").alias("description"),
        "ingredients", "ts", F.array("lang").alias("recipeCategory"),
    )
