"""Queries over shredded pages: node arrays, selections, texts, links."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.functions import nodes as N
from larder.functions import text as X
from larder.functions.urls import url_host
from larder.operators import links as L
from larder.operators.shred import shred_pages
from larder.queries import query
from larder.queries.tables import ORDERS_SQL, _t, recipe_pages, table
from larder.sources import feeds, pages as P
from larder.storage import fresh_folder


def shredded(spark, sf):
    return shred_pages(table(spark, sf, "pages"))


def _n(col):
    return F.size(col).cast("long")


def _count_sql(pattern: str, of: str = "html") -> str:
    return f"CAST(len(regexp_extract_all({of}, '{pattern}')) AS BIGINT)"


# The entities that occur in the given pages, on the checking side.
def _unescaped(sql: str) -> str:
    for entity, char in (("&copy;", "©"), ("&middot;", "·"), ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#x27;", "''"), ("&amp;", "&")):
        sql = f"replace({sql}, '{entity}', '{char}')"
    return sql


@query(
    f"SELECT page_id, {_count_sql('<p[ >]')} AS p, {_count_sql('<li[ >]')} AS li, {_count_sql('<a ')} AS a, "
    f"{_count_sql('<br>')} AS br, {_count_sql('<b>')} AS b FROM pages"
)
def q_shred_counts(spark, sf):
    return shredded(spark, sf).select(
        "page_id", *[_n(N.select_tag("nodes", t)).alias(t) for t in ("p", "li", "a", "br", "b")]
    )


@query(
    r"SELECT page_id, "
    + _unescaped(r"regexp_extract(html, '<title>(.*?)</title>', 1)")
    + " AS title, "
    + _unescaped("regexp_replace(regexp_extract(html, '<article>(.*)</article>', 1, 's'), '<[^>]*>', '', 'g')")
    + " AS article, CAST(length(regexp_extract(html, '<script>(.*?)</script>', 1)) AS BIGINT) AS script FROM pages"
)
def q_page_text(spark, sf):
    nodes = F.col("nodes")

    def first(tag):
        return F.get(N.select_tag("nodes", tag), F.lit(0))

    return shredded(spark, sf).select(
        "page_id",
        F.array_join(N.own_text(nodes, first("title")), "").alias("title"),
        N.joined_text(nodes, first("article")).alias("article"),
        F.length(N.joined_text(nodes, first("script"))).cast("long").alias("script"),
    )


@query(
    r"""SELECT page_id, CAST(len(ads) AS BIGINT) AS ads, coalesce(array_to_string(ads, '|'), '') AS texts,
        CAST(0 AS BIGINT) AS prefixes FROM (SELECT page_id, """
    + f"list_transform(regexp_extract_all(html, '<div class=\"ad\">(.*?)</div>', 1, 's'), lambda x: {_unescaped('x')}) AS ads FROM pages) t"
)
def q_select_class(spark, sf):
    d = shredded(spark, sf).select(
        "page_id", "nodes", N.select_class("nodes", "ad").alias("ads")
    )
    return d.select(
        "page_id",
        _n("ads").alias("ads"),
        F.array_join(
            F.transform("ads", lambda n: N.joined_text(F.col("nodes"), n)), "|"
        ).alias("texts"),
        _n(N.select_class("nodes", "a")).alias("prefixes"),
    )


HREFS = "regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1)"


@query(
    f"""SELECT page_id, CAST(len(h) AS BIGINT) AS present, CAST(len(list_filter(h, lambda x: starts_with(x, '/th'))) AS BIGINT) AS starts,
        CAST(len(list_filter(h, lambda x: contains(x, 'ing'))) AS BIGINT) AS contains, CAST(len(list_filter(h, lambda x: x = '/the')) AS BIGINT) AS eq
        FROM (SELECT page_id, list_transform({HREFS}, lambda x: {_unescaped('x')}) AS h FROM pages) t"""
)
def q_select_attr(spark, sf):
    def count(op, value=None):
        return _n(N.select_attr("nodes", "href", value, tag="a", op=op))

    return shredded(spark, sf).select(
        "page_id",
        count("present").alias("present"),
        count("starts", "/th").alias("starts"),
        count("contains", "ing").alias("contains"),
        count("eq", "/the").alias("eq"),
    )


LI = "regexp_extract_all(html, '<li><a [^>]*>(.*?)</a>', 1)"


@query(
    f"""SELECT page_id, {_unescaped("li[2]")} AS second, {_unescaped("li[-1]")} AS last, {_unescaped("li[1]")} AS first_per_list,
        array_to_string(['title', 'nav', 'h1'], ',') AS tags
        FROM (SELECT page_id, {LI} AS li FROM pages) t"""
)
def q_union_nth(spark, sf):
    nodes = F.col("nodes")
    items = N.select_tag("nodes", "li")
    both = N.union_sel(
        N.select_tag("nodes", "h1"), N.select_tag("nodes", "nav"),
        F.concat(N.select_tag("nodes", "title"), N.select_tag("nodes", "nav")),
    )

    def text(sel):
        return N.joined_text(nodes, sel)

    return shredded(spark, sf).select(
        "page_id",
        text(N.nth(items, 2)).alias("second"),
        text(N.nth(items, -1)).alias("last"),
        text(F.get(N.nth_per_parent(items, 1), F.lit(0))).alias("first_per_list"),
        F.array_join(F.transform(both, lambda n: n["tag"]), ",").alias("tags"),
    )


ARTICLE = "regexp_extract(html, '</h1>(.*)</article>', 1, 's')"


@query(
    f"""SELECT page_id, {_count_sql('<p>', ARTICLE)} AS after_heading, {_count_sql('<p><b>')} AS bold,
        {_count_sql('<p>', ARTICLE)} - {_count_sql('<p><b>')} AS plain, CAST(0 AS BIGINT) AS above FROM pages"""
)
def q_sibling(spark, sf):
    nodes = F.col("nodes")
    d = shredded(spark, sf).select(
        "page_id", "nodes", F.get(N.select_tag("nodes", "h1"), F.lit(0)).alias("h1")
    ).withColumn("p", N.following_sibling(nodes, F.col("h1"), "p"))
    return d.select(
        "page_id",
        _n("p").alias("after_heading"),
        _n(F.filter("p", lambda n: N.has_child(nodes, n, "b"))).alias("bold"),
        _n(F.filter("p", lambda n: N.lacks_child(nodes, n, "b", "img"))).alias("plain"),
        _n(F.filter("p", lambda n: n["pos"] < F.col("h1.pos"))).alias("above"),
    )


@query(
    f"""WITH {ORDERS_SQL} SELECT page_id, 'http://www.example.com/og/' || key AS og_url, replace(og_image, '/b/', '/a/') AS og_image,
        'About ' || key AS description, CAST(NULL AS VARCHAR) AS og_title, og_image AS last_image FROM o"""
)
def q_page_meta(spark, sf):
    d = shred_pages(recipe_pages(spark, sf, "schema_org"))
    images = N.meta_values(N.select_tag("nodes", "meta"), "property", "og:image")
    d = d.select("page_id", N.page_meta("nodes").alias("m"), N.nth(images, -1).alias("last_image"))
    return d.select("page_id", "m.og_url", "m.og_image", "m.description", "m.og_title", "last_image")


@query(
    f"""WITH {ORDERS_SQL} SELECT page_id, CAST(n * 2 + 3 AS BIGINT) AS spans, 'Order ' || key AS title_text,
        prep AS iso, CAST(n AS BIGINT) AS amounts, description AS about FROM o WHERE name IS NOT NULL
        UNION ALL SELECT page_id, n * 2 + 3, '', prep, n, description FROM o WHERE name IS NULL"""
)
def q_text_and_attributes(spark, sf):
    """Subtree selections: texts, attributes and ISO values below one element."""
    nodes = F.col("nodes")
    d = shred_pages(recipe_pages(spark, sf, "data_vocabulary")).select(
        "page_id", "nodes", F.get(N.select_tag("nodes", "article"), F.lit(0)).alias("root")
    )
    root = F.col("root")
    return d.select(
        "page_id",
        _n(F.filter(N.subtree(nodes, root), lambda n: n["tag"] == "span")).alias("spans"),
        X.clean_string(
            F.array_join(
                F.transform(N.select_attr(nodes, "itemprop", "name", "h1", root=root), lambda n: N.joined_text(nodes, n)), "")
        ).alias("title_text"),
        N.iso_attr(N.select_attr(nodes, "itemprop", "prepTime", root=root)).alias("iso"),
        _n(N.select_attr(nodes, "itemprop", "amount", root=root)).alias("amounts"),
        N.joined_text(
            nodes, F.get(N.select_attr(nodes, "itemprop", "summary", root=root), F.lit(0))
        ).alias("about"),
    )


# --- links --------------------------------------------------------------------------------

LINKS_SQL = f"""links AS (SELECT DISTINCT page_id, url AS src_url, regexp_extract(url, '^[a-z]+://[^/?#]*', 0) || {_unescaped('h')} AS dst_url
  FROM (SELECT page_id, url, unnest({HREFS}) AS h FROM pages) t)"""

RULES = [
    L.LinkRule("pages", r"/[A-Z]", L.FOLLOW),
    L.LinkRule("pages", r"/th", L.PARSE, deny=r"/the[^a-z]*$"),
    L.LinkRule("pages", r"ing$", L.PARSE_FOLLOW),
    L.LinkRule("pages", r"[?]page=\d+", L.FOLLOW),
]


def _links(spark, sf):
    return L.extract_links(shredded(spark, sf))


@query(f"WITH {LINKS_SQL} SELECT page_id, src_url, dst_url FROM links")
def q_links(spark, sf):
    return _links(spark, sf)


ROUTE_SQL = r"""CASE WHEN regexp_matches(dst_url, '/[A-Z]') THEN 0
  WHEN regexp_matches(dst_url, '/th') AND NOT regexp_matches(dst_url, '/the[^a-z]*$') THEN 1
  WHEN regexp_matches(dst_url, 'ing$') THEN 2 WHEN regexp_matches(dst_url, '[?]page=\d+') THEN 3 END"""


@query(
    f"""WITH {LINKS_SQL} SELECT page_id, dst_url, CAST(r AS INTEGER) AS rule_no,
        CASE r WHEN 0 THEN 'follow' WHEN 1 THEN 'parse' WHEN 2 THEN 'parse_follow' ELSE 'follow' END AS action
        FROM (SELECT *, {ROUTE_SQL} AS r FROM links) t WHERE r IS NOT NULL"""
)
def q_route_links(spark, sf):
    links = _links(spark, sf).withColumn("source", F.lit("pages"))
    return L.route_links(links, RULES).select("page_id", "dst_url", "rule_no", "action")


@query(f"WITH {LINKS_SQL} SELECT page_id, dst_url FROM links WHERE {ROUTE_SQL} IS NOT NULL")
def q_match_rules(spark, sf):
    links = _links(spark, sf).withColumn("source", F.lit("pages"))
    return L.match_rules(links, RULES).select("page_id", "dst_url")


@query(
    f"""WITH {LINKS_SQL}, h AS (SELECT *, regexp_extract(dst_url, '^[a-z]+://([^/?#:]*)', 1) AS host FROM links)
        SELECT page_id, dst_url FROM h WHERE host = 'example.org' OR ends_with(host, '.example.org')
        OR host = 'blog.ththan.example.net' OR ends_with(host, '.blog.ththan.example.net')
        OR host = 'tiontion.example.com' OR ends_with(host, '.tiontion.example.com')"""
)
def q_filter_domains(spark, sf):
    names = ["Example.org", "blog.ththan.example.net", "tiontion.example.com", "ample.net"]
    domains = spark.createDataFrame([(d,) for d in names], "domain string")
    return L.filter_domains(_links(spark, sf), domains).select("page_id", "dst_url")


def _graph(spark, sf):
    """List pages over all parts: ten parts per list, each list links to two more, to the
    recipes of its parts, and back to the first."""
    lists = table(spark, sf, "part").withColumn("i", F.floor(F.col("p_partkey") / 10)).groupBy("i").agg(
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list("p_partkey")),
                lambda k: F.concat(F.lit('<li><a href="/recipe/'), k.cast("string"), F.lit('">r</a>')),
            ),
            "",
        ).alias("items")
    )
    i = F.col("i")
    return lists.select(
        i.alias("page_id"),
        _t("http://parts.example.com/list/", i).alias("url"),
        _t('<html><body><a href="/list/0">first</a><a href="', i * 2 + 1, '">a</a><a href="', i * 2 + 2,
           '">b</a><a href="/about">about</a><ul>', F.col("items"), "</ul></body></html>").alias("html"),
    )


@query(
    """WITH RECURSIVE lists AS (SELECT DISTINCT p_partkey // 10 AS i FROM part),
    walk(i, depth) AS (
      SELECT CAST(0 AS BIGINT), 0
      UNION ALL
      SELECT c.i, w.depth + 1 FROM walk w JOIN lists l ON l.i = w.i
      CROSS JOIN LATERAL (VALUES (w.i * 2 + 1), (w.i * 2 + 2)) c(i)
    ),
    reached AS (
      SELECT 'http://parts.example.com/list/' || CAST(i AS VARCHAR) AS url, depth,
             'follow' AS action FROM walk
      UNION ALL
      SELECT 'http://parts.example.com/recipe/' || CAST(p_partkey AS VARCHAR), depth + 1, 'parse'
      FROM walk JOIN part ON p_partkey // 10 = i
    )
    SELECT url, CAST(depth AS INTEGER) AS depth, action FROM reached"""
)
def q_link_reach(spark, sf):
    graph = _graph(spark, sf)
    rules = [
        L.LinkRule("parts", r"/list/\d+$", L.FOLLOW),
        L.LinkRule("parts", r"/recipe/\d+$", L.PARSE),
    ]
    links = L.extract_links(shred_pages(graph)).withColumn("source", F.lit("parts"))
    starts = spark.createDataFrame([("http://parts.example.com/list/0",)], "url string")
    return L.link_reach(L.route_links(links, rules), starts)


@query(
    """SELECT page_id, url FROM pages WHERE regexp_extract(url, '^[a-z]+://[^/]+/([a-z]+)/', 1) IN ('fr', 'de')
       OR url LIKE 'https://%#top'"""
)
def q_pages_for_urls(spark, sf):
    pages = table(spark, sf, "pages")
    language = F.regexp_extract("url", "^[a-z]+://[^/]+/([a-z]+)/", 1)
    wanted = pages.filter(
        language.isin("fr", "de") | (F.col("url").startswith("https://") & F.col("url").endswith("#top"))
    ).select("url")
    return P.pages_for_urls(pages, wanted.union(wanted)).select("page_id", "url")


@query(
    """SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1) AS source FROM pages
       WHERE NOT (contains(url, '/en/') AND url LIKE '%.example.org/%') AND NOT (url LIKE '%/' AND url LIKE '%.example.com/%')"""
)
def q_skip_pages(spark, sf):
    domain = F.regexp_extract(url_host("url"), r"example\.\w+$", 0)
    pages = table(spark, sf, "pages").withColumn("source", domain)
    rules = [("example.org", "contains", "/en/"), ("example.com", "endswith", "/")]
    return P.skip_pages(pages, rules).select("page_id", url_host("url").alias("source"))


# --- feeds and sitemaps -------------------------------------------------------------------

HOST_SQL = "regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1)"


def _xml_text(col):
    return F.replace(F.replace(col, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


#: Pages that one feed document or sitemap lists.
LISTED = 40


def _feeds(spark, sf):
    """RSS documents of ``LISTED`` pages each per host and variant; hosts below www send broken ones."""
    host = url_host("url")
    rows = table(spark, sf, "pages").select(
        host.alias("host"),
        F.floor(F.col("page_id") / LISTED).alias("part"),
        F.explode(F.array(F.lit("item"), F.lit("origlink"), F.lit("any"))).alias("variant"),
        _xml_text(F.col("url")).alias("u"),
    )
    prefix = F.when(F.col("host").startswith("m."), "odd-one").otherwise("feedburner")
    item = F.when(
        F.col("variant") == "origlink",
        _t("<item><title>t</title><link>http://proxy.example.com/</link><", prefix, ":origLink>", F.col("u"), "</", prefix, ":origLink></item>"),
    ).otherwise(_t("<item><title>t</title><link> ", F.col("u"), "\n</link></item>"))
    docs = rows.groupBy("host", "variant", "part").agg(
        F.array_join(F.array_sort(F.collect_list(item)), "").alias("items"),
        F.array_join(F.array_sort(F.collect_list(_t('<p><a class="x" href="', F.col("u"), '">more<br></a>'))), "").alias("anchors"),
    )
    rss = _t(
        '<?xml version="1.0"?><rss version="2.0" xmlns:feedburner="http://rssnamespace.org/feedburner/ext/1.0">'
        "<channel><title>Feed</title><link>http://", F.col("host"), "/</link>", F.col("items"), "</channel></rss>",
    )
    broken = F.col("host").startswith("www.")
    return docs.select(
        _t("http://", F.col("host"), "/feed/", F.col("variant")).alias("feed_url"),
        F.when(broken, _t("<html><p>gone", F.col("anchors"))).otherwise(rss).alias("xml"),
        "variant",
    )


@query(
    f"""WITH h AS (SELECT DISTINCT {HOST_SQL} AS host, url FROM pages)
    SELECT DISTINCT 'http://' || host || '/feed/' || variant AS feed_url, url AS link FROM h, (VALUES ('item'), ('origlink'), ('any')) v(variant)
      WHERE NOT (host LIKE 'www.%' AND variant = 'origlink')
    UNION ALL SELECT DISTINCT 'http://' || host || '/feed/any', 'http://' || host || '/' FROM h WHERE host NOT LIKE 'www.%'"""
)
def q_feed_links(spark, sf):
    """Anchors of broken documents count for two variants; for the third they are adverts."""
    return feeds.feed_links(_feeds(spark, sf), fallback=F.col("variant") != "origlink").distinct()


@query(
    f"""SELECT page_id, url FROM pages WHERE {HOST_SQL} NOT LIKE 'www.%'"""
)
def q_feed_pages(spark, sf):
    from larder.plans.pipeline import feed_pages

    links = feeds.feed_links(_feeds(spark, sf).filter("variant = 'origlink'"))
    return feed_pages(links, table(spark, sf, "pages")).select("page_id", "url")


@query(
    f"""SELECT DISTINCT top AS source, url AS dst_url FROM (SELECT url, regexp_extract({HOST_SQL}, '(example[.][a-z]+)$', 1) AS top FROM pages) t
        WHERE top <> 'example.org' AND ((top = 'example.com' AND regexp_matches(url, '/(en|fr)/[0-9]+'))
        OR (top = 'example.net' AND regexp_matches(url, '/.+') AND NOT regexp_matches(url, '[?]')))"""
)
def q_sitemap_urls(spark, sf):
    """Sitemaps of ``LISTED`` pages of a host, named by one of several parts of the index of its top domain.

    Parts and index are stored in several documents each. Parts name the index they are named in, a circle; the .org
    index is malformed.
    """
    pages = table(spark, sf, "pages").select(
        url_host("url").alias("host"), _xml_text(F.col("url")).alias("u"), F.floor(F.col("page_id") / LISTED).alias("no")
    )
    pages = pages.withColumn("top", F.regexp_extract("host", r"example\.[a-z]+$", 0))
    joined = lambda c: F.array_join(F.array_sort(F.collect_list(c)), "").alias("x")
    listed = lambda c: _t("<sitemap><loc>", c, "</loc></sitemap>")
    top, site = _t("http://", F.col("top"), "/index.xml"), _t("http://", F.col("host"), "/sitemap-", F.col("no"), ".xml")
    part = _t("http://", F.col("top"), "/part-", F.pmod(F.xxhash64("host"), F.lit(5)), ".xml")
    maps = pages.groupBy("host", "no").agg(joined(_t("<url><loc>", F.col("u"), "</loc></url>"))).select(
        site.alias("sitemap_url"), _t('<?xml version="1.0"?><urlset>', F.col("x"), "</urlset>").alias("xml")
    )
    sites = pages.select("top", "host", "no").distinct()
    parts = sites.groupBy("top", part.alias("sitemap_url"), "no").agg(joined(listed(site))).select(
        "sitemap_url", _t("<sitemapindex>", listed(top), F.col("x"), "</sitemapindex>").alias("xml")
    )
    named = sites.select("top", part.alias("name")).distinct().groupBy("top", F.pmod(F.xxhash64("name"), F.lit(2)))
    index = named.agg(joined(listed(F.col("name")))).select(
        top.alias("sitemap_url"),
        F.when(F.col("top") == "example.org", "<sitemapindex><sitemap><loc>oops")
        .otherwise(_t("<sitemapindex>", F.col("x"), "</sitemapindex>")).alias("xml"),
    ).unionByName(parts)
    roots = pages.select(F.col("top").alias("source"), _t("http://", F.col("top"), "/index.xml").alias("sitemap_url"))
    rules = [
        L.LinkRule("example.com", r"/(en|fr)/\d+"),
        L.LinkRule("example.net", r"/.+", deny=r"[?]"),
        L.LinkRule("example.org", r"/.+"),
    ]
    return feeds.sitemap_urls(maps.unionByName(index), roots, rules)


@query(
    """SELECT 'http://www.food.com/recipe/' || CAST(l_orderkey AS VARCHAR) || '?a=' || CAST(l_linenumber AS VARCHAR) || '&b=' || CAST(l_partkey AS VARCHAR) AS loc,
       'url' AS kind, count(*) AS n FROM lineitem GROUP BY 1
       UNION ALL SELECT 'http://www.food.com/sitemap-' || CAST(o_orderkey AS VARCHAR) || '.xml', 'sitemap', 1 FROM orders"""
)
def q_sitemap_files(spark, sf):
    """One sitemap of all order lines and one index of all orders, each written in parts by many tasks, and read by many."""
    folder = fresh_folder(spark, "sitemap-files")
    line = table(spark, sf, "lineitem")
    url = _t("http://www.food.com/recipe/", F.col("l_orderkey"), "?a=", F.col("l_linenumber"), "&b=", F.col("l_partkey"))
    entry = _t("<url>\n<loc> ", _xml_text(url), "</loc><lastmod>2012-01-01</lastmod><priority>0.5</priority></url>")
    part = _t("<sitemap><loc>http://www.food.com/sitemap-", F.col("o_orderkey"), ".xml</loc></sitemap>")
    for name, root, entries in (
        ("url", "urlset", line.select(entry.alias("value"))),
        ("index", "sitemapindex", table(spark, sf, "orders").select(part.alias("value"))),
    ):
        first, last = (spark.createDataFrame([(x,)], "value string").coalesce(1) for x in (f'<?xml version="1.0"?><{root} xmlns="http://example.org/">', f"</{root}>"))
        # gathered into one file, all entries would pass through one task
        first.union(entries).union(last).write.text(f"{folder}/{name}")
    found = feeds.sitemap_file_entries(spark, f"{folder}/*/part-*")
    return found.groupBy("loc", "kind").agg(F.count("*").alias("n"))
