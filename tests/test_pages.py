"""Shredding, extraction by markup and by site rules, on small pages."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from larder.functions import nodes as N
from larder.operators import links as L
from larder.operators import microdata as M
from larder.operators.records import extract_records, normalize_records
from larder.operators.shred import NodeColumns, shred_pages
from larder.operators.site_extract import shred_site_pages, site_extract
from larder.plans import link_rules, pipeline
from larder.plans.site_rules import SITES
from larder.queries.site_pages import DV, EGG, SITE_PAGES, SO


def pages(spark, *rows):
    return spark.createDataFrame(
        [(i, f"http://a.com/d/p{i}", s, h) for i, (s, h) in enumerate(rows)],
        "page_id long, url string, source string, html string",
    )


def records(df, *fields):
    out = normalize_records(df, ("page_id", "item_no")).orderBy("page_id", "item_no").collect()
    return [tuple(r[f] for f in fields) for r in out]


def tree(spark, html):
    rows = shred_pages(pages(spark, ("s", html))).select(F.explode("nodes").alias("n")).select("n.*")
    return [(r.pos, r.parent, r.end, r.tag, r.text) for r in rows.orderBy("pos").collect()]


def test_lenient_tree(spark):
    got = tree(spark, "<UL><li>a<li>b<br>c</ul><p>x<p><b>y<div>z</div></i><!-- <q> --><script>if(a<b)'</p>'</script>&amp;t")
    assert [(t, p) for _, p, _, t, _ in got] == [
        ("html", -1), ("body", 0),
        ("ul", 1), ("li", 2), ("#text", 3), ("li", 2), ("#text", 5), ("br", 5), ("#text", 5),
        ("p", 1), ("#text", 9), ("p", 1), ("b", 11), ("#text", 12), ("div", 1), ("#text", 14),
        ("script", 1), ("#text", 16), ("#text", 1),
    ]
    assert got[2][2] == 8 and got[-1][4] == "&t" and got[17][4] == "if(a<b)'</p>'"


def test_empty_elements_and_missing_tags(spark):
    got = tree(spark, "<title>t</title><script src='a'/><p>x<span class=\"k\"/>y<a href=x/>z</a><div id=d />w")
    assert [(t, p) for _, p, _, t, _ in got] == [
        ("html", -1), ("title", 0), ("#text", 1), ("script", 0), ("body", 0), ("p", 4), ("#text", 5), ("span", 5),
        ("#text", 5), ("a", 5), ("#text", 9), ("div", 4), ("#text", 4),
    ]
    whole = tree(spark, "<html><head><title>t</title></head>\n<body><p>x</body></html>")
    assert [t for *_, t, _ in whole] == ["html", "head", "title", "#text", "#text", "body", "p", "#text"]


def test_item_with_empty_elements(spark):
    html = """<head><script src="s.js"/></head><article itemscope itemtype="http://data-vocabulary.org/Recipe"><h1 itemprop="name">Pie</h1>
      <script type="t" src="x"/><img itemprop="photo" src="/a.jpg"/><span itemprop="prepTime" datetime="PT5M"/>
      <ul><li itemprop="ingredient"><span itemprop="amount"><span class="value">2</span><span class="type"/></span> <span itemprop="name">eggs</span></li>
      <li itemprop="ingredient"><span itemprop="amount"><span class="value">1</span><span class="type"/></span> <span itemprop="name">onion</span></li></ul></article>"""
    raw = extract_records(shred_pages(pages(spark, ("food", html))), M.microdata_records)
    ((name, ingredients),) = records(raw, "name", "ingredients")
    assert name == "Pie" and ingredients == ["2 eggs", "1 onion"]


@pytest.mark.parametrize("part, tail", [("<a ", ""), ("<div>", ""), ("<b></i>", ""), ("<a '>\"", ""), ("<p><table><td><div>", ""), ("<!-", ">")])
def test_time_grows_with_the_page(part, tail):
    def seconds(n):
        start = time.process_time()
        NodeColumns().add_page(part * n + tail)
        return time.process_time() - start

    assert min(seconds(40_000) for _ in range(2)) < 40 * max(min(seconds(4_000) for _ in range(3)), 0.005)


@pytest.mark.parametrize("html", ["", "<", "<a", "<a href='x", "</p></div>", "<!-- open", "<p", "a < b > c", "<a b='1\" c>x</a>", None])
def test_broken_markup_never_fails(spark, html):
    for pos, parent, end, _, _ in tree(spark, html):
        assert parent < pos <= end


def test_attributes(spark):
    d = shred_pages(pages(spark, ("s", "<img SRC=a.jpg data-lazy-src='b&amp;c' class='x  y' class=z itemscope>")))
    n = d.select(F.col("nodes")[2]["attrs"].alias("a")).first().a
    assert (n.src, n.data_lazy_src, n["class"], n.itemscope, n.id) == ("a.jpg", "b&c", "x  y", "", None)


def test_large_pages_are_cut_into_batches(spark):
    html = "<p>x" * 150_000
    rows = shred_pages(pages(spark, ("s", html), ("s", html), ("s", "<b>1"))).select("page_id", F.size("nodes").alias("n"))
    assert sorted((r.page_id, r.n) for r in rows.collect()) == [(0, 300_002), (1, 300_002), (2, 4)]


MICRODATA = """<meta property="og:image" content="//i/1.png"><div itemscope itemtype="http://schema.org/Recipe">
<h1 itemprop="name headline">Pie</h1><img itemprop=image src="//x/y.jpg"><a itemprop=url href="/rel">u</a>
<li itemprop=ingredients>1 egg<li itemprop=ingredients>1 egg<li itemprop=ingredients>2 eggs</li>
<div itemprop=nutrition itemscope><b itemprop=calories>12</b></div></div><div itemscope itemtype="http://schema.org/Person">
<b itemprop=name>P</b></div>"""


def test_microdata(spark):
    raw = extract_records(shred_pages(pages(spark, ("food", MICRODATA))), M.microdata_records)
    got = records(raw, "source", "name", "url", "image", "ingredients", "calories")
    assert got[0] == ("food", "Pie", "http://a.com/d/p0", "http://i/1.png", ["1 egg", "2 eggs"], "12")
    # an unknown item type still gives a record that holds only its source
    assert got[1] == ("food", None, None, None, None, None)


def test_flat_properties_skip_nested_items(spark):
    html = MICRODATA.replace("<h1", '<div itemprop="author" itemscope><b itemprop="name">No</b></div><h1')
    raw = extract_records(shred_pages(pages(spark, ("s", html.replace("name headline", "name")))), M.flat_itemprop_records)
    assert records(raw, "name", "calories", "ingredients", "url") == [("Pie", None, ["1 egg", "1 egg", "2 eggs"], "/rel")]


@pytest.fixture(scope="module")
def site_records(spark):
    df = pages(spark, *[(s, p[0]) for s, p in SITE_PAGES.items()])
    rows = normalize_records(site_extract(shred_site_pages(df, SITES), SITES), ("page_id", "item_no")).collect()
    return {r.source: r for r in rows}


def test_every_site_is_covered():
    assert set(SITE_PAGES) == set(SITES)


@pytest.mark.parametrize("site", list(SITE_PAGES))
def test_site(site_records, site):
    _, name, ingredients, more = SITE_PAGES[site]
    r = site_records[site]
    assert (r.name, r.url is not None) == (name, True)
    if ingredients is not None:
        assert r.ingredients == ingredients
    assert {f: r[f] for f in more} == more


def test_page_wide_fields_repeat_per_scope(spark):
    html = '<blockquote class="recipe hrecipe"><b class="fn">A</b></blockquote><blockquote class="recipe hrecipe"><b class="fn">B</b></blockquote>'
    scoped = html.replace("blockquote", "div")
    df = pages(spark, ("loveandoliveoil", html), ("fortheloveofcooking", scoped))
    got = records(site_extract(shred_site_pages(df, SITES), SITES), "name")
    assert got == [("A",), ("A",), ("A",), ("B",)]


def test_fallback_site_and_dispatch(spark):
    item = f'<html><img class="wp-image" data-lazy-src="i.jpg"><meta property="og:url" content="http://o/u"><div itemscope itemtype="{SO}"><b itemprop="name">Item</b><i itemprop="ingredients">1 egg</i></div></html>'
    mention = SITE_PAGES["whatsgabycooking"][0].replace("Stir", SO)
    df = pages(spark, ("whatsgabycooking", item), ("whatsgabycooking", mention), ("food", MICRODATA), ("chow", SITE_PAGES["chow"][0]))
    rows = normalize_records(pipeline.extract_pages(df), ("page_id",)).filter("name is not null")
    got = sorted((r.page_id, r.name, r.image) for r in rows.collect())
    assert got == [(0, "Item", "i.jpg"), (1, "Pie", "i.jpg"), (2, "Pie", "http://i/1.png"), (3, "Pie", None)]


def test_result_does_not_depend_on_partitions(spark):
    df = pages(spark, *[(s, p[0]) for s, p in list(SITE_PAGES.items())[:8]])
    a, b = (
        normalize_records(site_extract(shred_site_pages(df.repartition(n), SITES), SITES), ("page_id",)).collect() for n in (1, 7)
    )
    assert sorted(map(str, a)) == sorted(map(str, b))


def test_link_rules_of_the_sites(spark):
    cases = [
        ("bbcfood", "http://bbc.co.uk/food/recipes/search?x", None),
        ("bbcfood", "http://bbc.co.uk/food/recipes/pie_1", "parse"),
        ("bbcgoodfood", "http://bbcgoodfood.com/recipes/12/pie?pager=1", None),
        ("food", "http://food.com/recipes/x", "follow"),
        ("food", "http://food.com/recipe-finder/all?pn=2", None),
        ("myrecipes", "http://www.myrecipes.com/x", "parse_follow"),
        ("tastykitchen", "http://tastykitchen.com/recipes/page/2/", "follow"),
        ("tastykitchen", "http://tastykitchen.com/recipes/category/x/", None),
        ("twopeasandtheirpod", "http://www.twopeasandtheirpod.com/category/recipes/a-b/", "follow"),
        ("nowhere", "http://x.com/", None),
    ]
    df = spark.createDataFrame([(s, u) for s, u, _ in cases], "source string, dst_url string")
    got = {(r.source, r.dst_url): r.action for r in L.route_links(df, link_rules.LINK_RULES).collect()}
    assert [got.get((s, u)) for s, u, _ in cases] == [a for _, _, a in cases]


def test_structure_selections(spark):
    d = shred_pages(pages(spark, ("s", "<ul><li class='a b'>1<li>2</ul><ul><li class=b>3</ul>")))
    nodes = F.col("nodes")
    li = N.select_tag("nodes", "li")
    r = d.select(
        F.transform(N.nth_per_parent(li, -1), lambda n: N.joined_text(nodes, n)).alias("last"),
        F.size(N.select_class("nodes", "b")).alias("b"),
        F.size(N.union_sel(li, N.select_class("nodes", "b"))).alias("u"),
    ).first()
    assert (r["last"], r.b, r.u) == (["2", "3"], 2, 3)
