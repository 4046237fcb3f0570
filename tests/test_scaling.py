"""What keeps the work of one page, task and worker small."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from larder.functions import nodes as N
from larder.functions import text as X
from larder.operators import links as L
from larder.operators import maintain as MT
from larder.operators import microdata as M
from larder.operators import shred
from larder.operators.records import first_nonempty
from larder.operators.site_extract import shred_site_pages, site_extract
from larder.plans import ingest, pipeline
from larder.plans.site_rules import SITES
from larder.queries.tables import spread
from larder.storage import fresh_folder, names_in


def batch(*html):
    return pa.RecordBatch.from_pydict({"page_id": [*range(len(html))], "html": [*html]})


def test_a_tag_is_read_once(monkeypatch):
    read = []
    known = shred.read_tag
    monkeypatch.setattr(shred, "read_tag", lambda m: read.append(m[0]) or known(m))
    out = pa.Table.from_batches(shred.shred_batches(iter([batch(*['<p class="a">x<p class="a">y</p>'] * 50)])))
    assert sorted(read) == ["</p>", '<p class="a">']
    nodes = out["nodes"].to_pylist()
    assert all(n == nodes[0] for n in nodes)
    assert [n["attrs"]["class"] for n in nodes[0]] == [None, None, "a", None, "a", None]
    assert [(n["pos"], n["end"], n["parent"], n["depth"]) for n in nodes[0]] == [
        (0, 5, -1, 0), (1, 5, 0, 1), (2, 3, 1, 2), (3, 3, 2, 3), (4, 5, 1, 2), (5, 5, 4, 3),
    ]


def by_add_page(pages):
    columns = shred.NodeColumns()
    for html in pages:
        if html:
            columns.add_page(html)
        columns.close_row()
    return columns.to_arrow()


def test_the_tags_of_plain_pages_are_not_followed_one_by_one(monkeypatch):
    learnt, known = [], shred.Steps.learn
    monkeypatch.setattr(shred.Steps, "learn", lambda *a: learnt.append(a) or known(*a))
    monkeypatch.setattr(shred.NodeColumns, "add_page", None)
    item = '<li itemprop="i" itemscope>a{0} &amp; é<span itemprop=name>{0}</span><br>'
    pages = ["<html><head><title>{0}</title></head><body><p>{0}<ul>".format(i) + item.format(i) * 9 + "</ul></body></html>" for i in range(300)]
    out = pa.Table.from_batches(shred.shred_batches(iter([batch(*pages)])))["nodes"]
    monkeypatch.undo()
    assert out.combine_chunks().equals(by_add_page(pages))
    assert len(learnt) < 20 * 10  # of 9,300 tags, by chunks of pages


def test_plain_and_other_pages_have_the_same_nodes():
    parts = [
        "<p>", "<li>a", "</ul>", "<table><tr><td>x", "</td>", "</table>", "<dl><dt>t<dd>", "<hr>", "<li/>", "<option>", "</b>", "<A HREF=x/>", "<img alt='a>b'>",
        '<p class="x>', "a < b", "x>y", "<!-- c -->", "<!-- <p> -->", "<!-->", "<script>a &amp; b</script>", "<style>a>b</style>", "<script src=a/>", '<a"b c="d>',
        "<div itemscope itemprop=q>", "</div>", "&eacute;é", "</body>", "<head>", "<?x y?>", "<" + "b>" + "<b>" * 70, "</html>", "<script>a",
    ]
    pages = ["", None, "x", "<p>y", "<html>", "<html><body>"]
    pages += [f"<html><head></head><body>{a}{b}{c}z</body></html>\n" for a in parts for b in parts for c in parts[::5]]
    out = pa.Table.from_batches(shred.shred_batches(iter([batch(*pages)])))["nodes"].combine_chunks()
    assert out.equals(by_add_page(pages))


def test_a_worker_holds_few_nodes():
    """Pages of 20,000 nodes are handed on a few at a time, whatever the size of the input batch."""
    out = [*shred.shred_batches(iter([batch(*["<br>" * 20_000] * 9)]))]
    assert [b.num_rows for b in out] == [3, 3, 3]
    assert all(len(n) == 20_002 for b in out for n in b.column("nodes").to_pylist())


def test_a_choice_is_extracted_once(spark):
    a, b = F.col("a"), F.col("b")
    assert str(first_nonempty(F.reverse(a), b)).count("reverse") == 1


def test_first_nonempty(spark):
    rows = spark.createDataFrame(
        [([], [], ["c"]), ([], ["b"], ["c"]), (["a"], [], []), (None, ["b"], ["c"]), (None, None, None), ([], None, [])],
        "a array<string>, b array<string>, c array<string>",
    )
    got = rows.select(first_nonempty(F.col("a"), F.col("b"), F.col("c")).alias("x")).collect()
    assert [r.x for r in got] == [["c"], ["b"], ["a"], ["b"], None, []]


def test_class_token_and_names_of_properties(spark):
    html = '<p class="ab">1<p class="a\tb">2<p class="b a">3<p class>4<p>5<p class="aa ba">6<i itemscope><b itemprop=" u\tv  w ">7</b><b itemprop="">8</b></i>'
    rows = spark.createDataFrame([("u", html)], "url string, html string")
    nodes = F.col("nodes")
    got = shred.shred_pages(rows).select(
        F.transform(N.select_class(nodes, "a"), lambda n: N.joined_text(nodes, n)).alias("a"),
        F.transform(M.microdata_marks(nodes), lambda m: m["name"]).alias("names"),
    )
    # a trim of spaces only: a name is cut at every run of white space
    assert got.first() == (["2", "3"], [None, "u", "v", "w", ""])


def test_edges(spark):
    cases = {"": "", " ": "", "a": "a", " a ": "a", "a   ": "a", "\x1c a \t b \n\n": "a \t b", "a b": "a b", "\n": "", "a b  ": "a b"}
    rows = spark.createDataFrame([(k,) for k in cases], "v string").select("v", X.strip_edges("v").alias("s"))
    assert {r.v: r.s for r in rows.collect()} == cases


SCHEMA = "_id string, source string, name string, url string, ingredients array<string>, ts timestamp"


def test_a_batch_is_cleaned_by_several_tasks(spark):
    store = fresh_folder(spark, "many")
    rows = spark.range(400).select(
        F.col("id").cast("string").alias("_id"), F.lit("s").alias("source"), F.concat(F.lit(" n "), "id").alias("name"),
        F.lit("u").alias("url"), F.array(F.lit("1 egg")).alias("ingredients"), F.lit("2024-01-01").cast("timestamp").alias("ts"),
    )
    MT.add_batch(rows.repartition(8), store, 0)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        written, _, _ = MT.cleanup_stale(spark, store, SCHEMA, "d")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert written == ["batch=0"]
    files = [n for n in names_in(spark, f"{store}/batch=0/gen=1-d") if n.endswith(".parquet")]
    assert len(files) > 1
    kept = MT.read_generations(spark, store, SCHEMA).select("_id", "name").collect()
    assert sorted((int(r[0]), r.name) for r in kept) == [(i, f"n {i}") for i in range(400)]


def test_sitemaps_are_written_in_parts(spark, tmp_path, monkeypatch):
    from larder.queries import dom

    line = spark.range(40).select(F.col("id").alias("l_orderkey"), F.lit(1).alias("l_linenumber"), (F.col("id") % 3).alias("l_partkey"))
    line.repartition(4).write.parquet(f"{tmp_path}/lineitem.parquet")
    line.select(F.col("l_orderkey").alias("o_orderkey")).repartition(4).write.parquet(f"{tmp_path}/orders.parquet")
    folder = f"{tmp_path}/maps"
    monkeypatch.setattr(dom, "fresh_folder", lambda *_: folder)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
    try:
        got = dom.q_sitemap_files(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    for name in ("url", "index"):
        with_entries = [n for n in names_in(spark, f"{folder}/{name}") if n.startswith("part-") and "<loc>" in open(f"{folder}/{name}/{n}").read()]
        assert len(with_entries) > 1
    assert sorted((r["loc"], r.kind, r.n) for r in got) == sorted(
        [(f"http://www.food.com/recipe/{i}?a=1&b={i % 3}", "url", 1) for i in range(40)]
        + [(f"http://www.food.com/sitemap-{i}.xml", "sitemap", 1) for i in range(40)]
    )


def test_pages_are_dealt_to_several_tasks_per_core(spark):
    """One task per core would leave cores idle behind the slowest; every row is still there once."""
    rows = spread(spark.range(1000).withColumnRenamed("id", "k"), "k")
    sizes = rows.rdd.glom().map(len).collect()
    assert len(sizes) == 4 * spark.sparkContext.defaultParallelism
    assert sum(sizes) == 1000 and max(sizes) < 100
    assert sorted(r.k for r in rows.collect()) == [*range(1000)]


def test_an_end_is_implied_at_once_or_from_further_out():
    """The open element that a tag ends is the innermost one or lies further out; items end with it."""
    html = '<ul><li itemscope>a<li><b>c<li>d<ul><li>e</ul>f</ul><table><tr><td>1<td><i>2<tr><th>3</table>'
    nodes = pa.Table.from_batches(shred.shred_batches(iter([batch(html)])))["nodes"].to_pylist()[0]
    assert [(n["text"] or n["tag"], n["parent"], n["end"], n["item"]) for n in nodes] == [
        ("html", -1, 23, -1), ("body", 0, 23, -1), ("ul", 1, 13, -1), ("li", 2, 4, -1), ("a", 3, 4, 3), ("li", 2, 7, -1),
        ("b", 5, 7, -1), ("c", 6, 7, -1), ("li", 2, 13, -1), ("d", 8, 9, -1), ("ul", 8, 12, -1), ("li", 10, 12, -1),
        ("e", 11, 12, -1), ("f", 8, 13, -1), ("table", 1, 23, -1), ("tr", 14, 20, -1), ("td", 15, 17, -1), ("1", 16, 17, -1),
        ("td", 15, 20, -1), ("i", 18, 20, -1), ("2", 19, 20, -1), ("tr", 14, 23, -1), ("th", 21, 23, -1), ("3", 22, 23, -1),
    ]


def test_a_walk_shreds_only_pages_that_it_can_follow(spark, monkeypatch):
    """Recipes, which a walk only takes, pages of foreign hosts and pages without URL are not read for links."""
    starts = {"food": ["http://www.food.com/start"], "tastykitchen": []}
    links = {
        "http://www.food.com/start": ["http://www.food.com/recipes/a", "http://www.food.com/recipe/1", "http://x.org/recipes/b"],
        "http://www.food.com/recipes/a": ["http://www.food.com/recipe/2", "/recipes/a", "http://tastykitchen.com/recipes/page/2/"],
        "http://www.food.com/recipe/1": ["http://www.food.com/recipe/3", "http://www.food.com/recipes/c"],
        "http://www.food.com/recipes/c": ["http://www.food.com/recipe/4"],
        "http://x.org/recipes/b": ["http://www.food.com/recipe/5"],
        None: ["http://www.food.com/recipe/6"],
    }
    rows = [("food", u, "".join(f'<a href="{d}">r</a>' for d in to)) for u, to in links.items()]
    pages = spark.createDataFrame([*rows, rows[1], (None, "http://www.food.com/recipes/a", rows[1][2])], "source string, url string, html string")
    monkeypatch.setattr(ingest, "START_URLS", starts)
    shredded = []
    monkeypatch.setattr(ingest, "shred_pages", lambda d: shredded.append(d) or shred.shred_pages(d))
    got = sorted(r.url for r in ingest.site_page_urls(pages).collect())
    assert got == ["http://www.food.com/recipe/1", "http://www.food.com/recipe/2"]
    assert sorted(r.url for r in shredded[0].collect()) == [
        "http://www.food.com/recipes/a", "http://www.food.com/recipes/a", "http://www.food.com/recipes/c", "http://www.food.com/start",
    ]


def test_a_page_is_followed_as_its_routed_links_are(spark):
    """At a domain that two sites list, the rules of either may follow a page, whatever site the page counts to."""
    rules = [L.LinkRule("a", "/list", L.FOLLOW, deny="x$"), L.LinkRule("b", "/list", L.PARSE), L.LinkRule("b", "/all", L.PARSE_FOLLOW)]
    domains = {"a": ["One.com", "two.com"], "b": ["one.com", "sub.two.com"]}
    cases = {
        "http://one.com/list": True, "http://www.one.com/all": True, "http://one.com/listx": False, "http://two.com/all": False,
        "http://sub.two.com/all": True, "http://sub.two.com/list": True, "http://three.com/list": False, "http://s.com/": True,
        "list": False, None: False,
    }
    rows = spark.createDataFrame([(u,) for u in cases], "url string")
    got = rows.select("url", L.may_be_followed(F.col("url"), rules, domains, ["http://s.com/"]).alias("x"))
    assert {r.url: r.x for r in got.collect()} == cases


def plan_of(df) -> str:
    """The analysed plan, with every field of every expression."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.debug.maxToStringFields", "10000")
    try:
        return df._jdf.queryExecution().analyzed().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")


def test_no_slice_of_a_stored_page(spark):
    """A slice of the stored array reads all nodes of the page: one for every property, class or hit."""
    pages = spark.createDataFrame([(1, "http://a/", "food", "<p>")], "page_id long, url string, source string, html string")
    d = shred.shred_pages(pages)
    for extractor in (M.microdata_records, M.flat_itemprop_records, M.lower_itemprop_records, M.hrecipe_records):
        assert "slice(nodes#" not in plan_of(d.select(extractor(F.col("nodes"), F.col("url"))))
    assert "slice(nodes#" not in plan_of(M.microdata_items(d))
    assert "slice(nodes#" not in plan_of(site_extract(shred_site_pages(pages, SITES), SITES))


def test_a_nested_item_is_looked_up_once(spark):
    html = (
        '<div itemscope itemtype="http://data-vocabulary.org/Recipe"><b itemprop="nutrition" itemscope>'
        '<i itemprop="calories">1</i><i itemprop="sugar">2</i><i itemprop="calories">3</i></b>'
        '<b itemprop="nutrition" itemscope><i itemprop="calories">4</i></b>'
        '<p itemprop="ingredient" itemscope><i itemprop="name">egg</i><i itemprop="amount">5</i></p>'
        '<p itemprop="ingredient" itemscope><i itemprop="name">salt</i></p><p itemprop="ingredient">oil</p></div>'
    )
    pages = spark.createDataFrame([(1, "u", html), (2, "u", "<p>"), (3, "u", None)], "page_id long, url string, html string")
    d = shred.shred_pages(pages).select("page_id", M.microdata_records(F.col("nodes"), F.col("url")).alias("r"))
    assert plan_of(d).count("= nutrition)") == 1
    got = {r.page_id: r.r for r in d.collect()}
    assert got[2] is None and got[3] is None
    (r,) = got[1]
    assert (r.calories, r.sugarContent, r.aggregateRating) == (["1", "3"], ["2"], None)
    assert r.ingredients == ["5 egg", "salt", "oil"]


def test_pages_meet_the_site_rules_where_they_are(spark):
    """No page is dealt by its site, and records are not extracted once more to count them."""
    pages = spark.createDataFrame(
        [(1, "http://a/1", "food", '<div itemscope itemtype="http://schema.org/Recipe"><b itemprop="name">n</b></div>'), (2, "http://a/2", "lovefood", "<p>x</p>"), (3, "http://a/3", None, "<p>x</p>")],
        "page_id bigint, url string, source string, html string",
    )
    raw = pipeline.extract_pages(pages)
    plan = raw._jdf.queryExecution()
    assert "Exchange hashpartitioning" not in plan.executedPlan().toString()
    filters = [line for line in plan.optimizedPlan().toString().split("\n") if "Filter" in line]
    assert filters and not any("lambdafunction" in line for line in filters)
    assert [(r.page_id, r.item_no, r.source, r.name) for r in raw.orderBy("page_id").collect()] == [(1, 0, ["food"], ["n"])]
