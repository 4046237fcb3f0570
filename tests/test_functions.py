"""Column functions against known values, and invariants of the normalisation."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from larder.functions import dates as D
from larder.functions import ingredients as I
from larder.functions import text as X
from larder.functions import urls as U

# A recipe box with tags, comments and void elements, and its text with all white space.
BOX = (
    '<div class="box" itemscope="">\n   <div title="recipe">\n      <h2 id="f-1"><span itemprop="name">Pasta</span></h2>\n'
    '      <dl><dt>Prep:</dt><dd> <time datetime="PT1H">1 Hour</time></dd></dl>\n   </div><!--/header-->\n'
    '   <img width="213" src="http://a/b.jpg">\n<ul><li><span>8 ounces</span><span> Short pasta</span></li></ul> </div>\n'
)
BOX_TEXT = "\n   \n      Pasta\n      Prep: 1 Hour\n   \n   \n8 ounces Short pasta \n"


def values(spark, fn, inputs, kind="string"):
    rows = [(i, v) for i, v in enumerate(inputs)]
    df = spark.createDataFrame(rows, f"i int, v {kind}")
    return [r[0] for r in df.select("i", fn(F.col("v")).alias("o")).orderBy("i").select("o").collect()]


def test_dates(spark):
    cases = {
        "October 11 2009": "2009-10-11",
        "2009-10-11": "2009-10-11",
        "Saturday, April 5th, 2013": "2013-04-05",
        "5 Apr 2013": "2013-04-05",
        "2013-04-15T10:00:00+00:00": "2013-04-15",
        "20130415": "20130415",
        "2013-W05-2": "2013-W05-2",
        "Sept. 3, 2011": "2011-09-03",
        "yesterday": None,
        "2013-13-45": None,
        "": None,
        None: None,
    }
    assert values(spark, D.iso_date, list(cases)) == list(cases.values())


def test_parse_iso_date(spark):
    got = values(spark, D.parse_iso_date, ["2009-10-11", "20091011", "2009-W41-7", "2009-284", "x", "2009-W60"])
    assert got == [dt.date(2009, 10, 11)] * 4 + [None, None]


def test_durations(spark):
    cases = {
        "15 minutes": "PT15M",
        "90 minutes": "PT1H30M",
        "1 hour 30 minutes": "PT1H30M",
        "1 day, 2 hours": "P1DT2H",
        "0 minutes": "P0D",
        "PT15M": "PT15M",
        "P1Y2M": "P1Y2M",
        "PT1HPT1H": None,
        "P": None,
        "soon": None,
        None: None,
    }
    assert values(spark, D.iso_duration, list(cases)) == list(cases.values())


def test_parse_iso_duration(spark):
    got = values(spark, D.parse_iso_duration, ["P1D", "PT15M", "PT1HPT1H", "P1Y", "-PT5M", "P1W"])
    assert got == [
        dt.timedelta(days=1),
        dt.timedelta(minutes=15),
        None,
        None,
        -dt.timedelta(minutes=5),
        dt.timedelta(weeks=1),
    ]


def test_strip_html(spark):
    got = values(spark, X.strip_html, ["<strong>foo</strong> <script>bar baz</script>", BOX])
    assert got == ["foo bar baz", BOX_TEXT]


def test_strip_html_escape(spark):
    got = values(spark, lambda c: X.strip_html(c, escape=True), ["a & b &amp; <i>c</i> > d"])
    assert got == ["a &amp; b &amp; c &gt; d"]


def test_trim(spark):
    got = values(spark, X.trim_whitespace, ["\n          \n        Recipe\n", "  a b \t\n c ", ""])
    assert got == ["Recipe", "a b c", ""]


@pytest.mark.parametrize("fn", [X.clean_string, X.strip_html, D.iso_date, D.iso_duration])
def test_idempotent(spark, fn):
    inputs = [" a  b\t", BOX, "October 11 2009", "15 minutes", "2009-10-11", "PT5M", "<b>x</b>", None]
    once = values(spark, fn, inputs)
    assert values(spark, fn, once) == once


def test_lists(spark):
    arr = "array<string>"
    assert values(spark, X.take_first, [["", None, "a", "b"], [], None], arr) == ["a", None, None]
    assert values(spark, X.flatten_value, [["a", "b"], [], None], arr) == ["a", "", ""]
    assert values(spark, X.drop_header_lines, [["My Ingredients:", "1 egg"]], arr) == [["1 egg"]]
    assert values(spark, X.drop_labels, [["For the pie", " 1 egg ", "Crust:", " ", "Forks"]], arr) == [
        ["1 egg", "Forks"]
    ]
    assert values(spark, X.distinct_list, [["b", "a", "b"]], arr) == [["b", "a"]]
    assert values(spark, X.squash, [[" a\n", "\tb "]], arr) == ["a b"]


def test_date_phrases(spark):
    assert values(spark, lambda c: X.clean_date_phrase(c, "on"), ["on Monday | on"]) == ["Monday  on"]
    assert values(spark, lambda c: X.clean_date_phrase(c, "posted"), ["Posted on May 1 in"]) == ["May 1"]
    assert values(spark, lambda c: X.clean_date_phrase(c, "bar"), ["a | b | c", "none"]) == [" b | c", ""]


def test_labelled_values(spark):
    got = values(spark, X.labelled_values, ["Yield: 4 | Prep: 5 minutes | cook time: 1 hour", "x Yields: 4"])
    assert got[0].asDict() == {"recipeYield": "4 ", "prepTime": "5 minutes ", "cookTime": "1 hour"}
    assert got[1].asDict() == {"recipeYield": None, "prepTime": None, "cookTime": None}


def test_ingredient_score(spark):
    lists = [["1 egg", "Salt", "mix"], ["1st step", "2. stir"], [], ["10 g x", "a dash"]]
    assert values(spark, I.ingredient_score, lists, "array<string>") == [2 / 3, 0.0, 0.0, 0.5]
    assert values(spark, I.is_ingredient_container, lists, "array<string>") == [False] * 4


def test_resolve_url(spark):
    base = "http://a.com/b/c?x=1#t"
    cases = {
        "/q": "http://a.com/q",
        "d": "http://a.com/b/d",
        "../d": "http://a.com/d",
        "?y=2": "http://a.com/b/c?y=2",
        "#z": "http://a.com/b/c?x=1#z",
        "//h/i": "http://h/i",
        "http://z/": "http://z/",
        "": base,
    }
    assert values(spark, lambda c: U.resolve_url(F.lit(base), c), list(cases)) == list(cases.values())
    assert values(spark, U.url_host, ["HTTP://u@A.com:80/x", "mailto:a", None]) == ["a.com", None, None]


def test_usual_dates_are_read_as_the_others(spark):
    """The one expression for the usual layouts gives what the rewriting steps give."""
    import random

    from larder.functions import dates

    rnd = random.Random(3)
    months = ["Jan", "january", "Feb.", "MARCH", "sept", "Sept.", "december", "may", "foo", "7", "13"]
    day = lambda: rnd.choice([str(rnd.randint(0, 40)), f"{rnd.randint(1, 31):02}", f"{rnd.randint(1, 31)}{rnd.choice(['st', 'nd', 'th'])}"])
    texts = []
    for _ in range(6000):
        year, month = rnd.choice(["2012", "1999", "0000", "12"]), rnd.choice(months)
        parts = rnd.choice([[month, day(), year], [day(), month, year], [year, month, day()], [month, year], [f"{year}-{rnd.randint(1, 13):02}-{rnd.randint(1, 32):02}"]])
        mark = rnd.choice([" ", "-", "/", ".", ", ", "  "])
        texts.append(rnd.choice(["", "Monday, ", "Tue ", "wed. "]) + mark.join(parts) + rnd.choice(["", "", " at 10:30", "T10:20:00Z", " ", " pm"]))
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    both = rows.select("t", dates.iso_date("t").alias("got"), F.when(F.col("t").rlike(r"\d{4}"), dates._other_date(F.col("t"))).cast("string").alias("other"))
    both = both.where(dates.parse_iso_date("t").isNull()).collect()
    assert sum(r.got is not None for r in both) > 500
    assert [r for r in both if r.got != r.other] == []
