"""URL filters by site rules and by mined association rules, in DataFrame operations only.

FP-growth looks for combinations of URL tokens that go with a bad label. Combinations with enough support and
confidence are the rules. Tokens that the same labelled pages have are one item to it, as nothing in the labels tells
them apart: k of them would else make 2^k combinations that all say the same. A rule is a list of items, each with
its tokens. It is filed under all tokens of its rarest item; the tokens of a URL fetch the rules filed under them,
and a rule fires if the URL has a token of each of its items.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.llm.common import cut, lower_ascii

#: (host, path, verdict)
SITE_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
#: A rule covers at least this share, and this number, of the labelled pages, and this share of the pages
#: that it covers is bad.
SUPPORT, LEAST, CONFIDENCE = 0.001, 20, 0.6
BAD, GOOD = "label=bad", "label=good"


def host_of(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def site_rule(host: Column, path: Column, rules=SITE_RULES) -> Column:
    """(rule, verdict) of the longest rule that fits, else null.

    A rule fits its host and all subdomains if the path starts with the rule's. ``rules`` is a short list
    that the caller gives; of rules of one length the first counts.
    """
    fit = F.lit(None).cast("struct<rule:string,verdict:string>")
    for site, prefix, verdict in reversed(sorted(rules, key=lambda r: -len(r[0] + r[1]))):
        here = ((host == site) | host.endswith("." + site)) & path.startswith(prefix)
        fit = F.when(here, F.struct(F.lit(site + prefix).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(fit)
    return fit


def url_tokens(url: Column) -> Column:
    """Distinct tokens: scheme, every suffix of the host, path parts, query keys, a fragment mark.

    Digits are replaced by one sign, so that numbered addresses share their tokens; no URL is without a
    token, and a null url has the token of an empty one.
    """
    url = F.coalesce(url, F.lit(""))
    blur = lambda c: F.regexp_replace(c, "[0-9]+", "#")
    parts = F.split(host_of(url), r"\.")
    hosts = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.concat(F.lit("host="), F.array_join(F.slice(parts, i, F.size(parts)), ".")))
    segments = F.filter(F.split(path_of(url), "/"), lambda s: s != "")
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    keys = F.filter(F.transform(F.split(query, "&"), lambda q: F.split(q, "=")[0]), lambda k: k != "")
    named = lambda name, values: F.transform(values, lambda v: F.concat(F.lit(name), blur(v)))
    scheme = F.concat(F.lit("scheme="), F.regexp_extract(url, "(?s)^(.*?)://", 1))
    mark = F.when(url.contains("#"), F.array(F.lit("fragment"))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(F.array(scheme), hosts, named("path=", segments), named("query=", keys), mark))


def _items(held: DataFrame, least: int) -> DataFrame:
    """(token, item, n) of the tokens that ``least`` rows of ``held(row, has)`` have.

    Tokens with the same rows, told by the number and two sums of the rows' hashes, have one item: the
    first of their names.
    """
    wide = lambda *c: F.sum(F.xxhash64(*c).cast("decimal(20,0)"))
    each = held.select("row", F.explode("has").alias("token"))
    tokens = each.groupBy("token").agg(F.count("*").alias("n"), wide("row").alias("a"), wide("row", F.lit(1)).alias("b")).where(F.col("n") >= least)
    names = tokens.groupBy("n", "a", "b").agg(F.min("token").alias("item"))
    return tokens.join(names, ["n", "a", "b"]).select("token", "item", "n")


def mine_rules(pages: DataFrame, labels: DataFrame, support: float = SUPPORT, least: int = LEAST, confidence: float = CONFIDENCE) -> DataFrame:
    """(items, tokens, filed, confidence): rules mined from the labelled pages, a row for each token they are filed under.

    A page is bad if it is labelled as of low quality or toxic; labels with nulls in both count for nothing,
    several labels of one page as bad if one is, and rows that repeat a page_id and url as one. Support and
    confidence prune, and a rule goes if a shorter one within it is as confident. Without labelled pages
    there are no rules.
    """
    bad = F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))
    marks = labels.where("doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL)").groupBy("doc_id").agg(F.max(bad).alias("bad"))
    held = pages.select("page_id", "url").distinct().join(marks, F.col("page_id") == F.col("doc_id"))
    held = held.select(F.struct("page_id", "url").alias("row"), "bad", url_tokens(F.col("url")).alias("has"))
    n = held.count()
    empty = pages.sparkSession.createDataFrame([], "items array<string>, tokens array<array<string>>, filed string, confidence double")
    if not n:
        return empty
    share = min(1.0, max(support, least / n))
    items = cut(_items(held, min(n, math.ceil(share * n))), "items")
    named = held.select("row", F.explode("has").alias("token")).join(items, "token").groupBy("row").agg(F.collect_set("item").alias("items"))
    mark = F.array(F.when(F.col("bad"), BAD).otherwise(GOOD))
    baskets = held.join(named, "row", "left").select(F.concat(F.coalesce("items", F.array().cast("array<string>")), mark).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=share, minConfidence=confidence).fit(baskets)
    rules = model.associationRules.where(F.array_contains("consequent", BAD)).select(F.array_sort("antecedent").alias("items"), "confidence")
    # the tokens of one item all come from one URL, so their list is no longer than that
    single = items.groupBy(F.col("item").alias("filed")).agg(F.max("n").alias("n"), F.array_sort(F.collect_list("token")).alias("tokens"))
    each = rules.select("*", F.explode("items").alias("filed")).join(single, "filed")
    filed = cut(
        each.groupBy("items").agg(
            F.min_by("filed", F.struct("n", "filed")).alias("filed"), F.max("confidence").alias("confidence"),
            F.array_sort(F.collect_list("tokens")).alias("tokens"), F.min_by("tokens", F.struct("n", "filed")).alias("under"),
        ),
        "rules",
    )
    a, b = filed.alias("a"), filed.alias("b")
    within = F.expr("size(b.items) < size(a.items) AND size(array_except(b.items, a.items)) = 0 AND b.confidence >= a.confidence")
    heads = a.select("a.*", F.explode("a.items").alias("head")).alias("a")
    needless = heads.join(b, F.expr("a.head = b.filed") & within).select(F.col("a.items").alias("items")).distinct()
    return filed.join(needless, "items", "left_anti").select("items", "tokens", F.explode("under").alias("filed"), "confidence")


def blocked_urls(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The distinct ``url`` values of ``urls`` on which a rule fires (a null url as the empty one)."""
    tokens = urls.select(F.coalesce("url", F.lit("")).alias("url")).distinct().select("url", url_tokens(F.col("url")).alias("has"))
    fetched = tokens.select("url", "has", F.explode("has").alias("filed")).join(rules.select("filed", "tokens"), "filed")
    return fetched.where(F.forall("tokens", lambda some: F.arrays_overlap(some, "has"))).select("url").distinct()


def judge_urls(pages: DataFrame, labels: DataFrame, site_rules=SITE_RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages(page_id, url)``.

    The longest site rule decides; where none fits, a URL on which a mined rule fires is blocked and all others
    are allowed. Null urls have an empty host and path; repeated rows and null page_ids stay; an
    empty table gives an empty result. Other columns are not read.
    """
    rules = mine_rules(pages, labels)
    blocked = blocked_urls(pages, rules).select(F.col("url").alias("bad_url"))
    url = F.col("url")
    rows = pages.select("page_id", "url").join(blocked, F.coalesce("url", F.lit("")) == F.col("bad_url"), "left")
    parts = rows.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), F.col("bad_url").isNotNull().alias("mined"))
    fit = parts.withColumn("fit", site_rule(F.col("host"), F.col("path"), site_rules))
    other = F.when(F.col("mined"), F.lit("block")).otherwise(F.lit("allow"))
    return fit.select("page_id", "host", "path", F.col("fit.rule").alias("rule"), F.coalesce("fit.verdict", other).alias("verdict"))
