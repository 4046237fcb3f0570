"""Queries over the text, date, duration, URL and list functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from larder.functions import dates as D
from larder.functions import ingredients as I
from larder.functions import text as X
from larder.functions import urls as U
from larder.queries import query
from larder.queries.tables import _t, orders_with_lines, table


def _messy():
    return F.concat(
        F.lit("\t \n"), F.replace(F.col("text"), F.lit(" "), F.lit(" \t ")), F.lit("  \n")
    )


MESSY_SQL = "chr(9) || ' ' || chr(10) || replace(text, ' ', ' ' || chr(9) || ' ') || chr(160) || ' ' || chr(10)"


@query(
    f"SELECT doc_id, trim(regexp_replace({MESSY_SQL}, '[ \\t\\n\\r\\f\\x0b]+', ' ', 'g'), ' ' || chr(160)) AS clean FROM documents"
)
def q_clean_string(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.clean_string(_messy()).alias("clean"))


@query(
    f"SELECT doc_id, md5(trim(regexp_replace({MESSY_SQL}, '[ \\t\\n\\r\\f\\x0b]+', ' ', 'g'), ' ' || chr(160))) AS digest FROM documents"
)
def q_trim_whitespace(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", F.md5(X.trim_whitespace(_messy())).alias("digest")
    )


@query(
    r"SELECT page_id, regexp_replace(html, '<!--.*?-->|</?[A-Za-z][^>]*>|<![^>]*>', '', 'gs') AS text FROM pages"
)
def q_strip_html(spark, sf):
    return table(spark, sf, "pages").select("page_id", X.strip_html("html").alias("text"))


@query(
    """SELECT doc_id, coalesce(list_filter(string_split(text, chr(10)), lambda x: x <> '')[1], '') AS first_line,
       string_split(text, chr(10))[1] AS flat FROM documents"""
)
def q_take_first(spark, sf):
    lines = F.concat(F.array(F.lit(""), F.lit(None).cast("string")), F.split("text", "\n", -1))
    return table(spark, sf, "documents").select(
        "doc_id",
        F.coalesce(X.take_first(lines), F.lit("")).alias("first_line"),
        X.flatten_value(F.split("text", "\n", -1)).alias("flat"),
    )


@query(
    """SELECT doc_id, CAST(len(w) AS BIGINT) AS n, CAST(len(list_distinct(w)) AS BIGINT) AS n_distinct
       FROM (SELECT doc_id, string_split(text, ' ') AS w FROM documents) t"""
)
def q_distinct_list(spark, sf):
    words = F.split("text", " ", -1)
    return table(spark, sf, "documents").select(
        "doc_id",
        F.size(words).cast("long").alias("n"),
        F.size(X.distinct_list(words)).cast("long").alias("n_distinct"),
    )


HEADED_SQL = """(SELECT doc_id, list_concat(list_concat(['Ingredients', 'INGREDIENT list:', 'For the ' || lang, 'Sauce:', '  ', 'For'],
  string_split(text, chr(10))), ['My ingredients']) AS lines FROM documents) t"""


def _headed():
    return F.concat(
        F.array(
            F.lit("Ingredients"), F.lit("INGREDIENT list:"), F.concat(F.lit("For the "), "lang"),
            F.lit("Sauce:"), F.lit("  "), F.lit("For"),
        ),
        F.split("text", "\n", -1),
        F.array(F.lit("My ingredients")),
    )


@query(
    f"""SELECT doc_id, array_to_string(list_filter(lines, lambda x: NOT contains(lower(x), 'ingredient')), chr(10)) AS kept FROM {HEADED_SQL}"""
)
def q_drop_headers(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", F.array_join(X.drop_header_lines(_headed()), "\n").alias("kept")
    )


@query(
    f"""SELECT doc_id, array_to_string(list_filter(list_transform(lines, lambda x: trim(x)),
       lambda x: NOT starts_with(x, 'For ') AND NOT ends_with(x, ':') AND x <> ''), chr(10)) AS kept FROM {HEADED_SQL}"""
)
def q_drop_labels(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", F.array_join(X.drop_labels(_headed()), "\n").alias("kept")
    )


@query(
    """SELECT doc_id, array_to_string(list_transform(list_filter(string_split(text, chr(10)), lambda x: x <> ''),
       lambda x: '- ' || trim(x)), chr(10)) AS mapped FROM documents"""
)
def q_map_drop(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id",
        F.array_join(
            X.map_drop(
                F.split("text", "\n", -1), lambda x: F.nullif(x, F.lit("")), X.strip_edges, lambda x: F.concat(F.lit("- "), x)
            ),
            "\n",
        ).alias("mapped"),
    )


@query(
    r"SELECT doc_id, trim(regexp_replace(text, '[ \n]+', ' ', 'g')) AS squashed FROM documents"
)
def q_squash(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", X.squash(F.split(F.regexp_replace("text", "\n", "\n\u0001"), "\u0001", -1)).alias("squashed")
    )


# --- dates and durations ------------------------------------------------------------------


def _written_dates():
    d = F.col("o_orderdate")
    day = F.dayofmonth(d)
    ordinal = F.when(day.isin(1, 21, 31), "st").when(day.isin(2, 22), "nd").when(
        day.isin(3, 23), "rd"
    ).otherwise("th")
    styles = {
        "iso": F.date_format(d, "yyyy-MM-dd"),
        "stamp": F.date_format(d, "yyyy-MM-dd'T'HH:mm:ss'+00:00'"),
        "long": F.date_format(d, "MMMM d yyyy"),
        "weekday": F.concat(
            F.date_format(d, "EEEE"), F.lit(", "), F.date_format(d, "MMM d"), ordinal, F.lit(", "), F.date_format(d, "yyyy")
        ),
        "british": F.date_format(d, "d MMMM yyyy"),
        "slashes": F.date_format(d, "M/d/yyyy"),
        "relative": F.lit("2 months ago"),
        "invalid": F.date_format(d, "yyyy-'13'-dd"),
    }
    return F.explode(
        F.array(*[F.struct(F.lit(k).alias("style"), v.alias("phrase")) for k, v in styles.items()])
    )


DATES_SQL = """SELECT o_orderkey, style,
  CASE WHEN style IN ('relative', 'invalid') THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day
FROM orders, (VALUES ('iso'), ('stamp'), ('long'), ('weekday'), ('british'), ('slashes'), ('relative'), ('invalid')) s(style)"""


@query(DATES_SQL)
def q_iso_date(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", _written_dates().alias("w"))
    return rows.select(
        "o_orderkey", F.col("w.style").alias("style"), D.iso_date("w.phrase").alias("day")
    )


@query(
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS calendar, strftime(o_orderdate, '%Y-%m-%d') AS compact,
       strftime(o_orderdate, '%Y-%m-%d') AS week, strftime(o_orderdate, '%Y-%m-%d') AS ordinal,
       strftime(o_orderdate, '%Y-%m-01') AS month, CAST(NULL AS VARCHAR) AS text FROM orders"""
)
def q_parse_iso_date(spark, sf):
    d = F.col("o_orderdate")
    thursday = F.date_add(d.cast("date"), F.lit(3) - F.weekday(d))
    forms = {
        "calendar": F.date_format(d, "yyyy-MM-dd"),
        "compact": F.date_format(d, "yyyyMMdd"),
        "week": _t(F.year(thursday), "-W", F.lpad(F.weekofyear(d).cast("string"), 2, "0"), "-", F.weekday(d) + 1),
        "ordinal": _t(F.year(d), "-", F.lpad(F.dayofyear(d).cast("string"), 3, "0")),
        "month": F.date_format(d, "yyyy-MM"),
        "text": F.date_format(d, "MMMM d yyyy"),
    }
    return table(spark, sf, "orders").select(
        "o_orderkey", *[D.parse_iso_date(v).cast("string").alias(k) for k, v in forms.items()]
    )


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey,
       CASE WHEN q % 60 = 0 THEN 'PT' || CAST(q // 60 AS VARCHAR) || 'H' WHEN q < 60 THEN 'PT' || CAST(q AS VARCHAR) || 'M'
            ELSE 'PT' || CAST(q // 60 AS VARCHAR) || 'H' || CAST(q % 60 AS VARCHAR) || 'M' END AS minutes,
       'PT' || CAST(l_linenumber AS VARCHAR) || 'H' || CAST(p AS VARCHAR) || 'M' AS both,
       'P' || CAST(l_linenumber AS VARCHAR) || 'DT' || CAST(p AS VARCHAR) || 'S' AS days,
       'PT' || CAST(q AS VARCHAR) || 'M' AS iso, CAST(NULL AS VARCHAR) AS twice, CAST(NULL AS VARCHAR) AS months
       FROM (SELECT *, CAST(l_quantity AS BIGINT) * 5 AS q, CAST(l_quantity AS BIGINT) % 59 + 1 AS p FROM lineitem) t"""
)
def q_iso_duration(spark, sf):
    q = F.col("l_quantity").cast("long") * 5
    p = F.col("l_quantity").cast("long") % 59 + 1
    n = F.col("l_linenumber")
    phrases = {
        "minutes": _t(q, " minutes"),
        "both": _t(n, " hours ", p, " min"),
        "days": _t(n, " day, ", p, " secs"),
        "iso": _t("PT", q, "M"),
        "twice": _t("PT", q, "MPT", q, "M"),
        "months": _t(n, " months"),
    }
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        *[D.iso_duration(v).alias(k) for k, v in phrases.items()],
    )


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, CAST(q AS BIGINT) * 60 AS minutes,
       CAST(l_linenumber AS BIGINT) * 86400 + q * 3600 AS days, CAST(l_linenumber AS BIGINT) * 604800 AS weeks,
       CAST(NULL AS BIGINT) AS years, CAST(NULL AS BIGINT) AS twice
       FROM (SELECT *, CAST(l_quantity AS BIGINT) AS q FROM lineitem) t"""
)
def q_parse_iso_duration(spark, sf):
    q, n = F.col("l_quantity").cast("long"), F.col("l_linenumber")
    phrases = {
        "minutes": _t("PT", q, "M"),
        "days": _t("P", n, "DT", q, "H"),
        "weeks": _t("P", n, "W"),
        "years": _t("P", n, "Y"),
        "twice": _t("PT", q, "HPT", q, "H"),
    }

    def seconds(c):
        i = D.parse_iso_duration(c)
        return F.extract(F.lit("DAY"), i).cast("long") * 86400 + (
            F.extract(F.lit("HOUR"), i).cast("long") * 3600
            + F.extract(F.lit("MINUTE"), i).cast("long") * 60
            + F.extract(F.lit("SECOND"), i).cast("long")
        )

    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        *[seconds(v).alias(k) for k, v in phrases.items()],
    )


# --- URLs ---------------------------------------------------------------------------------

PARTS_SQL = r"""(SELECT page_id, url, regexp_extract(url, '^[a-z]+://[^/?#]*', 0) AS origin,
  regexp_extract(url, '^[^?#]*', 0) AS document, regexp_replace(url, '#.*$', '') AS whole,
  regexp_replace(regexp_extract(url, '^[^?#]*', 0), '[^/]*$', '') AS folder FROM pages) t"""


@query(
    rf"""SELECT page_id, origin || '/a/b?x=1' AS rooted, folder || 'c.html' AS relative,
        document || '?page=3' AS query, whole || '#end' AS fragment, url AS empty,
        regexp_extract(url, '^[a-z]+:', 0) || '//cdn.example.com/i.png' AS protocol, 'mailto:a@b.c' AS scheme,
        regexp_replace(folder, '[^/]*/$', '') || 'up' AS parent, folder || 'here' AS dot,
        (url LIKE '%//%') AS absolute FROM {PARTS_SQL}"""
)
def q_resolve_url(spark, sf):
    refs = {
        "rooted": "/a/b?x=1", "relative": "c.html", "query": "?page=3", "fragment": "#end", "empty": "",
        "protocol": "//cdn.example.com/i.png", "scheme": "mailto:a@b.c", "parent": "../up", "dot": "./here",
    }
    return table(spark, sf, "pages").select(
        "page_id",
        *[U.resolve_url("url", F.lit(r)).alias(k) for k, r in refs.items()],
        U.is_absolute("url").alias("absolute"),
    )


@query(
    "SELECT page_id, 'http:' || substr(url, instr(url, '//')) AS fixed, url AS kept FROM pages"
)
def q_protocol_relative(spark, sf):
    relative = F.regexp_replace("url", "^https?:", "")
    return table(spark, sf, "pages").select(
        "page_id",
        U.fix_protocol_relative(relative).alias("fixed"),
        U.fix_protocol_relative("url").alias("kept"),
    )


@query(
    "SELECT page_id, replace(url, '.example.', '_lg.example.') || '_lg.jpg' AS image, "
    "regexp_replace(url, '/[^/]*$', '') || '/photo.jpg' AS in_folder FROM pages"
)
def q_image_rewrite(spark, sf):
    medium = F.concat(
        F.replace(F.col("url"), F.lit(".example."), F.lit("_med.example.")), F.lit("_med.jpg")
    )
    return table(spark, sf, "pages").select(
        "page_id",
        X.replace_literal(medium, "_med.", "_lg.").alias("image"),
        U.page_folder_join("url", F.lit("photo.jpg")).alias("in_folder"),
    )


# --- ingredients and phrases --------------------------------------------------------------


def _scored(spark, sf):
    o = orders_with_lines(spark, sf)
    lines = F.transform("lines", lambda x: F.concat_ws(" ", x["qty"], x["part"]))
    extra = F.array(F.lit("1st step"), F.lit(" Salt "), F.col("o_orderpriority"), F.lit("7. heat"))
    texts = F.concat(F.when(F.col("o_orderstatus") == "O", F.array(F.lit("to serve"))).otherwise(extra), lines)
    return o.select("o_orderkey", texts.alias("texts"))


# lines are all alike; of the four extra texts "Salt" and the priority ("1-URGENT") count, the
# ordinal and the numbered step do not. A line whose quantity has one digit counts only
# because a character other than a dot follows.
SCORED_SQL = """(SELECT o_orderkey, o_orderstatus, CAST(coalesce(n, 0) AS DOUBLE) AS n FROM orders
  LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1) l ON l_orderkey = o_orderkey) t"""
SCORE_SQL = "CASE WHEN o_orderstatus = 'O' THEN n / (n + 1) ELSE (n + 2) / (n + 4) END"


@query(f"SELECT o_orderkey, {SCORE_SQL} AS score FROM {SCORED_SQL}")
def q_ingredient_score(spark, sf):
    return _scored(spark, sf).select("o_orderkey", I.ingredient_score("texts").alias("score"))


@query(
    f"""SELECT o_orderkey, {SCORE_SQL} > CAST(2 AS DOUBLE) / 3 AS is_list,
        CASE WHEN o_orderstatus = 'O' THEN n > 0 ELSE true END AS any_match FROM {SCORED_SQL}"""
)
def q_ingredient_containers(spark, sf):
    return _scored(spark, sf).select(
        "o_orderkey",
        I.is_ingredient_container("texts").alias("is_list"),
        I.is_ingredient_container("texts", 0.0, I.INGREDIENT_START_SHORT, None).alias("any_match"),
    )


@query(
    r"""SELECT doc_id, CAST(len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(trim(x),
        '^(\d+[^\.]|salt|garlic|pine|parmesan|pepper|few|handful|pinch|some|dash)', 'i')
        AND NOT regexp_matches(trim(x), '^\d(st|nd|rd|th)'))) AS DOUBLE) / len(string_split(text, chr(10))) AS score FROM documents"""
)
def q_ingredient_score_lines(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", I.ingredient_score(F.split("text", "\n", -1)).alias("score")
    )


@query(
    """SELECT l_orderkey, array_to_string(list_transform(range(1, CAST(len(p) AS BIGINT)),
         lambda i: q[i] || ' ' || p[i + 1]), '|') AS zipped, array_to_string(pairs, '|') AS paired
       FROM (SELECT l_orderkey, list(q ORDER BY l_linenumber, l_partkey, l_extendedprice) AS q,
               list(p_name ORDER BY l_linenumber, l_partkey, l_extendedprice) AS p,
               list(CASE WHEN l_returnflag = 'N' THEN p_name ELSE q || ' ' || p_name END ORDER BY l_linenumber, l_partkey, l_extendedprice) AS pairs
             FROM (SELECT *, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS q FROM lineitem JOIN part ON l_partkey = p_partkey) x
             GROUP BY 1) t"""
)
def q_zip_ingredients(spark, sf):
    item = table(spark, sf, "lineitem").join(
        table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey")
    )
    qty = F.col("l_quantity").cast("long").cast("string")
    rows = item.groupBy("l_orderkey").agg(
        F.array_sort(
            F.collect_list(
                F.struct("l_linenumber", "l_partkey", "l_extendedprice", qty.alias("qty"), "p_name", "l_returnflag")
            )
        ).alias("x")
    )
    amounts = F.transform("x", lambda r: r["qty"])
    some = F.transform("x", lambda r: F.when(r["l_returnflag"] != "N", r["qty"]))
    names = F.transform("x", lambda r: r["p_name"])
    later = F.slice(names, F.lit(2), F.greatest(F.size(names) - 1, F.lit(0)))
    return rows.select(
        "l_orderkey",
        F.array_join(I.assemble_ingredients(amounts, later, "zip"), "|").alias("zipped"),
        F.array_join(I.assemble_ingredients(some, names, "pair"), "|").alias("paired"),
    )


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, q || ' servings ' AS serves, q || ' minutes ' AS prep,
       l_linenumber || ' hours' AS cook, CAST(NULL AS VARCHAR) AS no_yield, q || ' minutes' AS timed_prep,
       l_linenumber || ' hours' AS timed_cook, CAST(NULL AS VARCHAR) AS odd_unit, 'minutes ' || q AS rest
       FROM (SELECT *, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS q FROM lineitem) t"""
)
def q_labelled_values(spark, sf):
    q, n = F.col("l_quantity").cast("long"), F.col("l_linenumber")
    line = _t("Yields: ", q, " servings | Prep Time: ", q, " minutes | Cook Time: ", n, " hours")
    timed = _t("Prep Time: ", q, " minutes Cook Time: ", n, " hours")
    a, b, c = X.labelled_values(line), X.labelled_values(_t("About ", line)), X.timed_values(timed)
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        a["recipeYield"].alias("serves"), a["prepTime"].alias("prep"), a["cookTime"].alias("cook"),
        b["recipeYield"].alias("no_yield"),
        c["prepTime"].alias("timed_prep"), c["cookTime"].alias("timed_cook"),
        X.timed_values(_t("Prep Time: ", q, " moments"))["prepTime"].alias("odd_unit"),
        X.after_first_space(_t("Prep minutes ", q)).alias("rest"),
    )


@query(
    """SELECT o_orderkey, day AS on_day, day AS posted, day AS after_bar, '' AS no_bar
       FROM (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders) t"""
)
def q_date_phrase(spark, sf):
    long = F.date_format("o_orderdate", "MMMM d, yyyy")
    phrases = {
        "on_day": X.clean_date_phrase(_t("on ", long, " |"), "on"),
        "posted": X.clean_date_phrase(_t("Posted on ", long, " in "), "posted"),
        "after_bar": X.clean_date_phrase(_t("Magazine | ", long), "bar"),
    }
    return table(spark, sf, "orders").select(
        "o_orderkey",
        *[D.iso_date(v).alias(k) for k, v in phrases.items()],
        X.clean_date_phrase(_t("no bar", long), "bar").alias("no_bar"),
    )


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, 'Makes ' || q AS phrase, 'Makes' AS alone,
       'Serves ' || CAST(CAST(q AS BIGINT) % 10 AS VARCHAR) || '.' AS serves
       FROM (SELECT *, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS q FROM lineitem) t"""
)
def q_yield_phrase(spark, sf):
    q = F.col("l_quantity").cast("long")
    texts = F.array(F.lit("Mix well."), _t("Serves ", q % 10, ". Enjoy"))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        X.yield_phrase(F.lit(" Makes "), q.cast("string")).alias("phrase"),
        X.yield_phrase(F.lit("Makes"), F.lit(None).cast("string")).alias("alone"),
        F.array_join(X.serves_phrases(texts), ",").alias("serves"),
    )
