"""Semantic markup extractors: microdata items, flat item properties, hRecipe.

All functions map a page's node array to an array of raw records (see ``records``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions import nodes as N
from larder.functions import text as X
from larder.functions.urls import is_absolute
from larder.operators.records import prefer_image, raw_struct
from larder.schema import NUTRITION_FIELDS

SCHEMA_ORG = "http://schema.org/Recipe"
SCHEMA_ORG_LOWER = "http://schema.org/recipe"
DATA_VOCABULARY = "http://data-vocabulary.org/Recipe"

# Record field -> data-vocabulary property.
DATA_VOCABULARY_NAMES = {
    "name": "name",
    "description": "summary",
    "creator": "author",
    "datePublished": "published",
    "dateCreated": "dateCreated",
    "recipeYield": "yield",
    "cookTime": "cookTime",
    "prepTime": "prepTime",
    "totalTime": "totalTime",
    "recipeCategory": "recipeType",
    "recipeInstructions": "instructions",
}
DATA_VOCABULARY_NUTRITION = {
    "calories": "calories",
    "carbohydrateContent": "carbohydrate",
    "cholesterolContent": "cholesterol",
    "fatContent": "fatContent",
    "fiberContent": "fiber",
    "proteinContent": "protein",
    "saturatedFatContent": "saturatedFat",
    "servingSize": "servingSize",
    "sodiumContent": "sodium",
    "sugarContent": "sugar",
    "transFatContent": "transFat",
    "unsaturatedFatContent": "unsaturatedFat",
}
# Schema.org properties that keep their name in the record.
SCHEMA_ORG_NAMES = [
    "name", "description", "creator", "datePublished", "dateCreated", "recipeYield", "cookTime",
    "prepTime", "totalTime", "recipeInstructions",
]

# Elements whose microdata value is an attribute.
VALUE_ATTRIBUTES = {
    "content": ["meta"],
    "src": ["audio", "embed", "iframe", "img", "source", "track", "video"],
    "href": ["a", "area", "link"],
}

# Attribute that holds the value of a flat item property.
FLAT_ATTRIBUTES = {
    "photo": "src",
    "image": "src",
    "url": "href",
    "prepTime": "content",
    "cookTime": "content",
    "totalTime": "content",
    "datePublished": "content",
}

# Record field -> hRecipe class.
HRECIPE_CLASSES = {
    "name": "fn",
    "recipeYield": "yield",
    "description": "summary",
    "prepTime": "preptime",
    "cookTime": "cooktime",
}


def property_value(nodes: Column, n: Column) -> Column:
    """Microdata value of an element, by its tag."""
    value = F.when(
        (n["tag"] == "time") & N.attr(n, "datetime").isNotNull(), N.attr(n, "datetime")
    )
    for name, tags in VALUE_ATTRIBUTES.items():
        value = value.when(n["tag"].isin(*tags), F.coalesce(N.attr(n, name), F.lit("")))
    return value.otherwise(N.joined_text(nodes, n))


def microdata_marks(nodes: Column) -> Column:
    """The few nodes that carry microdata, one entry per property name.

    The page is scanned once; all further look-ups run over this short list. A property
    belongs to its nearest enclosing item, which the shredder has already noted.
    """

    def entries(ns: Column, n: Column) -> Column:
        # nearly all hold one name, NULL among them: no pattern is compiled to cut those
        names = F.when(
            N.attr(n, "itemprop").rlike(r"\s"), F.split(F.trim(N.attr(n, "itemprop")), r"\s+")
        ).otherwise(F.array(N.attr(n, "itemprop")))
        scoped = N.attr(n, "itemscope").isNotNull()
        value = F.when(N.attr(n, "itemprop").isNotNull(), property_value(ns, n))
        return F.transform(
            names,
            lambda name: F.struct(
                n["pos"].alias("pos"),
                n["end"].alias("end"),
                n["item"].alias("item"),
                name.alias("name"),
                F.trim(N.attr(n, "itemtype")).alias("itemtype"),
                scoped.alias("scoped"),
                value.alias("value"),
            ),
        )

    def of_page(ns: Column) -> Column:
        found = F.filter(
            ns, lambda n: N.attr(n, "itemprop").isNotNull() | N.attr(n, "itemscope").isNotNull()
        )
        return F.flatten(F.transform(found, lambda n: entries(ns, n)))

    return X.let(N.held(nodes), of_page)


def _named(props: Column, name: str | Column) -> Column:
    return F.filter(props, lambda p: p["name"] == name)


def _values(props: Column, name: str | Column) -> Column:
    return F.transform(_named(props, name), lambda p: p["value"])


def _members(marks: Column, owner: Column) -> Column:
    """Properties of a nested item; none when there is no such item."""
    return F.filter(marks, lambda m: m["item"] == owner["pos"])


def _nested(props: Column, name: str) -> Column:
    return F.get(F.filter(props, lambda p: (p["name"] == name) & p["scoped"]), F.lit(0))


def _first(props: Column, name: str) -> Column:
    return F.get(_named(props, name), F.lit(0))["value"]


def by_name(props: Column) -> Column:
    """MAP property -> values in document order, so that each field is one look-up."""
    names = F.array_distinct(F.transform(props, lambda p: p["name"]))
    return X.let(
        names, lambda ns: F.map_from_arrays(ns, F.transform(ns, lambda n: _values(props, n)))
    )


def _nested_by_name(marks: Column, props: Column, name: str) -> Column:
    """``by_name`` of the nested item that a property opens. The item and its properties are bound, or they
    would be looked up again for every mark and every name."""
    return X.let(_nested(props, name), lambda owner: X.let(_members(marks, owner), by_name))


def _get(props: Column, name: str) -> Column:
    return F.try_element_at(props, F.lit(name))


def _head(values: Column) -> Column:
    return F.get(values, F.lit(0))


def _schema_org(own: Column, nutrition: Column, rating: Column, page_url: Column, og: Column) -> dict:
    url = _head(_get(own, "url"))
    return {
        **{f: _get(own, f) for f in SCHEMA_ORG_NAMES},
        **{f: _get(nutrition, f) for f in NUTRITION_FIELDS},
        "aggregateRating": _get(rating, "ratingValue"),
        "image": prefer_image(_get(own, "image"), og),
        "url": F.array(F.when(is_absolute(url), url).otherwise(page_url)),
        "ingredients": X.distinct_list(_get(own, "ingredients")),
        "recipeCategory": X.distinct_list(_get(own, "recipeCategory")),
    }


def _data_vocabulary(
    own: Column, nutrition: Column, rating: Column, page_url: Column, og: Column, ingredients: Column
) -> dict:
    return {
        **{f: _get(own, name) for f, name in DATA_VOCABULARY_NAMES.items()},
        **{f: _get(nutrition, name) for f, name in DATA_VOCABULARY_NUTRITION.items()},
        "aggregateRating": _get(rating, "ratingValue"),
        "image": prefer_image(_get(own, "photo"), og, always=True),
        "url": F.array(F.coalesce(_head(_get(own, "url")), page_url)),
        "ingredients": ingredients,
    }


def _ingredient(marks: Column, p: Column) -> Column:
    """Text of a data-vocabulary ingredient: amount and name, missing parts skipped."""

    def joined(parts: Column) -> Column:
        return F.concat_ws(" ", _first(parts, "amount"), _first(parts, "name"))

    return F.when(p["scoped"], X.let(_members(marks, p), joined)).otherwise(p["value"])


def microdata_records(nodes: Column, page_url: Column) -> Column:
    """Top-level microdata items as raw records; an unknown item type gives an empty one."""
    og = N.meta_values(N.select_tag(nodes, "meta"), "property", "og:image")

    def item(marks: Column, top: Column, og_images: Column) -> Column:
        own = _members(marks, top)

        def record(props: Column) -> Column:
            return X.let(
                F.struct(
                    by_name(props).alias("own"),
                    _nested_by_name(marks, props, "nutrition").alias("nutrition"),
                    _nested_by_name(marks, props, "aggregateRating").alias("rating"),
                    F.transform(
                        _named(props, "ingredient"), lambda p: _ingredient(marks, p)
                    ).alias("ingredients"),
                ),
                typed,
            )

        def typed(g: Column) -> Column:
            shared = (g["own"], g["nutrition"], g["rating"], page_url, og_images)
            return (
                F.when(top["itemtype"] == SCHEMA_ORG, raw_struct(_schema_org(*shared)))
                .when(
                    top["itemtype"] == DATA_VOCABULARY,
                    raw_struct(_data_vocabulary(*shared, g["ingredients"])),
                )
                .otherwise(raw_struct({}))
            )

        return X.let(F.filter(own, lambda m: m["name"].isNotNull()), record)

    def page_records(marks: Column) -> Column:
        tops = F.filter(marks, lambda m: m["scoped"] & m["name"].isNull())
        return F.when(
            F.size(tops) > 0,
            X.let(og, lambda o: F.transform(tops, lambda t: item(marks, t, o))),
        )

    return X.let(microdata_marks(nodes), page_records)


def microdata_items(shredded: DataFrame, keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """Top-level items of every page with their (also nested) properties, one row per
    property: item, item type, property, value. Rows of properties that open a nested item
    carry that item's type."""
    marks = shredded.select(*keep, microdata_marks(F.col("nodes")).alias("marks"))
    tops = marks.select(
        *keep,
        "marks",
        F.explode(F.filter("marks", lambda m: m["scoped"] & m["name"].isNull())).alias("top"),
    )
    inside = F.filter(
        "marks",
        lambda m: m["name"].isNotNull()
        & (m["pos"] > F.col("top.pos"))
        & (m["pos"] <= F.col("top.end")),
    )
    rows = tops.select(*keep, "top", F.explode(inside).alias("p"))
    return rows.select(
        *keep,
        F.col("top.pos").alias("item"),
        F.col("top.itemtype").alias("itemtype"),
        F.col("p.item").alias("owner"),
        F.col("p.pos").alias("pos"),
        F.col("p.name").alias("property"),
        F.when(F.col("p.scoped"), F.col("p.itemtype")).alias("nested_type"),
        F.col("p.value").alias("value"),
    )


def flat_itemprop_records(
    nodes: Column,
    page_url: Column,
    itemtype: str = SCHEMA_ORG,
    join: str = " ",
    og_url: bool = True,
) -> Column:
    """Second schema.org reading: every element of the item type is a record, its
    properties are those with no nested item on the way.

    ``og_url``: the page's og:url values come first as the record URL (the page URL is not
    used); otherwise the page URL does.
    """

    def value(ns: Column, n: Column) -> Column:
        name = N.attr(n, "itemprop")
        out = None
        for prop, attribute in FLAT_ATTRIBUTES.items():
            v = F.coalesce(N.attr(n, attribute), F.lit(""))
            out = F.when(name == prop, v) if out is None else out.when(name == prop, v)
        joined = F.array_join(N.nonblank(N.deep_text(ns, n)), join)
        out = out.otherwise(joined)
        return X.clean_string(out) if join else X.strip_edges(out)

    def props(ns: Column, root: Column) -> Column:
        # An ancestor item strictly between the root and the node has a larger position
        # than the root.
        own = F.filter(
            N.subtree(ns, root),
            lambda n: N.attr(n, "itemprop").isNotNull()
            & N.attr(n, "itemscope").isNull()
            & (n["item"] <= root["pos"]),
        )
        return F.transform(
            own, lambda n: F.struct(N.attr(n, "itemprop").alias("name"), value(ns, n).alias("value"))
        )

    lead = (
        N.meta_values(N.select_tag(nodes, "meta"), "property", "og:url")
        if og_url
        else F.array(page_url)
    )

    def record(p: Column) -> Column:
        image = _get(p, "image")
        fields = {
            f: _get(p, f)
            for f in [
                *SCHEMA_ORG_NAMES,
                *NUTRITION_FIELDS,
                "aggregateRating",
                "dateModified",
                "keywords",
                "cookingMethod",
                "recipeCuisine",
                "recipeDiet",
                "ingredients",
                "recipeCategory",
            ]
        }
        fields["image"] = (
            F.when(F.size(image) > 0, image).otherwise(_get(p, "photo")) if join else image
        )
        none = F.expr("cast(array() as array<string>)")
        fields["url"] = F.concat(lead, F.coalesce(_get(p, "url"), none))
        return raw_struct(fields)

    def records(ns: Column) -> Column:
        roots = F.filter(ns, lambda n: N.attr(n, "itemtype") == itemtype)
        return F.transform(roots, lambda r: X.let(props(ns, r), lambda p: X.let(by_name(p), record)))

    return X.let(N.held(nodes), records)


def lower_itemprop_records(nodes: Column, page_url: Column) -> Column:
    """The lower-case item type variant: texts joined without a separator, page URL kept,
    protocol-relative images completed."""
    records = flat_itemprop_records(nodes, page_url, SCHEMA_ORG_LOWER, join="", og_url=False)
    return F.transform(
        records,
        lambda r: r.withField(
            "image",
            F.transform(r["image"], lambda v: F.regexp_replace(v, r"^//", "http://")),
        ),
    )


def hrecipe_records(nodes: Column, page_url: Column) -> Column:
    """hRecipe microformat: one record per page, fields by class below the recipe root."""

    def record(ns: Column, scope: Column) -> Column:
        def texts(css: str) -> Column:
            return F.flatten(F.transform(N.select_class(scope, css), lambda n: N.deep_text(ns, n)))

        fields = {f: texts(css) for f, css in HRECIPE_CLASSES.items()}
        fields["ingredients"] = F.transform(
            N.select_class(scope, "ingredient"), lambda n: N.joined_text(ns, n)
        )
        fields["url"] = F.array(page_url)
        return F.array(raw_struct(fields))

    def of_page(ns: Column) -> Column:
        classed = F.filter(
            N.under(ns, N.select_class(ns, "hrecipe")), lambda n: N.attr(n, "class").isNotNull()
        )
        return X.let(classed, lambda scope: record(ns, scope))

    return X.let(N.held(nodes), of_page)
