"""Record, node and relational schemas."""

from __future__ import annotations

from pyspark.sql import types as T

# The record fields, grouped by how their output rule treats them.
# PLAIN: first value, markup removed, trimmed.   KEEP: first value, trimmed only.
PLAIN_FIELDS = ["description", "image", "name", "url", "recipeYield", "aggregateRating"]
KEEP_FIELDS = [
    "creator", "keywords", "cookingMethod", "recipeCuisine", "recipeDiet", "recipeInstructions",
    "calories", "carbohydrateContent", "cholesterolContent", "fatContent", "fiberContent",
    "proteinContent", "saturatedFatContent", "servingSize", "sodiumContent", "sugarContent",
    "transFatContent", "unsaturatedFatContent",
]
DATE_FIELDS = ["dateCreated", "dateModified", "datePublished"]
DURATION_FIELDS = ["cookTime", "prepTime", "totalTime"]
LIST_FIELDS = ["ingredients", "recipeCategory"]

NUTRITION_FIELDS = KEEP_FIELDS[6:]

RECIPE_FIELDS = [
    "source",
    *PLAIN_FIELDS,
    *KEEP_FIELDS,
    *DATE_FIELDS,
    *DURATION_FIELDS,
    *LIST_FIELDS,
]

RECIPE_SCHEMA = T.StructType(
    [
        T.StructField(f, T.ArrayType(T.StringType()) if f in LIST_FIELDS else T.StringType())
        for f in RECIPE_FIELDS
    ]
)

STORE_SCHEMA = T.StructType(
    [
        T.StructField("_id", T.StringType()),
        *RECIPE_SCHEMA.fields,
        T.StructField("ts", T.TimestampType()),
    ]
)

PAGE_SCHEMA = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
    ]
)

# Attributes kept by the shredder: all that any selector reads. A struct of known names
# is narrower than a map and lets Catalyst prune.
NODE_ATTRS = [
    "class", "id", "itemprop", "itemtype", "itemscope", "property", "name", "rel", "content",
    "datetime", "src", "href", "title", "style", "data_lazy_src",
]

NODE_TYPE = T.StructType(
    [
        T.StructField("pos", T.IntegerType()),  # 0-based document order = array index
        T.StructField("end", T.IntegerType()),  # last descendant position, pos when none
        T.StructField("parent", T.IntegerType()),  # -1 for a root
        T.StructField("depth", T.IntegerType()),
        T.StructField("item", T.IntegerType()),  # nearest enclosing itemscope, -1 when none
        T.StructField("tag", T.StringType()),  # "#text" for text
        T.StructField("text", T.StringType()),
        T.StructField(
            "attrs", T.StructType([T.StructField(a, T.StringType()) for a in NODE_ATTRS])
        ),
    ]
)

# Record field -> column of the relational recipes table.
RELATIONAL_COLUMNS = {
    "source": "source",
    "description": "description",
    "image": "original_photo_url",
    "name": "name",
    "url": "original_url",
    "creator": "author",
    "dateCreated": "created_at",
    "dateModified": "updated_at",
    "datePublished": "date_published",
    "keywords": "keywords",
    "cookingMethod": "cooking_method",
    "cookTime": "cook_time",
    "prepTime": "prep_time",
    "recipeCuisine": "recipe_cuisine",
    "recipeInstructions": "instructions",
    "recipeYield": "recipe_yield",
    "totalTime": "total_time",
    "aggregateRating": "aggregate_rating",
    "calories": "calories",
    "carbohydrateContent": "carbs",
    "cholesterolContent": "cholesterol",
    "fatContent": "fat",
    "fiberContent": "fiber",
    "proteinContent": "protein",
    "saturatedFatContent": "saturated_fat",
    "servingSize": "serving_size",
    "sodiumContent": "sodium",
    "sugarContent": "sugar",
    "transFatContent": "transfat",
    "unsaturatedFatContent": "unsaturated_fat",
}
COUNTER_COLUMNS = ["up_votes", "down_votes", "fb_likes", "fb_shares", "pins", "tweets"]
