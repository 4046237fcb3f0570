"""The relational model in buckets: an upsert reads and writes only the buckets that its batch touches.

Recipes are filed by a hash of their match key, and ingredients with their recipe, so the rows that a batch can
match or replace lie in its keys' buckets. New categories and links are appended.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.operators.upsert import MATCH_KEYS, Tables, incoming_rows, upsert_recipes
from larder.storage import staged

BUCKETS = 64
#: The bucket of ingredients whose recipe is not stored; no batch touches it.
NO_RECIPE = -1
PARTS = ("recipes", "ingredients", "categories", "categorizations")


def bucket_of(buckets: int) -> Column:
    return F.pmod(F.xxhash64(*MATCH_KEYS), F.lit(buckets)).cast("int")


def _write(df: DataFrame, path: str, mode: str) -> None:
    """One file per bucket; with ``overwrite`` only the buckets that ``df`` has are replaced."""
    rows = df.repartition("bucket").write.mode(mode).partitionBy("bucket")
    rows.option("partitionOverwriteMode", "dynamic").parquet(path)


def _with_bucket(ingredients: DataFrame, recipes: DataFrame) -> DataFrame:
    place = recipes.select(F.col("id").alias("recipe_id"), "bucket").distinct()
    return ingredients.join(place, "recipe_id", "left").withColumn("bucket", F.coalesce("bucket", F.lit(NO_RECIPE)))


def file_tables(tables: Tables, root: str, buckets: int = BUCKETS) -> None:
    """Write the tables (all but the publishers) to an empty folder, in buckets."""
    recipes = tables.recipes.withColumn("bucket", bucket_of(buckets))
    _write(recipes, f"{root}/recipes", "append")
    _write(_with_bucket(tables.ingredients, recipes), f"{root}/ingredients", "append")
    tables.categories.write.parquet(f"{root}/categories")
    tables.categorizations.write.parquet(f"{root}/categorizations")


def read_filed(spark: SparkSession, root: str, publishers: DataFrame) -> Tables:
    """The tables, with the column ``bucket`` in recipes and ingredients."""
    return Tables(publishers, *(spark.read.parquet(f"{root}/{p}") for p in PARTS))


def upsert_filed(
    spark: SparkSession,
    root: str,
    publishers: DataFrame,
    batch: DataFrame,
    order: list[str],
    columns: str = "same_name",
    buckets: int = BUCKETS,
) -> list[int]:
    """``upsert_recipes`` into the tables below ``root``, in place; the buckets that were written.

    The new rows are staged before any table changes. Ingredients are replaced first, categories
    and links added where they are missing, and recipes written last: until then the batch's new recipes
    count as new, under the same ids, so an upsert that failed is simply run again. ``buckets`` must be that of
    ``file_tables``. Batches are valid records: each has ingredients.
    """
    filed = read_filed(spark, root, publishers)
    keys = incoming_rows(filed, batch, order).select(bucket_of(buckets).alias("bucket")).distinct()
    touched = sorted(r[0] for r in keys.collect())  # at most ``buckets`` numbers
    if not touched:
        return touched
    here = F.col("bucket").isin(touched)
    none = spark.createDataFrame([], filed.categorizations.schema)
    mine = Tables(
        publishers, filed.recipes.where(here).drop("bucket"), filed.ingredients.where(here).drop("bucket"), filed.categories, none
    )
    new = upsert_recipes(mine, batch, order, columns)
    recipes = staged(new.recipes.withColumn("bucket", bucket_of(buckets)), "recipes")
    ingredients = staged(_with_bucket(new.ingredients, recipes), "ingredients")
    categories = staged(new.categories.join(filed.categories, ["id", "name"], "left_anti"), "categories")
    links = new.categorizations.join(filed.categorizations, ["category_id", "recipe_id"], "left_anti")
    links = staged(links, "links")

    _write(ingredients, f"{root}/ingredients", "overwrite")
    categories.write.mode("append").parquet(f"{root}/categories")
    links.write.mode("append").parquet(f"{root}/categorizations")
    _write(recipes, f"{root}/recipes", "overwrite")
    return touched

