"""Re-normalise a store, list the changes, validate, write back."""

from __future__ import annotations

import hashlib
import inspect

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder import storage
from larder.functions import dates, ingredients, text, urls
from larder.operators import records
from larder.operators.quality import REQUIRED
from larder.operators.records import normalized
from larder.schema import LIST_FIELDS, RECIPE_FIELDS

CARRIED = ["_id", "ts"]


def _stored_fields(store: DataFrame) -> list[str]:
    return [f for f in RECIPE_FIELDS if f in store.columns]


def renormalize(store: DataFrame) -> DataFrame:
    """Every stored field through its rule again; ``_id`` and ``ts`` are carried over."""
    fields, new = _stored_fields(store), normalized(dict(store.dtypes))
    return store.select(*CARRIED, *[new[f].alias(f) for f in fields])


def _old_and_new(store: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """Old and new version of a record as two structs of one row: no join is needed."""
    fields, new = _stored_fields(store), normalized(dict(store.dtypes))
    return store.select(
        *CARRIED,
        *carried,
        F.struct(*fields).alias("old"),
        F.struct(*[new[f].alias(f) for f in fields]).alias("new"),
    )


def _text(side: str, field: str) -> Column:
    c = F.col(side)[field]
    return F.to_json(c) if field in LIST_FIELDS else c


def field_diff(store: DataFrame) -> DataFrame:
    """(_id, name, source, field, old, new) for every field whose rule changes its value.

    That includes values that the rule now takes away: their new value is NULL. List fields are
    shown as JSON.
    """
    pairs = _old_and_new(store)
    fields = [f for f in RECIPE_FIELDS if f in pairs.schema["old"].dataType.names]
    changes = [
        F.when(
            ~F.col("new")[f].eqNullSafe(F.col("old")[f]),
            F.struct(
                F.lit(f).alias("field"), _text("old", f).alias("old"), _text("new", f).alias("new")
            ),
        )
        for f in fields
    ]
    rows = pairs.select(
        "_id",
        F.col("old.name").alias("name"),
        F.col("old.source").alias("source"),
        F.explode(F.filter(F.array(*changes), lambda c: c.isNotNull())).alias("c"),
    )
    return rows.select(
        "_id", "name", "source", "c.field", F.col("c.old").alias("old"), F.col("c.new").alias("new")
    )


def _new_reason() -> Column:
    out = None
    for field in REQUIRED:
        c = F.col("new")[field]
        gone = c.isNull() | ((F.size(c) == 0) if field in LIST_FIELDS else (c == ""))
        reason = F.lit(f"Missing '{field}'")
        out = F.when(gone, reason) if out is None else out.when(gone, reason)
    return out


def cleanup(
    store: DataFrame, update: bool = False, carried: tuple[str, ...] = ()
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(changes, invalid, new store).

    ``changes`` lists field changes; ``invalid`` lists (_id, reason) of records that fail
    validation after cleaning, which are reported and never deleted; the new store has the
    cleaned version of every valid record and the old version of every invalid one. With
    ``update=False`` (a dry run) the store comes back as it was. Each output is one
    projection of the store; write the new store to a new path. ``carried`` names further columns
    that the new store keeps.
    """
    pairs = _old_and_new(store, carried).withColumn("reason", _new_reason())
    invalid = pairs.filter(F.col("reason").isNotNull()).select("_id", "reason")
    fields = _stored_fields(store)
    if not update:
        return field_diff(store), invalid, store
    chosen = [
        F.when(F.col("reason").isNull(), F.col("new")[f]).otherwise(F.col("old")[f]).alias(f)
        for f in fields
    ]
    return field_diff(store), invalid, pairs.select("_id", *chosen, "ts", *carried)


# --- a store that remembers by which rules it was cleaned -----------------------------------

NEW = "0-new"
#: Modules that decide what a cleaned record looks like.
RULE_MODULES = (dates, ingredients, text, urls, records)


def rules_digest() -> str:
    """Changes with the code of the rules."""
    code = "".join(inspect.getsource(m) for m in RULE_MODULES)
    return hashlib.md5(code.encode()).hexdigest()[:12]


def _generations(spark: SparkSession, store: str) -> dict[str, list[str]]:
    """batch folder -> its generations, the live one last."""
    order = lambda name: int(name.removeprefix("gen=").split("-")[0])
    out = {}
    for batch in storage.names_in(spark, store):
        if batch.startswith("batch="):
            out[batch] = sorted((n for n in storage.names_in(spark, f"{store}/{batch}") if n.startswith("gen=")), key=order)
    return {b: g for b, g in out.items() if g}


def add_batch(rows: DataFrame, store: str, batch: int) -> None:
    """File new records, not cleaned yet; the same batch written again replaces itself."""
    rows.write.mode("overwrite").parquet(f"{store}/batch={batch}/gen={NEW}")


def read_generations(spark: SparkSession, store: str, schema: T.StructType | str) -> DataFrame:
    """All records of the store, each batch in its last generation."""
    folders = [f"{store}/{b}/{g[-1]}" for b, g in _generations(spark, store).items()]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def cleanup_stale(
    spark: SparkSession, store: str, schema: T.StructType | str, digest: str | None = None
) -> tuple[list[str], DataFrame, DataFrame]:
    """(batches written, changes, invalid): clean the batches that other rules, or none, cleaned last.

    Batches that these rules cleaned are not read. A batch's new generation appears whole beside the old
    one, and from then on readers take it; the old one is removed afterwards. A clean-up that failed
    is run again and goes on with the batches that are left.
    """
    digest = digest or rules_digest()
    found = _generations(spark, store)
    stale = {b: g for b, g in found.items() if not g[-1].endswith(f"-{digest}")}
    if not stale:
        none = spark.createDataFrame([], schema)
        changes, invalid, _ = cleanup(none)
        return [], changes, invalid
    rows = spark.read.schema(schema).parquet(*(f"{store}/{b}/{g[-1]}" for b, g in stale.items()))
    path = F.col("_metadata.file_path")
    placed = rows.withColumn("batch", F.regexp_extract(path, r"/batch=([0-9]+)/", 1).cast("long"))
    placed = placed.withColumn("gen", F.regexp_extract(path, r"/gen=([0-9]+)-", 1).cast("long"))
    old = storage.staged(placed, "stale")
    changes, invalid, new = cleanup(old, update=True, carried=("batch", "gen"))
    changes, invalid = storage.staged(changes, "changes"), storage.staged(invalid, "invalid")
    filed = new.withColumn("gen", F.concat((F.col("gen") + 1).cast("string"), F.lit(f"-{digest}")))
    # every task writes what it has read of a batch: gathered, a large batch would be one task's
    writer = filed.write.mode("overwrite").partitionBy("batch", "gen")
    writer.option("partitionOverwriteMode", "dynamic").parquet(store)
    for batch, generations in _generations(spark, store).items():
        for name in generations[:-1]:
            storage.delete(spark, f"{store}/{batch}/{name}")
    return sorted(stale), changes, invalid
