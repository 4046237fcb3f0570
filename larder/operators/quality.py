"""Record validation and de-duplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fields that must be filled, in the order they are checked.
REQUIRED = ["source", "name", "url", "ingredients"]


def is_missing(df: DataFrame, field: str) -> Column:
    """NULL, the empty string or the empty list."""
    c = F.col(field)
    if dict(df.dtypes)[field].startswith("array"):
        return c.isNull() | (F.size(c) == 0)
    return c.isNull() | (c == "")


def reject_reason(df: DataFrame) -> Column:
    """Name of the first required field that is missing, NULL for a valid record."""
    out = None
    for field in REQUIRED:
        reason = F.lit(f"Missing '{field}'")
        out = F.when(is_missing(df, field), reason) if out is None else out.when(
            is_missing(df, field), reason
        )
    return out


def with_reject_reason(df: DataFrame) -> DataFrame:
    return df.withColumn("reason", reject_reason(df))


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid records, rejected records with ``reason``). Both sides are plain filters."""
    marked = with_reject_reason(df)
    return (
        marked.filter(F.col("reason").isNull()).drop("reason"),
        marked.filter(F.col("reason").isNotNull()),
    )


def session_hash() -> Column:
    """md5 of name and URL, joined without a separator."""
    return F.md5(F.concat(F.col("name"), F.col("url")))


def keep_first(df: DataFrame, key: Column | list[Column], order: list[str]) -> DataFrame:
    """One row per key: the first by ``order``, whose values must be known and differ within a key.

    The first order value of each key comes from an aggregation of two narrow columns, combined on the
    map side, and a semi join brings the rows back. Its keys include the order value, so a key that
    holds a third of all rows is spread over the tasks, and columns that nobody reads afterwards
    are never read. ``df`` is read twice: pass a stored table or cheap projections of one.
    """
    keys = key if isinstance(key, list) else [key]
    names = [f"_key{i}" for i in range(len(keys))]
    first = F.min(order[0]) if len(order) == 1 else F.min(F.struct(*order))
    slim = df.select(*[k.alias(n) for k, n in zip(keys, names)], *order)
    firsts = slim.groupBy(*names).agg(first.alias("_first"))
    place = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    same = [k.eqNullSafe(F.col(n)) for k, n in zip(keys, names)]
    return df.join(firsts, [*same, place == F.col("_first")], "left_semi")


def dedupe_session(df: DataFrame, order: list[str]) -> DataFrame:
    """Drop records whose name and URL were seen before in this session (see ``keep_first``)."""
    return keep_first(df, session_hash(), order)


def contract_violations(df: DataFrame, key: str) -> DataFrame:
    """Rows (key, rule) for every broken rule of the extraction contract."""
    rules = [
        F.when(is_missing(df, f), F.lit(f"{f} missing")) for f in ("name", "ingredients", "url")
    ]
    rules.append(F.when(F.col("image").startswith("//"), F.lit("image not absolute")))
    broken = F.filter(F.array(*rules), lambda r: r.isNotNull())
    return df.select(key, F.explode(broken).alias("rule"))


def known_publishers(df: DataFrame, publishers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records of known publishers, skipped records), by equality of source and name.

    No broadcast hint: the planner broadcasts the publishers when their measured size
    allows it and otherwise splits a skewed source at run time.
    """
    names = publishers.select(F.col("name").alias("_publisher")).distinct()
    on = F.col("source") == F.col("_publisher")
    return df.join(names, on, "left_semi"), df.join(names, on, "left_anti")
