"""Raw records: every field a list of collected values, and the step to final records.

An extractor is a Column function ``nodes, page_url -> ARRAY<raw record>``. It runs inside
the page's row, so extraction needs no shuffle, and a fallback between extractors is a
``CASE`` on the array size.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions import nodes as N
from larder.functions import text as X
from larder.functions.dates import iso_date, iso_duration
from larder.functions.urls import fix_protocol_relative
from larder.schema import (
    DATE_FIELDS,
    DURATION_FIELDS,
    KEEP_FIELDS,
    LIST_FIELDS,
    PLAIN_FIELDS,
    RECIPE_FIELDS,
)

RAW_FIELDS = [f for f in RECIPE_FIELDS if f != "source"]
NO_VALUES = "cast(null as array<string>)"


def raw_struct(fields: dict[str, Column]) -> Column:
    """A raw record with all fields; missing ones are NULL, unknown names are dropped."""
    return F.struct(
        *[fields[f].alias(f) if f in fields else F.expr(NO_VALUES).alias(f) for f in RAW_FIELDS]
    )


def first_nonempty(*choices: Column) -> Column:
    """The first array that has elements (the last one when none has)."""

    def either(choice: Column, rest: Column) -> Column:
        # bound, or the choice would be extracted twice
        return X.let(choice, lambda v: F.when(F.size(v) > 0, v).otherwise(rest))

    out = choices[-1]
    for c in reversed(choices[:-1]):
        out = either(c, out)
    return out


def extract_records(
    shredded: DataFrame,
    extractor: Callable[[Column, Column], Column],
    keep: tuple[str, ...] = ("page_id",),
    source: Column | None = None,
) -> DataFrame:
    """Run an extractor on every page: one row per record.

    ``source`` defaults to the page table's ``source`` column.
    """
    src = F.col("source") if source is None else source
    rows = shredded.select(
        *keep,
        src.alias("_source"),
        F.col("url").alias("page_url"),
        F.posexplode(extractor(F.col("nodes"), F.col("url"))).alias("item_no", "_raw"),
    )
    return rows.select(
        *keep,
        "page_url",
        "item_no",
        F.array("_source").alias("source"),
        *[F.col("_raw")[f].alias(f) for f in RAW_FIELDS],
    )


def prefer_image(image: Column, og_images: Column, always: bool = False) -> Column:
    """The page's last Open Graph image wins over the record's image; a protocol-relative
    result gets a scheme. Without an image the record stays without one unless ``always``."""
    own = X.take_first(image)
    best = F.coalesce(N.nth(og_images, -1), own)
    value = fix_protocol_relative(best if always else F.when(own.isNotNull(), best))
    return F.filter(F.array(value), lambda v: v.isNotNull())


def overlay(record_value: Column, extra: Column) -> Column:
    """A non-empty added value wins, else the existing one stays."""
    return F.coalesce(F.nullif(extra, F.lit("")), record_value)


def overlay_records(records: DataFrame, extra: dict[str, Column]) -> DataFrame:
    """Overlay page-level values over finished records."""
    return records.withColumns({f: overlay(F.col(f), c) for f, c in extra.items()})


def field_rule(field: str, values: Column) -> Column:
    """The output rule of one record field over its list of collected values."""
    if field in LIST_FIELDS:
        out = X.map_drop(values, X.strip_html, X.trim_whitespace)
        return X.drop_header_lines(out) if field == "ingredients" else out
    first = X.take_first(values)
    if field in PLAIN_FIELDS:
        return X.trim_whitespace(X.strip_html(first))
    if field in KEEP_FIELDS:
        return X.trim_whitespace(first)
    if field in DATE_FIELDS:
        return iso_date(X.strip_html(first))
    if field in DURATION_FIELDS:
        return iso_duration(X.strip_html(first))
    return first


def _after_strip(parse: Callable[[Column], Column]) -> Callable[[Column], Column]:
    return lambda v: parse(X.strip_html(v))


def normalize_records(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Raw records -> records: known fields only, each through its own rule.

    Columns may be lists of values or single strings. Fields that the input lacks become
    NULL; columns that are neither a field nor named in ``keep`` are dropped. One projection,
    so unused fields are pruned.
    """
    return raw.select(*keep, *[c.alias(f) for f, c in normalized(dict(raw.dtypes)).items()])


def normalized(types: dict[str, str]) -> dict[str, Column]:
    """The rule of every record field over the columns of a table, by field.

    Dates, and durations, share one long rule: it is written once over the array of the
    three fields, which keeps the plan short.
    """

    def values(field: str) -> Column:
        col = F.col(field)
        return col if types[field].startswith("array") else F.array(col)

    out = {}
    for f in RECIPE_FIELDS:
        if f not in types:
            out[f] = F.lit(None).cast("array<string>" if f in LIST_FIELDS else "string")
        elif f not in DATE_FIELDS and f not in DURATION_FIELDS:
            out[f] = field_rule(f, values(f))
    for group, parse in ((DATE_FIELDS, iso_date), (DURATION_FIELDS, iso_duration)):
        have = [f for f in group if f in types]
        if have:
            firsts = F.array(*[X.take_first(values(f)) for f in have])
            parsed = F.transform(firsts, _after_strip(parse))
            out.update({f: F.get(parsed, F.lit(i)) for i, f in enumerate(have)})
    return {f: out[f] for f in RECIPE_FIELDS}
