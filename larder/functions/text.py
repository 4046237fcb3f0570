"""Text and list normalisation as Column expressions (no Python worker involved)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace stripped from the edges of a text. ``(?U)\s`` is every
# Unicode white-space character, 0x1c-0x1f are the four information separators.
EDGE_SPACE = r"[\s\x1c-\x1f]"

# Markup removed by strip_html (comments, tags, declarations).
MARKUP = r"(?s)<!--.*?-->|</?[A-Za-z][^>]*>|<![^>]*>"

# Phrases of the labelled running texts.
YIELD_LABEL = r"(?i)^Yields?:?\s([^|]+)"
PREP_LABEL = r"(?i)^.+Prep(?: Time)?:?\s([^|]+)"
COOK_LABEL = r"(?i)^.+Cook Time:?\s([^|]+)"
PREP_TIMED = r"(?i)^\s?Prep Time:\s?(\d+\s(?:second|minute|hour|day)s?)"
COOK_TIMED = r"(?i)^.+\s?Cook Time:\s?(\d+\s(?:second|minute|hour|day)s?)"
SERVES = r"Serves \d\."


def as_col(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once for all its uses in ``body``.

    A Column used n times is copied n times into the plan; nested uses grow
    exponentially and can exceed the code generator's limits. A one-element lambda
    keeps the plan linear.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip_edges(col: Column | str) -> Column:
    """Remove Unicode white space at both ends (``trim`` removes 0x20 only)."""
    # The look-behind starts a trailing match only at the head of a run of white
    # space, so a long inner run costs linear time.
    return F.regexp_replace(
        as_col(col),
        rf"(?U)^{EDGE_SPACE}++|{EDGE_SPACE}(?<!{EDGE_SPACE}{{2}}){EDGE_SPACE}*+\z",
        "",
    )


def clean_string(col: Column | str) -> Column:
    """Collapse every run of ASCII white space to one space and strip the edges."""
    return strip_edges(F.regexp_replace(as_col(col), r"\s+", " "))


def trim_whitespace(col: Column | str) -> Column:
    """Strip, then clean: the composition equals ``clean_string``."""
    return clean_string(col)



def strip_html(col: Column | str, escape: bool = False) -> Column:
    """Remove tags, comments and declarations; the text of scripts stays.

    ``escape=True`` re-escapes a bare ``&``, ``<`` or ``>`` that is left over.
    """
    out = F.regexp_replace(as_col(col), MARKUP, "")
    if escape:
        out = F.regexp_replace(out, r"&(?!#?\w+;)", "&amp;")
        out = F.replace(F.replace(out, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    return out


def flatten_value(arr: Column | str) -> Column:
    """First element of a list, the empty string for an empty or missing list."""
    return F.coalesce(F.get(as_col(arr), F.lit(0)), F.lit(""))


def take_first(arr: Column | str) -> Column:
    """First element that is neither NULL nor the empty string."""
    return F.get(F.filter(as_col(arr), lambda x: x.isNotNull() & (x != "")), F.lit(0))


def map_drop(arr: Column | str, *fns: Callable[[Column], Column]) -> Column:
    """Apply ``fns`` to every element in turn and drop the NULL results."""

    def chain(x: Column) -> Column:
        for fn in fns:
            x = fn(x)
        return x

    return F.filter(F.transform(as_col(arr), chain), lambda x: x.isNotNull())


def drop_header_lines(arr: Column | str) -> Column:
    """Drop entries that contain the word "ingredient" in any case."""
    return F.filter(as_col(arr), lambda x: ~F.contains(F.lower(x), F.lit("ingredient")))


def drop_labels(arr: Column | str) -> Column:
    """Drop section labels ("For ...", "...:") and blank entries of stripped texts."""
    return F.filter(
        F.transform(as_col(arr), strip_edges),
        lambda x: ~x.startswith("For ") & ~x.endswith(":") & (x != ""),
    )


def drop_blank(arr: Column | str) -> Column:
    return F.filter(F.transform(as_col(arr), strip_edges), lambda x: x != "")


def distinct_list(arr: Column | str) -> Column:
    """Distinct entries in the order of their first occurrence."""
    return F.array_distinct(as_col(arr))


def squash(arr: Column | str) -> Column:
    """Join all parts without a separator and normalise the white space."""
    return clean_string(F.array_join(as_col(arr), ""))


def _group(col: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(col, pattern, 1), F.lit(""))


def labelled_values(text: Column | str) -> Column:
    """``Yields: a | Prep Time: b | Cook Time: c`` -> struct of the three values."""
    t = as_col(text)
    return F.struct(
        _group(t, YIELD_LABEL).alias("recipeYield"),
        _group(t, PREP_LABEL).alias("prepTime"),
        _group(t, COOK_LABEL).alias("cookTime"),
    )


def timed_values(text: Column | str) -> Column:
    """``Prep Time: 10 minutes Cook Time: 1 hour`` -> struct, only with a known unit."""
    t = as_col(text)
    return F.struct(
        _group(t, PREP_TIMED).alias("prepTime"), _group(t, COOK_TIMED).alias("cookTime")
    )


def after_first_space(col: Column | str) -> Column:
    """The rest of a text after its first space, NULL when it has none."""
    c = as_col(col)
    return F.when(F.instr(c, " ") > 0, F.regexp_replace(c, r"(?s)\A[^ ]* ", ""))


def clean_date_phrase(col: Column | str, mode: str) -> Column:
    """Cut the words around a date.

    ``on``      the first "on" and all bars are removed
    ``posted``  "Posted on" and "in" are removed everywhere
    ``bar``     the text after the first bar, empty when there is none
    """
    c = as_col(col)
    if mode == "on":
        return strip_edges(F.replace(F.regexp_replace(c, r"(?s)\A(.*?)on", "$1"), F.lit("|"), F.lit("")))
    if mode == "posted":
        return strip_edges(
            F.replace(F.replace(c, F.lit("Posted on"), F.lit("")), F.lit("in"), F.lit(""))
        )
    if mode == "bar":
        return F.when(F.instr(c, "|") > 0, F.regexp_replace(c, r"(?s)\A[^|]*\|", "")).otherwise(
            F.when(c.isNotNull(), F.lit(""))
        )
    raise ValueError(f"unknown mode {mode!r}")


def yield_phrase(*parts: Column | str) -> Column:
    """Compose a yield from its parts, missing parts skipped."""
    return strip_edges(F.concat_ws(" ", *[strip_edges(as_col(p)) for p in parts]))


def serves_phrases(arr: Column | str) -> Column:
    """All "Serves n." phrases of a list of texts."""
    return F.flatten(
        F.transform(as_col(arr), lambda x: F.regexp_extract_all(x, F.lit(SERVES), F.lit(0)))
    )


def replace_literal(col: Column | str, old: str, new: str) -> Column:
    """Replace every occurrence, no pattern (``_med.`` -> ``_lg.`` image sizes)."""
    return F.replace(as_col(col), F.lit(old), F.lit(new))
