"""Selections over the node array of a page (see ``operators.shred``).

A selection is an ``ARRAY<node struct>`` in document order. Because a node's array index
is its ``pos`` and its subtree is the interval ``pos+1 .. end``, a subtree is a ``slice``
and a descendant test is two integer comparisons; nothing recurses and nothing shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from larder.functions.text import as_col, let

TEXT = "#text"


def attr(node: Column, name: str) -> Column:
    return node["attrs"][name.replace("-", "_")]


def held(nodes: Column | str) -> Column:
    """All nodes as a list of rows: bound by ``let``, a slice of it costs its own length. One of the array as
    it is stored reads all nodes of the page, each time."""
    return F.filter(as_col(nodes), lambda n: n["pos"].isNotNull())


def subtree(nodes: Column | str, root: Column) -> Column:
    """Descendants of one element, text nodes included."""
    return F.slice(as_col(nodes), root["pos"] + 2, root["end"] - root["pos"])


def subtree_or_self(nodes: Column | str, root: Column) -> Column:
    return F.slice(as_col(nodes), root["pos"] + 1, root["end"] - root["pos"] + 1)


def under(nodes: Column | str, roots: Column) -> Column:
    """Descendants-or-self of several elements, in document order, each once."""
    n = as_col(nodes)

    def inside(rs: Column) -> Column:
        parts = F.flatten(F.transform(rs, lambda r: subtree_or_self(n, r)))
        return F.when(F.size(rs) <= 1, parts).otherwise(in_order(parts))

    return let(roots, inside)


def node_at(nodes: Column | str, pos: Column) -> Column:
    return F.get(as_col(nodes), pos)


def children(nodes: Column | str, root: Column) -> Column:
    return F.filter(subtree(nodes, root), lambda n: n["parent"] == root["pos"])


def in_order(sel: Column) -> Column:
    """Document order without duplicates: ``pos`` is the first struct field."""
    return F.array_sort(F.array_distinct(sel))


def union_sel(a: Column, *more: Column) -> Column:
    """Union of selections, as a path union: document order, each node once."""
    return in_order(F.concat(a, *more))


def select_tag(nodes: Column | str, tag: str) -> Column:
    return F.filter(as_col(nodes), lambda n: n["tag"] == tag)


def has_class(node: Column, token: str) -> Column:
    """The white-space separated class list holds ``token``."""
    padded = F.concat(
        F.lit(" "), F.regexp_replace(attr(node, "class"), r"\s", " "), F.lit(" ")
    )
    # most classes do not have the token's letters at all: only the others are rewritten
    held = F.contains(attr(node, "class"), F.lit(token))
    return attr(node, "class").isNotNull() & held & F.contains(padded, F.lit(f" {token} "))


def select_class(
    nodes: Column | str, token: str, root: Column | None = None, tag: str | None = None
) -> Column:
    """Descendant-or-self elements that carry a class token."""
    source = as_col(nodes) if root is None else subtree_or_self(nodes, root)

    def test(n: Column) -> Column:
        hit = has_class(n, token)
        return (n["tag"] == tag) & hit if tag else hit

    return F.filter(source, test)


def attr_test(node: Column, name: str, op: str, value: str | None) -> Column:
    a = attr(node, name)
    if op == "eq":
        return a.isNotNull() & (a == value)
    if op == "contains":
        return a.isNotNull() & F.contains(a, F.lit(value))
    if op == "starts":
        return a.isNotNull() & a.startswith(value)
    if op == "present":
        return a.isNotNull()
    if op == "token":
        return has_class(node, value) if name == "class" else a.isNotNull() & F.array_contains(
            F.split(a, r"\s+"), value
        )
    raise ValueError(f"unknown operator {op!r}")


def select_attr(
    nodes: Column | str,
    name: str,
    value: str | None = None,
    tag: str | None = None,
    op: str = "eq",
    root: Column | None = None,
) -> Column:
    """Elements by attribute: ``eq`` (whole string), ``contains``, ``starts``, ``present``,
    ``token``. With ``root`` only its descendants are searched."""
    source = as_col(nodes) if root is None else subtree(nodes, root)

    def test(n: Column) -> Column:
        hit = attr_test(n, name, op, value)
        return (n["tag"] == tag) & hit if tag else hit

    return F.filter(source, test)


def own_text(nodes: Column | str, root: Column) -> Column:
    """Text nodes directly below an element, as strings."""
    n = as_col(nodes)
    return F.transform(
        F.filter(subtree(n, root), lambda t: (t["tag"] == TEXT) & (t["parent"] == root["pos"])),
        lambda t: t["text"],
    )


def deep_text(nodes: Column | str, root: Column) -> Column:
    """All text nodes below an element, as strings in document order."""
    return F.transform(
        F.filter(subtree(nodes, root), lambda t: t["tag"] == TEXT), lambda t: t["text"]
    )


def child_text(nodes: Column | str, root: Column) -> Column:
    """Text nodes of the direct children (``node()/text()``)."""
    n = as_col(nodes)
    return F.transform(
        F.filter(
            subtree(n, root),
            lambda t: (t["tag"] == TEXT) & (node_at(n, t["parent"])["parent"] == root["pos"]),
        ),
        lambda t: t["text"],
    )


def nonblank(texts: Column) -> Column:
    return F.filter(texts, lambda t: t.rlike(r"[^ \t\r\n]"))


def joined_text(nodes: Column | str, root: Column, sep: str = "") -> Column:
    return F.array_join(deep_text(nodes, root), sep)


def attr_values(sel: Column, name: str) -> Column:
    """Attribute values of a selection; elements without the attribute add nothing."""
    return F.filter(F.transform(sel, lambda n: attr(n, name)), lambda v: v.isNotNull())


def iso_attr(sel: Column) -> Column:
    """``content`` or ``datetime`` of the first element that has one, else empty."""
    values = F.transform(sel, lambda n: F.coalesce(attr(n, "content"), attr(n, "datetime")))
    return F.coalesce(F.get(F.filter(values, lambda v: v.isNotNull()), F.lit(0)), F.lit(""))


def nth(sel: Column, k: int) -> Column:
    """k-th element overall, 1-based, negative from the end, NULL when there is none."""
    return F.try_element_at(sel, F.lit(k))


def nth_per_parent(sel: Column, k: int) -> Column:
    """The k-th selected element (1-based, negative from the end) below each parent."""

    def rank(n: Column) -> Column:
        same = lambda m: (m["parent"] == n["parent"]) & (
            (m["pos"] <= n["pos"]) if k > 0 else (m["pos"] >= n["pos"])
        )
        return F.size(F.filter(sel, same))

    return F.filter(sel, lambda n: rank(n) == abs(k))


def has_child(nodes: Column | str, node: Column, *tags: str) -> Column:
    """The element has a direct child with one of the tags."""
    return F.exists(
        subtree(nodes, node), lambda c: (c["parent"] == node["pos"]) & c["tag"].isin(*tags)
    )


def lacks_child(nodes: Column | str, node: Column, *tags: str) -> Column:
    return ~has_child(nodes, node, *tags)


def following_sibling(nodes: Column | str, node: Column, tag: str | None = None) -> Column:
    """Later children of the same parent (text nodes too when ``tag`` is None)."""
    n = as_col(nodes)
    last = F.when(node["parent"] >= 0, node_at(n, node["parent"])["end"]).otherwise(
        F.size(n) - 1
    )
    tail = F.slice(n, node["end"] + 2, F.greatest(last - node["end"], F.lit(0)))

    def test(s: Column) -> Column:
        hit = s["parent"] == node["parent"]
        return hit & (s["tag"] == tag) if tag else hit

    return F.filter(tail, test)


def first_own_text(nodes: Column | str, node: Column) -> Column:
    return F.get(own_text(nodes, node), F.lit(0))


# Page-level properties read from meta elements.
META_PROPERTIES = {
    "og_title": ("property", "og:title"),
    "og_description": ("property", "og:description"),
    "og_url": ("property", "og:url"),
    "og_image": ("property", "og:image"),
    "published_time": ("property", "article:published_time"),
    "modified_time": ("property", "article:modified_time"),
    "description": ("name", "description"),
}


def meta_values(metas: Column, attribute: str, value: str) -> Column:
    return attr_values(F.filter(metas, lambda n: attr(n, attribute) == value), "content")


def page_meta(nodes: Column | str) -> Column:
    """Open Graph, article and description values plus the canonical link of a page.

    The array is scanned once for the few meta and link elements; every property is then
    looked up in that short list, the first occurrence winning.
    """
    found = F.filter(
        as_col(nodes),
        lambda n: ((n["tag"] == "meta") & attr(n, "content").isNotNull())
        | ((n["tag"] == "link") & (attr(n, "rel") == "canonical")),
    )

    def pick(sel: Column) -> Column:
        values = [
            F.get(meta_values(sel, a, v), F.lit(0)).alias(k) for k, (a, v) in META_PROPERTIES.items()
        ]
        canonical = F.get(
            attr_values(F.filter(sel, lambda n: n["tag"] == "link"), "href"), F.lit(0)
        ).alias("canonical")
        return F.struct(*values, canonical)

    # transform over a one-element array binds the short list once for all look-ups
    return F.get(F.transform(F.array(found), pick), F.lit(0))
