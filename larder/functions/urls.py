"""URL functions as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from larder.functions.text import as_col, let

# URL grammar (RFC 3986, scheme and authority).
SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:"
ORIGIN = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*"
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


def is_absolute(url: Column | str) -> Column:
    return as_col(url).rlike(SCHEME)


def url_host(url: Column | str) -> Column:
    """Lower-case host, NULL when the URL has none."""
    return F.nullif(F.lower(F.regexp_extract(as_col(url), HOST, 1)), F.lit(""))


def _remove_dots(url: Column) -> Column:
    """Resolve ``.`` and ``..`` segments of an absolute URL's path."""
    origin = F.regexp_extract(url, ORIGIN, 0)
    path = F.regexp_extract(url, ORIGIN + r"([^?#]*)", 1)
    tail = F.regexp_extract(url, r"[?#].*$", 0)
    segments = F.split(path, "/", -1)
    kept = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == ".", acc)
        .when(s == "..", F.when(F.size(acc) > 1, F.slice(acc, 1, F.size(acc) - 1)).otherwise(acc))
        .otherwise(F.concat(acc, F.array(s))),
    )
    closing = F.when(path.rlike(r"/\.\.?$"), "/").otherwise("")
    return F.concat(origin, F.array_join(kept, "/"), closing, tail)


def resolve_url(base: Column | str, ref: Column | str) -> Column:
    """Absolute form of ``ref`` seen from the page ``base``."""
    return let(as_col(base), lambda b: let(as_col(ref), lambda r: _resolve(b, r)))


def _resolve(b: Column, r: Column) -> Column:
    origin = F.regexp_extract(b, ORIGIN, 0)
    document = F.regexp_extract(b, r"^[^?#]*", 0)
    folder = F.when(document == origin, F.concat(origin, F.lit("/"))).otherwise(
        F.regexp_replace(document, r"[^/]*$", "")
    )
    joined = (
        F.when(r.rlike(SCHEME), r)
        .when(r == "", b)
        .when(r.startswith("//"), F.concat(F.regexp_extract(b, SCHEME, 0), r))
        .when(r.startswith("/"), F.concat(origin, r))
        .when(r.startswith("?"), F.concat(document, r))
        .when(r.startswith("#"), F.concat(F.regexp_replace(b, r"#.*$", ""), r))
        .otherwise(F.concat(folder, r))
    )
    dotted = ~r.rlike(SCHEME) & r.rlike(r"^[^?#]*(?:^|/)\.\.?(?:/|$|[?#])")
    return F.when(dotted, let(joined, _remove_dots)).otherwise(joined)


def page_folder_join(page_url: Column | str, name: Column | str) -> Column:
    """Replace everything after the last slash of the page URL by ``name``."""
    return F.concat(F.regexp_replace(as_col(page_url), r"/[^/]*$", ""), F.lit("/"), as_col(name))


def fix_protocol_relative(col: Column | str) -> Column:
    """``//host/x`` -> ``http://host/x``."""
    return F.regexp_replace(as_col(col), r"^//", "http://")


def host_parents(host: Column) -> Column:
    """The host and all domains above it, nearest first."""
    labels = F.split(host, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
