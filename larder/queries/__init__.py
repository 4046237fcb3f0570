"""Registered queries: one or more per operator, each with the SQL that checks it.

``query`` registers a function ``(spark, sf_dir) -> DataFrame`` under its own name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql.strip()
        return fn

    return register


def load_all() -> None:
    from larder.queries import dom, extraction, jobs, normalise, report, site, store, streams  # noqa: F401
