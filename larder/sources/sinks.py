"""Store sinks: export and snapshot under a time-stamped name."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

STAMP = "%Y%m%d-%H%M%S"


def export_json(df: DataFrame, root: str, when: dt.datetime) -> str:
    """One JSON document per line, gzip, in a folder named after ``when``; returns it."""
    path = f"{root}/{when.strftime(STAMP)}"
    df.write.option("compression", "gzip").json(path)
    return path


def snapshot(df: DataFrame, root: str, when: dt.datetime) -> str:
    """Full copy of a store under a time-stamped name; returns its path."""
    path = f"{root}/{when.strftime(STAMP)}-dump"
    df.write.parquet(path)
    return path
