"""Queries over the count reports. The events table plays the store: type as source."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from larder.operators import report as R
from larder.queries import query
from larder.queries.tables import table
from larder.storage import fresh_folder

AS_OF = "2024-01-31 00:00:00"


def _store(spark, sf):
    e = table(spark, sf, "events")
    return e.select(F.col("event_type").alias("source"), F.col("ts").cast("timestamp_ntz").alias("ts"))


def _as_of():
    return F.lit(AS_OF).cast("timestamp_ntz")


@query(
    f"SELECT event_type AS source, count(*) AS total FROM events WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY GROUP BY 1"
)
def q_total_by_source(spark, sf):
    return R.total_by_source(_store(spark, sf), _as_of(), 7)


@query("SELECT event_type AS source, count(*) AS total FROM events GROUP BY 1")
def q_total_all_time(spark, sf):
    return R.total_by_source(_store(spark, sf), _as_of(), 0)


WINDOWED = f"""(SELECT event_type AS source, d AS days FROM events, (VALUES (1), (7), (30), (0)) w(d)
  WHERE d = 0 OR ts >= TIMESTAMP '{AS_OF}' - to_days(d)) t"""


@query(f"SELECT days, source, count(*) AS total FROM {WINDOWED} GROUP BY 1, 2")
def q_source_report(spark, sf):
    return R.source_report(_store(spark, sf), _as_of())


@query(
    f"""SELECT days, CASE WHEN grouping(source) = 1 THEN 'TOTAL' ELSE source END AS source, count(*) AS total,
        grouping(source) = 1 AS is_total FROM {WINDOWED} GROUP BY GROUPING SETS ((days, source), (days))"""
)
def q_report_total(spark, sf):
    return R.with_total(R.source_report(_store(spark, sf), _as_of()))


@query(
    f"""SELECT '{{' || string_agg('"' || label || '":{{' || inside || '}}', ',' ORDER BY label) || '}}' AS report FROM (
        SELECT CASE WHEN days = 0 THEN 'All time' ELSE 'Last ' || CAST(days AS VARCHAR) || ' day(s)' END AS label,
          string_agg('"' || source || '":' || CAST(total AS VARCHAR), ',' ORDER BY source) AS inside FROM (
          SELECT days, CASE WHEN grouping(source) = 1 THEN 'TOTAL' ELSE source END AS source, count(*) AS total
          FROM {WINDOWED} GROUP BY GROUPING SETS ((days, source), (days))) x GROUP BY 1) y"""
)
def q_report_json(spark, sf):
    return R.report_json(R.source_report(_store(spark, sf), _as_of()))


@query(f"SELECT days, source, count(*) AS total FROM {WINDOWED} GROUP BY 1, 2")
def q_report_from_counts(spark, sf):
    """Three batches, each leaving its daily counts; the report reads these alone."""
    folder = fresh_folder(spark, "counts")
    rows = _store(spark, sf).withColumn("batch", F.pmod(F.xxhash64("ts"), F.lit(3)))
    for n in range(3):
        R.daily_counts(rows.filter(F.col("batch") == n)).write.parquet(f"{folder}/batch={n}")
    kept = R.merge_counts(spark.read.parquet(folder))
    return R.report_from_counts(kept, dt.datetime.fromisoformat(AS_OF))
