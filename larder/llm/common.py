"""What the operators share: tables, written cuts of the lineage, Arrow passes over whole partitions."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.storage import work_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_path(spark: SparkSession, what: str) -> str:
    return f"{work_folder(spark)}/{what}-{uuid.uuid4().hex}"


def cut(df: DataFrame, what: str) -> DataFrame:
    """``df`` written to the shared folder and read back: a lost executor costs no recomputation."""
    return cut_at(df, what)[0]


def cut_at(df: DataFrame, what: str) -> tuple[DataFrame, str]:
    path = fresh_path(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a table that ``cut_at`` wrote, once nothing reads it any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z, everything else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_blocks(
    batches: Iterator[pa.RecordBatch], column: str, chars: int = 2_000_000
) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds about ``chars`` of ``column``, or one longer row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        at = batch.schema.get_field_index(column)
        sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_pylist()
        start = held = 0
        for i, n in enumerate(sizes):
            if i > start and held + n > chars:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        yield batch.slice(start)


#: Rows that Spark hands to a Python worker at once. Rows are whole texts, so its own number (10,000) would
#: keep several hundred MB of them in buffers beside the heap.
BATCH_ROWS = 1000


def arrow_map(df: DataFrame, fn: Callable, schema) -> DataFrame:
    """``df.mapInArrow`` with batches of at most ``BATCH_ROWS`` rows, a setting of the session."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= BATCH_ROWS:
        conf.set(key, BATCH_ROWS)
    return df.mapInArrow(fn, schema)
