"""The folders of a streamed record store: batches as they come, merged from time to time.

``run=<query>/batch=<n>`` holds the rows of one micro-batch, ``merged=<n>`` those of many, sorted by their key with
a Bloom filter. The last file below ``_commits`` names the merged folders in use and up to which batch of each
run they hold all rows, so readers see either the batches or what was merged from them, never both.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder import storage

#: Merged folders below this size are merged again with what comes next; also the size of a file.
TARGET_BYTES = 512 << 20
NOTHING = {"merged": [], "covered": {}, "retired": []}


def _last_commit(spark: SparkSession, store: str) -> tuple[int, dict]:
    done = [n for n in storage.names_in(spark, f"{store}/_commits") if n.endswith(".json")]
    if not done:
        return 0, NOTHING
    return int(done[-1].removesuffix(".json")), json.loads(storage.read_text(spark, f"{store}/_commits/{done[-1]}"))


def _batches(spark: SparkSession, store: str, covered: dict[str, int]) -> list[tuple[str, int]]:
    """(run, batch) of the whole batches that no merged folder holds."""
    out = []
    for run in storage.names_in(spark, store):
        for name in storage.names_in(spark, f"{store}/{run}") if run.startswith("run=") else []:
            batch = int(name.removeprefix("batch="))
            if batch > covered.get(run, -1) and storage.exists(spark, f"{store}/{run}/{name}/_SUCCESS"):
                out.append((run, batch))
    return sorted(out)


def live_folders(spark: SparkSession, store: str) -> list[str]:
    """The folders that together hold every row of the store once."""
    _, commit = _last_commit(spark, store)
    batches = [f"{store}/{run}/batch={n}" for run, n in _batches(spark, store, commit["covered"])]
    return [*(f"{store}/{name}" for name in commit["merged"]), *batches]


def read_stored(spark: SparkSession, store: str, schema: T.StructType | str) -> DataFrame:
    """All rows of the store."""
    folders = live_folders(spark, store)
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def write_sorted(df: DataFrame, path: str, key: str, files: int, rows_per_file: int = 1_000_000) -> None:
    """``df`` in files of one range of ``key`` each, sorted, with a Bloom filter on it: a reader that looks for
    some keys skips the files and row groups that do not have them."""
    (
        df.repartitionByRange(files, key)
        .sortWithinPartitions(key)
        .write.option(f"parquet.bloom.filter.enabled#{key}", "true")
        .option(f"parquet.bloom.filter.expected.ndv#{key}", str(rows_per_file))
        .parquet(path)
    )


def compact(spark: SparkSession, store: str, schema: T.StructType | str, key: str = "url", target: int = TARGET_BYTES) -> list[str]:
    """Merge the batches, and merged folders that are still small, into one folder; the live folders after it.

    Readers go on with the old folders until the commit file is there; these are removed by the compaction after
    that. One compaction runs at a time: the second of two that race fails when it commits and leaves the store
    as it was. The stream may go on meanwhile: a batch that it writes again is one that is merged already.
    """
    last, commit = _last_commit(spark, store)
    batches = _batches(spark, store, commit["covered"])
    if not batches:
        return live_folders(spark, store)
    sizes = {name: storage.size_of(spark, f"{store}/{name}") for name in commit["merged"]}
    small = [name for name, size in sizes.items() if size < target]
    sources = [*small, *(f"{run}/batch={n}" for run, n in batches)]
    total = sum(storage.size_of(spark, f"{store}/{name}") for name in sources)
    name = f"merged={last + 1:08d}"
    storage.delete(spark, f"{store}/{name}")  # what a compaction that failed may have left
    rows = spark.read.schema(schema).parquet(*(f"{store}/{s}" for s in sources))
    write_sorted(rows, f"{store}/{name}", key, max(1, -(-total // target)))
    covered = {**commit["covered"], **dict(batches)}  # the last batch of each run, as they are sorted
    new = {"merged": [*(m for m in commit["merged"] if m not in small), name], "covered": covered, "retired": sources}
    storage.write_text(spark, f"{store}/_commits/{last + 1:08d}.json", json.dumps(new))
    for old in commit["retired"]:
        storage.delete(spark, f"{store}/{old}")
    return live_folders(spark, store)


def known_keys(spark: SparkSession, store: str, schema: T.StructType | str, key: str) -> DataFrame:
    """The distinct keys of the store (column ``key``)."""
    return read_stored(spark, store, schema).select(key).where(F.col(key).isNotNull()).distinct()
