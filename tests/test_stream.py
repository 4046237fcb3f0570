"""The streamed store: keys as state, replays, and merging of batches."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from larder import storage
from larder.streaming import stored
from larder.streaming.ingest import stream_upsert

ROW = "url string, arrival int"


def upsert(spark, tmp_path, source, checkpoint, max_files=1):
    stream = spark.readStream.schema(ROW).option("maxFilesPerTrigger", max_files).parquet(f"{tmp_path}/{source}")
    query = stream_upsert(stream, f"{tmp_path}/store", f"{tmp_path}/{checkpoint}", ["arrival"])
    query.awaitTermination()
    return query


def add(spark, tmp_path, source, rows):
    spark.createDataFrame(rows, ROW).coalesce(1).write.mode("append").parquet(f"{tmp_path}/{source}")


def kept(spark, tmp_path):
    return sorted((r.url, r.arrival) for r in stored.read_stored(spark, f"{tmp_path}/store", ROW).collect())


def test_keys_are_state(spark, tmp_path):
    add(spark, tmp_path, "in", [("u1", 2), ("u1", 1), ("u2", 3), (None, 4), ("u3", None), ("u3", 9)])
    first = upsert(spark, tmp_path, "in", "a")
    assert kept(spark, tmp_path) == [("u1", 1), ("u2", 3), ("u3", None)]
    # the store is not read any more: later batches know its keys though its rows are away
    (run,) = [n for n in storage.names_in(spark, f"{tmp_path}/store") if n.startswith("run=")]
    os.rename(f"{tmp_path}/store/{run}", f"{tmp_path}/away")
    add(spark, tmp_path, "in", [("u1", 0), ("u4", 5)])
    second = upsert(spark, tmp_path, "in", "a")
    assert kept(spark, tmp_path) == [("u4", 5)]
    assert sum(p["numInputRows"] for p in map(dict, second.recentProgress)) == 2 < sum(p["numInputRows"] for p in map(dict, first.recentProgress))


def test_another_checkpoint_takes_over_the_keys(spark, tmp_path):
    add(spark, tmp_path, "in", [("u1", 1), ("u2", 2)])
    upsert(spark, tmp_path, "in", "a")
    add(spark, tmp_path, "in", [("u2", 7), ("u3", 3)])
    upsert(spark, tmp_path, "in", "b")
    upsert(spark, tmp_path, "in", "a")  # u3 is known to the store, not to this state: it is a run of its own
    urls = [u for u, _ in kept(spark, tmp_path)]
    assert urls.count("u1") == urls.count("u2") == 1


def test_a_batch_that_runs_again(spark, tmp_path):
    """The commit of the last batch is lost, so the query does it again."""
    for rows in ([("u1", 1)], [("u2", 2), ("u1", 3)]):
        add(spark, tmp_path, "in", rows)
        upsert(spark, tmp_path, "in", "a")
    before = kept(spark, tmp_path)
    commits = f"{tmp_path}/a/commits"
    last = max(int(n) for n in os.listdir(commits) if n.isdigit())
    for name in (str(last), f".{last}.crc"):
        if os.path.exists(f"{commits}/{name}"):
            os.remove(f"{commits}/{name}")
    upsert(spark, tmp_path, "in", "a")
    assert kept(spark, tmp_path) == before == [("u1", 1), ("u2", 2)]


def batch(spark, store, run, n, rows):
    spark.createDataFrame(rows, ROW).coalesce(1).write.mode("overwrite").parquet(f"{store}/run={run}/batch={n}")


def files_of(spark, store):
    return sum(f.endswith(".parquet") for folder in stored.live_folders(spark, store) for f in storage.names_in(spark, folder))


def test_a_hundred_batches_leave_few_files(spark, tmp_path):
    store, want = f"{tmp_path}/store", []
    for n in range(100):
        rows = [(f"u{n:03}-{i}", n) for i in range(3)]
        batch(spark, store, "ab"[n % 2], n // 2, rows)
        want += rows
        if n % 20 == 19:
            stored.compact(spark, store, ROW)
            assert kept(spark, tmp_path) == sorted(want)
    assert files_of(spark, store) == 1
    # of what was merged only the folders that the last compaction replaced are still there
    folders = [n for run in ("run=a", "run=b") for n in storage.names_in(spark, f"{store}/{run}")]
    assert len(folders) == 20


def test_merged_batches_count_once(spark, tmp_path):
    store = f"{tmp_path}/store"
    batch(spark, store, "a", 0, [("u1", 1)])
    batch(spark, store, "a", 1, [("u2", 2)])
    stored.compact(spark, store, ROW)
    batch(spark, store, "a", 1, [("u2", 2)])  # the stream writes its last batch again
    assert kept(spark, tmp_path) == [("u1", 1), ("u2", 2)]
    batch(spark, store, "a", 2, [("u3", 3)])
    os.makedirs(f"{store}/run=a/batch=3/_temporary")  # a batch that is being written
    assert kept(spark, tmp_path) == [("u1", 1), ("u2", 2), ("u3", 3)]
    assert stored.compact(spark, store, ROW) == [f"{store}/merged=00000002"]
    assert kept(spark, tmp_path) == [("u1", 1), ("u2", 2), ("u3", 3)]
    assert stored.compact(spark, store, ROW) == [f"{store}/merged=00000002"]


def test_large_folders_are_left_alone(spark, tmp_path):
    store = f"{tmp_path}/store"
    for n in range(3):
        batch(spark, store, "a", n, [(f"u{n}", n)])
        stored.compact(spark, store, ROW, target=1)
    assert stored.live_folders(spark, store) == [f"{store}/merged={n:08d}" for n in (1, 2, 3)]
    assert kept(spark, tmp_path) == [("u0", 0), ("u1", 1), ("u2", 2)]


def test_of_two_compactions_one_wins(spark, tmp_path):
    store = f"{tmp_path}/store"
    batch(spark, store, "a", 0, [("u1", 1)])
    storage.write_text(spark, f"{store}/_commits/00000001.json", json.dumps(stored.NOTHING))
    with pytest.raises(FileExistsError):
        storage.write_text(spark, f"{store}/_commits/00000001.json", "{}")
    assert kept(spark, tmp_path) == [("u1", 1)]


def test_no_store(spark, tmp_path):
    assert kept(spark, tmp_path) == [] and stored.compact(spark, f"{tmp_path}/store", ROW) == []


def test_lookups_skip_row_groups(spark, tmp_path):
    """Keys that the store does not have: sorted files and their Bloom filters rule out nearly every row group."""
    path = f"{tmp_path}/keys"
    rows = spark.range(200_000).select(F.concat(F.lit("http://h/"), F.col("id") * 2).alias("url"), F.col("id").alias("arrival"))
    stored.write_sorted(rows, path, "url", 8)
    absent = [f"http://h/{2 * i + 1}" for i in range(0, 190_000, 30_011)]
    hit = spark.read.parquet(path).where(F.col("url").isin(absent))
    assert hit.count() == 0
    plan = hit._jdf.queryExecution().executedPlan()
    while plan.children().size():
        plan = plan.children().head()
    hit.collect()
    read = plan.metrics().get("numOutputRows").get().value()
    assert read < 50_000, read
