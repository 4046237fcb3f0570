"""WARC archives: exact round trips, ranges of any size, records inside payloads."""

from __future__ import annotations

import base64
import gzip
import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from larder.llm import queries, warc
from larder.llm.common import fresh_path

SF = "/root/testdata/sf0.001"
FIELDS = "page_id bigint, url string, html string"


def rows_of_pages():
    rnd = random.Random(3)
    noise = "".join(chr(rnd.choice([rnd.randrange(32, 127), rnd.randrange(0x400, 0x2000)])) for _ in range(150_000))
    texts = [None, "", "", "<p>one</p>", "<p>one</p>", "<p>two</p>", "\r\n\r\nWARC/1.1\r\n", "é日本\x00", noise, noise, "HTTP/1.1 200 OK\r\n\r\n"]
    rows = [(100 - i, f"http://h/{i}\r\nX: y", t) for i, t in enumerate(texts)]
    return [*rows, (7, None, "<p>two</p>"), (None, "http://n/", "<p>two</p>"), (None, None, "alone"), (7, None, "<p>two</p>")]


def expected(rows):
    out, least = [], {}
    for key, _, html in rows:
        data = (html or "").encode()
        order = (key is None, key or 0)
        least[data] = min(least.get(data, order), order)
    for key, _, html in rows:
        data = (html or "").encode()
        none, first = least[data]
        response = (key is None, key or 0) == (none, first)
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((key, len(data), digest, "response" if response else "revisit", None if response else first, data if response else None))
    return sorted(out, key=str)


def read_back(archives, **options):
    got = warc.read_warc(archives, **options).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload")
    return sorted(((*r[:5], None if r[5] is None else bytes(r[5])) for r in got.collect()), key=str)


@pytest.mark.parametrize("range_bytes", [1 << 20, 1000, 97])
def test_round_trip_in_ranges(spark, range_bytes):
    rows = rows_of_pages()
    pages = spark.createDataFrame(rows, FIELDS).repartition(3).select("*", F.lit("own").alias("refers_to"), F.lit(1).alias("path"))
    files = warc.write_warc(pages, fresh_path(spark, "warc"), file_bytes=100_000)
    assert files.count() > 1
    assert read_back(files, range_bytes=range_bytes) == expected(rows)


def test_files_are_gzip_members_of_records(spark):
    files = warc.write_warc(spark.createDataFrame(rows_of_pages(), FIELDS).coalesce(1), fresh_path(spark, "warc"))
    (only,) = files.collect()
    with open(only["path"].removeprefix("file:"), "rb") as f:
        data = f.read()
    assert len(data) == only["size"] and gzip.decompress(data).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n")
    members = 0
    while data:
        unpack = zlib.decompressobj(31)
        record = unpack.decompress(data)
        head, _, block = record.partition(b"\r\n\r\n")
        length = next(int(x.split(b":")[1]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length"))
        assert block[length:] == b"\r\n\r\n" and b"\r\nX: y" not in head
        data, members = unpack.unused_data, members + 1
    assert members == only["records"] == len(rows_of_pages()) + 1


def test_members_inside_a_payload_are_no_records(spark, tmp_path):
    """An archive stored within a record, byte for byte, beside bytes that only look like a member."""
    inner = warc._member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", "<urn:uuid:inner>")], b"")
    inner += warc._page_record("<urn:uuid:inner>", "2024-01-01T00:00:00Z", 66, "http://inner/", b"inner", None, False)

    def stored(headers, block):
        head = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", len(block))])
        pack = zlib.compressobj(0, zlib.DEFLATED, 31)
        return pack.compress(f"WARC/1.1\r\n{head}\r\n".encode() + block + b"\r\n\r\n") + pack.flush()

    info = "<urn:uuid:outer>"
    http = b"HTTP/1.1 200 OK\r\n\r\n"
    outer = stored([("WARC-Type", "warcinfo"), ("WARC-Record-ID", info)], b"x")
    for key, payload in ((1, inner), (2, warc.MAGIC * 50 + inner[:40]), (3, b"plain")):
        outer += stored([("WARC-Type", "response"), ("WARC-Record-ID", f"<urn:x-page:{key}>"), ("WARC-Warcinfo-ID", info)], http + payload)
    (tmp_path / "a.warc.gz").write_bytes(outer)
    files = warc.archives_in(spark, str(tmp_path))
    for range_bytes in (1 << 20, 64):
        got = warc.read_warc(files, range_bytes=range_bytes).collect()
        assert sorted((r["page_id"], bytes(r["payload"])) for r in got) == [(1, inner), (2, warc.MAGIC * 50 + inner[:40]), (3, b"plain")]


def test_a_changed_payload_is_reported(spark, tmp_path):
    record = warc._member([("WARC-Type", "response"), ("WARC-Payload-Digest", "sha1:" + "A" * 32)], b"HTTP/1.1 200 OK\r\n\r\nx")
    (tmp_path / "a.warc.gz").write_bytes(record)
    with pytest.raises(Exception, match="does not have its digest"):
        warc.read_warc(warc.archives_in(spark, str(tmp_path))).collect()


def test_small_payloads_stay_responses(spark):
    files = warc.write_warc(spark.createDataFrame(rows_of_pages(), FIELDS), fresh_path(spark, "warc"), least_bytes=1)
    kinds = {(r["payload_bytes"] > 0, r["record_type"]) for r in warc.read_warc(files).collect()}
    assert kinds == {(False, "response"), (True, "response"), (True, "revisit")}


def test_no_pages(spark):
    files = warc.write_warc(spark.createDataFrame([], FIELDS), fresh_path(spark, "warc"))
    assert files.count() == 0 and warc.read_warc(files).count() == 0


def test_query_keeps_every_page(spark):
    got = queries.op11_warc(spark, SF)
    assert got.count() == spark.read.parquet(f"{SF}/pages.parquet").count()
