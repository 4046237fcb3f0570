"""WARC archives: one gzip member per record, written by tasks and read in byte ranges.

Every writing task makes files of its own under names that no other attempt uses; the files of the attempts that
succeeded are those that the returned table names. A reading task scans its range for the first bytes of a gzip member
and takes a place for a record only if it decodes to WARC headers that name the file's own warcinfo record, so
members inside a stored payload do not count. It reads all records that start in its range, also beyond its end.

Files are opened through pyarrow's file systems, by the same addresses that Spark uses (file, hdfs, s3, gs, abfs).
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.common import arrow_map, by_blocks, cut

MAGIC = b"\x1f\x8b\x08"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FILE_BYTES = 256 << 20
RANGE_BYTES = 32 << 20
STEP = 64 << 10
#: Decoded bytes within which the headers of a record end.
HEADER_BYTES = 1 << 20
RECORD_ID = re.compile(r"<urn:x-page:(null|-?[0-9]+)>")
ODD = re.compile(r"[\x00-\x1f\x7f]")


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _open(path: str):
    from pyarrow.fs import FileSystem

    # "file:/x" is how Hadoop writes "file:///x"
    return FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


def _record_id(page_id: int | None) -> str:
    return f"<urn:x-page:{'null' if page_id is None else page_id}>"


def _page_id(record_id: str | None) -> int | None:
    found = RECORD_ID.fullmatch(record_id or "")
    return None if not found or found[1] == "null" else int(found[1])


def _member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """One record as a gzip member of its own."""
    head = "".join(f"{name}: {value}\r\n" for name, value in [*headers, ("Content-Length", str(len(block)))])
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    raw = f"WARC/1.1\r\n{head}\r\n".encode("utf-8", "surrogatepass")
    return pack.compress(raw) + pack.compress(block) + pack.compress(b"\r\n\r\n") + pack.flush()


def _page_record(info: str, date: str, page_id, url: str | None, payload: bytes, refers_to, is_revisit: bool) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    headers = [
        ("WARC-Type", "revisit" if is_revisit else "response"), ("WARC-Record-ID", _record_id(page_id)),
        ("WARC-Warcinfo-ID", info), ("WARC-Date", date), ("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}"),
        ("Content-Type", "application/http;msgtype=response"),
    ]
    if url is not None:
        headers.append(("WARC-Target-URI", ODD.sub(lambda c: f"%{ord(c[0]):02X}", url)))
    if is_revisit:
        headers += [("WARC-Refers-To", _record_id(refers_to)), ("WARC-Profile", PROFILE)]
    return _member(headers, http if is_revisit else http + payload)


class _Archive:
    """The file that a task is writing."""

    def __init__(self, folder: str, date: str):
        self.path = f"{folder.rstrip('/')}/{uuid.uuid4().hex}.warc.gz"
        self.info, self.size, self.records = f"<urn:uuid:{uuid.uuid4()}>", 0, 0
        fs, at = _open(self.path)
        fs.create_dir(at.rsplit("/", 1)[0], recursive=True)
        self.out = fs.open_output_stream(at, compression=None)
        fields = b"software: larder\r\nformat: WARC File Format 1.1\r\n"
        headers = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", self.info), ("WARC-Date", date), ("Content-Type", "application/warc-fields")]
        self.write(_member(headers, fields))

    def write(self, member: bytes) -> None:
        self.out.write(member)
        self.size += len(member)
        self.records += 1

    def close(self) -> tuple:
        self.out.close()
        return self.path, self.size, self.records


def _write_pass(folder: str, date: str, file_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, now = [], None
        for batch in by_blocks(batches, "html"):
            columns = [batch[c].to_pylist() for c in ("page_id", "url", "html", "refers_to", "is_revisit")]
            for page_id, url, html, refers_to, is_revisit in zip(*columns, strict=True):
                now = now or _Archive(folder, date)
                now.write(_page_record(now.info, date, page_id, url, html or b"", refers_to, is_revisit))
                if now.size >= file_bytes:
                    done.append(now.close())
                    now = None
        if now:
            done.append(now.close())
        columns = zip(*done, strict=True) if done else [[], [], []]
        types = [pa.string(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], ["path", "size", "records"])

    return run


def with_revisits(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``pages(page_id, url, html)`` with ``refers_to`` and ``is_revisit``, the html as UTF-8 bytes.

    Of equal payloads of at least ``least_bytes`` the one with the least page_id (unknown ones last) is
    no revisit; rows that repeat that page_id and payload are not either. Only payloads that occur under several
    page_ids enter the join, one row each, whatever their number of copies.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select("page_id", "url", payload.alias("html"), F.sha2(payload, 256).alias("__same"))
    order = F.struct(F.col("page_id").isNull().alias("unknown"), "page_id")
    shared = rows.where(F.octet_length("html") >= least_bytes).groupBy(F.col("__same").alias("__key"))
    shared = shared.agg(F.min(order).alias("__first"), F.max(order).alias("__last")).where("__first < __last")
    shared = shared.select("__key", F.col("__first.page_id").alias("__least"))
    later = F.col("__key").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("__least"))
    joined = rows.join(shared, F.col("__same") == F.col("__key"), "left")
    return joined.select("page_id", "url", "html", F.when(later, F.col("__least")).alias("refers_to"), later.alias("is_revisit"))


def write_warc(pages: DataFrame, folder: str, least_bytes: int = 0, file_bytes: int = FILE_BYTES, date: str | None = None) -> DataFrame:
    """Write ``pages(page_id, url, html)`` to archives under ``folder``; (path, size, records) of every file.

    One record per row: a response with the html in UTF-8, or a revisit of the response that holds the same payload.
    A null html is an empty payload; a null url is left out; control characters of a url are written as
    %XX; a null page_id is kept as such; an empty table writes no file; other columns are not read.
    """
    date = date or datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    records = with_revisits(pages, least_bytes)
    return cut(arrow_map(records, _write_pass(folder, date, file_bytes), "path string, size bigint, records bigint"), "archives")


def archives_in(spark: SparkSession, folder: str) -> DataFrame:
    """(path, size) of all archives under a folder that others wrote; their contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").option("recursiveFileLookup", "true")
    return files.load(folder).select("path", F.col("length").alias("size"))


class _Reader:
    """One archive, read forward in steps."""

    def __init__(self, path: str):
        fs, at = _open(path)
        self.file = fs.open_input_file(at)
        self.size = self.file.size()
        self.info = self._own_info()

    def _own_info(self) -> str | None:
        got = self.record(0, None)
        return got[1].get("warc-record-id") if got and got[1].get("warc-type") == "warcinfo" else None

    def record(self, at: int, info: str | None) -> tuple[int, dict, bytes] | None:
        """(length, headers, block) of the record whose member begins at ``at``; None if there is none."""
        unpack, raw, end, wanted = zlib.decompressobj(31), bytearray(), -1, None
        position = at
        try:
            while not unpack.eof and position < self.size:
                data = self.file.read_at(min(STEP, self.size - position), position)
                position += len(data)
                raw += unpack.decompress(data)
                if wanted is None:
                    if raw[:5] != b"WARC/"[: len(raw[:5])]:
                        return None
                    end = raw.find(b"\r\n\r\n")
                    if end < 0 and len(raw) > HEADER_BYTES:
                        return None
                    if end >= 0:
                        wanted = self._headers(bytes(raw[:end]))
                        if wanted is None or info is not None and wanted.get("warc-warcinfo-id") != info:
                            return None
        except zlib.error:
            return None
        if not unpack.eof or wanted is None:
            return None
        length = position - at - len(unpack.unused_data)
        block = bytes(raw[end + 4 : -4])
        if raw[-4:] != b"\r\n\r\n" or len(block) != int(wanted["content-length"]):
            return None
        return length, wanted, block

    @staticmethod
    def _headers(raw: bytes) -> dict | None:
        first, *lines = raw.decode("utf-8", "surrogatepass").split("\r\n")
        out = {}
        for line in lines:
            name, colon, value = line.partition(":")
            if not colon:
                return None
            out[name.strip().lower()] = value.strip()
        return out if out.get("content-length", "").isdigit() and "warc-type" in out else None

    def places(self, start: int, end: int) -> Iterator[int]:
        """Where the first bytes of a member are, from ``start`` on and before ``end``; ``send`` goes further on."""
        at = start
        while at < end:
            data = self.file.read_at(min(STEP, end - at) + len(MAGIC) - 1, at)
            found = data.find(MAGIC)
            if found < 0 or at + found >= end:
                at += max(1, len(data) - len(MAGIC) + 1)
                continue
            on = yield at + found
            at = on if on is not None else at + found + 1

    def records(self, start: int, end: int) -> Iterator[tuple[int, dict, bytes]]:
        """(offset, headers, block) of all records that start in [start, end)."""
        places = self.places(start, end)
        at = next(places, None)
        while at is not None:
            got = self.record(at, None if at == 0 else self.info)
            if got:
                yield at, got[1], got[2]
            try:
                at = places.send(at + got[0] if got else None)
            except StopIteration:
                return


def _page_row(path: str, at: int, headers: dict, block: bytes) -> tuple:
    head, _, payload = block.partition(b"\r\n\r\n")
    stated = headers.get("warc-payload-digest", "").removeprefix("sha1:")
    if headers["warc-type"] == "revisit":
        length = re.search(rb"(?im)^content-length: *([0-9]+)", head)
        size, digest, payload = int(length[1]) if length else None, stated, None
    else:
        size, digest = len(payload), payload_digest(payload)
        if stated and stated != digest:
            raise ValueError(f"payload of the record at {at} of {path} does not have its digest")
    refers = _page_id(headers.get("warc-refers-to"))
    return (path, at, _page_id(headers.get("warc-record-id")), headers["warc-type"], headers.get("warc-target-uri"), size, digest, refers, payload)


COLUMNS = {
    "path": pa.string(), "offset": pa.int64(), "page_id": pa.int64(), "record_type": pa.string(), "url": pa.string(),
    "payload_bytes": pa.int64(), "payload_digest": pa.string(), "refers_to": pa.int64(), "payload": pa.binary(),
}


def _read_pass(columns: list[str]):
    names = list(COLUMNS)
    picked = [names.index(c) for c in columns]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], COLUMNS[names[i]]) for i in picked], columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ranges = [batch[c].to_pylist() for c in ("path", "start", "end")]
            for path, start, end in zip(*ranges, strict=True):
                rows, held = [], 0
                for at, headers, block in _Reader(path).records(start, end):
                    if headers["warc-type"] not in ("response", "revisit"):
                        continue
                    rows.append(tuple(_page_row(path, at, headers, block)))
                    held += len(block)
                    if held > 4_000_000 or len(rows) >= 1000:
                        yield batch_of(rows)
                        rows, held = [], 0
                yield batch_of(rows)

    return run


def read_warc(archives: DataFrame, columns: list[str] | None = None, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The response and revisit records of ``archives(path, size)``, read in ranges of ``range_bytes``.

    Columns (all, or those named): path, offset, page_id, record_type, url, payload_bytes and payload_digest (of the
    full payload, for revisits as their headers state), refers_to and payload (null for revisits). A response
    whose payload does not have its digest ends the job. No archives give an empty result.
    """
    columns = columns or list(COLUMNS)
    size = F.col("size")
    ranges = archives.where(size > 0).select(
        "path", size, F.explode(F.sequence(F.lit(0).cast("bigint"), size - 1, F.lit(range_bytes).cast("bigint"))).alias("start")
    )
    ranges = ranges.select("path", "start", F.least(F.col("start") + range_bytes, size).alias("end"))
    total = archives.agg(F.sum(F.ceil(size / range_bytes))).first()[0] or 1
    kinds = {pa.string(): "string", pa.int64(): "bigint", pa.binary(): "binary"}
    schema = ", ".join(f"{c} {kinds[COLUMNS[c]]}" for c in columns)
    return arrow_map(ranges.repartition(int(min(total, 100_000))), _read_pass(columns), schema)
