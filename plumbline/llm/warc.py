"""WARC archives through a chunked record table.

Writing: payloads are cut into chunks of at most ``CHUNK`` bytes (at a character
border).  A record is one row per chunk, named by record id and chunk number,
and carries the running digest of the payload up to that chunk; so nothing
longer than a chunk is ever built.  A payload of several chunks becomes a
segmented record of the WARC format (``WARC-Segment-Number``, ``continuation``
records).  Rows are written by Spark's text writer, whose line end is the blank
lines that close a WARC record, in files of a bounded number of rows.

Of the records with equal payloads of at least ``min_bytes`` the one with the
largest page id is the ``response``; the others are ``revisit`` records that name
it and hold no payload.

Reading: every archive file is parsed by its Content-Length fields.  A record
of one chunk is checked on the spot; the segments of a longer one, which may
lie in several files, become chunk rows again that meet in (record, chunk)
order, and the digest and length checks run over them incrementally.

Defined cases: a null page is an empty payload; a null page id is archived with
an empty id and never referred to; repeated rows of one id and payload are
records of their own, all of the type their page has; extra columns are
ignored; an empty table gives no records.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.common import in_arrow, slices, table, written
from plumbline.session import checkpoint_dir

CHUNK = 32 << 10
ROWS_PER_FILE = 1024
RECORD_END = "\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_SCHEMA = ("record string, page_id long, chunk_no int, whole boolean, record_type string, refers_to long, "
           "payload_bytes long, payload_digest string, data binary")


def digest_text(sha: bytes) -> str:
    return base64.b32encode(sha).decode()


def chunks(raw: memoryview, size: int = CHUNK) -> Iterator[memoryview]:
    """Pieces of at most ``size`` bytes that end at character borders; an empty
    payload is one empty piece."""
    at = 0
    while True:
        end = min(len(raw), at + size)
        while end < len(raw) and raw[end] & 0xC0 == 0x80:
            end -= 1
        yield raw[at:end]
        at = end
        if at >= len(raw):
            return


def with_references(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """(page_id, url, html, sha, size, response): ``response`` is the page whose record
    holds the payload, where several pages have it."""
    p = pages.select(pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"),
                     F.coalesce(pages["html"].cast("string"), F.lit("")).alias("html"))
    p = p.withColumn("sha", F.sha1(F.col("html").cast("binary"))).withColumn("size", F.octet_length("html").cast("long"))
    shared = (p.groupBy("sha", "size").agg(F.max("page_id").alias("response"), F.count("*").alias("n"))
              .filter((F.col("n") > 1) & (F.col("size") >= min_bytes)).select("sha", "response"))
    return p.join(written(shared, "payloads"), "sha", "left")


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Archive rows: one WARC record (or segment) each, without its end."""
    for batch in batches:
        for part in slices(batch, "html"):
            page, url, record, response = (part.column(i).to_pylist() for i in (0, 1, 3, 4))
            html, out = part.column(2), []
            for i in range(part.num_rows):
                raw = memoryview(html[i].as_buffer())
                known = page[i] is not None
                kind = "revisit" if known and response[i] is not None and response[i] != page[i] else "response"
                sha, whole = hashlib.sha1(raw), len(raw)
                head = [f"WARC-Target-URI: {re.sub('[^!-~]', '', url[i] or '')}", f"WARC-Date: {DATE}",
                        f"X-Page-Id: {page[i] if known else ''}", f"X-Payload-Length: {whole}",
                        f"WARC-Payload-Digest: sha1:{digest_text(sha.digest())}"]
                if kind == "revisit":
                    out.append(_record("revisit", f"{record[i]}-0", [
                        *head, f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{response[i]}>"], b""))
                    continue
                running, n = hashlib.sha1(), 0
                segmented = whole > CHUNK
                for piece in chunks(raw):
                    running.update(piece)
                    n += 1
                    more = list(head)
                    if segmented:
                        more += [f"WARC-Segment-Number: {n}", f"X-Running-Digest: sha1:{digest_text(running.digest())}"]
                        if n > 1:
                            more.append(f"WARC-Segment-Origin-ID: <urn:record:{record[i]}-0>")
                    block = bytes(piece)
                    if n == 1:
                        block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {whole}\r\n\r\n"
                                 .encode() + block)
                    out.append(_record("response" if n == 1 else "continuation", f"{record[i]}-{n - 1}", more, block))
                    if len(out) >= 256:
                        yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])
                        out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], names=["value"])


def _record(kind: str, record: str, head: list[str], block: bytes) -> str:
    kind_of = "application/http; msgtype=response" if kind != "continuation" else "application/octet-stream"
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:record:{record}>", *head,
             f"Content-Type: {kind_of}", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines) + "\r\n\r\n" + block.decode("utf-8")


def write_archives(pages: DataFrame, path: str, min_bytes: int = 0) -> None:
    """Archive every row of ``pages`` (page_id, url, html) under ``path``."""
    rows = (with_references(pages, min_bytes)
            .select("page_id", "url", "html",
                    F.concat_ws("-", F.col("page_id").cast("string"), F.monotonically_increasing_id().cast("string")).alias("record"),
                    "response"))
    (rows.transform(in_arrow, _records, "value string").write.option("lineSep", RECORD_END)
     .option("maxRecordsPerFile", ROWS_PER_FILE).text(path))


_field = re.compile(rb"([A-Za-z0-9-]+):[ \t]*(.*)")


def parse(raw: memoryview) -> Iterator[tuple[dict[str, str], memoryview]]:
    """(fields, block) of every record of an archive file."""
    at, data = 0, raw.obj if isinstance(raw.obj, bytes) else bytes(raw)
    while at < len(raw):
        end = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:end].split(b"\r\n")
        if not first.startswith(b"WARC/1."):
            raise ValueError(f"no WARC record at byte {at}")
        fields = {m[1].decode().lower(): m[2].decode() for m in map(_field.fullmatch, lines) if m}
        start = end + 4
        stop = start + int(fields["content-length"])
        yield fields, raw[start:stop]
        if data[stop:stop + 4] != b"\r\n\r\n":
            raise ValueError(f"record not closed at byte {stop}")
        at = stop + 4


def _chunk_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in _SCHEMA.split(", ")]
    types = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    for batch in batches:
        for i in range(batch.num_rows):
            rows, held = [], 0
            for f, block in parse(memoryview(batch.column(0)[i].as_py())):
                record, _, no = f["warc-record-id"][12:-1].rpartition("-")
                total = int(f["x-payload-length"])
                sha = f["warc-payload-digest"].removeprefix("sha1:")
                page = int(f["x-page-id"]) if f["x-page-id"] else None
                if f["warc-type"] == "revisit":
                    rows.append((record, page, 0, True, "revisit", int(f["warc-refers-to"][10:-1]), total, sha, None))
                    continue
                data = bytes(block)
                if f["warc-type"] == "response":
                    data = data[data.index(b"\r\n\r\n") + 4:]
                whole = len(data) == total
                if whole:  # checked here; its bytes need not travel
                    check(record, hashlib.sha1(data), total, sha, total)
                    data = None
                rows.append((record, page, int(no), whole, "response", None, total, sha, data))
                held += 0 if whole else len(data)
                if held >= 1 << 20 or len(rows) >= 4096:
                    yield batch_of(rows)
                    rows, held = [], 0
            if rows:
                yield batch_of(rows)


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """The chunked record table of the archives under ``path``."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.transform(in_arrow, _chunk_rows, _SCHEMA)


def check(record: str, sha, size: int, want: str, want_size: int) -> None:
    if digest_text(sha.digest()) != want or size != want_size:
        raise ValueError(f"record {record}: payload does not match its digest")


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per record from its chunk rows, which come in order; the digest
    grows with each chunk and only one batch is held."""
    held, sha, size, row, whole = None, None, 0, None, True
    done: list[tuple] = []

    def close() -> None:
        if row is not None:
            if not whole:
                check(held, sha, size, row[2], row[1])
            done.append(row)

    def flush() -> pa.RecordBatch:
        cols = list(zip(*done, strict=True)) or [()] * 5
        out = pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()), strict=True)],
            names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])
        done.clear()
        return out

    for batch in batches:
        cols = [batch.column(i).to_pylist() for i in range(8)]
        data = batch.column(8)
        for i, record in enumerate(cols[0]):
            if record != held:
                close()
                held, sha, size, whole = record, hashlib.sha1(), 0, cols[3][i]
                row = (cols[1][i], cols[6][i], cols[7][i], cols[4][i], cols[5][i])
            if data[i].is_valid:
                piece = memoryview(data[i].as_buffer())
                sha.update(piece)
                size += len(piece)
        yield flush()
    close()
    yield flush()


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to), every digest and
    length recomputed from the archived bytes."""
    rows = read_chunks(spark, path).repartition("record").sortWithinPartitions("record", "chunk_no")
    return rows.transform(in_arrow, _fold, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{checkpoint_dir(spark)}/plumbline-llm/warc-{uuid.uuid4().hex}"
    write_archives(table(spark, sf_dir, "pages"), path)
    return read_archives(spark, path)
