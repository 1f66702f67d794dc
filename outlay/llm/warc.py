"""Operator 10, WARC: writer, and a splittable reader of gzip members.

Writer: one record per page, one gzip member per record. Pages with equal
payloads of at least ``min_bytes`` bytes are written once, as ``response`` of the
largest page_id; the others are ``revisit`` records that refer to it and carry
no payload. Tasks write archives into the shared folder and return a manifest
row per file; only files in the written manifest are read, so a lost or
repeated task leaves no trace.

Reader: archives are cut into byte ranges. A task scans its range for the gzip
magic and accepts a candidate when the member decodes to a WARC header. It
owns the records that start inside its range, reading past the end to finish
the last one; from an accepted member on, the next starts where it ended.

Defined cases: NULL html is an empty payload, and NULL or broken URLs are
written percent-encoded; NULL page_ids are written without a number and read
back as NULL, rank below any number and have no response of their own unless
all equal payloads lack one; equal rows repeated are each written, and all rows
of the largest page_id are responses; an empty table gives no archive and no
rows; members that are no WARC record, and bytes between members, are skipped.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch, stage, text_or_empty, text_slices

MAGIC = b"\x1f\x8b\x08"
FILE_BYTES, SPLIT_BYTES, READ_BYTES, LEVEL = 64 << 20, 8 << 20, 1 << 20, 4
DATE = "2020-01-01T00:00:00Z"
_URN = "urn:outlay:page:"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(page_id: int | None) -> str:
    return f"<{_URN}{'' if page_id is None else page_id}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record."""
    http = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _urn(page_id)),
              ("WARC-Date", DATE), ("WARC-Target-URI", quote(url or "", safe=":/?#[]@!$&'()*+,;=%~")),
              ("WARC-Payload-Digest", f"sha1:{digest(payload)}"),
              ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    if revisit:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                   ("WARC-Refers-To", _urn(refers_to))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def member(data: bytes, level: int = LEVEL) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def open_folder(folder: str) -> tuple[pa.fs.FileSystem, str]:
    """File system and path of a shared folder given as URI or local path."""
    if re.match(r"file:/+", folder):
        return pa.fs.LocalFileSystem(), "/" + re.sub(r"^file:/+", "", folder)
    return pa.fs.FileSystem.from_uri(folder) if "://" in folder else (pa.fs.LocalFileSystem(), folder)


def with_roles(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, html, refers_to and ``revisit``; payloads meet by digest, counted before the join."""
    p = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", text_or_empty(F.col("html")).alias("html"))
    p = p.withColumn("sha", F.when(F.octet_length("html") >= min_bytes, F.sha1(F.col("html").cast("binary"))))
    top = (p.filter("sha IS NOT NULL").groupBy("sha")
           .agg(F.max("page_id").alias("top"), F.count("*").alias("n")).filter("n > 1").drop("n"))
    revisit = F.coalesce(F.col("top").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") < F.col("top"))),
                         F.lit(False))
    return p.join(top, "sha", "left").select(
        "page_id", "url", "html", F.when(revisit, F.col("top")).alias("refers_to"), revisit.alias("revisit"))


def write(pages: DataFrame, folder: str, min_bytes: int = 0, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write archives below ``folder``; the manifest (path, bytes, records)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_folder(folder)
        out = name = None
        size = n = 0

        def close() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict({"path": [name], "bytes": [size], "records": [n]})

        for part in text_slices(batches, "html", READ_BYTES):
            rows = [part.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to", "revisit")]
            for page_id, url, html, refers_to, revisit in zip(*rows):
                if out is None:
                    fs.create_dir(root, recursive=True)
                    name, size, n = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)
                data = member(record(page_id, url, html.encode(), refers_to, revisit))
                out.write(data)
                size, n = size + len(data), n + 1
                if size >= file_bytes:
                    yield close()
                    out = None
        if out is not None:
            yield close()

    return stage(with_roles(pages, min_bytes).mapInArrow(run, "path string, bytes bigint, records bigint"), "manifest")


def parse(data: bytes) -> dict | None:
    """Headers and block of a decoded record; None if it is no whole WARC record."""
    end = data.find(b"\r\n\r\n")
    if not data.startswith(b"WARC/") or end < 0:
        return None
    head = dict(re.findall(r"^([^:\r\n]+):[ \t]*([^\r\n]*)", data[:end].decode("utf-8", "replace"), re.M))
    head = {k.lower(): v for k, v in head.items()}
    try:
        size = int(head["content-length"])
    except (KeyError, ValueError):
        return None
    block = data[end + 4:end + 4 + size]
    return head | {"block": block} if len(block) == size else None


def members(read, start: int, end: int) -> Iterator[tuple[int, dict]]:
    """(offset, record) of the members that start in [start, end); ``read(offset, n)`` gives file bytes."""
    buf, base = read(start, end - start + READ_BYTES), start

    def more() -> bool:
        nonlocal buf
        chunk = read(base + len(buf), READ_BYTES)
        buf += chunk
        return bool(chunk)

    def decode(at: int) -> tuple[bytes, int] | None:
        """(content, offset behind) of the member at ``at``; rejected on its first bytes if no WARC header."""
        z, out, i = zlib.decompressobj(31), b"", at
        parts, checked = [], False
        try:
            while not z.eof:
                if i - base >= len(buf) and not more():
                    return None
                chunk = buf[i - base:i - base + (1 << 16)]
                parts.append(z.decompress(chunk))
                i += len(chunk)
                if not checked:
                    out = b"".join(parts)[:5]
                    if len(out) == 5 or z.eof:
                        if out != b"WARC/":
                            return None
                        checked = True
        except zlib.error:
            return None
        return b"".join(parts), i - len(z.unused_data)

    at = start
    while at < end:
        if buf[at - base:at - base + 3] != MAGIC:
            found = buf.find(MAGIC, at - base)
            if found < 0 or base + found >= end:
                return
            at = base + found
        got = decode(at)
        rec = parse(got[0]) if got else None
        if rec is None:
            at += 1
            continue
        yield at, rec
        at = got[1]


def _page(urn: str | None) -> int | None:
    m = re.fullmatch(rf"<{_URN}(-?\d+)>", urn or "")
    return int(m[1]) if m else None


def read(spark: SparkSession, folder: str, manifest: DataFrame, split_bytes: int = SPLIT_BYTES,
         payload: bool = False) -> DataFrame:
    """Records of the archives in ``manifest`` (path, bytes), read by byte ranges."""
    ranges = manifest.select("path", "bytes", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(split_bytes).cast("bigint"))).alias("start"))
    count = max(1, ranges.count())
    ranges = ranges.select("path", "start", F.least(F.col("start") + split_bytes, "bytes").alias("end")).repartition(count)
    schema = pa.schema([("path", pa.string()), ("start", pa.int64()), ("record_type", pa.string()),
                        ("page_id", pa.int64()), ("refers_to", pa.int64()), ("target_uri", pa.string()),
                        ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_folder(folder)
        for b in batches:
            for path, start, end in zip(*[c.to_pylist() for c in b.columns]):
                rows, held = [], 0
                with fs.open_input_file(f"{root}/{path}") as f:
                    def at(offset: int, n: int) -> bytes:
                        f.seek(offset)
                        return f.read(n)

                    for offset, r in members(at, start, end):
                        http, _, body = r["block"].partition(b"\r\n\r\n")
                        length = re.search(rb"(?im)^content-length:\s*(\d+)", http)
                        revisit = r.get("warc-type") == "revisit"
                        rows.append({
                            "path": path, "start": offset, "record_type": r.get("warc-type"),
                            "page_id": _page(r.get("warc-record-id")), "refers_to": _page(r.get("warc-refers-to")),
                            "target_uri": r.get("warc-target-uri"),
                            "payload_bytes": int(length[1]) if revisit and length else len(body),
                            "payload_digest": r.get("warc-payload-digest", "").removeprefix("sha1:") if revisit
                            else digest(body), "payload": body if payload and not revisit else None})
                        held += len(body) if payload else 300
                        if held >= FILE_BYTES // 8:
                            yield pa.RecordBatch.from_pylist(rows, schema=schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return ranges.mapInArrow(run, (
        "path string, start bigint, record_type string, page_id bigint, refers_to bigint, target_uri string, "
        "payload_bytes bigint, payload_digest string, payload binary"))


class DamagedArchive(ValueError):
    """Archives whose records are not those that their manifest counts."""


def verify(records: DataFrame, manifest: DataFrame, shown: int = 20) -> DataFrame:
    """``records``, after each file's were counted against ``manifest`` (path, records).

    Records that cannot be decoded are not among those read, so a file with fewer
    than it was written with is damaged: an error names such files and both counts.
    """
    read_back = records.groupBy("path").agg(F.count("*").alias("found"))
    wrong = manifest.join(read_back, "path", "left").withColumn("found", F.coalesce("found", F.lit(0))).filter(
        "records <> found")
    files = wrong.orderBy("path").limit(shown).collect()
    if files:
        raise DamagedArchive("; ".join(f"{r['path']}: {r['found']} of {r['records']} records" for r in files)
                             + (" and others" if len(files) == shown else ""))
    return records


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write the pages as archives, then read these back; every file's records are counted against the manifest."""
    spark = pages.sparkSession
    folder = scratch(spark, "warc")
    manifest = write(pages, folder, min_bytes)
    return verify(stage(read(spark, folder, manifest), "records"), manifest)
