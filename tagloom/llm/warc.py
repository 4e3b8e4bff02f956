"""WARC archives: a writer of one gzip member per record and a sequential reader that verifies them."""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..lineage import checkpoint_dir, cut
from .common import slices

#: Payloads of at least so many bytes are stored once; others that are equal revisit the first.
MIN_REVISIT = 0
#: A task begins a new archive after so many compressed bytes.
ARCHIVE_BYTES = 128 << 20
READ_BYTES = 1 << 20
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = b"\r\n"
MANIFEST = "path string, records long, bytes long"
RECORDS = (
    "path string, record_offset long, record_type string, record_id string, target_uri string, refers_to string, "
    "payload_bytes long, payload_digest string, payload binary, problem string"
)


def base32_sha1(payload: Column) -> Column:
    """The bare upper-case base32 of the SHA-1 of binary data: each 20 bits, five hex digits, are four characters."""
    digits = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digits, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def plan_records(pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """page_id, url, html, digest, refers_to: which page is stored whole (refers_to null) and which revisits it.

    The first page of each payload is found with map-side minima over (digest, size), never with a group in a task.
    """
    body = F.coalesce(pages["html"].cast("string"), F.lit(""))
    rows = pages.select(
        pages["page_id"].cast("long").alias("page_id"), pages["url"].cast("string").alias("url"), body.alias("html"),
        base32_sha1(F.encode(body, "UTF-8")).alias("digest"), F.octet_length(body).cast("long").alias("size"))
    first = rows.filter(F.col("size") >= min_bytes).groupBy("digest", "size").agg(F.min("page_id").alias("first_id"))
    return rows.join(first, ["digest", "size"], "left").select(
        "page_id", "url", "html", "digest",
        F.when(F.col("page_id") > F.col("first_id"), F.col("first_id")).alias("refers_to"))


def _name(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _member(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One record as a gzip member; a revisit has the response's HTTP head as its block, without the payload."""
    head = CRLF.join([b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8",
                      b"Content-Length: " + str(len(payload)).encode(), b"", b""])
    block = head if refers_to is not None else head + payload
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit", "WARC-Record-ID": _name(page_id), "WARC-Date": DATE,
        "WARC-Target-URI": re.sub(r"[\x00-\x20]", lambda m: f"%{ord(m[0]):02X}", url or ""),
        "WARC-Payload-Digest": f"sha1:{digest}",
        "WARC-Block-Digest": "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode(),
        "Content-Type": "application/http;msgtype=response", "Content-Length": str(len(block)),
    }
    if refers_to is not None:
        fields |= {"WARC-Profile": PROFILE, "WARC-Refers-To": _name(refers_to)}
    top = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items())
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(top.encode() + CRLF + block + CRLF + CRLF) + squeeze.flush()


def write_warc(records: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write the records of ``plan_records`` to archives under ``folder``; the manifest (path, records, bytes).

    Every attempt of a task writes files of its own name, and the manifest, a written table, lists those of the
    attempts that succeeded: what a lost or repeated task leaves behind is never read.
    """

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        out, path, n, size = None, "", 0, 0

        def row():
            return pa.RecordBatch.from_arrays([pa.array([path]), pa.array([n]), pa.array([size])], ["path", "records", "bytes"])

        for batch in slices(batches, "html"):
            for page_id, url, html, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    path, n, size = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{base}/{path.rpartition('/')[2]}", compression=None)
                member = _member(page_id, url, html.encode(), digest, refers_to)
                out.write(member)
                n, size = n + 1, size + len(member)
                if size >= archive_bytes:
                    out.close()
                    out = None
                    yield row()
        if out is not None:
            out.close()
            yield row()

    return cut(records.select("page_id", "url", "html", "digest", "refers_to").mapInArrow(write, MANIFEST))


class Broken(ValueError):
    """A record that is not framed as its header says."""


def members(stream, size: int = READ_BYTES) -> Iterator[tuple[int, bytes]]:
    """(offset, inflated bytes) of each gzip member, read front to back; holds one member and one chunk."""
    offset, held = 0, b""
    while True:
        held = held or stream.read(size)
        if not held:
            return
        inflate, parts, used = zlib.decompressobj(31), [], 0
        while not inflate.eof:
            if not held:
                held = stream.read(size)
                if not held:
                    raise Broken(f"the archive ends within the member at {offset}")
            try:
                parts.append(inflate.decompress(held))
            except zlib.error as e:
                raise Broken(f"the member at {offset} is damaged: {e}") from None
            used += len(held)
            held = inflate.unused_data
        yield offset, b"".join(parts)
        offset += used - len(held)


def _fields(lines: list[bytes]) -> dict[str, str]:
    pairs = (line.decode("utf-8", "replace").partition(":") for line in lines)
    return {k.strip().lower(): v.strip() for k, _, v in pairs}


def parse(member: bytes) -> dict:
    """The parts of a record; raises Broken if framing or digests don't hold."""
    head, found, rest = member.partition(CRLF + CRLF)
    lines = head.split(CRLF)
    if not found or not lines[0].startswith(b"WARC/"):
        raise Broken("no WARC header")
    top = _fields(lines[1:])
    length = top.get("content-length", "")
    if not length.isdigit() or len(rest) != int(length) + 4 or rest[int(length):] != CRLF + CRLF:
        raise Broken(f"Content-Length {length or 'missing'}, block of {len(rest) - 4} bytes")
    block = rest[: int(length)]
    if (told := top.get("warc-block-digest", "").removeprefix("sha1:")) and told != base64.b32encode(hashlib.sha1(block).digest()).decode():
        raise Broken("the block's digest is another")
    out = {"record_type": top.get("warc-type"), "record_id": top.get("warc-record-id"), "target_uri": top.get("warc-target-uri"),
           "refers_to": top.get("warc-refers-to"), "payload_digest": top.get("warc-payload-digest", "").removeprefix("sha1:") or None,
           "payload": block, "payload_bytes": len(block)}
    if top.get("content-type", "").startswith("application/http"):
        http, _, payload = block.partition(CRLF + CRLF)
        told = _fields(http.split(CRLF)[1:]).get("content-length", "")
        size = int(told) if told.isdigit() else len(payload)
        revisit = out["record_type"] == "revisit"
        if not revisit and size != len(payload):
            raise Broken(f"HTTP Content-Length {size}, payload of {len(payload)} bytes")
        out |= {"payload": None if revisit else payload, "payload_bytes": size}
        if not revisit and out["payload_digest"] not in (None, base64.b32encode(hashlib.sha1(payload).digest()).decode()):
            raise Broken("the payload's digest is another")
    return out


def read_warc(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """A row per record of the archives listed in column ``path``; columns as in RECORDS.

    An archive is read front to back by one task, a chunk at a time. A record whose framing or digest does not hold has
    ``problem`` set and null parts, and reading goes on behind it; if a member itself is damaged or cut off, its row is
    the archive's last, as there is no frame to find the next one by. ``payloads=False`` leaves the bodies out.
    """
    names = [c.split()[0] for c in RECORDS.split(", ")]
    kinds = [{"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[c.split()[1]] for c in RECORDS.split(", ")]

    def rows(path: str) -> Iterator[dict]:
        store, name = fs.FileSystem.from_uri(path)
        offset = 0
        with store.open_input_stream(name, compression=None) as stream:
            try:
                for offset, member in members(stream):
                    try:
                        yield {"path": path, "record_offset": offset} | parse(member)
                    except Broken as e:
                        yield {"path": path, "record_offset": offset, "problem": str(e)}
            except Broken as e:
                yield {"path": path, "record_offset": offset, "problem": str(e)}

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(held):
            return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in held], k) for n, k in zip(names, kinds, strict=True)], names)

        held, size = [], 0
        for batch in batches:
            for path in batch.column(0).to_pylist():
                for r in rows(path):
                    size += len(r.get("payload") or b"")
                    held.append(r if payloads else r | {"payload": None})
                    if size >= READ_BYTES * 4 or len(held) >= 5000:
                        yield out(held)
                        held, size = [], 0
        if held:
            yield out(held)

    n = max(1, archives.count())
    return archives.select("path").repartition(n).mapInArrow(read, RECORDS)


def round_trip(spark: SparkSession, pages: DataFrame, min_bytes: int = MIN_REVISIT) -> DataFrame:
    """Write a record per page, read the archives back: page_id, payload_bytes, payload_digest, record_type, refers_to, url.

    A null html is an empty payload and a null url an empty URI. Of equal payloads the one with the smallest page_id is
    the response, also among empty ones; rows that repeat a page_id with that payload are responses too, as none of them
    is later; a row without page_id is a response with page_id null. An empty table gives no rows; further columns are ignored.
    """
    folder = f"{checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    folder = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    records = read_warc(write_warc(plan_records(pages, min_bytes), folder), payloads=False)
    page = r"<urn:page:(-?\d+)>"
    number = {c: F.regexp_extract(c, page, 1).try_cast("long") for c in ("record_id", "refers_to")}
    return records.select(
        number["record_id"].alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        number["refers_to"].alias("refers_to"), F.col("target_uri").alias("url"), "problem")
