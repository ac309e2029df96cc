"""WARC archives compressed record by record with a Zstandard dictionary that leads the file.

Pages with equal payloads of at least ``MIN_REVISIT`` bytes are stored once: the one with the largest ``page_id`` is the
response, the others are revisits that refer to it. A task writes archives of about ``ARCHIVE_BYTES`` of records; each
has a dictionary built from a sample of its own records (``SAMPLE_BYTES`` at most, taken evenly), compressed in a leading
skippable frame, and one Zstandard frame for each record. A manifest lists the finished archives, so that files of lost
or repeated task attempts are never read.

A null ``html`` is an empty payload; a null ``url`` gives a record without target; a null ``page_id`` reads back as
null and is never the response of a group that has other ids. Rows that repeat the response's ``page_id`` and payload are responses too.
Other columns are not archived. An empty table gives no archive. Archives are written with ``pyarrow.fs``, so the folder may
be local and shared, or in a store it knows.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pilotlamp.session import durable, new_folder

MIN_REVISIT = 1000
ARCHIVE_BYTES = 32 << 20
SAMPLE_BYTES, DICTIONARY_BYTES = 1 << 20, 64 << 10
DICTIONARY_FRAME = 0x184D2A5D  # fixed value: magic number of the skippable frame with the dictionary
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
_MANIFEST = "archive string, records long, bytes long"
_RECORD = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long"


def _filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    return (fs.LocalFileSystem(), uri) if uri.startswith("/") else fs.FileSystem.from_uri(uri)


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page(name: str | None) -> int | None:
    text = (name or "")[len("<urn:page:"):-1]
    return int(text) if text else None


def record(page_id, url, payload: bytes, digest: str, response_id, is_revisit: bool) -> bytes:
    """One WARC record; a revisit keeps the HTTP header only."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if is_revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if is_revisit else 'response'}", f"WARC-Record-ID: {_name(page_id)}", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))  # a field is one line
    head.append(f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}")
    if is_revisit:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_name(response_id)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple:
    """The columns of ``_RECORD`` from one WARC record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rsplit(b"Content-Length: ", 1)[1])
    digest = base64.b32decode(fields["WARC-Payload-Digest"][len("sha1:"):]).hex()
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    url = fields.get("WARC-Target-URI")
    return (_page(fields["WARC-Record-ID"]), url, payload if kind == "response" else None, size, digest, kind, _page(fields.get("WARC-Refers-To")))


def dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict:
    """Trained on an even sample of the records; too few for that serve as content themselves."""
    step = max(1, -(-sum(map(len, records)) // SAMPLE_BYTES))
    sample = records[::step]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, sample, k=512, d=8)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(sample)[:DICTIONARY_BYTES].ljust(8, b" "), dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def write_archive(out, records: list[bytes]) -> int:
    """Writes one archive to the stream; returns its size."""
    shared = dictionary(records)
    body = zstandard.ZstdCompressor(level=3).compress(shared.as_bytes())
    size = out.write(struct.pack("<II", DICTIONARY_FRAME, len(body)) + body)
    shared.precompute_compress(level=3)
    press = zstandard.ZstdCompressor(dict_data=shared, write_checksum=True)
    for r in records:
        size += out.write(press.compress(r))
    return size


def read_archive(raw) -> Iterator[bytes]:
    """The records of an archive, frame by frame."""
    magic, size = struct.unpack("<II", raw.read(8))
    if magic != DICTIONARY_FRAME:
        raise ValueError("no dictionary frame")
    body = zstandard.ZstdDecompressor().decompress(raw.read(size))
    trained = body[:4] == struct.pack("<I", 0xEC30A437)  # fixed value: magic number of a trained dictionary
    shared = zstandard.ZstdCompressionDict(body, dict_type=zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT)
    press = zstandard.ZstdDecompressor(dict_data=shared)
    held, end = b"", False
    while held or not end:
        frame, parts = press.decompressobj(), []
        while not frame.eof:
            if not held:
                held = raw.read(1 << 20)
                if not held:
                    end = True
                    break
            parts.append(frame.decompress(held))
            held = frame.unused_data
        if frame.eof:
            yield b"".join(parts)
        elif any(parts):
            raise ValueError("cut archive")


def plan_records(pages: DataFrame) -> DataFrame:
    """``page_id, url, payload, digest, response_id, is_revisit`` of every page.

    Copies are counted by digest before the join, so only digests that repeat are looked up; a digest with many pages
    is split by the adaptive skew join.
    """
    payload = F.coalesce(F.encode("html", "utf-8"), F.encode(F.lit(""), "utf-8"))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("n", F.octet_length("payload"))
    copies = rows.where(F.col("n") >= MIN_REVISIT).groupBy("digest", "n").agg(F.max("page_id").alias("response_id"), F.count("*").alias("rows"))
    copies = copies.where("rows > 1").drop("rows").withColumn("known", F.lit(True))
    found = rows.join(copies, ["digest", "n"], "left")
    revisit = F.col("known").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("response_id"))
    return found.select("page_id", "url", "payload", "digest", "response_id", F.coalesce(revisit, F.lit(False)).alias("is_revisit"))


def write_archives(pages: DataFrame, folder: str | None = None) -> tuple[DataFrame, str]:
    """Archives all pages under ``folder``; returns the manifest and the folder."""
    folder = folder or new_folder(pages.sparkSession, "warc")
    store, root = _filesystem(folder)
    store.create_dir(root, recursive=True)

    def archive(batches):
        held, size = [], 0
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                held.append(record(*row))
                size += len(held[-1])
                if size >= ARCHIVE_BYTES:
                    yield finish(held)
                    held, size = [], 0
        if held:
            yield finish(held)

    def finish(records):
        store, root = _filesystem(folder)
        name = f"{uuid.uuid4().hex}.warc.zst"
        with store.open_output_stream(f"{root}/{name}") as out:
            size = write_archive(out, records)
        return pa.RecordBatch.from_pydict({"archive": [name], "records": [len(records)], "bytes": [size]})

    return durable(plan_records(pages).mapInArrow(archive, _MANIFEST)), folder


def read_archives(manifest: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records of all archives of the manifest."""
    names = ["page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def unpack(batches):
        store, root = _filesystem(folder)
        for b in batches:
            for name in b.column(0).to_pylist():
                with store.open_input_stream(f"{root}/{name}") as raw:
                    rows = []
                    for data in read_archive(raw):
                        r = parse(data)
                        rows.append(r if payloads else (*r[:2], None, *r[3:]))
                        if len(rows) == 500:
                            yield batch(rows)
                            rows = []
                    yield batch(rows)

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [()] * 7, kinds, strict=True)], names)

    spread = manifest.select("archive").repartition("archive")
    return spread.mapInArrow(unpack, _RECORD)
