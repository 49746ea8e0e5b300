"""WARC archives as seekable Zstandard bundles.

A task writes its records into bundles: records are grouped into frames that
decompress on their own, and a bundle ends with a seek table in a skippable
frame (the seekable Zstandard format), which plain Zstandard readers ignore.
The index maps a record id to its bundle, frame and offset in the frame.

Bundles have names of their own per attempt and go to the shared folder
through ``pyarrow.fs``; the index is written by Spark, whose commit decides
which attempt counts.  A bundle of a lost attempt is in no index.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.session import shared_path

from .common import map_arrow, staged

LEAST_REVISIT = 1000
FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 1 << 28
READ_BYTES, READ_FRAMES = 4 << 20, 4  # stored bytes that one task reads back, and frames that it reads in a row
LEVEL = 3

# Fixed values of the formats.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

INDEX = "page_id bigint, record_id string, bundle string, frame int, frame_offset bigint, frame_bytes bigint, offset bigint, length bigint"


def record_id(page_id: int | None, digest: str) -> str:
    name = f"page:{page_id}" if page_id is not None else f"payload:{digest}"
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"


def _clean(value: str) -> str:
    return "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> tuple[str, bytes]:
    """(record id, bytes) of one WARC/1.1 record; a revisit carries no payload."""
    sha = hashlib.sha1(payload)
    rid = record_id(page_id, sha.hexdigest())
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {rid}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(sha.digest()).decode()}",
        f"X-Payload-Length: {len(payload)}",
        "Content-Type: application/http;msgtype=response",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_clean(url)}")
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    block = HTTP
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: {record_id(refers_to, '')}", f"X-Refers-To-Page-Id: {refers_to}"]
    else:
        block += payload
    head.append(f"Content-Length: {len(block)}")
    return rid, "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes, at: int = 0) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers, payload) of the records of a decompressed frame."""
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].decode().split("\r\n")
        if version != "WARC/1.1":
            raise ValueError(f"no WARC record at {at}")
        head = dict(x.split(": ", 1) for x in lines)
        start, n = end + 4, int(head["Content-Length"])
        block = data[start : start + n]
        yield at, head, block[block.index(b"\r\n\r\n") + 4 :]
        at = start + n + 4


class Bundle:
    """Writer of one seekable bundle: records in, frames and at last the seek table out."""

    def __init__(self, out, name: str, frame_bytes: int = FRAME_BYTES, level: int = LEVEL):
        import zstandard

        self.out, self.name, self.limit = out, name, frame_bytes
        self.compress = zstandard.ZstdCompressor(level=level, write_content_size=True).compress
        self.frames: list[tuple[int, int]] = []
        self.written = 0
        self.held: list[bytes] = []
        self.held_bytes = 0
        self.open_index: list[list] = []

    def add(self, page_id: int | None, rid: str, data: bytes) -> list[list]:
        """Takes a record; index rows of the frame that this completes, if any."""
        self.open_index.append([page_id, rid, self.name, len(self.frames), self.written, 0, self.held_bytes, len(data)])
        self.held.append(data)
        self.held_bytes += len(data)
        return self.flush() if self.held_bytes >= self.limit else []

    def flush(self) -> list[list]:
        if not self.held:
            return []
        z = self.compress(b"".join(self.held))
        self.out.write(z)
        self.frames.append((len(z), self.held_bytes))
        self.written += len(z)
        rows = self.open_index
        for r in rows:
            r[5] = len(z)
        self.held, self.held_bytes, self.open_index = [], 0, []
        return rows

    def close(self) -> list[list]:
        rows = self.flush()
        entries = b"".join(struct.pack("<II", *f) for f in self.frames)
        footer = struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(entries) + len(footer)) + entries + footer)
        self.out.close()
        return rows


def seek_table(f, size: int) -> list[tuple[int, int, int]]:
    """(offset, compressed bytes, bytes) of the frames, from the end of a bundle."""
    f.seek(size - 9)
    n, _, magic = struct.unpack("<IBI", f.read(9))
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    f.seek(size - 9 - 8 * n - 8)
    magic, length = struct.unpack("<II", f.read(8))
    if magic != SKIPPABLE or length != 8 * n + 9:
        raise ValueError("broken seek table")
    out, at = [], 0
    raw = f.read(8 * n)
    for c, d in struct.iter_unpack("<II", raw):
        out.append((at, c, d))
        at += c
    return out


def _filesystem(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def choose(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = LEAST_REVISIT) -> DataFrame:
    """(page_id, url, payload, refers_to, revisit) for every row of ``pages``.

    Only digests that occur more than once are joined back; payloads that
    can't be revisited get a key of their own, so they neither match nor meet.
    """
    df = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).alias("url"), F.encode(F.coalesce(html_col, F.lit("")), "utf-8").alias("payload"))
    long = F.octet_length("payload") >= least
    keyed = df.withColumn("_key", F.when(long, F.sha1("payload")).otherwise(F.concat(F.lit("-"), F.xxhash64("page_id", "url").cast("string"))))
    copies = keyed.filter(long).groupBy("_key").agg(F.max("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1 and first is not null")
    out = keyed.join(copies.select("_key", "first"), "_key", "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return out.select("page_id", "url", "payload", F.when(revisit, F.col("first")).alias("refers_to"), revisit.alias("revisit"))


def write(chosen: DataFrame, folder: str, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Writes the records of :func:`choose` into bundles in ``folder``; the committed index."""

    def run(batches):
        fs, root = _filesystem(folder)
        fs.create_dir(root, recursive=True)
        bundle = None

        def rows_out(rows):
            return pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in rows], schema=schema)

        try:
            for b in batches:
                done: list[list] = []
                cols = [b.column(i).to_pylist() for i in range(5)]
                for page_id, url, payload, refers_to, revisit in zip(*cols):
                    if bundle is None:
                        name = f"{uuid.uuid4().hex}.warc.zst"
                        bundle = Bundle(fs.open_output_stream(f"{root}/{name}", compression=None), name, frame_bytes)
                    done += bundle.add(page_id, *record(page_id, url, payload, refers_to, revisit))
                    if bundle.written >= bundle_bytes:
                        done += bundle.close()
                        bundle = None
                if done:
                    yield rows_out(done)
            if bundle is not None:
                rows = bundle.close()
                bundle = None
                if rows:
                    yield rows_out(rows)
        finally:
            if bundle is not None:
                bundle.out.close()

    schema = pa.schema(
        [("page_id", pa.int64()), ("record_id", pa.string()), ("bundle", pa.string()), ("frame", pa.int32())]
        + [(c, pa.int64()) for c in ("frame_offset", "frame_bytes", "offset", "length")]
    )
    return staged(map_arrow(chosen, run, INDEX), "warc-index")


READ = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, record_id string, target_uri string, payload binary"


def read(index: DataFrame, folder: str, with_payload: bool = True, read_bytes: int = READ_BYTES) -> DataFrame:
    """Every record of the indexed bundles, frame by frame, with payload digests checked.

    A frame is opened through its bundle's seek table, which must agree with
    the index.  The payload of a revisit is null; its length and digest are
    those of the payload it refers to.
    """
    frames = index.select("bundle", "frame", "frame_offset", "frame_bytes").distinct()
    # dealt by what is to be read, not by the size of the index: neighbouring frames in runs of READ_FRAMES
    total = frames.agg(F.sum("frame_bytes")).first()[0] or 0
    frames = frames.select("bundle", "frame", "frame_offset").repartition(-(-total // read_bytes) or 1, "bundle", F.floor(F.col("frame") / READ_FRAMES))
    frames = frames.sortWithinPartitions("bundle", "frame")

    def run(batches):
        import zstandard

        fs, root = _filesystem(folder)
        decompress = zstandard.ZstdDecompressor().decompress
        held, f, table = None, None, []
        for b in batches:
            for name, frame, offset in zip(*[b.column(i).to_pylist() for i in range(3)]):
                if name != held:
                    if f is not None:
                        f.close()
                    path = f"{root}/{name}"
                    f, held = fs.open_input_file(path), name
                    table = seek_table(f, f.size())
                at, size, raw = table[frame]
                if at != offset:
                    raise ValueError(f"{name}: frame {frame} is at {at}, not {offset}")
                f.seek(at)
                data = decompress(f.read(size), max_output_size=raw)
                yield pa.RecordBatch.from_pylist([_row(h, p, with_payload) for _, h, p in parse(data)], schema=schema)
        if f is not None:
            f.close()

    schema = pa.schema(
        [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string())]
        + [("refers_to", pa.int64()), ("record_id", pa.string()), ("target_uri", pa.string()), ("payload", pa.binary())]
    )
    return map_arrow(frames, run, READ)


def _row(head: dict[str, str], payload: bytes, with_payload: bool) -> dict:
    number = lambda k: int(head[k]) if k in head else None
    digest = base64.b32decode(head["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    revisit = head["WARC-Type"] == "revisit"
    if not revisit and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != number("X-Payload-Length")):
        raise ValueError(f"{head['WARC-Record-ID']}: payload and digest differ")
    return {
        "page_id": number("X-Page-Id"),
        "payload_bytes": number("X-Payload-Length") if revisit else len(payload),
        "payload_digest": digest,
        "record_type": head["WARC-Type"],
        "refers_to": number("X-Refers-To-Page-Id"),
        "record_id": head["WARC-Record-ID"],
        "target_uri": head.get("WARC-Target-URI"),
        "payload": payload if with_payload and not revisit else None,
    }


def lookup(index: DataFrame, folder: str, record_ids: list[str]) -> list[tuple[str, bytes]]:
    """(record id, record bytes) of a few records, each read by one seek and one frame."""
    import zstandard

    fs, root = _filesystem(folder)
    out = []
    for r in index.filter(F.col("record_id").isin(record_ids)).collect():
        with fs.open_input_file(f"{root}/{r['bundle']}") as f:
            f.seek(r["frame_offset"])
            data = zstandard.ZstdDecompressor().decompress(f.read(r["frame_bytes"]))
        out.append((r["record_id"], data[r["offset"] : r["offset"] + r["length"]]))
    return out


def folder_for(spark: SparkSession) -> str:
    """URI of a new folder for bundles in the shared folder, on the file system that Spark takes it to be on."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(shared_path(spark, "llm", f"warc-{uuid.uuid4().hex}"))
    uri = jpath.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(jpath).toString()
    return uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri


def archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = LEAST_REVISIT) -> DataFrame:
    """Writes all pages and reads the archives back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Null html is an empty payload.  Rows that repeat the largest page_id of
    equal payloads are all responses; a null page_id revisits like any other
    but is referred to by none; equal payloads without any id are responses.
    A very long payload is one record, in a frame of its own size; an empty
    table makes no bundle and gives no rows; other columns are not read.
    Control characters of a url are percent-encoded, a null url is left out.
    """
    folder = folder_for(pages.sparkSession)
    index = write(choose(pages, id_col, url_col, html_col, least), folder)
    out = read(index, folder, with_payload=False)
    return out.select(F.col("page_id").alias(id_col), "payload_bytes", "payload_digest", "record_type", "refers_to")
