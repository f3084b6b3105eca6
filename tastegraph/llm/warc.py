"""Seekable Zstandard bundles of WARC records.

A bundle file holds groups of records, each compressed as a frame of its own, and ends with a skippable frame that
lists the compressed and plain size of every frame (the published seekable format). A record is found by its
bundle, the number of its frame and its offset inside the plain frame, so one frame is all that must be read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tastegraph.llm.common import run_path, slices, written

# Fixed values of the seekable format: magic numbers of the skippable frame and of the seek table.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
#: Plain bytes after which a frame, and compressed bytes after which a bundle, is closed.
FRAME_BYTES, BUNDLE_BYTES = 1 << 20, 256 << 20
#: The copies of one payload go to this many partitions.
SALTS = 16
DATE = "2024-01-01T00:00:00Z"

INDEX = "page_id long, bundle string, frame int, frame_offset long, record_length long"
RECORD = "page_id long, record_type string, refers_to long, payload_digest string, payload binary"


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC/1.1 record; a revisit has no payload and names the record that has it."""
    name = lambda i: f"<urn:page:{'null' if i is None else i}>"
    target = "".join(c for c in (url or "about:blank") if c > " ")
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {name(page_id)}",
        f"WARC-Target-URI: {target}", f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: text/html; charset=utf-8",
    ]
    if revisit:
        head += [f"WARC-Refers-To: {name(refers_to)}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    body = b"" if revisit else payload
    return "\r\n".join([*head, f"Content-Length: {len(body)}", "", ""]).encode() + body + b"\r\n\r\n"


def parsed(raw: bytes) -> tuple[int | None, str, int | None, str, bytes]:
    """(page_id, record_type, refers_to, payload_digest, payload) of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    number = lambda x: None if x is None or x == "<urn:page:null>" else int(x[len("<urn:page:"):-1])
    return (number(fields["WARC-Record-ID"]), fields["WARC-Type"], number(fields.get("WARC-Refers-To")),
            fields["WARC-Payload-Digest"].removeprefix("sha1:"), rest[:int(fields["Content-Length"])])


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    entries = b"".join(struct.pack("<II", *s) for s in sizes)
    return struct.pack("<II", SKIPPABLE, len(entries) + 9) + entries + struct.pack("<IBI", len(sizes), 0, SEEKABLE)


def read_seek_table(file, length: int) -> list[tuple[int, int, int]]:
    """(position, compressed size, plain size) of each frame."""
    file.seek(length - 9)
    count, _, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE:
        raise ValueError("no seek table at the end of the bundle")
    file.seek(length - 9 - 8 * count)
    sizes, at, out = struct.iter_unpack("<II", file.read(8 * count)), 0, []
    for packed, plain in sizes:
        out.append((at, packed, plain))
        at += packed
    return out


class BundleWriter:
    """Writes records of one partition; a bundle appears under its name only when it is complete."""

    def __init__(self, folder: str, partition: str, attempt: str, level: int = 3):
        self.files, self.folder = fs.FileSystem.from_uri(folder)
        self.partition, self.attempt = partition, attempt
        self.zstd = zstandard.ZstdCompressor(level=level)
        self.bundle, self.out = -1, None

    def name(self) -> str:
        return f"bundle-{self.partition}-{self.attempt}-{self.bundle:05d}.warc.zst"

    def add(self, raw: bytes) -> tuple[str, int, int, int]:
        """Bundle, frame, offset in the frame, and length of the record."""
        if self.out is None:
            self.bundle, self.sizes, self.frame, self.held, self.written = self.bundle + 1, [], [], 0, 0
            self.out = self.files.open_output_stream(f"{self.folder}/.{self.name()}", compression=None)
        place = (self.name(), len(self.sizes), self.held, len(raw))
        self.frame.append(raw)
        self.held += len(raw)
        if self.held >= FRAME_BYTES:
            self._end_frame()
            if self.written >= BUNDLE_BYTES:
                self.close()
        return place

    def _end_frame(self) -> None:
        packed = self.zstd.compress(b"".join(self.frame))
        self.out.write(packed)
        self.sizes.append((len(packed), self.held))
        self.written += len(packed)
        self.frame, self.held = [], 0

    def close(self) -> None:
        if self.out is None:
            return
        if self.frame:
            self._end_frame()
        self.out.write(seek_table(self.sizes))
        self.out.close()
        self.files.move(f"{self.folder}/.{self.name()}", f"{self.folder}/{self.name()}")
        self.out = None


def payload_of(html: Column) -> Column:
    return F.encode(F.coalesce(html, F.lit("")), "UTF-8")


def with_first_copies(pages: DataFrame, revisit_min_bytes: int = 0, id_column: str = "page_id", url_column: str = "url",
                      html_column: str = "html") -> DataFrame:
    """(page_id, url, payload, digest, refers_to): of equal payloads of at least so many bytes, the smallest id is first.

    A null id is larger than all others. Payload digests meet with partial minima; the answer goes back to the pages by
    digest and one of ``SALTS`` numbers, so a payload that a third of all pages share is spread out.
    """
    plain = pages.select(F.col(id_column).cast("long").alias("page_id"), F.col(url_column).alias("url"), payload_of(F.col(html_column)).alias("payload"))
    hashed = plain.withColumn("digest", F.sha1("payload"))
    firsts = hashed.where(F.octet_length("payload") >= revisit_min_bytes).groupBy("digest").agg(
        F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    salted = firsts.select("digest", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    met = hashed.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int")).join(salted, ["digest", "salt"], "left")
    copy = F.col("first").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") > F.col("first")))
    return met.select("page_id", "url", "payload", "digest", F.when(copy, F.col("first")).alias("refers_to"))


def write_bundles(pages: DataFrame, folder: str, revisit_min_bytes: int = 0, **columns: str) -> DataFrame:
    """Write every page as a record; returns the index (page_id, bundle, frame, frame_offset, record_length).

    Null html is an empty payload, a null url ``about:blank``; rows with equal ids and payloads are all responses
    to each other's first id, since none is larger. The index is kept as a table beside the bundles. Bundle names hold
    the task attempt, so a repeated or speculative attempt never touches a bundle that the index names; what lost
    attempts leave in the folder is named by no row of the index. Ids are whole numbers or text that is one.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, out = TaskContext.get(), None
        for batch in slices(batches, 2):
            out = out or BundleWriter(folder, f"{task.partitionId():06d}", str(task.taskAttemptId()))
            ids, rows = batch.column(0).to_pylist(), zip(*(c.to_pylist() for c in batch.columns), strict=True)
            places = []
            for page_id, url, payload, digest, refers_to in rows:
                coded = base64.b32encode(bytes.fromhex(digest)).decode()
                places.append(out.add(record(page_id, url, payload, coded, refers_to, refers_to is not None)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), *(pa.array(list(c), t) for c, t in zip(zip(*places, strict=True), (pa.string(), pa.int32(), pa.int64(), pa.int64()), strict=True))],
                names=[x.split()[0] for x in INDEX.split(", ")])
        if out:
            out.close()

    files, path = fs.FileSystem.from_uri(folder)
    files.create_dir(path)
    return written(with_first_copies(pages, revisit_min_bytes, **columns).mapInArrow(write, INDEX), "warc-index")


def read_bundles(index: DataFrame, folder: str) -> DataFrame:
    """(page_id, record_type, refers_to, payload_digest, payload) of the records named in an index, read from the bundles.

    Records of a frame are looked up together: each frame is read and unpacked once, by the seek table. The digest of every
    payload is computed again; one that is not its record's own ends the job.
    """
    def checked(raw: bytes) -> tuple:
        found = parsed(raw)
        if found[1] == "response" and base64.b32encode(hashlib.sha1(found[4]).digest()).decode() != found[3]:
            raise ValueError(f"the payload of page {found[0]} does not have the digest of its record")
        return found

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, path = fs.FileSystem.from_uri(folder)
        names, zstd = [x.split()[0] for x in RECORD.split(", ")], zstandard.ZstdDecompressor()
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary())
        for batch in batches:
            open_name, table, file, held, out = None, [], None, (None, b""), []
            size = 0
            for bundle, frame, places in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bundle != open_name:
                    info = files.get_file_info(f"{path}/{bundle}")
                    file = files.open_input_file(info.path)
                    open_name, table = bundle, read_seek_table(file, info.size)
                at, packed, plain = table[frame]
                file.seek(at)
                held = zstd.decompress(file.read(packed), max_output_size=plain)
                out += [checked(held[p["frame_offset"]:p["frame_offset"] + p["record_length"]]) for p in places]
                size += plain
                if size >= 8 * FRAME_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    frames = index.groupBy("bundle", "frame").agg(F.collect_list(F.struct("frame_offset", "record_length")).alias("places"))
    return frames.mapInArrow(read, RECORD)


def archived(pages: DataFrame, revisit_min_bytes: int = 0, **columns: str) -> DataFrame:
    """Write the pages, read the archives back and describe each record by its full payload.

    Returns (page_id, payload_bytes, payload_digest, record_type, refers_to); a revisit's payload is that of the record
    it refers to.
    """
    folder = run_path(pages.sparkSession, "warc")
    folder = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    index = write_bundles(pages, folder, revisit_min_bytes, **columns)
    back = written(read_bundles(index, folder).select(
        "page_id", "record_type", "refers_to", "payload_digest", F.octet_length("payload").cast("long").alias("own_bytes")), "warc-read")
    first = back.where("record_type = 'response'").groupBy("payload_digest").agg(F.max("own_bytes").alias("full_bytes"))
    full = first.select("payload_digest", "full_bytes", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    met = back.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int")).join(full, ["payload_digest", "salt"], "left")
    return met.select("page_id", F.when(F.col("record_type") == "response", F.col("own_bytes")).otherwise(F.col("full_bytes")).alias("payload_bytes"),
                      "payload_digest", "record_type", "refers_to")
