"""WARC archives in seekable Zstandard bundles.

``write`` turns every page into a WARC/1.1 record and groups the records of a
task into bundles. A bundle is a file of independent Zstandard frames, each with
some records, followed by a seek table in a skippable frame (the published
seekable format: magic 0x184D2A5E, per frame the compressed and decompressed
size, and a footer with the number of frames and the magic 0x8F92EAB1), so any
Zstandard reader can unpack the whole file and a seekable one can read a single
frame. The index maps each record id to its file, frame, offset inside the
decompressed frame and length.

Files go to a shared folder through Arrow's file systems. Every attempt of a
task writes files of its own names; only the names that reach the index (a
Parquet table, committed by Spark) are read, so a lost executor or a repeated
attempt leaves no wrong record behind.

Records with equal payloads (SHA-1 and length) are stored once: the one with the
largest id is the response, the others are revisits that refer to it. Counting
copies is a grouped maximum, combined before the shuffle; digests are compared
first, on (digest, length, id) rows; payloads are compressed before the one
shuffle, by id, that brings them their decision.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecheck.llm.common import scratch, stored, table

FRAME_BYTES = 1 << 20       # uncompressed records of a frame, about
BUNDLE_BYTES = 32 << 20     # compressed size from which a new bundle is begun
MIN_REVISIT_BYTES = 0       # smaller payloads are always responses
LEVEL = 3

# fixed values of the seekable format
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
FOOTER = struct.Struct("<IBI")
ENTRY = struct.Struct("<II")

INDEX = "record_id long, file string, frame int, begin long, length long"


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, payload_digest: str,
           kind: str, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; a revisit has no body. The url is percent-encoded
    where it would break the header."""
    target = "".join(c if " " < c < "\x7f" else "".join(f"%{b:02X}" for b in c.encode())
                     for c in url or "")
    name = lambda i: f"<urn:forecheck:page:{'null' if i is None else i}>"
    body = payload if kind == "response" else b""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {name(page_id)}",
             "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Target-URI: {target}",
             f"WARC-Payload-Digest: sha1:{payload_digest}",
             f"X-Payload-Length: {len(payload)}", f"Content-Length: {len(body)}",
             "Content-Type: text/html; charset=utf-8"]
    if kind == "revisit":
        lines += [f"WARC-Refers-To: {name(refers_to)}",
                  "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + body + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and body of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "")
                   for line in lines[1:])
    size = int(headers["Content-Length"])
    if rest[size:size + 4] != b"\r\n\r\n":
        raise ValueError("record length is wrong")
    return headers, rest[:size]


class Bundle:
    """Writes one bundle: records into frames, the seek table at the end."""

    def __init__(self, name: str):
        self.name, self.sizes, self.frame = name, [], []
        self.pending, self.written = 0, 0
        self.parts: list[bytes] = []
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)

    def add(self, raw: bytes) -> tuple[int, int, int]:
        """(frame, begin, length) of the record."""
        place = len(self.sizes), self.pending, len(raw)
        self.frame.append(raw)
        self.pending += len(raw)
        if self.pending >= FRAME_BYTES:
            self.end_frame()
        return place

    def end_frame(self) -> None:
        if self.frame:
            packed = self.compressor.compress(b"".join(self.frame))
            self.parts.append(packed)
            self.sizes.append((len(packed), self.pending))
            self.written += len(packed)
            self.frame, self.pending = [], 0

    def content(self) -> bytes:
        self.end_frame()
        entries = b"".join(ENTRY.pack(*s) for s in self.sizes)
        table_ = entries + FOOTER.pack(len(self.sizes), 0, SEEKABLE_MAGIC)
        return b"".join(self.parts) + struct.pack("<II", SKIPPABLE_MAGIC, len(table_)) + table_


def seek_table(f: pa.NativeFile) -> list[tuple[int, int, int]]:
    """(offset, compressed size, decompressed size) of each frame of a bundle,
    from the end of the open file."""
    end = f.size()
    f.seek(end - FOOTER.size)
    frames, _, magic = FOOTER.unpack(f.read(FOOTER.size))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table at the end of the bundle")
    f.seek(end - FOOTER.size - frames * ENTRY.size)
    out, offset = [], 0
    for packed, size in ENTRY.iter_unpack(f.read(frames * ENTRY.size)):
        out.append((offset, packed, size))
        offset += packed
    return out


def read_frame(f: pa.NativeFile, frame: tuple[int, int, int]) -> bytes:
    """One frame, read and decompressed on its own."""
    offset, packed, size = frame
    f.seek(offset)
    got = zstandard.ZstdDecompressor().decompress(f.read(packed), max_output_size=max(size, 1))
    if len(got) != size:
        raise ValueError("frame size differs from the seek table")
    return got


def _file_system(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:")
                                    else f"file://{folder}")


def plan(pages: DataFrame, id_col: str, url_col: str, payload_col: str,
         min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(id, url, payload_bytes, packed, refers_to): pages with their payload
    compressed, and the response that a revisit refers to."""
    payload = F.coalesce(pages[payload_col].cast("string"), F.lit(""))
    base = pages.select(
        pages[id_col].cast("long").alias("id"), pages[url_col].cast("string").alias("url"),
        payload.alias("payload"), F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha1(payload.cast("binary")).alias("sha1"))
    owner = (base.where(F.col("payload_bytes") >= min_bytes)
             .groupBy(F.col("sha1").alias("s"), F.col("payload_bytes").alias("b"))
             .agg(F.max("id").alias("owner"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").drop("n"))
    revisits = (base.select("id", "sha1", "payload_bytes")
                .join(owner, (F.col("sha1") == F.col("s")) & (F.col("payload_bytes") == F.col("b")))
                .where(F.col("id").isNull() | (F.col("id") != F.col("owner")))
                .select(F.col("id").alias("r"), "s", "b", "owner").distinct())

    def zipped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=LEVEL).compress
        for batch in batches:
            packed = [pack(p.encode()) for p in batch.column("payload").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in ("id", "url", "sha1", "payload_bytes")),
                 pa.array(packed, pa.binary())], ["id", "url", "sha1", "payload_bytes", "packed"])

    rows = base.mapInArrow(zipped, "id long, url string, sha1 string, payload_bytes long, packed binary")
    # joined by id as well, so the payloads of a hot digest stay spread out
    same = (rows["id"].eqNullSafe(F.col("r")) & (rows["sha1"] == F.col("s"))
            & (rows["payload_bytes"] == F.col("b")))
    return (rows.join(revisits, same, "left").drop("r", "s", "b", "sha1")
            .withColumnRenamed("owner", "refers_to"))


def write(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
          payload_col: str = "html", min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Write all pages as bundles under ``folder``; returns the index (stored).

    NULL payloads are empty, NULL urls an empty target, a NULL id is written as
    such. Rows with one id and equal payloads become one response and no
    revisits of themselves: every such row is written as a response. An empty
    table writes no file. Columns other than the three named are not read.
    """
    planned = plan(pages, id_col, url_col, payload_col, min_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _file_system(folder)
        unpack = zstandard.ZstdDecompressor().decompress
        bundle: Bundle | None = None
        rows: list[tuple] = []

        def finish():
            fs.create_dir(path, recursive=True)
            with fs.open_output_stream(f"{path}/{bundle.name}", compression=None) as f:
                f.write(bundle.content())
            ids, files, frames, begins, lengths = zip(*rows)
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(files, pa.string()),
                 pa.array(frames, pa.int32()), pa.array(begins, pa.int64()),
                 pa.array(lengths, pa.int64())],
                ["record_id", "file", "frame", "begin", "length"])

        for batch in batches:
            cols = {n: batch.column(n) for n in batch.schema.names}
            for k in range(batch.num_rows):
                if bundle is None:
                    bundle, rows = Bundle(f"{uuid.uuid4().hex}.warc.zst"), []
                page_id, ref = cols["id"][k].as_py(), cols["refers_to"][k].as_py()
                payload = unpack(cols["packed"][k].as_py())
                raw = record(page_id, cols["url"][k].as_py(), payload, digest(payload),
                             "response" if ref is None else "revisit", ref)
                rows.append((page_id, bundle.name, *bundle.add(raw)))
                if bundle.written >= BUNDLE_BYTES:
                    yield finish()
                    bundle = None
        if bundle is not None:
            yield finish()

    return stored(planned.select("id", "url", "packed", "refers_to").mapInArrow(run, INDEX),
                  "warc-index")


def read(folder: str, index: DataFrame) -> DataFrame:
    """Every indexed record, read back by frame: headers and the stored body.

    The index is grouped by file (a bundle is bounded) and dealt over as many
    tasks as there are files: the rows of the index are small, so their bytes say
    nothing of the work. Each task opens its files, reads the seek tables and then
    only the frames asked for.
    """
    files = index.agg(F.count_distinct("file")).first()[0]
    wanted = (index.repartition(max(1, files), "file").groupBy("file", "frame")
              .agg(F.collect_list(F.struct("record_id", "begin", "length")).alias("records"))
              .groupBy("file").agg(F.collect_list(F.struct("frame", "records")).alias("frames")))
    names = ["record_id", "target_uri", "body", "payload_bytes", "payload_digest", "record_type",
             "refers_to"]
    types = [pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _file_system(folder)
        for batch in batches:
            for name, groups in zip(batch.column("file").to_pylist(),
                                    batch.column("frames").to_pylist()):
                with fs.open_input_file(f"{path}/{name}") as f:
                    frames = seek_table(f)
                    for group in groups:
                        data = read_frame(f, frames[group["frame"]])
                        out = []
                        for r in group["records"]:
                            headers, body = parse(data[r["begin"]:r["begin"] + r["length"]])
                            ref = headers.get("WARC-Refers-To")
                            out.append((r["record_id"], headers["WARC-Target-URI"], body,
                                        int(headers["X-Payload-Length"]),
                                        headers["WARC-Payload-Digest"].removeprefix("sha1:"),
                                        headers["WARC-Type"],
                                        int(ref.rsplit(":", 1)[1].rstrip(">")) if ref else None))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    return wanted.mapInArrow(
        run, "record_id long, target_uri string, body binary, payload_bytes long, "
             "payload_digest string, record_type string, refers_to long")


def lookup(folder: str, index: DataFrame, ids: DataFrame,
           id_col: str = "record_id") -> DataFrame:
    """The records of some ids: only their frames are decompressed."""
    own = ids.select(ids[id_col].alias("record_id")).distinct()
    return read(folder, index.join(own, "record_id", "left_semi"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all ``pages`` to seekable bundles, read them back, check the digests
    of the stored bodies against the headers."""
    folder = scratch(spark, "warc")
    index = write(table(spark, sf_dir, "pages"), folder)
    found = read(folder, index)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = batch.column("record_type").to_pylist()
            bodies = batch.column("body").to_pylist()
            for kind, body, want in zip(kinds, bodies, batch.column("payload_digest").to_pylist()):
                if kind == "response" and digest(body) != want:
                    raise ValueError("a stored body differs from its digest")
            yield batch.drop_columns(["target_uri", "body"]).rename_columns(
                ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    return found.mapInArrow(check, "page_id long, payload_bytes long, payload_digest string, "
                                   "record_type string, refers_to long")
