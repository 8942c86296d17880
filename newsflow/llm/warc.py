"""WARC archives compressed record by record with a Zstandard dictionary.

The dictionary is built from a bounded sample of the records that are archived,
and stands in a skippable frame at the head of every archive, so each file can be
read by itself and each record by its offset. Records with equal payloads are
written once; the others are revisit records that refer to it.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import words as W

DICTIONARY_BYTES = 64 << 10
SAMPLE_RECORDS, SAMPLE_BYTES = 1_000, 8 << 20      # the dictionary is built from so much at most
ARCHIVE_BYTES = 16 << 20                           # uncompressed bytes from which a task begins its next archive
SKIPPABLE = 0x184D2A5D                             # fixed value: magic number of the frame that holds a dictionary
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"                      # archives are the same at every run
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"      # fixed value of the format


def record_id(page_id: int | None) -> str:
    """``<urn:uuid:...>`` with the page's number as its value; nil with version bits for a null."""
    return f"<urn:uuid:{uuid.UUID(int=(page_id % 2**64) if page_id is not None else 1 << 127)}>"


def page_id_of(record: str) -> int | None:
    n = uuid.UUID(record[10:-1]).int
    return None if n == 1 << 127 else n - 2**64 if n >= 2**63 else n


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def write_record(page_id, url, payload: bytes | None, size: int, digest: str, refers_to=None) -> bytes:
    """A response record with its payload, or (payload None) a revisit record."""
    kind = "revisit" if payload is None else "response"
    clean = "".join(c if c > " " else f"%{ord(c):02X}" for c in url or "")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(page_id)}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {clean}",
            f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Payload-Length: {size}"]
    if payload is None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
    else:
        head.append("Content-Type: text/html; charset=utf-8")
    body = payload or b""
    return "\r\n".join([*head, f"Content-Length: {len(body)}", "", ""]).encode() + body + b"\r\n\r\n"


def read_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *fields = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    named = {k.lower(): v for k, v in (f.split(": ", 1) if ": " in f else (f.rstrip(":"), "") for f in fields)}
    size = int(named["content-length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("the record's length is wrong")
    return named, rest[:size]


def read_archive(data: bytes):
    """The records of an archive, in order."""
    import zstandard as Z
    at, dictionary = 0, None
    if len(data) >= 8 and struct.unpack_from("<I", data)[0] == SKIPPABLE:
        at = 8 + struct.unpack_from("<I", data, 4)[0]
        dictionary = Z.ZstdCompressionDict(data[8:at])
    reader = Z.ZstdDecompressor(dict_data=dictionary)
    view = memoryview(data)
    while at < len(data):
        frame = reader.decompressobj()
        parts = [frame.decompress(view[at:at + (1 << 16)])]
        used = min(len(data), at + (1 << 16))
        while not frame.eof:
            if used >= len(data):
                raise ValueError("the archive is cut off")
            parts.append(frame.decompress(view[used:used + (1 << 16)]))
            used = min(len(data), used + (1 << 16))
        at = used - len(frame.unused_data)
        yield read_record(b"".join(parts))


def dictionary_of(pages: DataFrame, records: int = SAMPLE_RECORDS, size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary from at most ``records`` records of ``pages``, drawn by a hash of page_id, and ``SAMPLE_BYTES``
    of them; empty (no dictionary) if there is too little to learn from. It is trained in one task."""
    total = max(1, pages.count())
    drawn = pages.where(F.pmod(F.xxhash64("page_id"), F.lit(1_000_000)) < int(min(1, records / total) * 1_000_000) + 1).select("page_id", "url", "html")

    def train(batches):
        import zstandard as Z
        found = sorted(((p, u or "", (h or "").encode()) for b in batches for p, u, h in
                        zip(*(b.column(i).to_pylist() for i in range(3)), strict=True)), key=lambda r: (r[0] is None, r[0] or 0))
        samples, left = [], SAMPLE_BYTES
        for p, u, h in found:
            raw = write_record(p, u, h, len(h), base32_sha1(h))
            if len(raw) <= left:
                samples.append(raw)
                left -= len(raw)
        try:
            made = Z.train_dictionary(min(size, max(256, (SAMPLE_BYTES - left) // 8)), samples, level=LEVEL).as_bytes()
        except (Z.ZstdError, ValueError):          # too few or too small records
            made = b""
        yield pa.RecordBatch.from_arrays([pa.array([made], pa.binary())], ["dictionary"])

    row = drawn.repartition(1).mapInArrow(train, "dictionary binary").first()
    return bytes(row[0]) if row else b""


def roles(pages: DataFrame, least: int = 0) -> DataFrame:
    """``(page_id, payload_bytes, payload_digest_hex, refers_to)``: ``refers_to`` is null for response records."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    named = pages.select("page_id", F.length(payload).cast("bigint").alias("bytes"), F.sha1(payload).alias("hex"))
    first = named.where(F.col("bytes") >= least).groupBy("hex", "bytes").agg(F.min("page_id").alias("first"))
    return (named.join(first, ["hex", "bytes"], "left")
            .select("page_id", "bytes", "hex", F.when(F.col("first").eqNullSafe(F.col("page_id")), None).otherwise(F.col("first")).alias("refers_to")))


def _write(folder: str, sent):
    def run(batches):
        import zstandard as Z
        from pyarrow import fs
        from pyspark import TaskContext
        task = TaskContext.get()
        store, root = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
        raw = sent.value
        dictionary = Z.ZstdCompressionDict(raw) if raw else None
        press = Z.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_checksum=True, write_content_size=True)
        frames, size, made = [], 0, []

        def close():
            nonlocal frames, size
            if frames:
                final = f"{root}/archive-{task.partitionId():06d}-{len(made):04d}.warc.zst"
                own = f"{root}/.{task.taskAttemptId()}-{len(made):04d}.part"       # hidden until it is whole; a second attempt replaces it
                with store.open_output_stream(own) as f:
                    if raw:
                        f.write(struct.pack("<II", SKIPPABLE, len(raw)) + raw)
                    for x in frames:
                        f.write(x)
                store.move(own, final)
                made.append((final.rsplit("/", 1)[1], len(frames)))
                frames, size = [], 0

        for b in W.slices(batches, "html", 4 << 20):
            for page_id, url, html, n, hexed, first, response in zip(*(b.column(c).to_pylist() for c in
                                                                       ("page_id", "url", "html", "bytes", "hex", "refers_to", "response")), strict=True):
                digest = base64.b32encode(bytes.fromhex(hexed)).decode()
                record = write_record(page_id, url, (html or "").encode() if response else None, n, digest, first)
                frames.append(press.compress(record))
                size += len(record)
                if size >= ARCHIVE_BYTES:
                    close()
        close()
        yield pa.RecordBatch.from_arrays([pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.int64())], ["archive", "records"])
    return run


def write_archives(pages: DataFrame, folder: str, least: int = 0, partitions: int | None = None) -> DataFrame:
    """Archive every row of ``pages(page_id, url, html, ...)`` into ``folder``, which all executors share.

    Returns the written ``(archive, records)``. Of equal payloads of at least ``least``
    bytes the smallest page_id is the response, the others revisit it; a repeated row of
    that page_id is a response too. A null page_id is a revisit unless all of its payload's
    are null. Null html: an empty payload; null url: an empty target.
    """
    spark = pages.sparkSession
    pages = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    sent = spark.sparkContext.broadcast(dictionary_of(pages))
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(path)
    role = roles(pages, least).distinct()
    whole = pages.join(role.withColumnRenamed("page_id", "id").where("id IS NOT NULL"), F.col("page_id") == F.col("id")).where(
        F.sha1(F.coalesce(F.col("html"), F.lit("")).cast("binary")) == F.col("hex"))
    if not pages.where("page_id IS NULL").isEmpty():
        lost = pages.where("page_id IS NULL").withColumn("h", F.sha1(F.coalesce(F.col("html"), F.lit("")).cast("binary")))
        whole = whole.unionByName(lost.join(role.withColumnRenamed("page_id", "id").where("id IS NULL"), F.col("h") == F.col("hex")).drop("h"))
    # revisits need no payload
    rows = whole.select("page_id", "url", F.when(F.col("refers_to").isNull(), F.col("html")).alias("html"), "bytes", "hex", "refers_to",
                        F.col("refers_to").isNull().alias("response"))
    return rows.mapInArrow(_write(folder, sent), "archive string, records bigint")


def _read(batches):
    for b in batches:
        for data in b.column("content"):
            rows = []
            for head, payload in read_archive(data.as_py()):
                kind, size, digest = head["warc-type"], int(head["warc-payload-length"]), head["warc-payload-digest"].split(":")[1]
                if kind == "response" and (len(payload) != size or base32_sha1(payload) != digest):
                    raise ValueError(f"{head['warc-record-id']}: the payload differs from its digest")
                rows.append((page_id_of(head["warc-record-id"]), head["warc-target-uri"], payload if kind == "response" else None, size, digest, kind,
                             page_id_of(head["warc-refers-to"]) if kind == "revisit" else None))
                if len(rows) >= 200:
                    yield _rows(rows)
                    rows = []
            yield _rows(rows)


def _rows(rows):
    cols = list(zip(*rows, strict=True)) or [[]] * 7
    kinds = (pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                      ["page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"])


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """``(page_id, url, payload binary, payload_bytes, payload_digest, record_type, refers_to)`` of all archives in a folder.

    Payloads are checked against their digests. An empty folder: no rows."""
    schema = "page_id bigint, url string, payload binary, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder).select("content")
    return files.mapInArrow(_read, schema)


def archive(spark: SparkSession, pages: DataFrame, folder: str | None = None, least: int = 0) -> DataFrame:
    """Write all pages to archives in a (new) shared folder and read them back."""
    folder = folder or scratch_path(spark, "warc")
    write_archives(pages, folder, least).agg(F.sum("records")).first()
    return read_archives(spark, folder)
