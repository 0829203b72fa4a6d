"""WARC archives as seekable Zstandard bundles.

Records are grouped into independent frames of about ``frame_bytes``; frames
are joined into bundles of about ``bundle_bytes``; a bundle ends with a seek
table (a skippable frame with the sizes of all frames), so any frame can be
found from the bundle's end.  Beside each bundle lies an index that maps
record identifiers to frame, offset in the unpacked frame and length.

A bundle is a row of a Parquet table written by Spark's own committer: task
retries and lost executors leave no half bundles, and any store that Spark can
write to will do.  ``export`` turns the rows into ``.warc.zst`` files.

Of records with equal payloads of ``least_bytes`` or more, the one with the
largest id is a response and the others are revisit records that refer to it
and carry no payload.
"""

from __future__ import annotations

import base64
import hashlib
import os
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

#: Fixed values of the seekable Zstandard format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1

REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAME = "urn:x-page:"
DATE = "1970-01-01T00:00:00Z"
SALTS = 16

INDEX = T.ArrayType(
    T.StructType([T.StructField("record_id", T.StringType()), T.StructField("frame", T.IntegerType()), T.StructField("offset", T.LongType()), T.StructField("length", T.LongType())])
)
BUNDLES = T.StructType([T.StructField("bundle", T.StringType()), T.StructField("content", T.BinaryType()), T.StructField("records", INDEX)])
_ARROW_INDEX = pa.list_(pa.struct([("record_id", pa.string()), ("frame", pa.int32()), ("offset", pa.int64()), ("length", pa.int64())]))


def record(record_id: str, url: str | None, kind: str, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One WARC/1.1 record; a revisit holds the HTTP head alone."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if kind == "revisit" else http + payload
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="%/:=&?~#+!$,;'@()*[]"))
    head.append("WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())
    if kind == "revisit":
        head += ["WARC-Profile: " + REVISIT_PROFILE, f"WARC-Refers-To: <{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """The fields of one record; for a response the digest is taken from the
    payload and must equal the header's."""
    end = data.index(b"\r\n\r\n")
    lines = data[:end].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"not a WARC record: {lines[0]!r}")
    head = dict(line.split(": ", 1) for line in lines[1:])
    block = data[end + 4 : end + 4 + int(head["Content-Length"])]
    cut = block.index(b"\r\n\r\n") + 4
    http = dict(line.split(": ", 1) for line in block[: cut - 4].decode().split("\r\n")[1:])
    digest = base64.b32decode(head["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    payload = block[cut:] if head["WARC-Type"] == "response" else None
    if payload is not None and (len(payload) != int(http["Content-Length"]) or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"{head['WARC-Record-ID']}: the payload does not match its digest or length")
    return {
        "record_id": head["WARC-Record-ID"][1:-1],
        "url": head.get("WARC-Target-URI"),
        "record_type": head["WARC-Type"],
        "payload_bytes": int(http["Content-Length"]),
        "payload_digest": digest,
        "refers_to": head["WARC-Refers-To"][1:-1] if "WARC-Refers-To" in head else None,
        "payload": payload,
    }


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    body = b"".join(struct.pack("<II", *s) for s in sizes) + struct.pack("<IBI", len(sizes), 0, SEEKABLE_MAGIC)
    return struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body


def frames(content: bytes) -> list[tuple[int, int, int]]:
    """(start, packed size, unpacked size) of each frame, from the footer."""
    n, flags, magic = struct.unpack("<IBI", content[-9:])
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table at the bundle's end")
    width = 12 if flags & 0x80 else 8
    at, out = len(content) - 9 - n * width, []
    start = 0
    for i in range(n):
        packed, unpacked = struct.unpack_from("<II", content, at + i * width)
        out.append((start, packed, unpacked))
        start += packed
    return out


def unpack(content: bytes, frame: tuple[int, int, int]) -> bytes:
    import zstandard

    start, packed, unpacked = frame
    return zstandard.ZstdDecompressor().decompress(content[start : start + packed], max_output_size=unpacked)


class Bundler:
    """Collects records into frames and frames into bundles."""

    def __init__(self, name: str, frame_bytes: int, bundle_bytes: int, level: int):
        import zstandard

        self.zip = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.name, self.frame_bytes, self.bundle_bytes, self.number = name, frame_bytes, bundle_bytes, 0
        self._new()

    def _new(self) -> None:
        self.packed, self.sizes, self.records, self.open, self.open_bytes = [], [], [], [], 0

    def _close_frame(self) -> None:
        if self.open:
            data = b"".join(self.open)
            self.packed.append(self.zip.compress(data))
            self.sizes.append((len(self.packed[-1]), len(data)))
            self.open, self.open_bytes = [], 0

    def add(self, record_id: str, data: bytes) -> bool:
        """Whether the bundle has now reached its size."""
        if self.open and self.open_bytes + len(data) > self.frame_bytes:
            self._close_frame()
        self.records.append((record_id, len(self.sizes), self.open_bytes, len(data)))
        self.open.append(data)
        self.open_bytes += len(data)
        return sum(s for s, _ in self.sizes) + self.open_bytes // 4 >= self.bundle_bytes

    def close(self) -> pa.RecordBatch | None:
        self._close_frame()
        if not self.sizes:
            return None
        content = b"".join(self.packed) + seek_table(self.sizes)
        rows = [dict(zip(("record_id", "frame", "offset", "length"), r)) for r in self.records]
        out = pa.RecordBatch.from_arrays(
            [pa.array([f"{self.name}-{self.number:05d}"]), pa.array([content], pa.binary()), pa.array([rows], _ARROW_INDEX)], names=["bundle", "content", "records"]
        )
        self.number += 1
        self._new()
        return out


def plan_records(df: DataFrame, id_col: str, url_col: str, payload_col: str, least_bytes: int) -> DataFrame:
    """id, url, payload (bytes), digest, and for revisits ``first``, the id of
    the response.  Only digests of payloads that occur twice meet the rows, on
    a salted key; their table is as small as there are few repeats."""
    rows = df.select(
        df[id_col].alias("id"), df[url_col].cast("string").alias("url"), F.coalesce(F.encode(df[payload_col].cast("string"), "UTF-8"), F.lit(b"")).alias("payload")
    ).withColumn("digest", F.sha1("payload"))
    twice = (
        rows.where(F.octet_length("payload") >= least_bytes).groupBy("digest").agg(F.max("id").alias("first"), F.count("*").alias("n")).where("n > 1")
        .select(F.col("digest").alias("_digest"), "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    )
    # Smaller rows find no partner but are salted too: a third of all rows may be one short page.
    out = rows.withColumn("_s", F.pmod(F.xxhash64("id", "url"), F.lit(SALTS)).cast("int")).join(twice, (F.col("digest") == F.col("_digest")) & (F.col("_s") == F.col("_salt")), "left")
    return out.select("id", "url", "payload", "digest", F.when(~F.col("id").eqNullSafe(F.col("first")), F.col("first")).alias("first"))


def archive(
    df: DataFrame,
    path: str,
    id_col: str = "page_id",
    url_col: str = "url",
    payload_col: str = "html",
    least_bytes: int = 1000,
    frame_bytes: int = 256 << 10,
    bundle_bytes: int = 4 << 20,
    level: int = 3,
) -> None:
    """Write a record per row of ``df`` into bundles under ``path``.

    Null payloads are empty; null urls leave the target out; rows that share
    the largest id of a group of equal payloads are all responses; a row
    without id is a revisit if its group has an id and a response otherwise.
    An empty table writes no bundle.  Other columns are not read.
    """
    common.ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundler = Bundler(f"{TaskContext.get().partitionId():06d}", frame_bytes, bundle_bytes, level)
        n = 0
        for b in batches:
            for i in range(b.num_rows):
                rid, url, payload, digest, first = (c[i].as_py() for c in b.columns)
                name = NAME + (quote(str(rid), safe="") if rid is not None else f"none:{bundler.name}:{n}")
                kind = "response" if first is None else "revisit"
                refers = None if first is None else NAME + quote(str(first), safe="")
                n += 1
                if bundler.add(name, record(name, url, kind, payload, digest, refers)) and (out := bundler.close()):
                    yield out
        if out := bundler.close():
            yield out

    plan_records(df, id_col, url_col, payload_col, least_bytes).mapInArrow(run, BUNDLES).write.mode("error").parquet(path)


_FIELDS = {"record_id": "string", "url": "string", "record_type": "string", "payload_bytes": "long", "payload_digest": "string", "refers_to": "string"}


def _table(rows: list[dict], payload: bool) -> pa.RecordBatch:
    types = [pa.int64() if t == "long" else pa.string() for t in _FIELDS.values()] + [pa.binary()] * payload
    names = [*_FIELDS, *["payload"] * payload]
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], t) for n, t in zip(names, types)], names=names)


def _schema(payload: bool) -> str:
    return ", ".join([f"{k} {t}" for k, t in _FIELDS.items()] + ["payload binary"] * payload)


def bundles(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BUNDLES).parquet(path)


def read_records(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    """Every record of the bundles under ``path``, found by the seek tables
    and the records' own lengths; one frame is unpacked at a time."""
    common.ship(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                content = b.column(0)[i].as_py()
                for frame in frames(content):
                    data, at, rows = unpack(content, frame), 0, []
                    while at < len(data):
                        head = data.index(b"\r\n\r\n", at)
                        size = int(data[data.index(b"\r\nContent-Length: ", at) + 18 : head].split(b"\r\n")[0])
                        end = head + 4 + size + 4
                        rows.append(parse(data[at:end]))
                        at = end
                    yield _table(rows, payload)

    return bundles(spark, path).select("content").mapInArrow(run, _schema(payload))


def fetch(spark: SparkSession, path: str, wanted: DataFrame, id_col: str = "page_id") -> DataFrame:
    """The records with the ids in ``wanted``, with payloads: the index finds
    bundle, frame and offset, and only those frames are unpacked."""
    common.ship(spark)
    quoted = F.url_encode(F.col(id_col).cast("string"))
    for a, b in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):  # as urllib quotes
        quoted = F.replace(quoted, F.lit(a), F.lit(b))
    name = F.concat(F.lit(NAME), quoted)
    keys = wanted.where(F.col(id_col).isNotNull()).select(name.alias("record_id")).distinct()
    found = bundles(spark, path).select("bundle", F.explode("records").alias("r")).select("bundle", "r.*").join(keys, "record_id")
    rows = found.join(bundles(spark, path).select("bundle", "content"), "bundle").select("content", "frame", "offset", "length")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                content, frame, offset, length = (c[i].as_py() for c in b.columns)
                data = unpack(content, frames(content)[frame])
                yield _table([parse(data[offset : offset + length])], True)

    return rows.mapInArrow(run, _schema(True))


def page_id(name: str, kind: T.DataType):
    """The id inside a record name, as its own type (null for rows that had
    none)."""
    bare = F.substring(F.col(name), len(NAME) + 1, 1 << 30)
    return F.when(~bare.startswith("none:"), F.url_decode(bare)).cast(kind)


def export(spark: SparkSession, path: str, folder: str) -> DataFrame:
    """Write each bundle as ``<bundle>.warc.zst`` into a folder that all
    machines mount; a file appears under its name only when whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.makedirs(folder, exist_ok=True)
        for b in batches:
            for i in range(b.num_rows):
                name, content = b.column(0)[i].as_py(), b.column(1)[i].as_py()
                part = f"{folder}/.{name}.{uuid.uuid4().hex}"
                with open(part, "wb") as f:
                    f.write(content)
                os.replace(part, f"{folder}/{name}.warc.zst")
            yield pa.RecordBatch.from_arrays([b.column(0)], names=["bundle"])

    return bundles(spark, path).select("bundle", "content").mapInArrow(run, "bundle string")


def round_trip(df: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = 1000) -> DataFrame:
    """Archive ``df`` under ``path`` and read every record back: id,
    payload_bytes, payload_digest, record_type, refers_to."""
    archive(df, path, id_col, url_col, payload_col, least_bytes)
    kind = common.id_type(df, id_col)
    return read_records(df.sparkSession, path).select(
        page_id("record_id", kind).alias(id_col), "payload_bytes", "payload_digest", "record_type", page_id("refers_to", kind).alias("refers_to")
    )
