"""WARC archives as seekable Zstandard bundles.

Records are grouped into frames that decompress independently; a bundle ends with a skippable frame that maps record ids to
(frame, offset in the frame's data, length) and, last, the standard seek table of frame sizes. So one record is read by
seeking to one frame. Payloads of ``REVISIT_BYTES`` or more that occur in several pages are stored once, in the record of the
largest page_id; the others are revisit records that refer to it.

Null html is an empty payload, a null url an empty target. Rows that repeat the page_id that holds a payload are responses
too. A page with a null id can't be referred to; it revisits if another page has its payload.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyforge.llm import _base as B
from tallyforge.llm import files

REVISIT_BYTES = 1000
FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 1 << 26
DATE = "2024-01-01T00:00:00Z"
INDEX_MAGIC = 0x184D2A50
SEEK_MAGIC = 0x184D2A5E
SEEK_END = 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BUNDLES = "bundle string, n_records long"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.md5(f'page:{page_id}'.encode()).digest())}>"


def record(page_id: int | None, url: str, payload: bytes, sha1_hex: str, refers_to: int | None, revisit: bool) -> bytes:
    digest = base64.b32encode(bytes.fromhex(sha1_hex)).decode()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {DATE}",
        "WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"),
        f"WARC-Payload-Digest: sha1:{digest}",
        *([f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page: {refers_to}"] if revisit else []),
        f"X-Page: {'' if page_id is None else page_id}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes, int]:
    """Header fields, payload as stored, and the length of the full payload of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in head.decode().split("\r\n")[1:])
    http, _, payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    return fields, payload, int(http.rsplit(b": ", 1)[1])


class Bundle:
    """Writes one bundle."""

    def __init__(self, uri: str):
        import zstandard

        self.uri, self.squeeze = uri, zstandard.ZstdCompressor(level=3)
        files.make_parent(uri)
        system, path = files.opened(uri)
        self.out = system.open_output_stream(path, compression=None)
        self.frames: list[tuple[int, int]] = []
        self.index: list[tuple[str, int, int, int]] = []
        self.waiting: list[bytes] = []
        self.held = self.total = 0

    def add(self, key: str, raw: bytes) -> None:
        self.index.append((key, len(self.frames), self.held, len(raw)))
        self.waiting.append(raw)
        self.held += len(raw)
        self.total += len(raw)
        if self.held >= FRAME_BYTES:
            self._frame()

    def _frame(self) -> None:
        data = self.squeeze.compress(b"".join(self.waiting))
        self.out.write(data)
        self.frames.append((len(data), self.held))
        self.waiting, self.held = [], 0

    def close(self) -> int:
        if self.waiting:
            self._frame()
        index = self.squeeze.compress(json.dumps(self.index).encode())
        self.out.write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        self.frames.append((len(index) + 8, 0))
        table = b"".join(struct.pack("<II", *f) for f in self.frames) + struct.pack("<IBI", len(self.frames), 0, SEEK_END)
        self.out.write(struct.pack("<II", SEEK_MAGIC, len(table)) + table)
        self.out.close()
        return len(self.index)


class Reader:
    """Seeks in one bundle."""

    def __init__(self, uri: str):
        import zstandard

        system, path = files.opened(uri)
        self.source, self.unpack = system.open_input_file(path), zstandard.ZstdDecompressor()
        end = self.source.size()
        n, _, magic = struct.unpack("<IBI", files.read_range(self.source, end - 9, 9))
        if magic != SEEK_END:
            raise ValueError(f"{uri} has no seek table")
        sizes = [struct.unpack_from("<II", t, 8 * i) for t in [files.read_range(self.source, end - 9 - 8 * n, 8 * n)] for i in range(n)]
        self.at = [0]
        for packed, _ in sizes:
            self.at.append(self.at[-1] + packed)
        index = files.read_range(self.source, self.at[n - 1], sizes[-1][0])
        self.index = json.loads(self.unpack.decompress(index[8:]))
        self.frames = n - 1

    def frame(self, i: int) -> bytes:
        return self.unpack.decompress(files.read_range(self.source, self.at[i], self.at[i + 1] - self.at[i]))

    def fetch(self, key: str) -> bytes:
        """One record by its id: one frame is read."""
        _, frame, start, length = next(x for x in self.index if x[0] == key)
        return self.frame(frame)[start : start + length]

    def records(self):
        by_frame: dict[int, list] = {}
        for x in self.index:
            by_frame.setdefault(x[1], []).append(x)
        for i, own in by_frame.items():
            data = self.frame(i)
            for _, _, start, length in own:
                yield data[start : start + length]


def archived(pages: DataFrame) -> DataFrame:
    """Writes the archives to the shared folder; a row (bundle, n_records) for each."""
    plain = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    keyed = plain.withColumn("digest", F.sha1(F.encode("html", "utf-8"))).withColumn("n_bytes", F.octet_length("html").cast("long"))
    large = keyed.where(F.col("n_bytes") >= REVISIT_BYTES).groupBy("digest", "n_bytes").agg(F.max("page_id").alias("holder"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    held = B.written(large, "held_payloads")
    known = keyed.join(held, ["digest", "n_bytes"], "left").withColumn("revisit", F.col("holder").isNotNull() & ~F.col("holder").eqNullSafe(F.col("page_id")))
    folder = B.fresh_path(pages.sparkSession, "archives")

    def write(batches):
        bundle, made = None, []
        for batch in batches:
            for r in batch.to_pylist():
                if bundle is None:
                    bundle = Bundle(f"{folder}/{uuid.uuid4().hex}.warc.zst")
                bundle.add(record_id(r["page_id"]), record(r["page_id"], r["url"], r["html"].encode(), r["digest"], r["holder"], r["revisit"]))
                if bundle.total >= BUNDLE_BYTES:
                    made.append((bundle.uri, bundle.close()))
                    bundle = None
        if bundle is not None:
            made.append((bundle.uri, bundle.close()))
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in made], pa.string()), pa.array([x[1] for x in made], pa.int64())], ["bundle", "n_records"])

    # Only bundles of tasks that ended well are listed; a repeated task writes new files.
    return B.written(known.select("page_id", "url", "html", "digest", "holder", "revisit").mapInArrow(write, BUNDLES), "bundles")


def read_back(bundles: DataFrame) -> DataFrame:
    """A row for each record in the bundles. Digests and sizes of responses are computed anew from the stored payloads."""

    def read(batches):
        for batch in batches:
            for uri in batch.column("bundle").to_pylist():
                rows = []
                for raw in Reader(uri).records():
                    fields, payload, length = parse(raw)
                    revisit = fields["WARC-Type"] == "revisit"
                    sha1 = base64.b32decode(fields["WARC-Payload-Digest"].split(":")[1]).hex() if revisit else hashlib.sha1(payload).hexdigest()
                    page = int(fields["X-Page"]) if fields["X-Page"] else None
                    rows.append((page, length if revisit else len(payload), sha1, fields["WARC-Type"], int(fields["X-Refers-To-Page"]) if revisit else None))
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
                columns = list(zip(*rows, strict=True)) or [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    n = max(1, bundles.count())
    return bundles.select("bundle").repartition(n).mapInArrow(read, RECORDS)
