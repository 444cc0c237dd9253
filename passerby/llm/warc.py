"""WARC archives: written by Spark's tasks, read back in byte ranges.

An archive is a row of gzip members, one for each record. A reading task has a
range of bytes of one file. It looks for the three bytes that a member begins
with, takes a place for a member if it unpacks to a record's header, and owns
the records that start within its range, the last of which it reads to its end.
"""

import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from passerby.session import cut_lineage, run_folder

MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
#: Smallest payload of which copies become revisits.
LEAST_PAYLOAD = 100
RANGE_BYTES = 8 << 20
MOST_TASKS = 100_000
#: A range is read in steps of this size.
STEP = 1 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def place_of(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI; a plain path is a local one."""
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _uri(path: str) -> str:
    """``file:/x`` as Spark may write it, as ``file:///x``."""
    return path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path


def header(fields: list[tuple[str, object]]) -> bytes:
    return b"".join(f"{name}: {value}\r\n".encode() for name, value in fields)


def record(page_id, url: str | None, payload: bytes, digest: str, kind: str, refers_to) -> bytes:
    """One record as a gzip member. Its block is the HTTP answer; a revisit's has the header alone."""
    http = b"HTTP/1.1 200 OK\r\n" + header([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", len(payload))]) + b"\r\n"
    block = http + (payload if kind == "response" else b"")
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}\n{url}')}>"),
              ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Page-ID", "" if page_id is None else page_id)]
    if url:
        fields.append(("WARC-Target-URI", "".join(c if c.isprintable() and c != " " else "%20" for c in url)))
    fields.append(("WARC-Payload-Digest", f"sha256:{digest}"))
    if kind == "revisit":
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To-Page-ID", refers_to)]
    fields += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", len(block))]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(b"WARC/1.1\r\n" + header(fields) + b"\r\n" + block + b"\r\n\r\n") + packer.flush()


def records_of(pages: DataFrame, least: int = LEAST_PAYLOAD) -> DataFrame:
    """``pages`` as records: page_id, url, payload, payload_digest, record_type, refers_to.

    Equal payloads of ``least`` bytes or more are written once, for the smallest
    page_id; others with that payload revisit it. A null html is an empty
    payload. Rows that repeat the smallest page_id are responses too, and so are
    copies none of which has an id; a copy without an id revisits one with. The
    payload moves once, to where its digest is; the smallest ids are found
    before the shuffle, so a payload that a third of all pages share is no load.
    """
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("payload_digest", F.sha2("payload", 256))
    shared = rows.filter(F.octet_length("payload") >= least).groupBy(F.col("payload_digest").alias("digest")).agg(
        F.min("page_id").alias("first"), F.count("*").alias("rows")).filter("rows > 1 AND first IS NOT NULL").drop("rows")
    joined = rows.join(shared, F.col("payload_digest") == F.col("digest"), "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return joined.select("page_id", "url", "payload", "payload_digest", F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                         F.when(revisit, F.col("first")).alias("refers_to"))


def write(records: DataFrame, folder: str) -> DataFrame:
    """Writes ``records`` as archives under ``folder``, a file for each task: (path, bytes, records) of the files that count.

    A file is written under a name of its own attempt, so a task that runs
    twice leaves a second file that no row names.
    """

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, at = place_of(folder)
        out, path, size, count = None, None, 0, 0
        for batch in batches:
            if batch.num_rows and out is None:
                name = f"part-{uuid.uuid4().hex}.warc.gz"
                system.create_dir(at, recursive=True)
                out, path = system.open_output_stream(f"{at}/{name}", compression=None), f"{folder}/{name}"
            for first in range(0, batch.num_rows, 100):
                for row in batch.slice(first, 100).to_pylist():
                    size += out.write(record(row["page_id"], row["url"], row["payload"], row["payload_digest"], row["record_type"], row["refers_to"]))
                    count += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([size], pa.int64()), pa.array([count], pa.int64())],
                                                 ["path", "bytes", "records"])

    return cut_lineage(records.mapInArrow(save, "path string, bytes long, records long"))


@dataclass
class Reader:
    """Bytes of a file from any place on, read in steps; at most two steps and one record are held."""

    file: object
    size: int
    base: int = 0
    held: bytes = b""
    read: int = field(default=0)

    def at(self, place: int, count: int) -> bytes:
        """``count`` bytes from ``place``, fewer at the end of the file."""
        if place < self.base or place > self.base + len(self.held):
            self.base, self.held = place, b""
        while self.base + len(self.held) < min(place + count, self.size):
            self.file.seek(self.base + len(self.held))
            more = self.file.read(max(STEP, place + count - self.base - len(self.held)))
            if not more:
                break
            self.held = self.held[place - self.base:] + more
            self.base = place
        return self.held[place - self.base:place - self.base + count]


def member(reader: Reader, place: int) -> tuple[dict[str, str], bytes, int] | None:
    """The record in the gzip member at ``place`` and the place behind it, or None if there is no record.

    The version is unpacked first: bytes that only look like a member's
    beginning fail there, before much is read. A header is as long as it is.
    """
    unpack = zlib.decompressobj(31)
    data, at = bytearray(), place
    fields, start, length = None, 0, 0
    try:
        while not unpack.eof:
            chunk = reader.at(at, 1 << 16)
            if not chunk:
                return None
            seen = len(data)
            data += unpack.decompress(chunk)
            at += len(chunk) - len(unpack.unused_data)
            if not data.startswith(VERSION[:len(data)]):
                return None
            if fields is None:
                end = data.find(b"\r\n\r\n", max(0, seen - 3))
                if end >= 0:
                    lines = data[:end].decode("utf-8", "replace").split("\r\n")[1:]
                    fields = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
                    start, length = end + 4, int(fields["content-length"])
    except (zlib.error, KeyError, ValueError):
        return None
    if fields is None or len(data) < start + length:
        return None
    return fields, bytes(data[start:start + length]), at


def read_range(reader: Reader, start: int, end: int) -> Iterator[tuple[dict[str, str], bytes, int]]:
    """The records that start in [start, end): header fields, block, place."""
    place = start
    while place < end:
        window = reader.at(place, min(STEP, end - place + len(MAGIC) - 1))
        found = window.find(MAGIC)
        if found < 0 or place + found >= end:
            # The last two bytes may begin a member that goes on in the next step.
            place += max(1, len(window) - len(MAGIC) + 1) if found < 0 else found + 1
            continue
        place += found
        got = member(reader, place)
        if got is None:
            place += 1
            continue
        yield got[0], got[1], place
        place = got[2]


def parts_of(block: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and payload of an HTTP answer."""
    head, _, payload = block.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}, payload


RECORD = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("place", T.LongType()), T.StructField("record_type", T.StringType()),
    T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("refers_to", T.LongType()),
    T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()), T.StructField("payload", T.BinaryType()),
    T.StructField("intact", T.BooleanType())])


def read(spark: SparkSession, files: DataFrame, range_bytes: int = RANGE_BYTES, payloads: bool = True) -> DataFrame:
    """The records of archives; ``files`` has their (path, bytes).

    payload_bytes and payload_digest are those of the whole payload, for a
    revisit as its headers state them; ``intact`` says whether a response's own
    bytes have the stated digest. Damaged members are passed over, and reading
    goes on at the next that unpacks. Large and small files make tasks of like
    size; no file need be read by one task.
    """
    ranges = files.select("path", "bytes", F.explode(F.sequence(F.lit(0), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(range_bytes))).alias("start"))
    # A task for each range, so that the ranges of one file go to many tasks.
    tasks = files.agg(F.sum(F.ceil(F.col("bytes") / range_bytes))).first()[0] or 1
    ranges = ranges.repartition(min(int(tasks), MOST_TASKS), "path", "start")

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size, start in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                system, at = place_of(_uri(path))
                with system.open_input_file(at) as file:
                    rows: list[tuple] = []
                    held = 0
                    for fields, block, place in read_range(Reader(file, size), start, min(start + range_bytes, size)):
                        http, payload = parts_of(block)
                        kind = fields.get("warc-type", "")
                        stated = fields.get("warc-payload-digest", "").removeprefix("sha256:")
                        response = kind == "response"
                        digest = hashlib.sha256(payload).hexdigest() if response else stated
                        page = fields.get("warc-page-id") or None
                        origin = fields.get("warc-refers-to-page-id")
                        rows.append((path, place, kind, page and int(page), fields.get("warc-target-uri"),
                                     int(origin) if origin and origin != "None" else None,
                                     len(payload) if response else int(http.get("content-length", 0)), digest,
                                     payload if payloads and response else None, digest == stated))
                        held += len(payload)
                        if held > STEP or len(rows) >= 1000:
                            yield pa.RecordBatch.from_pylist([dict(zip(RECORD.names, row, strict=True)) for row in rows], schema=ARROW)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_pylist([dict(zip(RECORD.names, row, strict=True)) for row in rows], schema=ARROW)

    return ranges.mapInArrow(load, RECORD)


ARROW = pa.schema([("path", pa.string()), ("place", pa.int64()), ("record_type", pa.string()), ("page_id", pa.int64()), ("url", pa.string()),
                   ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()),
                   ("intact", pa.bool_())])


def round_trip(pages: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Every page written to archives in the shared folder and read back from them; an error if not all come back."""
    spark = pages.sparkSession
    files = write(records_of(pages), f"{run_folder(spark)}-warc")
    found = read(spark, files, range_bytes, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    found = cut_lineage(found)
    written, back = files.agg(F.sum("records")).first()[0] or 0, found.count()
    if written != back:
        raise ValueError(f"{back} of {written} records came back from the archives")
    return found


ORACLE = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload FROM pages),
firsts AS (
  SELECT payload, min(page_id) AS first FROM payloads WHERE octet_length(encode(payload)) >= 100 GROUP BY payload)
SELECT page_id, octet_length(encode(p.payload))::BIGINT AS payload_bytes, sha256(p.payload) AS payload_digest,
       CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM payloads p LEFT JOIN firsts f ON p.payload = f.payload
"""
