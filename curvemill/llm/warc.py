"""WARC archives of zstandard frames: written from a table of pages, read back and validated.

An archive begins with a skippable frame that holds a zstandard dictionary; after it each
record is a frame of its own. Spark's text writer puts the records of a task into one file and
an empty skippable frame behind each, as its line separator, so archives lie wherever Spark
can write, and a lost task writes its file anew.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from itertools import chain, islice
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curvemill.llm.common import write

# Fixed values of the formats.
FRAME_MAGIC = 0xFD2FB528
DICTIONARY_MAGIC = 0xEC30A437
SKIPPABLE_MAGIC = 0x184D2A50        # and the 15 numbers behind it
DICTIONARY_FRAME = 0x184D2A5D
SEPARATOR = "P*M\x18\x00\x00\x00\x00"   # a skippable frame without content
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NEEDED = ("warc-record-id", "warc-date", "warc-type", "content-length")

# A dictionary is trained on the first records of a file; it changes sizes, never results.
SAMPLE_RECORDS = 400
SAMPLE_BYTES = 8192             # of each of them
DICTIONARY_BYTES = 65_536
BATCH_BYTES = 8_000_000         # of results that a task holds before it passes them on
LEVEL = 3

RECORD = ("path string, place bigint, frame_bytes bigint, record_type string, key string, "
          "refers_to string, target string, payload binary, payload_bytes bigint, "
          "payload_digest string, error string")


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _field(value: str) -> str:
    """A header value: signs beyond printable ASCII, blanks and % are percent-encoded."""
    return quote(value, safe="!#$&'()*+,/:;=?@[]~^`{|}\\\"<>")


def _record_id(place: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'record {place}')}>"


def record_of(place: int, key: str | None, url: str | None, payload: bytes, first_place: int,
              first_key: str | None, date: str) -> bytes:
    """A response record, or a revisit record without payload if another row holds it."""
    digest = sha1_base32(payload)
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    revisit = place != first_place
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
             f"WARC-Record-ID: {_record_id(place)}", f"WARC-Date: {date}",
             f"WARC-Target-URI: {'about:blank' if url is None else _field(url)}",
             f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{sha1_base32(block)}",
             f"Payload-Length: {len(payload)}"]
    if key is not None:
        lines.append(f"Record-Key: {_field(key)}")
    if revisit:
        lines += [f"WARC-Refers-To: {_record_id(first_place)}", f"WARC-Profile: {PROFILE}"]
        if first_key is not None:
            lines.append(f"Refers-To-Key: {_field(first_key)}")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def dictionary_of(samples: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A dictionary of the samples; none where they are too few or too small to train one."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples) if len(samples) > 7 else None
    except zstandard.ZstdError:
        return None


def frames_of(records: Iterator[bytes]) -> Iterator[bytes]:
    """The dictionary frame, if there is a dictionary, and one frame per record."""
    first = list(islice(records, SAMPLE_RECORDS))
    trained = dictionary_of([r[:SAMPLE_BYTES] for r in first])
    if trained:
        trained.precompute_compress(level=LEVEL)
        content = zstandard.ZstdCompressor(level=19).compress(trained.as_bytes())
        yield struct.pack("<II", DICTIONARY_FRAME, len(content)) + content
    packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_checksum=True)
    for record in chain(first, records):
        yield packer.compress(record)


def write_archives(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url",
                   html: str = "html", date: str = "2024-01-01T00:00:00Z") -> None:
    """One archive per task in ``folder``, with a record per row.

    The payload is the html in UTF-8; a null is an empty payload. Of the rows with equal
    payloads the one with the least key is the response and the others revisit it; a null key
    comes last, and among equal keys one row is the response. A null url is about:blank. Pages
    of any length are one record. An empty table writes no archive. Other columns are not read.
    """
    payload = F.coalesce(F.col(html).cast("binary"), F.lit(b""))
    named = pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"),
                         payload.alias("payload"))
    rows = write(named.withColumns({"place": F.monotonically_increasing_id(),
                                    "same": F.unhex(F.sha2("payload", 256))}),
                 "warc-pages", codec="zstd").df
    order = F.struct(F.col("key").isNull(), "key", "place")
    groups = write(rows.groupBy("same").agg(F.count(F.lit(1)).alias("n"), F.min(order).alias("first"))
                   .where("n > 1").select("same", F.col("first")["place"].alias("first_place"),
                                          F.col("first")["key"].cast("string").alias("first_key")),
                   "warc-groups", ("same", "first_key")).copied()
    told = rows.join(groups, "same", "left").select(
        "place", F.col("key").cast("string"), "url", "payload",
        F.coalesce("first_place", "place").alias("first_place"), "first_key")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records = (record_of(*(c[i].as_py() for c in batch.columns), date)
                   for batch in batches for i in range(batch.num_rows))
        yield from _batches(({"value": f} for f in frames_of(records)),
                            pa.schema([("value", pa.binary())]), lambda x: len(x["value"]))

    told.mapInArrow(task, "value binary").select(F.col("value").cast("string")) \
        .write.option("lineSep", SEPARATOR).option("maxRecordsPerFile", 0).text(folder)


def _batches(rows: Iterator[dict], schema: pa.Schema, size) -> Iterator[pa.RecordBatch]:
    held, done = 0, []
    for row in rows:
        done.append(row)
        held += size(row) + 100
        if held >= BATCH_BYTES:
            yield pa.RecordBatch.from_pylist(done, schema)
            held, done = 0, []
    if done:
        yield pa.RecordBatch.from_pylist(done, schema)


def frame_end(data: memoryview, at: int) -> int:
    """Where the frame that begins at ``at`` ends, from the headers of its blocks."""
    if len(data) - at < 8:
        raise ValueError("the archive ends inside a frame")
    magic, size = struct.unpack_from("<II", data, at)
    if magic >> 4 == SKIPPABLE_MAGIC >> 4:
        end = at + 8 + size
    elif magic == FRAME_MAGIC:
        try:
            head = data[at:at + 18]
            end, last = at + zstandard.frame_header_size(head), False
            checked = zstandard.get_frame_parameters(head).has_checksum
        except zstandard.ZstdError as e:
            raise ValueError(f"broken frame header: {e}") from None
        while not last:
            if end + 3 > len(data):
                raise ValueError("the archive ends inside a frame")
            block = int.from_bytes(data[end:end + 3], "little")
            last, kind = block & 1, block >> 1 & 3
            if kind == 3:
                raise ValueError("reserved block type")
            end += 3 + (1 if kind == 1 else block >> 3)
        end += 4 * checked
    else:
        raise ValueError("no zstandard frame")
    if end > len(data):
        raise ValueError("the archive ends inside a frame")
    return end


def leading_dictionary(data: memoryview) -> zstandard.ZstdCompressionDict | None:
    """The dictionary of the leading skippable frame, plain or compressed; None without one."""
    if len(data) < 8 or struct.unpack_from("<I", data)[0] != DICTIONARY_FRAME:
        return None
    content = bytes(data[8:frame_end(data, 0)])
    try:
        if content[:4] == struct.pack("<I", FRAME_MAGIC):
            content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
        if content[:4] != struct.pack("<I", DICTIONARY_MAGIC):
            raise ValueError("the leading frame holds no dictionary")
        return zstandard.ZstdCompressionDict(content)
    except zstandard.ZstdError as e:
        raise ValueError(f"broken dictionary: {e}") from None


def _headers(lines: list[bytes]) -> dict[str, str]:
    found: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.partition(b":")
        if not colon or not re.fullmatch(rb"[!#$%&'*+.^_`|~0-9A-Za-z-]+", name):
            raise ValueError("broken header line")
        if name.decode().lower() in found:
            raise ValueError("repeated header")
        found[name.decode().lower()] = value.strip(b" \t").decode("utf-8", "strict")
    return found


def _length(value: str) -> int:
    if not re.fullmatch("[0-9]{1,18}", value):
        raise ValueError("broken length")
    return int(value)


def parsed(record: bytes) -> dict:
    """Fields of one record; ValueError where a header, a length or a digest is wrong."""
    head, gap, rest = record.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or not re.fullmatch(rb"WARC/1\.[01]", lines[0]):
        raise ValueError("no WARC header")
    fields = _headers(lines[1:])
    for name in NEEDED:
        if name not in fields:
            raise ValueError(f"{name} is missing")
    size = _length(fields["content-length"])
    if len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError("the block has another length")
    block, kind, payload = rest[:size], fields["warc-type"], None
    if fields.get("warc-block-digest", "sha1:").removeprefix("sha1:") not in ("", sha1_base32(block)):
        raise ValueError("the block has another digest")
    if kind in ("response", "request", "revisit") and fields.get(
            "content-type", "").startswith("application/http"):
        top, gap, payload = block.partition(b"\r\n\r\n")
        if not gap or not (top.startswith(b"HTTP/") or kind == "request"):
            raise ValueError("no HTTP header")
        http = _headers(top.split(b"\r\n")[1:])
        if kind == "response" and _length(http.get("content-length", str(len(payload)))) != len(payload):
            raise ValueError("the payload has another length")
    elif kind != "revisit":
        payload = block
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    if kind == "revisit":
        if not digest or "warc-profile" not in fields:
            raise ValueError("a revisit without digest or profile")
        payload, length = None, fields.get("payload-length")
        length = None if length is None else _length(length)
    else:
        length, found = len(payload), sha1_base32(payload)
        if digest not in (None, found):
            raise ValueError("the payload has another digest")
        digest = found
    return {"record_type": kind, "target": fields.get("warc-target-uri"), "payload": payload,
            "payload_bytes": length, "payload_digest": digest, **{
                c: None if fields.get(n) is None else unquote(fields[n])
                for c, n in (("key", "record-key"), ("refers_to", "refers-to-key"))}}


def records_of(data: bytes, payloads: bool = True) -> Iterator[dict]:
    """A row per record frame of an archive, in order.

    A record that can't be decoded or is not valid has only its place and an error; the frames
    behind it are read on. Where a frame's own end can't be found, the last row says so.
    """
    view, at = memoryview(data), 0
    try:
        unpacker = zstandard.ZstdDecompressor(dict_data=leading_dictionary(view))
        while at < len(view):
            end = frame_end(view, at)
            if struct.unpack_from("<I", view, at)[0] == FRAME_MAGIC:
                row = {"place": at, "frame_bytes": end - at}
                try:
                    frame = unpacker.decompressobj(read_across_frames=False)
                    record = frame.decompress(view[at:end])
                    if not frame.eof:
                        raise ValueError("the frame is not complete")
                    row |= parsed(record)
                    if not payloads:
                        row["payload"] = None
                except (ValueError, zstandard.ZstdError) as e:
                    row["error"] = str(e)
                yield row
            at = end
    except ValueError as e:
        yield {"place": at, "frame_bytes": len(view) - at, "error": str(e)}


def read_archives(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """A row per record of all archives in ``folder``, see ``records_of``.

    Archives may come from other writers; those of ``write_archives`` also name the key of the
    record and of the one it revisits. One file is read by one task: ``write_archives`` makes
    files no larger than a task's share of its input.
    """
    fields = [f.split() for f in RECORD.split(", ")]
    kinds = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in fields])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ({**row, "path": path.as_py()} for batch in batches
                for path, content in zip(batch.column(0), batch.column(1))
                for row in records_of(content.as_buffer().to_pybytes(), payloads))
        yield from _batches(rows, schema, lambda x: len(x.get("payload") or b""))

    return spark.read.format("binaryFile").load(folder).select("path", "content") \
        .mapInArrow(task, RECORD)
