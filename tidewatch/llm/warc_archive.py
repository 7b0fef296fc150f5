"""Zstandard web archives (``.warc.zst``): writing with revisit records, and reading.

An archive is a leading skippable frame that holds the compression dictionary,
then one frame per record. Spark writes and reads the files, so any store that
Spark reaches will do and a lost task is simply run again: a task gathers whole
archives of about ``archive_bytes`` as binary values, and the text sink puts
each into a file of its own. That sink closes a line with its separator, here
an empty skippable frame, which every reader of the format passes over.

Equal payloads (same SHA-1 and length) are written once. The smallest key of a
group comes from a salted pre-aggregation, and goes back to the rows by a join
on (digest, salt): a group may hold any share of the rows, no task gets all of
it. Payloads move in that join alone.

Reading walks the frames by their block headers, so a damaged record costs that
record only; a file cut off inside a frame, or followed by other bytes, gives
one error row for the rest. Each record must have a version line, the mandatory
headers, a block of exactly ``Content-Length`` bytes, the closing line breaks
and matching digests; a response's payload must be as long as its HTTP header
says. ``error`` names the first rule broken and is null for a sound record.

The dictionary is trained on about ``sample_records`` records (twice as many at
most) drawn by a hash, ``SAMPLE_BYTES`` of each; too few to train on, and the
archives have none.

Edge cases: a null payload is an empty one, a null url has no header; null keys
come last in a group (a group of null keys alone: all are responses); rows that
share the smallest key of a group are all responses; an empty table gives no
archive and reads back empty; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import urllib.parse
import uuid
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import ensure_checkpoint_dir

#: fixed values of the formats: frame magic numbers, dictionary magic, the profile of identical payloads
FRAME_MAGIC, DICTIONARY_FRAME_MAGIC, SKIPPABLE_MAGIC, DICTIONARY_MAGIC = 0xFD2FB528, 0x184D2A5D, 0x184D2A50, 0xEC30A437
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANDATORY = ("warc-type", "warc-record-id", "warc-date", "content-length")

#: an empty skippable frame, all of it ASCII: what the text sink writes after an archive
EMPTY_FRAME = struct.pack("<II", SKIPPABLE_MAGIC, 0).decode("ascii")
SALTS = 256
SAMPLE_BYTES = 16 << 10
MAX_RECORD_BYTES = 1 << 31


def base32_digest(hex_digest: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def record_id(key, digest: str) -> str:
    return f"<urn:nokey:{digest}>" if key is None else f"<urn:key:{urllib.parse.quote(str(key), safe='')}:{digest}>"


def key_of(column) -> F.Column:
    """Key in a record id, as text; null where the record has none."""
    found = F.regexp_extract(column, "^<urn:key:([^:]*):[A-Z2-7]+>$", 1)
    return F.when(F.startswith(column, F.lit("<urn:key:")), F.url_decode(found))


@dataclass(frozen=True)
class Page:
    key: object
    url: str | None
    payload: bytes
    digest: str  # bare base32 SHA-1 of the payload
    first: object  # key of the response that holds this payload
    revisit: bool


def record_bytes(page: Page, date: str) -> bytes:
    """One uncompressed record."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(page.payload)}\r\n\r\n".encode()
    block = http if page.revisit else http + page.payload
    headers = [("WARC-Type", "revisit" if page.revisit else "response"), ("WARC-Record-ID", record_id(page.key, page.digest)), ("WARC-Date", date)]
    if page.url is not None:
        headers.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m.group()):02X}", page.url)))
    headers.append(("WARC-Payload-Digest", f"sha1:{page.digest}"))
    if page.revisit:
        headers += [("WARC-Refers-To", record_id(page.first, page.digest)), ("WARC-Profile", PROFILE)]
    headers += [("WARC-Block-Digest", f"sha1:{base32_digest(hashlib.sha1(block).hexdigest())}"),
                ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers).encode() + b"\r\n" + block + b"\r\n\r\n"


def dictionary_frame(dictionary: bytes) -> bytes:
    return struct.pack("<II", DICTIONARY_FRAME_MAGIC, len(dictionary)) + dictionary


def frame_end(data: memoryview, at: int) -> int:
    """Where the frame that starts at ``at`` ends, from its header and block headers."""
    def number(begin: int, size: int) -> int:
        if begin + size > len(data):
            raise ValueError("truncated frame")
        return int.from_bytes(data[begin: begin + size], "little")

    magic = number(at, 4)
    if magic & 0xFFFFFFF0 == SKIPPABLE_MAGIC:
        end = at + 8 + number(at + 4, 4)
    elif magic == FRAME_MAGIC:
        descriptor = number(at + 4, 1)
        single = descriptor >> 5 & 1
        content = (single, 2, 4, 8)[descriptor >> 6]
        end, last = at + 5 + (1 - single) + (0, 1, 2, 4)[descriptor & 3] + content, 0
        while not last:
            block = number(end, 3)
            last, kind = block & 1, block >> 1 & 3
            if kind == 3:
                raise ValueError("reserved block type")
            end += 3 + (1 if kind == 1 else block >> 3)
        end += 4 * (descriptor >> 2 & 1)
    else:
        raise ValueError("not a frame")
    if end > len(data):
        raise ValueError("truncated frame")
    return end


def load_dictionary(data: memoryview) -> zstandard.ZstdCompressionDict | None:
    """Dictionary of an archive's leading skippable frame, stored plainly or as a frame of its own."""
    if len(data) < 8 or int.from_bytes(data[:4], "little") != DICTIONARY_FRAME_MAGIC:
        return None
    held = bytes(data[8: frame_end(data, 0)])
    if held[:4] == FRAME_MAGIC.to_bytes(4, "little"):
        held = zstandard.ZstdDecompressor().decompress(held)
    if held[:4] != DICTIONARY_MAGIC.to_bytes(4, "little"):
        raise ValueError("the leading frame holds no dictionary")
    return zstandard.ZstdCompressionDict(held)


FIELDS = ("warc_type", "record_id", "target_uri", "refers_to", "payload_digest", "payload_bytes", "payload")


def parse_record(record: bytes) -> dict:
    """Fields of one record; raises ValueError at the first broken rule."""
    head, found, rest = record.partition(b"\r\n\r\n")
    if not found:
        raise ValueError("no end of headers")
    lines = head.split(b"\r\n")
    if lines[0] not in (b"WARC/1.0", b"WARC/1.1"):
        raise ValueError("no version line")
    headers = _headers(lines[1:])
    for name in MANDATORY:
        if name not in headers:
            raise ValueError(f"no header {name}")
    if not re.fullmatch("[0-9]+", headers["content-length"]):
        raise ValueError("content-length is no number")
    size = int(headers["content-length"])
    block, closing = rest[:size], rest[size:]
    if len(block) != size or closing != b"\r\n\r\n":
        raise ValueError("block is not as long as content-length")
    _check(headers.get("warc-block-digest"), block, "block digest")
    out = {"warc_type": headers["warc-type"], "record_id": headers["warc-record-id"], "target_uri": headers.get("warc-target-uri"),
           "refers_to": headers.get("warc-refers-to"), "payload_digest": None, "payload_bytes": None, "payload": None}
    if headers.get("content-type", "").replace(" ", "").lower() == "application/http;msgtype=response":
        http, found, payload = block.partition(b"\r\n\r\n")
        if not found:
            raise ValueError("no end of HTTP headers")
        declared = _headers(http.split(b"\r\n")[1:]).get("content-length")
        if declared is not None and not re.fullmatch("[0-9]+", declared):
            raise ValueError("HTTP content-length is no number")
        digest = (headers.get("warc-payload-digest") or "").removeprefix("sha1:") or None
        if out["warc_type"] == "revisit":
            if payload:
                raise ValueError("revisit with a payload")
            if digest is None or out["refers_to"] is None:
                raise ValueError("revisit without payload digest or reference")
            out |= {"payload_digest": digest, "payload_bytes": None if declared is None else int(declared)}
        else:
            if declared is not None and int(declared) != len(payload):
                raise ValueError("payload is not as long as HTTP content-length")
            _check(headers.get("warc-payload-digest"), payload, "payload digest")
            out |= {"payload_digest": base32_digest(hashlib.sha1(payload).hexdigest()), "payload_bytes": len(payload), "payload": payload}
    return out


def _headers(lines: list[bytes]) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in lines:
        name, found, value = line.partition(b":")
        if not found or not name.strip():
            raise ValueError("header line without a name")
        out.setdefault(name.strip().decode("utf-8", "replace").lower(), value.strip().decode("utf-8", "replace"))
    return out


def _check(named: str | None, data: bytes, what: str) -> None:
    if named and named.startswith("sha1:") and named[5:] != base32_digest(hashlib.sha1(data).hexdigest()):
        raise ValueError(f"{what} does not match")


def records(data: memoryview, max_record_bytes: int = MAX_RECORD_BYTES):
    """``(offset, fields or None, error or None)`` of every record frame of an archive."""
    at, reader = 0, None
    try:
        reader = zstandard.ZstdDecompressor(dict_data=load_dictionary(data))
    except (ValueError, zstandard.ZstdError) as e:
        yield 0, None, f"dictionary: {e}"
        reader = zstandard.ZstdDecompressor()
    while at < len(data):
        try:
            end = frame_end(data, at)
        except ValueError as e:
            yield at, None, str(e)
            return
        if int.from_bytes(data[at: at + 4], "little") == FRAME_MAGIC:
            frame = bytes(data[at:end])
            try:
                if zstandard.frame_content_size(frame) > max_record_bytes:
                    raise ValueError("record is larger than allowed")
                unpacked = reader.decompressobj().decompress(frame) if zstandard.frame_content_size(frame) < 0 else reader.decompress(frame)
                yield at, parse_record(unpacked), None
            except zstandard.ZstdError as e:
                yield at, None, f"frame: {e}"
            except ValueError as e:
                yield at, None, str(e)
        at = end


def _marked(pages: DataFrame, key: str, url: str, payload: str, least_bytes: int) -> DataFrame:
    """Every page with its digest and the smallest key that has the same payload."""
    body = F.coalesce(F.col(payload).cast("string"), F.lit(""))
    rows = pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"), F.encode(body, "UTF-8").alias("payload"))
    rows = rows.select("*", F.sha1("payload").alias("digest"), F.octet_length("payload").cast("long").alias("bytes"),
                       F.pmod(F.xxhash64("key", "url"), F.lit(SALTS)).cast("int").alias("salt"))
    parts = rows.groupBy("digest", "bytes", "salt").agg(F.min("key").alias("first"))
    groups = parts.groupBy("digest", "bytes").agg(F.min("first").alias("first"), F.collect_set("salt").alias("salts"))  # at most SALTS
    joined = rows.join(groups.select("digest", "bytes", F.explode("salts").alias("salt"), "first"), ["digest", "bytes", "salt"])
    again = (F.col("bytes") >= least_bytes) & F.col("first").isNotNull() & ~F.col("key").eqNullSafe(F.col("first"))
    return joined.select("key", "url", "payload", "digest", "first", again.alias("revisit"))


def train_dictionary(pages: DataFrame, key: str, payload: str, size: int = 64 << 10, sample_records: int = 512) -> bytes | None:
    """A dictionary from a bounded sample of payloads (see the module's text)."""
    every = max(1, pages.count() // sample_records)
    chosen = pages.where(F.pmod(F.xxhash64(key, payload), F.lit(every)) == 0).select(F.substring(F.col(payload).cast("string"), 1, SAMPLE_BYTES).alias("part"))
    samples = sorted(r.part.encode()[:SAMPLE_BYTES] for r in chosen.where("length(part) > 0").limit(2 * sample_records).collect())
    if sum(map(len, samples)) < 8 * size:
        return None
    try:
        return zstandard.train_dictionary(size, samples, k=256, d=8).as_bytes()  # given k and d: no search over them
    except zstandard.ZstdError:
        return None


def write_archives(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html", least_bytes: int = 0,
                   archive_bytes: int = 32 << 20, level: int = 3, date: str = "1970-01-01T00:00:00Z", sample_records: int = 512) -> str:
    """Writes a record per row under ``path``; payloads of ``least_bytes`` or more are written once."""
    dictionary = train_dictionary(pages, key, payload, sample_records=sample_records)
    marked = _marked(pages, key, url, payload, least_bytes)

    def run(batches):
        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        packer = zstandard.ZstdCompressor(level=level, dict_data=known, write_checksum=True, write_content_size=True)
        head = [dictionary_frame(dictionary)] if dictionary else []
        frames, held = list(head), 0
        for batch in batches:
            columns = [batch.column(c) for c in ("key", "url", "payload", "digest", "first", "revisit")]
            for row in zip(*columns, strict=True):
                values = [v.as_py() for v in row]
                frames.append(packer.compress(record_bytes(Page(*values[:3], base32_digest(values[3]), *values[4:]), date)))
                held += len(frames[-1])
                if held >= archive_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(frames)], pa.binary())], names=["archive"])
                    frames, held = list(head), 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(frames)], pa.binary())], names=["archive"])

    archives = marked.mapInArrow(run, "archive binary").select(F.col("archive").cast("string").alias("value"))
    archives.write.mode("overwrite").option("lineSep", EMPTY_FRAME).option("maxRecordsPerFile", 1).text(path)
    return path


_ROW = pa.schema([("archive", pa.string()), ("offset", pa.int64()), ("warc_type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()),
                  ("refers_to", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary()), ("error", pa.string())])
SCHEMA = ("archive string, offset long, warc_type string, record_id string, target_uri string, refers_to string, "
          "payload_digest string, payload_bytes long, payload binary, error string")


def read_archives(spark: SparkSession, path: str, with_payload: bool = True, batch_bytes: int = 4 << 20, max_record_bytes: int = MAX_RECORD_BYTES) -> DataFrame:
    """One row per record of the archives under ``path``."""
    files = spark.read.format("binaryFile").load(path).where("length > 0").select("path", "content")

    def run(batches):
        for batch in batches:
            for name, content in zip(batch.column("path"), batch.column("content"), strict=True):
                rows, held = [], 0
                for offset, fields, error in records(memoryview(content.as_buffer()), max_record_bytes):
                    row = {"archive": name.as_py(), "offset": offset, **dict.fromkeys(FIELDS), **(fields or {}), "error": error}
                    held += 500 + len(row["payload"] or b"")
                    rows.append(row if with_payload else row | {"payload": None})
                    if held >= batch_bytes:
                        yield pa.RecordBatch.from_pylist(rows, schema=_ROW)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_ROW)

    return files.mapInArrow(run, SCHEMA)


def archive_path(spark: SparkSession) -> str:
    """A fresh folder below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tidewatch/warc-{uuid.uuid4().hex}"
