"""WARC archives as seekable Zstandard bundles.

Records are grouped into frames that can be decompressed by themselves; a bundle ends in a seek table (the public
seekable format: a skippable frame of compressed and decompressed frame sizes). The index maps a record's identifier to its bundle, frame
and place in the frame, so that reading a record decompresses one frame. Of equal payloads one record is a response; the others revisit it.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from livegauge.llm.common import Scratch
from livegauge.llm.files import opened, own_name
from livegauge.storage import new_path

FRAME_BYTES, BUNDLE_BYTES = 1 << 18, 64 << 20  # a frame takes records until it reaches this size, a bundle frames
LEAST_REVISIT = 1000  # smaller payloads are stored again
# Fixed values of the seekable Zstandard format.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1

_SPACE = uuid.uuid5(uuid.NAMESPACE_URL, "warc-record")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _clean(value: str) -> str:
    """A header value on one line."""
    return "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def record(page_id, url: str | None, payload: bytes, refers_to=None, date: str = "1970-01-01T00:00:00Z", unique: str = "") -> bytes:
    """One WARC 1.1 record; a revisit if ``refers_to`` is given, with the payload left out."""
    sha1 = hashlib.sha1(payload).digest()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    # What a revisit may refer to is named by page and payload, all else by its row, so that rows which repeat an id have names of their own.
    own = f"page {page_id} {sha1.hex()}" if refers_to is None and page_id is not None else f"row {unique} {page_id}"
    name = uuid.uuid5(_SPACE, own)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:uuid:{name}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(sha1).decode()}",
        "Content-Type: application/http; msgtype=response",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {_clean(url)}")
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        head += [
            f"WARC-Profile: {PROFILE}",
            f"WARC-Refers-To: <urn:uuid:{uuid.uuid5(_SPACE, f'page {refers_to} {sha1.hex()}')}>",
            f"X-Refers-To-Page-ID: {refers_to}",
        ]
    block = http if refers_to is not None else http + payload
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes, start: int = 0) -> tuple[dict[str, str], bytes, int]:
    """(headers, block, end) of the record at ``start``."""
    stop = data.index(b"\r\n\r\n", start)
    lines = data[start:stop].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record at {start}")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    begin = stop + 4
    end = begin + int(headers["Content-Length"])
    return headers, data[begin:end], end + 4


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The footer for frames of these (compressed, decompressed) sizes."""
    entries = b"".join(struct.pack("<II", *f) for f in frames)
    return struct.pack("<II", SKIPPABLE, len(entries) + 9) + entries + struct.pack("<IBI", len(frames), 0, SEEKABLE)


class Bundle:
    """A bundle opened for reading by frame."""

    def __init__(self, path: str):
        self.file = opened(path, "read")
        size = self.file.size()
        self.file.seek(size - 9)
        count, flags, magic = struct.unpack("<IBI", self.file.read(9))
        if magic != SEEKABLE:
            raise ValueError(f"{path} has no seek table")
        step = 12 if flags & 0x80 else 8
        self.file.seek(size - 9 - count * step)
        table = self.file.read(count * step)
        self.sizes = [struct.unpack_from("<II", table, step * k) for k in range(count)]
        self.starts = [0]
        for compressed, _ in self.sizes:
            self.starts.append(self.starts[-1] + compressed)

    def frame(self, number: int) -> bytes:
        self.file.seek(self.starts[number])
        return zstandard.ZstdDecompressor().decompress(self.file.read(self.sizes[number][0]), self.sizes[number][1])


class _Writer:
    """Bundles of one task."""

    def __init__(self, folder: str):
        self.folder, self.number, self.file = folder, 0, None
        self.packer = zstandard.ZstdCompressor(level=3)

    def frame(self, data: bytes) -> tuple[str, int]:
        if self.file is None:
            self.path, self.frames, self.size = own_name(self.folder, self.number, ".warc.zst"), [], 0
            self.file = opened(self.path, "write")
            self.number += 1
        packed = self.packer.compress(data)
        self.file.write(packed)
        self.frames.append((len(packed), len(data)))
        self.size += len(packed)
        at = self.path, len(self.frames) - 1
        if self.size >= BUNDLE_BYTES:
            self.close()
        return at

    def close(self) -> None:
        if self.file is not None:
            self.file.write(seek_table(self.frames))
            self.file.close()
            self.file = None


def write_archive(
    pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = LEAST_REVISIT
) -> DataFrame:
    """Write a record per page into bundles under ``folder`` and return the index: id, bundle, frame, offset (in the frame), length.

    Payload: the html in UTF-8, empty if null. Of the records with equal payloads of at least ``least`` bytes that with the largest id is
    the response, the others are revisits of it. Rows that repeat that id are all responses, and so are rows whose ids are all null. A null url is left out of the record.
    """
    spark = pages.sparkSession
    payload = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("html"))
    marks = rows.select("id", F.sha1("html").alias("sha1"), F.octet_length("html").alias("bytes"), F.crc32(F.col("html").cast("binary")).alias("crc"))
    marks = marks.where(F.col("bytes") >= least)
    groups = marks.groupBy("sha1", "bytes", "crc").agg(F.max("id").alias("refers_to"), F.count("*").alias("copies"))
    groups = groups.where("copies > 1 AND refers_to IS NOT NULL").drop("copies")
    copies = marks.join(groups, ["sha1", "bytes", "crc"]).where("NOT id <=> refers_to").select(F.col("id").alias("copy"), F.col("sha1").alias("of"), "refers_to").distinct()
    joined = rows.withColumn("sha1", F.sha1("html")).join(copies.hint("shuffle_hash"), F.col("id").eqNullSafe(F.col("copy")) & (F.col("sha1") == F.col("of")), "left")
    kind = dict(rows.dtypes)["id"]
    whole = kind in ("bigint", "int", "smallint", "tinyint")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        writer, held, size, seen = _Writer(folder), [], 0, 0
        columns = ["id", "bundle", "frame", "offset", "length"]

        def flush() -> pd.DataFrame:
            nonlocal held, size
            bundle, number = writer.frame(b"".join(r for _, r in held))
            found, offset = [], 0
            for row, data in held:
                found.append((row, bundle, number, offset, len(data)))
                offset += len(data)
            held, size = [], 0
            out = pd.DataFrame(found, columns=columns)
            return out.astype({"id": "Int64"}) if whole else out

        for batch in batches:
            for row, url, html, to in zip(batch["id"], batch["url"], batch["html"], batch["refers_to"], strict=True):
                row, to = (None if pd.isna(v) else int(v) if whole else v for v in (row, to))
                data = record(row, url, html.encode(), to, unique=f"{own_name('', 0, '')} {seen}")
                seen += 1
                held.append((row, data))
                size += len(data)
                if size >= FRAME_BYTES:
                    yield flush()
        if held:
            yield flush()
        writer.close()

    # Ids as text where they are whole numbers: pandas would hold such a column with nulls as floats.
    sent = joined.select(*(F.col(c).cast("string").alias(c) if whole else c for c in ("id", "refers_to")), "url", "html")
    index = sent.select("id", "url", "html", "refers_to").mapInPandas(run, f"id {kind}, bundle string, frame int, offset long, length long")
    return Scratch(spark, "warc-index").keep(index)


def read_archive(index: DataFrame) -> DataFrame:
    """The records that the index names, read from their bundles: id, url, record_type, refers_to, payload_bytes, payload_digest,
    payload (null for a revisit). A revisit's digest and size are those it states; a response's are taken from its payload."""
    kind = dict(index.dtypes)["id"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        path, number, bundle, frame = None, None, None, b""
        for batch in batches:
            rows = []
            for name, part, offset in zip(batch["bundle"], batch["frame"], batch["offset"], strict=True):
                if name != path:
                    path, number, bundle = name, None, Bundle(name)
                if part != number:
                    number, frame = part, bundle.frame(part)
                headers, block, _ = parse(frame, offset)
                http, _, payload = block.partition(b"\r\n\r\n")
                size = int(http.rpartition(b"Content-Length: ")[2])
                digest = base64.b32decode(headers["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                revisit = headers["WARC-Type"] == "revisit"
                if not revisit and (hashlib.sha1(payload).hexdigest(), len(payload)) != (digest, size):
                    raise ValueError(f"{name}, frame {part}, offset {offset}: the payload is not the one stored")
                rows.append(
                    (headers.get("X-Page-ID"), headers.get("WARC-Target-URI"), headers["WARC-Type"], headers.get("X-Refers-To-Page-ID"),
                     size, digest, None if revisit else payload.decode())
                )
            yield pd.DataFrame(rows, columns=["id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"])

    # As many ranges as bundles: adaptive execution sees the small index only, and would read all bundles in one task.
    bundles = index.select("bundle").distinct().count()
    ordered = index.repartitionByRange(max(1, bundles), "bundle").sortWithinPartitions("bundle", "frame", "offset")
    found = ordered.select("bundle", "frame", "offset").mapInPandas(
        run, "id string, url string, record_type string, refers_to string, payload_bytes long, payload_digest string, payload string"
    )
    return found.withColumn("id", F.col("id").cast(kind)).withColumn("refers_to", F.col("refers_to").cast(kind))


def archive_folder(spark) -> str:
    """A new folder for bundles in the session's shared folder."""
    return new_path(spark, "warc")
