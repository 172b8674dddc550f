"""WARC archives compressed record by record with an embedded dictionary.

``archive`` writes a WARC record for each row: one row of each group of
equal payloads is a response, the others are revisit records that refer to
it and leave the payload out.  A task writes its rows to archives of about
``ARCHIVE`` bytes.  An archive begins with a skippable frame that holds a
Zstandard dictionary, built from the archive's own first records; then every
record is a frame of its own, so any record can be read alone.  ``read``
gives the records back and checks each payload against its digest.

Scale: equal payloads meet by length and SHA-256 in a partial aggregate, and
only groups of two or more are joined back, from the small side's point of
view (a hot group is many rows of the large side, which AQE splits).  The
rows are numbered and written first, so a task that runs again sees the
same rows and of repeated rows exactly one is the response.  A task holds
``TRAINING`` bytes of records and a batch of rows.

Files go to the shared folder through Arrow's file systems.  A name has the
attempt in it, and the table of archives, committed by Spark, lists those of
the attempts that count; files of lost attempts are in no table.

Defined results: a null payload is empty; a null page_id goes last when a
group's response is chosen, and is read back as null; a null url leaves the
target out; control characters and blanks of a url are percent-encoded;
payloads of fewer than ``at_least`` bytes are all responses; too few records
to train on become a dictionary as they are; an empty table has no archive
and an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid

import pandas as pd
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .common import shared_dir, written

#: Bytes of an archive, after which a task begins another.
ARCHIVE = 256 << 20
#: Bytes of records that a dictionary is built from at most, and its size.
TRAINING, DICTIONARY = 4 << 20, 1 << 16
#: Format constants: magic numbers of the dictionary's skippable frame and of a Zstandard frame.
SKIPPABLE, FRAME = 0x184D2A5D, 0xFD2FB528
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEVEL = 3


def decided(pages: DataFrame, at_least: int = 0, id: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """row, page_id, url, payload, size, sha1 (hex) and, for a revisit, its
    response's first_row, first_id and first_url."""
    body = F.coalesce(F.col(payload).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), body.alias("payload"))
    rows = rows.withColumns({"row": F.monotonically_increasing_id(), "size": F.octet_length("payload").cast("long"), "sha1": F.sha1("payload"), "same": F.unhex(F.sha2("payload", 256))})
    rows = written(rows, "records", codec="zstd")
    place = F.struct(F.col("page_id").isNull().alias("last"), "page_id", "row", "url")
    groups = rows.where(F.col("size") >= at_least).groupBy("size", "same").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
    firsts = groups.select("size", "same", F.col("first.row").alias("first_row"), F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url"))
    out = rows.join(firsts, ["size", "same"], "left").drop("same")
    other = F.col("first_row") != F.col("row")
    return out.withColumns({c: F.when(other, F.col(c)) for c in ("first_row", "first_id", "first_url")})


def record_id(space: str, row: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.UUID(space), row)}>"


def safe(url: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def base32(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def record(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    """One WARC record; fields without a value are left out."""
    lines = [f"{k}: {v}" for k, v in [*fields, ("Content-Length", str(len(block)))] if v is not None]
    return "\r\n".join([VERSION, *lines, "", ""]).encode() + block + b"\r\n\r\n"


def page_record(r, space: str, date: str) -> bytes:
    """The response or revisit record of a decided row, whose numbers are
    texts.  The HTTP head says the full payload's length, whether the payload
    follows or not."""
    have = lambda x: None if pd.isna(x) else x
    link = lambda u: None if pd.isna(u) else safe(u)
    revisit = have(r.first_row) is not None
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {r.size}\r\n\r\n".encode()
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(space, r.row)), ("WARC-Date", date), ("WARC-Target-URI", link(r.url)),
        ("WARC-Payload-Digest", f"sha1:{base32(r.sha1)}"), ("Content-Type", "application/http;msgtype=response"), ("X-Page-Id", have(r.page_id)),
    ]
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(space, r.first_row)), ("WARC-Refers-To-Target-URI", link(r.first_url)), ("WARC-Refers-To-Date", date), ("X-Refers-To-Page-Id", have(r.first_id))]
    return record(fields, head if revisit else head + r.payload)


def trained(samples: list[bytes], size: int = DICTIONARY) -> bytes:
    """A dictionary from records; too few to train on are one as they are."""
    try:
        return zstandard.train_dictionary(size, samples, k=200, d=8).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-size:]


class Writer:
    """One archive: records are held until there are enough for the
    dictionary, then written one frame each."""

    def __init__(self, path: str, space: str, date: str):
        self.path, self.n, self.size, self.held, self.zstd = path, 0, 0, [], None
        system, place = fs.FileSystem.from_uri(path)
        system.create_dir(place.rsplit("/", 1)[0], recursive=True)
        self.out = system.open_output_stream(place, compression=None)
        info = b"software: ledgerlake\r\nformat: WARC File Format 1.1\r\n"
        self.add(record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", record_id(space, path)), ("WARC-Date", date), ("Content-Type", "application/warc-fields")], info), 0)

    def add(self, raw: bytes, counts: int = 1) -> None:
        self.n += counts
        if self.zstd is None:
            self.held.append(raw)
            self.size += len(raw)
            if self.size >= TRAINING:
                self.begin()
        else:
            self.put(self.zstd.compress(raw))

    def begin(self) -> None:
        made, held = trained(self.held), self.held
        self.held, self.size = [], 0
        packed = zstandard.ZstdCompressor(level=19).compress(made)
        self.put(struct.pack("<II", SKIPPABLE, len(packed)) + packed)
        self.zstd = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(made), write_checksum=True)
        for raw in held:
            self.put(self.zstd.compress(raw))

    def put(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def close(self) -> tuple[str, int, int]:
        if self.zstd is None:
            self.begin()
        self.out.close()
        return self.path, self.n, self.size


def archive(pages: DataFrame, at_least: int = 0, date: str = "1970-01-01T00:00:00Z", archive_bytes: int = ARCHIVE, **columns: str) -> DataFrame:
    """Writes the archives; returns archive (path), n_records, n_bytes."""
    space = str(uuid.uuid4())
    folder = f"{shared_dir(pages.sparkSession)}/warc-{space}"

    def write(batches):
        task = TaskContext.get()
        name, made, now = f"{folder}/{task.partitionId():06d}-{task.taskAttemptId()}", [], None
        for batch in batches:
            for r in batch.itertuples(index=False):
                if now is None:
                    now = Writer(f"{name}-{len(made):06d}.warc.zst", space, date)
                now.add(page_record(r, space, date))
                if now.zstd is not None and now.size >= archive_bytes:
                    made.append(now.close())
                    now = None
        if now is not None:
            made.append(now.close())
        yield pd.DataFrame(made, columns=["archive", "n_records", "n_bytes"])

    rows = decided(pages, at_least, **columns)
    rows = rows.withColumns({c: F.col(c).cast("string") for c in ("row", "page_id", "size", "first_row", "first_id")})
    made = rows.mapInPandas(write, "archive string, n_records long, n_bytes long")
    return written(made, "archives")


def frames(path: str, chunk: int = 1 << 20):
    """The decompressed frames of an archive, one after the other."""
    system, place = fs.FileSystem.from_uri(path)
    with system.open_input_stream(place, compression=None) as source:
        magic, size = struct.unpack("<II", source.read(8))
        if magic != SKIPPABLE:
            raise ValueError(f"{path}: no dictionary frame")
        made = source.read(size)
        if made[:4] == struct.pack("<I", FRAME):
            made = zstandard.ZstdDecompressor().decompress(made)
        zstd = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(made))
        data, one, parts = source.read(chunk), None, []
        while data:
            if one is None:
                one, parts = zstd.decompressobj(), []
            parts.append(one.decompress(data))
            data = one.unused_data if one.eof else b""
            if one.eof:
                yield b"".join(parts)
                one = None
            data = data or source.read(chunk)
        if one is not None:
            raise ValueError(f"{path}: the last record is cut")


def parsed(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Fields (names lower-cased) and block of a record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = {k.lower(): v for k, v in (x.split(": ", 1) for x in lines)}
    size = int(fields["content-length"])
    if version != VERSION or rest[size:] != b"\r\n\r\n":
        raise ValueError(f"not a record: {head[:80]!r}")
    return fields, rest[:size]


def read(archives: DataFrame) -> DataFrame:
    """page_id, url, record_type, payload_bytes, payload_digest, refers_to,
    payload (null in a revisit) of every page record of the archives.  A
    payload that its digest or length does not fit is an error."""

    def rows(paths):
        for path in paths:
            for raw in frames(path):
                f, block = parsed(raw)
                if f["warc-type"] not in ("response", "revisit"):
                    continue
                http, _, payload = block.partition(b"\r\n\r\n")
                size = int(dict(x.split(": ", 1) for x in http.decode().split("\r\n")[1:])["Content-Length"])
                full, digest = f["warc-type"] == "response", f["warc-payload-digest"].removeprefix("sha1:")
                if full and (size != len(payload) or digest != base64.b32encode(hashlib.sha1(payload).digest()).decode()):
                    raise ValueError(f"{path}: the payload of {f['warc-record-id']} is damaged")
                number = lambda name: int(f[name]) if name in f else None
                yield number("x-page-id"), f.get("warc-target-uri"), f["warc-type"], size, digest, number("x-refers-to-page-id"), payload if full else None

    types = {"page_id": "Int64", "url": object, "record_type": object, "payload_bytes": "Int64", "payload_digest": object, "refers_to": "Int64", "payload": object}

    def frame(held):
        columns = zip(*held) if held else [[] for _ in types]
        return pd.DataFrame({name: pd.Series(list(x), dtype=kind) for (name, kind), x in zip(types.items(), columns)})

    def restored(batches):
        for batch in batches:
            held, size = [], 0
            for row in rows(batch["archive"]):
                held.append(row)
                size += 256 + len(row[-1] or b"")
                if size >= TRAINING:
                    yield frame(held)
                    held, size = [], 0
            yield frame(held)

    one_each = archives.select("archive").repartition(max(1, archives.count()))
    return one_each.mapInPandas(restored, "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary")


def report(pages: DataFrame, at_least: int = 0) -> DataFrame:
    """The records of ``pages`` as their archives give them back."""
    return read(archive(pages, at_least)).drop("url", "payload")


#: The query in DuckDB's SQL.
REPORT_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, octet_length(encode(body)) AS payload_bytes, sha1(body) AS hex,
             row_number() OVER (PARTITION BY body ORDER BY page_id NULLS LAST) AS nth,
             first_value(page_id) OVER (PARTITION BY body ORDER BY page_id NULLS LAST) AS first_id FROM p),
b AS (SELECT *, list_transform(range(4), lambda i: translate(to_base(('0x' || substr(hex, 10 * i + 1, 10))::BIGINT, 32, 8), '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567')) AS parts FROM d)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, list_aggregate(parts, 'string_agg', '') AS payload_digest,
       CASE WHEN nth = 1 THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN nth > 1 THEN first_id END AS refers_to
FROM b
"""
