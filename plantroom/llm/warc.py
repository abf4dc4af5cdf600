"""Pages as WARC archives, found again by a two-level capture index.

Every page becomes a record, compressed on its own, of an archive file that a task writes: a response with its payload,
or, where another page of smaller id has the same payload, a revisit that refers to it. Payloads are never sorted or
grouped; only pages that are copies are told apart, by digest.

The index has a line for each record, keyed by its URL with the host reversed (`com,example,www)/path`), so that a
site's pages lie together. Lines are sorted over the cluster and written in compressed blocks; each index file ends
with a sparse directory of its blocks, and a table of one row for each index file is the top. A search bisects the
table, then a file's directory, reads the one range that holds the block, bisects its lines, and last reads the
records' ranges from the archives, in their order there.

Files are written and read with pyarrow, so the shared folder has to be in a store it knows (local or mounted paths,
hdfs, s3, gs). A task that is tried again writes files of other names; those of lost tries are named by no index line.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from base64 import b32encode
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha1
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plantroom.functions.columns import spread
from plantroom.llm.shared import partitions, shared_folder, stored

#: Bytes after which a task begins a new archive; lines of an index block; bytes read at once from an archive.
ARCHIVE_BYTES, BLOCK_LINES, READ_BYTES = 256 << 20, 3000, 8 << 20
LEVEL = 4
#: Pages name no time of capture.
DATE = "2000-01-01T00:00:00Z"
#: Copies of one row that a task writes; lines that a task searches or reads (a short line stands for a whole record).
COPIES, TASK_LINES = 1000, 50_000

_ENTRY = "key string, page_id long, file string, offset long, length long"
_SHARD = "file string, first_key string, first_page long, last_key string, last_page long, offset long, length long, lines long"
RECORD = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


# Files


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder or file, and its path there."""
    parts = urlsplit(uri)
    if parts.scheme in ("", "file"):
        return fs.LocalFileSystem(), parts.path
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", uri))


class Ranges:
    """Byte ranges of the files of one folder, read in order; the last file stays open."""

    def __init__(self, folder: str):
        self.store, self.folder = opened(folder)
        self.name, self.file = None, None

    def read(self, name: str, offset: int, length: int) -> bytes:
        if name != self.name:
            self.close()
            self.name, self.file = name, self.store.open_input_file(f"{self.folder}/{name}")
        data = self.file.read_at(length, offset)
        if len(data) != length:
            raise OSError(f"{name} ends before byte {offset + length}")
        return data

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


class Growing:
    """A new file of the folder and how long it is so far."""

    def __init__(self, folder: str, suffix: str):
        store, path = opened(folder)
        store.create_dir(path, recursive=True)
        self.name, self.size = f"{uuid.uuid4().hex}{suffix}", 0
        self.file = store.open_output_stream(f"{path}/{self.name}", compression=None)

    def add(self, data: bytes) -> tuple[int, int]:
        at = self.size
        self.file.write(data)
        self.size += len(data)
        return at, len(data)


# Records


def packed(data: bytes) -> bytes:
    """One gzip member."""
    squeeze = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return squeeze.compress(data) + squeeze.flush()


def unpacked(data: bytes) -> bytes:
    return zlib.decompressobj(31).decompress(data)


def _uri(url: str) -> str:
    """Control characters and blanks, which end a header line or a word, in percent form."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def _record_id(capture: str, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{capture} {copy}')}>"


def record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{name}: {value}\r\n" for name, value in [*fields, ("Content-Length", str(len(block)))])
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def capture_record(row: dict) -> bytes:
    """The record of a page: a response, or a revisit if the row says to which capture it refers."""
    revisit = row["first_capture"] is not None
    payload = b"" if revisit else row["payload"]
    size = row["payload_bytes"]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _record_id(row["capture"], row["copy"])),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", "sha1:" + b32encode(bytes.fromhex(row["digest"])).decode()),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if row["url"] is not None:
        fields.append(("WARC-Target-URI", _uri(row["url"])))
    if row["page_id"] is not None:
        fields.append(("X-Page-Id", str(row["page_id"])))
    if revisit:
        fields.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
        fields.append(("WARC-Refers-To", _record_id(row["first_capture"], 0)))
        if row["first_page"] is not None:
            fields.append(("X-Refers-To-Page-Id", str(row["first_page"])))
    return record(fields, http + payload)


def _headers(data: bytes) -> tuple[dict[str, str], bytes]:
    """The header lines below the first, by lower-case name, and what follows them."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")[1:]
    return {name.lower(): value for name, value in (line.split(": ", 1) for line in lines)}, rest


def read_record(data: bytes) -> dict:
    """What a record says of its page; a response's digest and length are those of the payload read."""
    fields, rest = _headers(data)
    size = int(fields["content-length"])
    block, end = rest[:size], rest[size:]
    if len(block) != size or end != b"\r\n\r\n":
        raise ValueError(f"record {fields.get('warc-record-id')} is not as long as it says")
    http, payload = _headers(block)
    said = fields["warc-payload-digest"].removeprefix("sha1:")
    length = int(http["content-length"])
    kind = fields["warc-type"]
    if kind == "response" and (len(payload), b32encode(sha1(payload).digest()).decode()) != (length, said):
        raise ValueError(f"the payload of record {fields['warc-record-id']} is not the one that was written")
    whole = lambda name: int(fields[name]) if name in fields else None
    return {
        "page_id": whole("x-page-id"),
        "url": fields.get("warc-target-uri"),
        "payload_bytes": length,
        "payload_digest": said,
        "record_type": kind,
        "refers_to": whole("x-refers-to-page-id"),
        "payload": payload if kind == "response" else None,
    }


# Keys


def url_key(url: Column) -> Column:
    """A URL without scheme and fragment, its host in lower case and reversed; other texts as they are, null empty."""
    whole = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)(:[0-9]*)?([^#]*).*$"
    text = F.regexp_replace(F.coalesce(url, F.lit("")), r"[\x00-\x20\x7f]", "%20")
    host = F.array_join(F.reverse(F.split(F.lower(F.regexp_extract(text, whole, 1)), r"\.")), ",")
    key = F.concat(host, F.regexp_extract(text, whole, 2), F.lit(")"), F.regexp_extract(text, whole, 3))
    return F.when(F.rlike(text, F.lit(whole)), key).otherwise(text)


def _place(key: str, page: int | None) -> tuple[str, bool, int]:
    """Orders index lines as Spark sorted them: by key, then page, no page first."""
    return key, page is not None, page or 0


# Index


def _lines(table: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*[table.column(name).to_pylist() for name in ("key", "page_id", "file", "offset", "length")], strict=True)


class Block:
    """Lines of a block, to be bisected."""

    def __init__(self, data: bytes):
        self.lines = [json.loads(line) for line in unpacked(data).decode().split("\n")]
        self.places = [_place(line[0], line[1]) for line in self.lines]


class Shard:
    """An index file: its directory, and the block that was read last."""

    def __init__(self, ranges: Ranges, name: str, offset: int, length: int):
        self.ranges, self.name = ranges, name
        self.directory = json.loads(unpacked(ranges.read(name, offset, length)))
        self.places = [_place(key, page) for key, page, _, _ in self.directory]
        self.number, self.block = -1, None

    def _block(self, number: int) -> Block:
        if number != self.number:
            _, _, offset, length = self.directory[number]
            self.number, self.block = number, Block(self.ranges.read(self.name, offset, length))
        return self.block

    def find(self, low: tuple, high: tuple) -> Iterator[list]:
        """Lines from place `low` to place `high`, both included."""
        number = max(0, bisect_left(self.places, low) - 1)
        while number < len(self.places) and self.places[number] <= high:
            block = self._block(number)
            for line in range(bisect_left(block.places, low), bisect_right(block.places, high)):
                yield block.lines[line]
            number += 1


@dataclass(frozen=True)
class Archive:
    """Where the archives and the index are, and the index files' first and last places; one row for each file."""

    folder: str
    shards: list[dict]

    def _in_order(self, rows: DataFrame, *order: str) -> DataFrame:
        """Sorted ranges, as many as the records ask for and not as few as the bytes of their lines."""
        wanted = sum(s["lines"] for s in self.shards) // TASK_LINES
        return rows.repartitionByRange(max(partitions(rows.sparkSession), wanted), *order).sortWithinPartitions(*order)

    def located(self, wanted: DataFrame) -> DataFrame:
        """The records of some URLs: key, page_id, file, offset, length.

        `wanted` has the column url; with page_id as well, only records of that page are found. Each distinct key, or
        key and page, is searched once, however often it is asked for.
        """
        by_page = "page_id" in wanted.columns
        names = ["key", "page_id"] if by_page else ["key"]
        asked = wanted.select(url_key(F.col("url")).alias("key"), *names[1:]).distinct()
        folder, shards = self.folder, self.shards
        firsts = [_place(s["first_key"], s["first_page"]) for s in shards]
        lasts = [_place(s["last_key"], s["last_page"]) for s in shards]

        def bounds(key: str, page: int | None) -> tuple[tuple, tuple]:
            return (_place(key, page),) * 2 if by_page else ((key, False, 0), (key, True, 1 << 63))

        def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keys = batch.column("key").to_pylist()
                pages = batch.column("page_id").to_pylist() if by_page else [None] * len(keys)
                found: tuple[list, list, list] = ([], [], [])
                for key, page in zip(keys, pages, strict=True):
                    low, high = bounds(key, page)
                    for shard in range(bisect_left(lasts, low), bisect_right(firsts, high)):
                        for column, value in zip(found, (shard, key, page), strict=True):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(found[0], pa.int64()), pa.array(found[1], pa.string()), pa.array(found[2], pa.int64())], names=["shard", "key", "page_id"])

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ranges, number, shard = Ranges(folder), -1, None
            for batch in batches:
                found: list[list] = []
                for at, key, page in zip(*[batch.column(c).to_pylist() for c in ("shard", "key", "page_id")], strict=True):
                    if at != number:
                        number, shard = at, Shard(ranges, shards[at]["file"], shards[at]["offset"], shards[at]["length"])
                    for line in shard.find(*bounds(key, page)):
                        found.append(line)
                        if len(found) >= 10_000:
                            yield _entries(found)
                            found = []
                yield _entries(found)
            ranges.close()

        chosen = asked.mapInArrow(choose, "shard long, key string, page_id long")
        return self._in_order(chosen, "shard", "key", "page_id").mapInArrow(search, _ENTRY)

    def read(self, located: DataFrame, payload: bool = True) -> DataFrame:
        """Located records, read from the archives in their order there, neighbours at once, each checked."""
        folder = self.folder
        schema = RECORD if payload else RECORD.rpartition(",")[0]
        names = [c.split()[0] for c in schema.split(", ")]
        types = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        arrow = pa.schema([(c.split()[0], types[c.split()[1]]) for c in schema.split(", ")])

        def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ranges = Ranges(folder)
            for batch in batches:
                for run in _runs(batch):
                    name, start = run[0][0], run[0][1]
                    data = ranges.read(name, start, run[-1][1] + run[-1][2] - start)
                    rows = [read_record(unpacked(data[offset - start : offset - start + length])) for _, offset, length in run]
                    yield pa.RecordBatch.from_pydict({c: [r[c] for r in rows] for c in names}, schema=arrow)
            ranges.close()

        return self._in_order(located.select("file", "offset", "length"), "file", "offset").mapInArrow(fetch, schema)


def _entries(lines: list[list]) -> pa.RecordBatch:
    columns = list(zip(*lines, strict=True)) if lines else [[]] * 5
    types = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["key", "page_id", "file", "offset", "length"])


def _runs(batch: pa.RecordBatch) -> Iterator[list[tuple[str, int, int]]]:
    """Sorted ranges of a file that follow each other, as far as they are read at once."""
    run: list[tuple[str, int, int]] = []
    for name, offset, length in zip(*[batch.column(c).to_pylist() for c in ("file", "offset", "length")], strict=True):
        if run and (name != run[0][0] or offset != run[-1][1] + run[-1][2] or offset + length - run[0][1] > READ_BYTES):
            yield run
            run = []
        run.append((name, offset, length))
    if run:
        yield run


def _indexed(entries: DataFrame, folder: str) -> list[dict]:
    """Write the index files; one row for each: how many there are is the number of shuffle partitions."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, directory, block, first, last, count = None, [], [], None, None, 0

        def close_block() -> None:
            nonlocal block
            if block:
                offset, length = file.add(packed("\n".join(json.dumps(line) for line in block).encode()))
                directory.append((block[0][0], block[0][1], offset, length))
                block = []

        for batch in batches:
            for line in _lines(batch):
                if file is None:
                    file, first = Growing(folder, ".cdx"), line
                block.append(line)
                last, count = line, count + 1
                if len(block) == BLOCK_LINES:
                    close_block()
        if file is not None:
            close_block()
            offset, length = file.add(packed(json.dumps(directory).encode()))
            file.file.close()
            row = {"file": file.name, "first_key": first[0], "first_page": first[1], "last_key": last[0], "last_page": last[1], "offset": offset, "length": length, "lines": count}
            yield pa.RecordBatch.from_pylist([row], schema=pa.schema([(c.split()[0], pa.string() if c.endswith("string") else pa.int64()) for c in _SHARD.split(", ")]))

    order = ["key", "page_id", "file", "offset"]
    shards = stored(entries.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(write, _SHARD), "warc-index").collect()
    return sorted((r.asDict() for r in shards), key=lambda s: _place(s["first_key"], s["first_page"]) + _place(s["last_key"], s["last_page"]))


# Archives


def _fields(pages: DataFrame, page_id: str, url: str, html: str) -> DataFrame:
    """page_id, url, payload, digest, payload_bytes and `capture`, which equal rows share."""
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.coalesce(F.col(html).cast("string"), F.lit("")).cast("binary").alias("payload")
    )
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    parts = [F.coalesce(F.col("page_id").cast("string"), F.lit("-")), F.lit(" "), F.col("digest"), F.coalesce(F.concat(F.lit(" "), F.col("url")), F.lit(""))]
    return rows.withColumn("capture", F.sha1(F.concat(*parts)))


def _told_apart(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Captures that have copies: (revisits with the times each is to be written, captures that stand in several rows).

    Nothing here holds a payload. Copies meet by digest; a digest that a third of all pages share is combined before it
    is shuffled, and the join with its first capture can be split.
    """
    slim = ["capture", "page_id", "url", "digest", "payload_bytes"]
    each = stored(rows.groupBy(*slim).agg(F.count("*").alias("copies")), "warc-captures")
    place = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", F.col("url").isNull().alias("no_url"), "url", "capture")
    first = each.groupBy("digest", "payload_bytes", spread(F.col("digest")).alias("__bucket")).agg(F.min(place).alias("first"), F.sum("copies").alias("all"))
    first = first.where("all > 1").select(F.col("digest").alias("__digest"), F.col("payload_bytes").alias("__bytes"), "first")
    same = (F.col("digest") == F.col("__digest")) & (F.col("payload_bytes") == F.col("__bytes"))
    shared = stored(
        each.join(first, same).select(*slim, "copies", F.col("first.page_id").alias("first_page"), F.col("first.capture").alias("first_capture")), "warc-copies"
    )
    is_first = F.col("capture") == F.col("first_capture")
    times = F.when(is_first, F.col("copies") - 1).otherwise(F.col("copies"))
    revisits = shared.withColumn("times", times).withColumn("copy", is_first.cast("int")).where("times > 0")
    return revisits, shared.where(is_first & (F.col("copies") > 1))


def written(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> Archive:
    """Write every page to archives in the shared folder, and their index."""
    folder = f"{shared_folder(pages.sparkSession)}/plantroom-warc-{uuid.uuid4().hex}"
    rows = _fields(pages, page_id, url, html)
    revisits, repeated = _told_apart(rows)
    none = F.lit(None)
    responses = rows
    if not revisits.isEmpty():
        # every capture but those that are a first one in a single row
        others = revisits.select("capture").distinct()
        responses = rows.join(others, "capture", "left_anti")
        if not repeated.isEmpty():
            again = rows.join(repeated.select("capture"), "capture", "left_semi")
            values = [F.first(c).alias(c) for c in rows.columns if c != "capture"]
            responses = responses.unionByName(again.groupBy("capture").agg(*values))
    responses = responses.select(
        "capture", F.lit(0).cast("long").alias("copy"), "page_id", "url", "digest", "payload_bytes", "payload", none.cast("long").alias("first_page"), none.cast("string").alias("first_capture")
    )
    # rows that stand in a table very often are dealt out in lots
    lots = revisits.withColumn("lot", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(times - 1) div {COPIES}")))).repartition("capture", "lot")
    number = F.explode(F.sequence(F.col("lot") * COPIES, F.least(F.col("lot") * COPIES + COPIES, F.col("times")) - 1))
    lots = lots.withColumn("number", number).withColumn("copy", F.col("copy") + F.col("number"))
    lots = lots.select("capture", "copy", "page_id", "url", "digest", "payload_bytes", none.cast("binary").alias("payload"), "first_page", "first_capture")
    records = responses.unionByName(lots).withColumn("key", url_key(F.col("url")))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = None
        for batch in batches:
            lines = []
            for row in batch.to_pylist():
                if file is not None and file.size >= ARCHIVE_BYTES:
                    file.file.close()
                    file = None
                if file is None:
                    file = Growing(folder, ".warc.gz")
                    info = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", _record_id(file.name, 0)), ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")]
                    file.add(packed(record(info, b"format: WARC File Format 1.1\r\n")))
                lines.append([row["key"], row["page_id"], file.name, *file.add(packed(capture_record(row)))])
            yield _entries(lines)
        if file is not None:
            file.file.close()

    entries = stored(records.mapInArrow(write, _ENTRY), "warc-entries")
    return Archive(folder, _indexed(entries, folder))


def captured(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write all pages to archives, look each one up in the index and read its record.

    Returns page_id, payload_bytes, payload_digest (base32 SHA-1; both of the full payload), record_type (response or
    revisit) and refers_to (the response's page_id for revisits).

    Payloads are the html in UTF-8, null is empty. Of equal payloads, empty ones included, the capture with the
    smallest page_id is the response (a null id after all others; then the smaller url), all others revisit it. Equal
    rows are one record each, one of them the response. A null url has an empty key. An empty table has no rows; other
    columns are ignored.
    """
    archive = written(pages, page_id, url, html)
    wanted = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"))
    found = archive.read(archive.located(wanted), payload=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
