"""WARC archives with a two-level capture index.

Writing takes two passes. The first writes every payload as a record into spool files, where the rows are, and reports
where each lies, with its digest and length. From those small rows the smallest id of each payload is found; then the
records that stay are copied, compressed as they are, to the archives, in long reads of neighbouring ones, and the others
become revisit records, which need no payload. So payloads are never shuffled. Every task writes one file at a time, under
a name of its own attempt, and only what a finished task reports belongs to the result, so a repeated task leaves nothing
behind that is read.

Index: capture lines, by reversed host and path, are sorted over the cluster and cut into gzip blocks (level one), a file
for each task; beside it lies a sparse directory of each block's first key and place (level two), with the places of its
lines, so that it is searched by bisection with range reads and never held whole. What is collected is one row for each
index file. A lookup bisects the files, then the directory, and reads ranges of blocks and of records.

Files are opened by the URI of the shared folder (pyarrow's file systems), so they need not be local.

Edge cases: a null html is an empty payload; a null url has the key ``)/`` and an empty target; a null page id is
written as an empty id, read back as null, and always a response; equal payloads of any size of at least ``least`` bytes
are told apart by their SHA-1 and length; rows that repeat, with one id and payload, are all responses; very long pages
are records like others; an empty table writes no archive and gives no rows; other columns are not carried.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import struct
import uuid
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_kept, drop_path, fresh_path, frugal, keep, lower_ascii

#: Capture lines of a block; bytes of adjacent records that one range read takes at most; bytes of a file after which
#: another is begun; directory entries that a reader remembers.
LINES, RANGE, ROLL, ENTRIES = 1000, 1 << 22, 1 << 28, 10_000
DATE = "2020-01-01T00:00:00Z"
SPOOLED = "page_id bigint, url string, key string, sha string, size bigint, file string, offset bigint, length bigint"
STORE = "file string, offset bigint, length bigint, key string, page_id bigint, payload_digest string, record_type string"


@lru_cache(16)
def opened(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


class Files:
    """Writes a task's members one after the other, into files of this attempt's own names."""

    def __init__(self, folder: str, ending: str):
        (self.store, self.path), self.ending = opened(folder), ending
        self.name, self.out, self.offset = "", None, 0

    def add(self, member: bytes) -> tuple[str, int]:
        """The file and offset of a member that is written now."""
        if self.out is None or self.offset > ROLL:
            self.close()
            self.store.create_dir(self.path, recursive=True)
            self.name, self.offset = f"{uuid.uuid4().hex}.{self.ending}", 0
            self.out = self.store.open_output_stream(f"{self.path}/{self.name}", compression=None)
        at = self.offset
        self.out.write(member)
        self.offset += len(member)
        return self.name, at

    def close(self) -> None:
        if self.out:
            self.out.close()
            self.out = None

    def put(self, name: str, raw: bytes) -> None:
        """A whole file beside the others."""
        with self.store.open_output_stream(f"{self.path}/{name}", compression=None) as out:
            out.write(raw)


class Ranges:
    """Range reads from the files of a folder; the last file stays open."""

    def __init__(self, folder: str):
        self.store, self.path = opened(folder)
        self.name, self.file = None, None

    def read(self, name: str, offset: int, length: int) -> bytes:
        if name != self.name:
            if self.file:
                self.file.close()
            self.name, self.file = name, self.store.open_input_file(f"{self.path}/{name}")
        return self.file.read_at(length, offset)


def index_key(url: Column) -> Column:
    """Reversed host and the rest of a url: ``com,example,www)/path?query``."""
    rest = F.regexp_replace(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = lower_ascii(F.regexp_extract(rest, r"^[^/?#]*", 0))
    tail = F.regexp_extract(rest, r"(?s)^[^/?#]*([^#]*)", 1)
    return F.concat(F.array_join(F.reverse(F.split(host, "[.]")), ","), F.lit(")"), F.when(tail.startswith("/"), tail).otherwise(F.concat(F.lit("/"), tail)))


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes | None, size: int, sha: str, refers_to: int | None = None) -> bytes:
    """A WARC/1.0 record: a response with its payload, or, without one, a revisit with the HTTP headers and the payload's size."""
    kind = "revisit" if payload is None else "response"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload or b"")
    head = [
        "WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {json.dumps(url or '', ensure_ascii=True)[1:-1]}", f"WARC-Payload-Digest: sha1:{sha}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(member: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC headers, HTTP headers and payload of a record in a gzip member."""
    raw = gzip.decompress(member)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    http, _, payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    return fields, dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:]), payload


def page_of(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def compressed(raw: bytes) -> bytes:
    return gzip.compress(raw, 4, mtime=0)


def batch_of(columns: list[list], kinds: str) -> pa.RecordBatch:
    """Columns as a batch of a schema in Spark's words."""
    of = {"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}
    fields = [x.split() for x in kinds.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, of[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])


def spooled(spark: SparkSession, pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write every page as a response record in ``folder``; where each lies, with its digest and size (SPOOLED). No shuffle."""
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).alias("url"), index_key(F.col(url_col)).alias("key"), payload.alias("payload"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = Files(folder, "spool")
        for batch in batches:
            out: list[list] = [[] for _ in range(8)]
            for page, url, key, raw in zip(*batch.columns):
                page, url, raw = page.as_py(), url.as_py(), raw.as_py()
                sha = digest(raw)
                member = compressed(record(page, url, raw, len(raw), sha))
                for column, value in zip(out, (page, url, key.as_py(), sha, len(raw), *files.add(member), len(member))):
                    column.append(value)
            yield batch_of(out, SPOOLED)
        files.close()

    return keep(spark, rows.mapInArrow(frugal(run), SPOOLED), "spooled")


def write_archives(spark: SparkSession, pages: DataFrame, folder: str, least: int = 0) -> DataFrame:
    """Write pages as archives in ``folder``; one capture per row (columns of STORE). Only small rows are shuffled."""
    place = fresh_path(spark, "spool")
    rows = spooled(spark, pages, place)
    first = keep(spark, rows.where(F.col("size") >= least).groupBy("sha", "size").agg(F.min("page_id").alias("response")), "responses")
    rows = rows.join(first, ["sha", "size"], "left").withColumn("refers_to", F.when(F.col("response") != F.col("page_id"), F.col("response")))
    rows = rows.select("file", "offset", "length", "key", "page_id", "sha", "refers_to", "size", F.when(F.col("refers_to").isNotNull(), F.col("url")).alias("url"))
    rows = rows.repartitionByRange("file", "offset").sortWithinPartitions("file", "offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, files = Ranges(place), Files(folder, "warc.gz")
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            stays = batch.filter(batch.column(6).is_null())
            at = 0
            for name, offset, members in ranges(stays):
                raw, place_in = source.read(name, offset, sum(members)), 0
                for length in members:
                    _, _, _, key, page, sha, *_ = (c[at].as_py() for c in stays.columns)
                    for column, value in zip(out, (*files.add(raw[place_in : place_in + length]), length, key, page, sha, "response")):
                        column.append(value)
                    at, place_in = at + 1, place_in + length
            for _, _, _, key, page, sha, refers, size, url in zip(*(c.to_pylist() for c in batch.filter(batch.column(6).is_valid()).columns)):
                member = compressed(record(page, url, None, size, sha, refers))
                for column, value in zip(out, (*files.add(member), len(member), key, page, sha, "revisit")):
                    column.append(value)
            yield batch_of(out, STORE)
        files.close()

    captures = keep(spark, rows.mapInArrow(frugal(run), STORE), "captures")
    drop_path(spark, place)
    return captures


def write_index(spark: SparkSession, captures: DataFrame, folder: str) -> list[tuple[str, str, int]]:
    """Sort captures into compressed blocks in ``folder``, a file a task, each with its directory; a row for each file in
    their order: first key, name, blocks.

    Captures are dealt by ranges of key, page and place, so that many captures of one url don't meet in one task.
    """
    ranged = captures.repartitionByRange("key", "page_id", "file", "offset")
    ordered = ranged.sortWithinPartitions("key", "page_id", "file", "offset").select("key", F.to_json(F.struct("key", "page_id", "payload_digest", "record_type", "file", "offset", "length")).alias("line"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = Files(folder, "cdx.gz")
        keys, lines = [], []
        entries: list[bytes] = []
        first = None

        def close() -> None:
            nonlocal first
            member = gzip.compress("\n".join(lines).encode(), 6, mtime=0)
            name, at = files.add(member)
            entries.append(json.dumps([keys[0], at, len(member)]).encode())
            first = first or (keys[0], name)
            keys.clear()
            lines.clear()

        for batch in batches:
            for key, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                keys.append(key)
                lines.append(line)
                if len(lines) >= LINES:
                    close()
        if lines:
            close()
        files.close()
        if first:
            starts = [0]
            for e in entries:
                starts.append(starts[-1] + len(e))
            files.put(f"{first[1]}.dir", b"".join(entries))
            files.put(f"{first[1]}.pos", struct.pack(f"<{len(starts)}q", *starts))
            yield batch_of([[TaskContext.get().partitionId()], [first[0]], [first[1]], [len(entries)]], INDEX)

    rows = keep(spark, ordered.mapInArrow(run, INDEX), "index").collect()  # one for each index file
    return [(r["key"], r["name"], r["blocks"]) for r in sorted(rows, key=lambda r: r["part"])]


INDEX = "part bigint, key string, name string, blocks bigint"


class Index:
    """Reads the index: bisection over its files, then over a file's directory by range reads."""

    def __init__(self, folder: str, files: list[tuple[str, str, int]]):
        self.files, self.held = files, {}
        self.places, self.entries, self.blocks = Ranges(folder), Ranges(folder), Ranges(folder)

    def entry(self, file: int, i: int) -> tuple[str, int, int]:
        """First key, offset and length of a block, by its number in a file."""
        if (file, i) not in self.held:
            if len(self.held) >= ENTRIES:
                self.held.clear()
            name = self.files[file][1]
            start, end = struct.unpack("<2q", self.places.read(f"{name}.pos", 8 * i, 16))
            self.held[file, i] = tuple(json.loads(self.entries.read(f"{name}.dir", start, end - start)))
        return self.held[file, i]

    def places_of(self, key: str) -> Iterator[tuple[str, int, int]]:
        """(file name, offset, length) of the blocks that may hold a key, in order."""
        file = max(0, bisect_left(self.files, key, key=lambda f: f[0]) - 1)
        # the last block that begins before the key, since the key may begin inside it
        block = bisect_left(range(self.files[file][2]), key, key=lambda i: self.entry(file, i)[0]) - 1 if self.files else 0
        block = max(0, block)
        while file < len(self.files):
            name, n = self.files[file][1:]
            while block < n:
                first, offset, length = self.entry(file, block)
                if first > key:
                    return
                yield name, offset, length
                block += 1
            file, block = file + 1, 0

    def block(self, name: str, offset: int, length: int) -> list[dict]:
        return [json.loads(x) for x in gzip.decompress(self.blocks.read(name, offset, length)).decode().split("\n")]


class Archive:
    """An archive's folder, its index files, its captures' keys, and how to read it."""

    def __init__(self, spark: SparkSession, folder: str, files: list[tuple[str, str, int]], keys: DataFrame):
        self.spark, self.folder, self.files, self.keys = spark, folder, files, keys

    def find(self, keys: DataFrame) -> DataFrame:
        """The captures (file, offset, length) of many keys (key, each once), by the index.

        Each key is looked up by bisection; the blocks that may hold it are then read, each by neighbouring tasks only. A
        key with very many captures has many blocks, which are dealt over the tasks.
        """
        folder, files = self.folder, self.spark.sparkContext.broadcast(self.files)
        found = "name string, at bigint, size bigint, key string"

        def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = Index(folder, files.value)
            for batch in batches:
                for first in range(0, batch.num_rows, 1000):
                    rows = [(*place, key) for key in batch.column(0).slice(first, 1000).to_pylist() for place in index.places_of(key)]
                    yield batch_of([list(c) for c in zip(*rows)] or [[]] * 4, found)

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index, last, lines, starts = Index(folder, files.value), None, [], []
            for batch in batches:
                out: list[list] = [[], [], []]
                for *place, key in zip(*(c.to_pylist() for c in batch.columns)):
                    if place != last:
                        last, lines = place, index.block(*place)
                        starts = [x["key"] for x in lines]
                    at = bisect_left(starts, key)
                    while at < len(lines) and starts[at] == key:
                        for column, name in zip(out, ("file", "offset", "length")):
                            column.append(lines[at][name])
                        at += 1
                yield batch_of(out, "file string, offset bigint, length bigint")

        sought = keys.sort("key").mapInArrow(look, found)
        return sought.repartitionByRange("name", "at", "key").sortWithinPartitions("name", "at", "key").mapInArrow(read, "file string, offset bigint, length bigint")

    def records(self, keys: DataFrame | None = None) -> DataFrame:
        """The records of the given keys (by default of all), by the index: page_id, url, payload_bytes, payload_digest,
        record_type, refers_to, payload.

        Captures are sorted by file and place, so that neighbouring records are read in one range.
        """
        folder = self.folder
        wanted = self.find(self.keys if keys is None else keys).repartitionByRange("file", "offset").sortWithinPartitions("file", "offset")
        kinds = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary"

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            archives = Ranges(folder)
            for batch in batches:
                for file, offset, members in ranges(batch):
                    raw, at = archives.read(file, offset, sum(members)), 0
                    out: list[list] = [[] for _ in range(7)]
                    for length in members:
                        for column, value in zip(out, row_of(raw[at : at + length])):
                            column.append(value)
                        at += length
                    yield batch_of(out, kinds)

        return wanted.mapInArrow(frugal(run), kinds)

    def lookup(self, key: str) -> list[dict]:
        """The captures of one key (see ``index_key``): bisection in the directory, one range read per block."""
        index = Index(self.folder, self.files)
        return [x for place in index.places_of(key) for x in index.block(*place) if x["key"] == key]

    def read(self, capture: dict) -> dict:
        """The record of a capture, by one range read."""
        names = ("page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload")
        return dict(zip(names, row_of(Ranges(self.folder).read(capture["file"], capture["offset"], capture["length"]))))


def ranges(batch: pa.RecordBatch) -> Iterator[tuple[str, int, list[int]]]:
    """Runs of neighbouring records: file, offset, lengths."""
    file = start = end = None
    members: list[int] = []
    for f, offset, length in zip(*(batch.column(i).to_pylist() for i in range(3))):
        if f == file and offset == end and end + length - start <= RANGE:
            members.append(length)
        else:
            if members:
                yield file, start, members
            file, start, members = f, offset, [length]
        end = offset + length
    if members:
        yield file, start, members


def row_of(member: bytes) -> tuple:
    """The columns of ``records`` from a gzip member; a response's digest is taken from its payload."""
    fields, http, payload = parsed(member)
    kind = fields["WARC-Type"]
    sha = digest(payload) if kind == "response" else fields["WARC-Payload-Digest"].removeprefix("sha1:")
    return page_of(fields["WARC-Record-ID"]), json.loads(f'"{fields["WARC-Target-URI"]}"'), int(http["Content-Length"]), sha, kind, page_of(fields.get("WARC-Refers-To")), payload if kind == "response" else None


def archive(spark: SparkSession, pages: DataFrame, least: int = 0) -> Archive:
    """Write pages to a fresh archive with its index in the shared folder."""
    folder = fresh_path(spark, "warc")
    captures = write_archives(spark, pages, folder, least)
    files = write_index(spark, captures, folder)
    keys = keep(spark, captures.select("key").distinct(), "keys")
    drop_kept(spark, captures)
    return Archive(spark, folder, files, keys)


def sql() -> str:
    """The rows of a write and read back, as DuckDB SQL over the view ``pages``."""
    bits = ", ".join(f"WHEN '{x:x}' THEN '{x:04b}'" for x in range(16))
    cases = bits.replace(", WHEN", " WHEN")
    return f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS sha FROM pages),
b AS (
  SELECT *, array_to_string(list_transform(string_split(sha, ''), lambda h: CASE h {cases} END), '') AS bits, min(page_id) OVER (PARTITION BY sha, payload_bytes) AS response FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + list_sum(list_transform(range(5), lambda k: CASE WHEN bits[5 * i + k + 1] = '1' THEN CAST(pow(2, 4 - k) AS BIGINT) ELSE 0 END))::BIGINT, 1)), '') AS payload_digest,
       CASE WHEN response = page_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN response <> page_id THEN response END AS refers_to
FROM b
"""
