"""WARC 1.1 archives as a Spark data source.

``spark.read.format("warc")`` and ``df.write.format("warc")`` after
``register(spark)``; ``read_warc`` and ``archive_pages`` wrap them.

Reading.  The driver plans partitions from file lengths: a file is cut at the
record offsets that the writer left in ``_manifest.json``, else it is one
partition, and short files share one.  A task parses a record's headers first.
Predicates on the record type and on headers are pushed to that point
(``pushFilters``: =, <=>, IN, <, >, null tests, prefixes), and a payload is
decoded only where its record passes and the ``payload`` column is asked for.
An unwanted payload is skipped: in plain files by ``Content-Length``; in gzip
files by the ``sl`` extra field, which holds a member's compressed length, so
it isn't even inflated.  Foreign gzip members without that field are inflated
and dropped, a piece at a time.

The schema that the reader is given names the columns: those of ``FIXED``, the
binary ``payload`` (of an HTTP response its body), ``payload_sha1`` (the
digest header as bare lower-case hex), ``http_status``, ``headers`` (all of
them, names in lower case), and any other name is read from the header of that
name with ``-`` for ``_`` as its declared type (null where it is not a number).

Writing (``archive_pages``).  One record per row.  Of rows with equal payloads
of at least ``min_bytes`` bytes the one with the largest id is a ``response``;
the others are ``revisit`` records without the payload that refer to it.  Each
task rolls files at ``file_bytes``; the manifest, written by the commit, names
the files of the tasks that succeeded, so what a lost or repeated task left
behind is never read.

Stores.  Archives are opened through ``pyarrow.fs`` (local, HDFS, S3, GCS).

Defined results.  Null payload: empty.  Null or empty url: no target header;
control characters and spaces in a url are percent-encoded.  Null id: ranks
below all ids, reads back as null.  Rows with equal id and payload: one of them
is the response, the others revisit it.  Empty table: an archive of no records.
Extra columns are not read.  A payload is held whole, as its row is; nothing
else of its file is.  A truncated or malformed record is a ``ValueError`` that
names the file and the offset.
"""

from __future__ import annotations

import base64
import json
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, Filter,
                                    GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan,
                                    LessThanOrEqual, StringStartsWith, WriterCommitMessage)

from trailmix.llm.common import pick, release, ship, written
from trailmix.session import ensure_checkpoint_dir

# Fixed values of the format: header names of the columns with names of their own.
FIXED = {
    "record_id": "warc-record-id", "record_type": "warc-type", "record_date": "warc-date",
    "target_uri": "warc-target-uri", "refers_to": "warc-refers-to", "payload_digest": "warc-payload-digest",
    "block_length": "content-length", "content_type": "content-type", "profile": "warc-profile",
}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "_manifest.json"
SCHEMA = ("record_id string, record_type string, record_date string, target_uri string, refers_to string, "
          "payload_digest string, content_type string, block_length long, payload binary")
MIN_BYTES = 1000
FILE_BYTES = 1 << 30
PARTITION_BYTES = 128 << 20
# Rows of the winners table (about 100 bytes each) up to which it is broadcast.
MAX_BROADCAST_GROUPS = 100_000
SALTS = 32
_CHUNK = 1 << 16
_BATCH_BYTES = 4 << 20
_BATCH_ROWS = 2048


def _store(path: str) -> tuple[pafs.FileSystem, str]:
    path = path.replace("s3a://", "s3://", 1)
    if "://" not in path and path.startswith("file:"):
        path = "file://" + path[len("file:"):]
    if "://" not in path:
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(path)


# ---------------------------------------------------------------- records

def _member(data: bytes, level: int = 6) -> bytes:
    """A gzip member that says how long it is (extra field ``sl``: compressed
    and plain length), so that a reader can pass over it."""
    squeeze = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = squeeze.compress(data) + squeeze.flush()
    size = 24 + len(body) + 8
    tail = zlib.crc32(data).to_bytes(4, "little") + (len(data) & 0xFFFFFFFF).to_bytes(4, "little")
    if max(size - 12, len(data)) >= 1 << 32:
        return b"\x1f\x8b\x08\x00\0\0\0\0\x00\xff" + body + tail
    lengths = size.to_bytes(4, "little") + len(data).to_bytes(4, "little")
    return b"\x1f\x8b\x08\x04\0\0\0\0\x00\xff" + b"\x0c\x00sl\x08\x00" + lengths + body + tail


def _clean(value: str) -> str:
    """A header value on one line: spaces and control characters percent-encoded."""
    if value.isprintable() and " " not in value:
        return value
    return "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode("utf-8", "replace")) for c in value)


def record(kind: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = [("WARC-Type", kind), *headers, ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode("utf-8", "replace") + b"\r\n" + block + b"\r\n\r\n"


def page_record(row: dict, date: str) -> bytes:
    """A response or revisit record of a row of ``_marked``."""
    size = row["size"]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    headers = [("WARC-Record-ID", f"<{row['record_id']}>"), ("WARC-Date", date), ("Content-Type", "application/http; msgtype=response"),
               ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(row["sha1"])).decode()), ("X-Payload-Length", str(size))]
    if row["url"]:
        headers.append(("WARC-Target-URI", _clean(row["url"])))
    if row["refers_to"] is None:
        return record("response", headers, http + (row["payload"] or b""))
    headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{row['refers_to']}>")]
    return record("revisit", headers, http)


class _Source:
    """Bytes of a file from some offset on, read in chunks, with skipping."""

    def __init__(self, file, at: int):
        self.file, self.at, self.held = file, at, b""
        file.seek(at)

    def need(self, n: int) -> bytes:
        """The next n bytes (fewer at the end of the file), without moving on."""
        if len(self.held) < n:
            pieces, size = [self.held], len(self.held)
            while size < n and (more := self.file.read(max(_CHUNK, n - size))):
                pieces.append(more)
                size += len(more)
            self.held = b"".join(pieces)
        return self.held[:n]

    def skip(self, n: int) -> None:
        if n <= len(self.held):
            self.held = self.held[n:]
        else:
            self.file.seek(self.at + n)
            self.held = b""
        self.at += n

    def back(self, data: bytes) -> None:
        self.held = data + self.held
        self.at -= len(data)

    def take(self, n: int) -> bytes:
        out = self.need(n)
        self.skip(len(out))
        return out


class _Plain:
    """A record of an uncompressed file."""

    def __init__(self, source: _Source):
        self.source, self.size = source, None

    def head(self) -> bytes:
        n = _CHUNK
        while True:
            have = self.source.need(n)
            end = have.find(b"\r\n\r\n")
            if end >= 0:
                return self.source.take(end + 4)
            if len(have) < n:
                raise ValueError("record header without an end")
            n *= 2

    def block(self, length: int) -> bytes:
        out = self.source.take(length)
        if len(out) < length:
            raise ValueError("record block is cut off")
        return out

    def end(self, left: int) -> None:
        self.source.skip(left)
        while self.source.need(2) == b"\r\n":
            self.source.skip(2)


class _Zipped:
    """A record that is a gzip member of its own."""

    def __init__(self, source: _Source):
        self.source, self.start, self.size = source, source.at, None
        fixed = source.need(12)
        at = 10
        if fixed[3] & 4:
            extra = int.from_bytes(fixed[10:12], "little")
            field = source.need(12 + extra)[12:]
            while len(field) >= 4:
                n = int.from_bytes(field[2:4], "little")
                if field[:2] == b"sl" and n >= 8:
                    self.size = int.from_bytes(field[4:8], "little")
                field = field[4 + n:]
            at = 12 + extra
        for flag in (8, 16):  # a name, a comment
            if fixed[3] & flag:
                n = 256
                while (stop := source.need(at + n).find(b"\0", at)) < 0:
                    n *= 2
                    if n > 1 << 20:
                        raise ValueError("gzip header without an end")
                at = stop + 1
        source.skip(at + (2 if fixed[3] & 2 else 0))
        self.inflate, self.plain = zlib.decompressobj(-15), b""

    def _more(self, most: int) -> bytes:
        data = self.inflate.unconsumed_tail
        if not data:
            own = _CHUNK if self.size is None else min(_CHUNK, self.start + self.size - self.source.at)
            data = self.source.take(own)
            if not data:
                raise ValueError("gzip member is cut off")
        return self.inflate.decompress(data, most)

    def head(self) -> bytes:
        while (end := self.plain.find(b"\r\n\r\n")) < 0:
            if self.inflate.eof:
                raise ValueError("record header without an end")
            self.plain += self._more(2048)
        out, self.plain = self.plain[:end + 4], self.plain[end + 4:]
        return out

    def block(self, length: int) -> bytes:
        pieces, size = [self.plain], len(self.plain)
        while size < length and not self.inflate.eof:
            pieces.append(self._more(max(_CHUNK, length - size)))
            size += len(pieces[-1])
        data = b"".join(pieces)
        if len(data) < length:
            raise ValueError("record block is cut off")
        self.plain = data[length:]
        return data[:length]

    def end(self, left: int) -> None:
        if self.size is not None:
            self.source.skip(self.start + self.size - self.source.at)
            return
        while not self.inflate.eof:
            self._more(_CHUNK)
        self.source.back(self.inflate.unused_data)
        self.source.skip(8)


def _parsed(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record: {lines[0][:40]!r}")
    out: dict[str, str] = {}
    last = None
    for line in lines[1:]:
        if line[:1] in (" ", "\t") and last:  # a folded header
            out[last] += " " + line.strip()
        elif ":" in line:
            last, value = line.split(":", 1)
            last = last.strip().lower()
            out[last] = value.strip()
    return out


def records(file, start: int, stop: int, wanted: Callable[[dict], bool], payload: Callable[[dict], bool]) -> Iterator[tuple[dict, bytes | None]]:
    """(headers, block) of the wanted records that begin in [start, stop); the
    block only where ``payload`` asks for it."""
    source = _Source(file, start)
    while source.at < stop and source.need(1):
        at = source.at
        try:
            one = _Zipped(source) if source.need(2) == b"\x1f\x8b" else _Plain(source)
            headers = _parsed(one.head())
            left = int(headers["content-length"])
            block = None
            keep = wanted(headers)
            if keep and payload(headers):
                block, left = one.block(left), 0
            one.end(left)
        except (ValueError, KeyError, zlib.error) as e:
            raise ValueError(f"malformed WARC record at byte {at}: {e}") from e
        if keep:
            yield headers, block


def _http_body(block: bytes) -> bytes:
    end = block.find(b"\r\n\r\n")
    return block[end + 4:] if end >= 0 else b""


def _hex(digest: str | None) -> str | None:
    kind, _, value = (digest or "").partition(":")
    if kind.lower() != "sha1" or not value:
        return None
    return value.lower() if len(value) == 40 else base64.b32decode(value.upper()).hex()


# ---------------------------------------------------------------- reading

@dataclass
class Span(InputPartition):
    """Parts of files that one task reads: (path, first byte, end)."""

    parts: tuple

    def __init__(self, parts):
        self.parts = tuple(parts)


class _Column:
    """One output column: its value from the headers and the block."""

    def __init__(self, field: T.StructField):
        self.name, self.number = field.name, isinstance(field.dataType, (T.LongType, T.IntegerType))
        self.header = FIXED.get(self.name, self.name.replace("_", "-").lower())

    def of_headers(self, headers: dict):
        if self.name == "headers":
            return headers
        if self.name == "payload_sha1":
            return _hex(headers.get("warc-payload-digest"))
        value = headers.get(self.header)
        if self.name in ("record_id", "refers_to") and value:
            return value.strip("<>")
        if self.number and value is not None:
            return int(value) if value.lstrip("+-").isdecimal() else None
        return value

    def value(self, headers: dict, block: bytes | None):
        if self.name == "payload":
            return block if block is None or not headers.get("content-type", "").startswith("application/http") else _http_body(block)
        if self.name == "http_status":
            line = (block or b"")[:64].split(b" ", 2)
            return int(line[1]) if len(line) > 1 and line[0].startswith(b"HTTP/") and line[1].isdigit() else None
        return self.of_headers(headers)


def _test(filter: Filter, columns: dict[str, _Column]) -> Callable[[dict], bool] | None:
    """The filter as a test of headers, or None where Spark has to apply it."""
    if len(getattr(filter, "attribute", ())) != 1 or (c := columns.get(filter.attribute[0])) is None:
        return None
    if c.name in ("payload", "http_status", "headers"):
        return None
    get = c.of_headers
    if isinstance(filter, IsNull):
        return lambda h: get(h) is None
    if isinstance(filter, IsNotNull):
        return lambda h: get(h) is not None
    v = getattr(filter, "value", None)
    compare = {EqualTo: lambda x: x == v, EqualNullSafe: lambda x: x == v, In: lambda x: x in v,
               GreaterThan: lambda x: x > v, GreaterThanOrEqual: lambda x: x >= v, LessThan: lambda x: x < v,
               LessThanOrEqual: lambda x: x <= v, StringStartsWith: lambda x: x.startswith(v)}.get(type(filter))
    if compare is None or (v is None and not isinstance(filter, EqualNullSafe)):
        return None
    if isinstance(filter, EqualNullSafe):
        return lambda h: get(h) == v
    return lambda h: (x := get(h)) is not None and compare(x)


class WarcReader(DataSourceReader):
    def __init__(self, path: str, schema: T.StructType, partition_bytes: int):
        self.path, self.schema, self.partition_bytes = path, schema, partition_bytes
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]):
        columns = {f.name: _Column(f) for f in self.schema.fields}
        for f in filters:
            if _test(f, columns) is None:
                yield f
            else:
                self.filters.append(f)

    def partitions(self) -> list[Span]:
        store, root = _store(self.path)
        spans: list[tuple[str, int, int]] = []
        for name, size, cuts in _listing(store, root):
            at = 0
            for cut in [*[c for c in cuts if 0 < c < size], size]:
                if cut - at >= self.partition_bytes or cut == size:
                    spans.append((name, at, cut))
                    at = cut
        out: list[Span] = []
        held: list[tuple[str, int, int]] = []
        total = 0
        for span in spans:
            n = span[2] - span[1]
            if held and total + n > self.partition_bytes:
                out.append(Span(held))
                held, total = [], 0
            held.append(span)
            total += n
        return [*out, *([Span(held)] if held else [])] or [Span(())]

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        columns = [_Column(f) for f in self.schema.fields]
        tests = [_test(f, {c.name: c for c in columns}) for f in self.filters]
        blocks = any(c.name in ("payload", "http_status") for c in columns)
        kinds = [_ARROW[f.dataType.typeName()] for f in self.schema.fields]
        rows: list[list] = [[] for _ in columns]
        size = 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, kinds, strict=True)], [c.name for c in columns])

        store, _ = _store(self.path)
        for name, start, stop in partition.parts:
            with store.open_input_file(name) as file:
                try:
                    for headers, block in records(file, start, stop, lambda h: all(t(h) for t in tests), lambda h: blocks):
                        for r, c in zip(rows, columns, strict=True):
                            r.append(c.value(headers, block))
                        size += len(block or b"") + 500
                        if size >= _BATCH_BYTES or len(rows[0]) >= _BATCH_ROWS:
                            yield batch()
                            rows, size = [[] for _ in columns], 0
                except ValueError as e:
                    raise ValueError(f"{name}: {e}") from e
        if rows and rows[0]:
            yield batch()


_ARROW = {"string": pa.string(), "long": pa.int64(), "bigint": pa.int64(), "integer": pa.int32(), "binary": pa.binary(),
          "map": pa.map_(pa.string(), pa.string())}


def _listing(store: pafs.FileSystem, root: str) -> list[tuple[str, int, list[int]]]:
    """(path, bytes, offsets of some records) of the archive's files."""
    info = store.get_file_info(root)
    if info.type == pafs.FileType.File:
        return [(root, info.size, [])]
    if info.type == pafs.FileType.NotFound:
        raise ValueError(f"no archive at {root}")
    manifest = f"{root}/{MANIFEST}"
    if store.get_file_info(manifest).type == pafs.FileType.File:
        with store.open_input_stream(manifest) as f:
            return [(f"{root}/{x['name']}", x["bytes"], x["cuts"]) for x in json.loads(f.read())["files"]]
    found = store.get_file_info(pafs.FileSelector(root, recursive=True))
    return sorted((i.path, i.size, []) for i in found if i.type == pafs.FileType.File and i.path.endswith((".warc", ".warc.gz")))


# ---------------------------------------------------------------- writing

@dataclass
class Files(WriterCommitMessage):
    files: list


class WarcWriter(DataSourceArrowWriter):
    """Rows of ``_marked`` as records; see the module docstring."""

    def __init__(self, path: str, options: dict, overwrite: bool):
        self.path, self.overwrite = path, overwrite
        self.zipped = options.get("compression", "gzip") == "gzip"
        self.file_bytes = int(options.get("file_bytes", FILE_BYTES))
        self.cut_bytes = int(options.get("cut_bytes", PARTITION_BYTES // 8))
        self.date = options.get("date", "1970-01-01T00:00:00Z")

    def write(self, batches: Iterator[pa.RecordBatch]) -> Files:
        store, root = _store(self.path)
        store.create_dir(root, recursive=True)
        shape = _member if self.zipped else bytes
        done: list[dict] = []
        out = None

        def opened():
            name = f"part-{uuid.uuid4().hex}.warc" + (".gz" if self.zipped else "")
            done.append({"name": name, "bytes": 0, "records": 0, "cuts": []})
            stream = store.open_output_stream(f"{root}/{name}", compression=None)
            put(stream, shape(record("warcinfo", [
                ("WARC-Record-ID", f"<{uuid.uuid4().urn}>"), ("WARC-Date", self.date), ("WARC-Filename", name),
                ("Content-Type", "application/warc-fields")], b"software: trailmix\r\nformat: WARC File Format 1.1\r\n")))
            return stream

        def put(stream, data: bytes) -> None:
            at = done[-1]
            if at["bytes"] - (at["cuts"][-1] if at["cuts"] else 0) >= self.cut_bytes:
                at["cuts"].append(at["bytes"])
            stream.write(data)
            at["bytes"] += len(data)
            at["records"] += 1

        try:
            for b in batches:
                for i in range(b.num_rows):
                    row = {c: b.column(c)[i].as_py() for c in b.schema.names}
                    if out is not None and done[-1]["bytes"] >= self.file_bytes:
                        out.close()
                        out = None
                    out = out or opened()
                    put(out, shape(page_record(row, self.date)))
        finally:
            if out is not None:
                out.close()
        return Files(done)

    def commit(self, messages) -> None:
        store, root = _store(self.path)
        store.create_dir(root, recursive=True)
        new = [f for m in messages if m for f in m.files]
        old = []
        if not self.overwrite and store.get_file_info(f"{root}/{MANIFEST}").type == pafs.FileType.File:
            with store.open_input_stream(f"{root}/{MANIFEST}") as f:
                old = json.loads(f.read())["files"]
        with store.open_output_stream(f"{root}/{MANIFEST}") as f:
            f.write(json.dumps({"files": old + new}).encode())

    def abort(self, messages) -> None:
        """Files of a failed write are in no manifest, so none is read."""


class WarcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: T.StructType) -> WarcReader:
        return WarcReader(self.options["path"], schema, int(self.options.get("partition_bytes", PARTITION_BYTES)))

    def writer(self, schema: T.StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options["path"], dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    """Make the format known to the session and let Spark push filters to it."""
    ship(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)


def read_warc(spark: SparkSession, path: str, columns: str = SCHEMA, **options: int) -> DataFrame:
    """Records of an archive.  Name only the columns needed: payloads are
    decoded only if ``payload`` or ``http_status`` is among them."""
    register(spark)
    reader = spark.read.format("warc").schema(columns)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path)


def _marked(pages: DataFrame, id_col: str, url_col: str, payload_col: str, min_bytes: int) -> DataFrame:
    """One row per record: record_id, refers_to (null: response), url, payload
    (null on revisits), size and sha1 of the payload."""
    payload = F.coalesce(F.col("payload").cast("binary"), F.lit(b""))
    rows = pick(pages, id=id_col, url=url_col, payload=payload_col).select(
        F.col("id").cast("long").alias("id"), F.col("url").cast("string").alias("url"), payload.alias("payload"),
        F.monotonically_increasing_id().alias("row"))
    rows = written(rows.withColumns({"size": F.octet_length("payload").cast("long"), "sha1": F.sha1("payload")}), "pages")
    # SHA-1 names a payload in the records; SHA-256 decides that two are equal.
    long = rows.select("id", "row", "size", F.sha2("payload", 256).alias("key")).filter(F.col("size") >= min_bytes)
    best = (long.groupBy("key").agg(F.max(F.struct("id", "row")).alias("best"), F.count(F.lit(1)).alias("n"))
            .filter("n > 1").select("key", "best"))
    best = written(best, "responses")
    keyed = rows.withColumn("key", F.when(F.col("size") >= min_bytes, F.sha2("payload", 256)))
    if best.count() <= MAX_BROADCAST_GROUPS:
        found = keyed.join(F.broadcast(best), "key", "left")
    else:
        # Copies of one payload go to as many tasks as there are salts.
        salted = best.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salt = F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")
        spread = F.coalesce(F.col("key"), F.concat(F.lit("-"), F.col("row")))  # short payloads: no group
        found = keyed.withColumns({"key": spread, "salt": salt}).join(salted, ["key", "salt"], "left")
    again = F.col("best").isNotNull() & (F.col("best.row") != F.col("row"))

    def ident(page, row):
        return F.concat(F.lit("urn:x-page:"), F.coalesce(page.cast("string"), F.lit("")), F.lit(":"), row.cast("string"))

    marked = found.select(
        ident(F.col("id"), F.col("row")).alias("record_id"),
        F.when(again, ident(F.col("best.id"), F.col("best.row"))).alias("refers_to"),
        "url", F.when(~again, F.col("payload")).alias("payload"), "size", "sha1")
    marked.held = (rows, best)
    return marked


def archive_pages(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                  min_bytes: int = MIN_BYTES, date: str = "1970-01-01T00:00:00Z", **options: str | int) -> None:
    """Write a record per page; ``options``: compression (gzip or none),
    file_bytes, cut_bytes."""
    register(pages.sparkSession)
    marked = _marked(pages, id_col, url_col, payload_col, min_bytes)
    writer = marked.write.format("warc").mode("append").option("date", date)
    for k, v in options.items():
        writer = writer.option(k, v)
    writer.save(path)
    release(*marked.held)


def page_number(uri: str):
    """The page id in a record id of ``archive_pages``; null where it had none."""
    return F.regexp_extract(uri, r"^urn:x-page:(-?[0-9]*):", 1).try_cast("long")


def read_pages(spark: SparkSession, path: str, **options: int) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of the
    pages in an archive.  Responses are decoded and digested anew; revisits
    give what their headers say, and no payload is touched for them."""
    responses = read_warc(spark, path, "record_id string, record_type string, payload binary", **options) \
        .filter("record_type = 'response'")
    revisits = read_warc(spark, path, "record_id string, record_type string, refers_to string, payload_sha1 string, "
                                      "x_payload_length long", **options).filter("record_type = 'revisit'")
    return responses.select(
        page_number("record_id").alias("page_id"), F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha1("payload").alias("payload_digest"), "record_type", F.lit(None).cast("long").alias("refers_to"),
    ).unionByName(revisits.select(
        page_number("record_id").alias("page_id"), F.col("x_payload_length").alias("payload_bytes"),
        F.col("payload_sha1").alias("payload_digest"), "record_type", page_number("refers_to").alias("refers_to")))


def warc_folder(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{uuid.uuid4().hex}-warc"
