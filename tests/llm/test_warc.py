import gzip
import hashlib
import io
import json
import os
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trailmix.llm import warc

SCHEMA = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType()),
                       T.StructField("payload", T.StringType()), T.StructField("KEY", T.StringType()), T.StructField("row", T.StringType())])
BIG = "<p>Grüße " + "x" * 1500
ROWS = [
    (1, "http://a/1", BIG), (7, "http://a/7", BIG), (3, None, BIG), (7, "http://again", BIG), (None, "http://no id", BIG),
    (2, "", ""), (4, "http://b", None), (5, "http://c\r\nWARC-Type: metadata", "short"), (6, "http://c", "short"),
    (8, "http://d", "y" * 999), (9, "http://d", "y" * 999), (10, "http://e", "z" * 1000), (11, "http://f", "z" * 1000),
    (12, "http://g", "é" * 500), (13, "http://g", "é" * 500), (-5, "http://h", "\r\n\r\nWARC/1.1\r\n\r\n" * 90),
    (20, "http://long", "".join(chr(65 + i * i % 60) for i in range(400_000))),
]


def frame(spark, rows=ROWS):
    return spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(3)


def brute(rows):
    out, groups, seen = Counter(), defaultdict(list), set()
    for i, _, t in rows:
        groups[(t or "").encode()].append(i)
    for i, _, t in rows:
        raw = (t or "").encode()
        best = max((x for x in groups[raw] if x is not None), default=None)
        first = i == best and (raw, i) not in seen
        seen.add((raw, i))
        again = len(raw) >= 1000 and not first
        out[i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", best if again else None] += 1
    return out


def result(df):
    return Counter(tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect())


@pytest.mark.parametrize("options", [{}, {"compression": "none"}, {"file_bytes": 2000, "cut_bytes": 500}])
def test_round_trip(spark, scratch, options):
    path = os.path.join(scratch, "w")
    warc.archive_pages(frame(spark), path, **options)
    assert result(warc.read_pages(spark, path)) == brute(ROWS)
    assert result(warc.read_pages(spark, path, partition_bytes=700)) == brute(ROWS)


def test_copies_over_many_tasks(spark, scratch, monkeypatch):
    monkeypatch.setattr(warc, "MAX_BROADCAST_GROUPS", 0)
    rows = ROWS + [(100 + i, f"http://{i}", BIG) for i in range(80)]
    warc.archive_pages(frame(spark, rows), os.path.join(scratch, "w"))
    assert result(warc.read_pages(spark, os.path.join(scratch, "w"))) == brute(rows)


def test_empty_table(spark, scratch):
    warc.archive_pages(frame(spark, []), os.path.join(scratch, "w"))
    assert warc.read_pages(spark, os.path.join(scratch, "w")).count() == 0


def test_a_member_is_standard_gzip_and_a_record_follows_the_format(spark, scratch):
    path = os.path.join(scratch, "w")
    warc.archive_pages(frame(spark).coalesce(1), path)
    files = json.load(open(os.path.join(path, warc.MANIFEST)))["files"]
    data = b"".join(gzip.open(os.path.join(path, f["name"])).read() for f in files)
    assert data.count(b"WARC/1.1\r\nWARC-Type: ") == len(ROWS) + len(files)
    assert data.count(b"WARC-Type: metadata") == 0  # a url's line break ends no header
    assert b"WARC-Profile: " + warc.PROFILE.encode() in data


def foreign(zipped):
    """Records as another writer leaves them: gzip members without lengths, folded headers, HTTP and not."""
    out = b""
    for i, (kind, body) in enumerate([("warcinfo", b"software: x"), ("response", b"HTTP/1.1 404 Not Found\r\nX: y\r\n\r\nbody"),
                                      ("request", b"GET / HTTP/1.1\r\n\r\n"), ("resource", b"plain \x00 bytes" * 9000)]):
        kind_of = "application/http; msgtype=x" if kind in ("response", "request") else "text/plain"
        r = (f"WARC/1.0\r\nwarc-type: {kind}\r\nWARC-Record-ID: <urn:r:{i}>\r\nX-Note: one\r\n two\r\nX-Count: {i}\r\n"
             f"Content-Type: {kind_of}\r\nContent-Length: {len(body)}\r\n\r\n").encode() + body + b"\r\n\r\n"
        out += gzip.compress(r) if zipped else r
    return out


@pytest.mark.parametrize("zipped", [True, False])
def test_foreign_archives(spark, scratch, zipped):
    for name in ("a", "b"):
        with open(os.path.join(scratch, f"{name}.warc" + ".gz" * zipped), "wb") as f:
            f.write(foreign(zipped))
    rows = warc.read_warc(spark, scratch, "record_id string, record_type string, http_status int, x_note string, x_count long, payload binary")
    got = sorted((r.record_id, r.record_type, r.http_status, r.x_note, r.x_count, bytes(r.payload)) for r in rows.collect())
    want = [("urn:r:0", "warcinfo", None, "one two", 0, b"software: x"), ("urn:r:1", "response", 404, "one two", 1, b"body"),
            ("urn:r:2", "request", None, "one two", 2, b""), ("urn:r:3", "resource", None, "one two", 3, b"plain \x00 bytes" * 9000)]
    assert got == sorted(want * 2)
    assert {r.headers["x-note"] for r in warc.read_warc(spark, scratch, "headers map<string,string>").collect()} == {"one two"}


def test_predicates_reach_the_headers(spark, scratch):
    path = os.path.join(scratch, "w")
    warc.archive_pages(frame(spark), path)
    rows = warc.read_warc(spark, path, "record_type string, target_uri string, x_payload_length long, payload binary")
    some = rows.filter((F.col("record_type") == "response") & F.col("target_uri").startswith("http://") & (F.col("x_payload_length") >= 1000)
                       & F.col("x_payload_length").isin(999, 1000, len(BIG.encode())) & (F.length("payload") > 0))
    plan = some._jdf.queryExecution().executedPlan().toString()
    # Only the test of the payload is left to Spark.
    assert "(length(payload" in plan.split("BatchScan")[0] and "record_type" not in plan.split("BatchScan")[0].split("Filter")[1].split("\n")[0]
    assert sorted(len(r.payload) for r in some.collect()) == sorted([1000, 1000, len(BIG.encode())])


class Watched(io.BytesIO):
    """Counts the bytes that are read."""

    got = 0

    def read(self, n=-1):
        out = super().read(n)
        self.got += len(out)
        return out


@pytest.mark.parametrize("zipped", [True, False])
def test_unwanted_payloads_are_passed_over(zipped, monkeypatch):
    noise = os.urandom(3_000_000)
    one = warc.record("response", [("WARC-Record-ID", "<urn:x>")], noise)
    data = (warc._member(one) if zipped else one) * 3
    inflated = []
    real = warc.zlib.decompressobj

    class Inflate:
        def __init__(self, bits):
            self.own = real(bits)

        def decompress(self, *a):
            out = self.own.decompress(*a)
            inflated.append(len(out))
            return out

        def __getattr__(self, name):
            return getattr(self.own, name)

    monkeypatch.setattr(warc.zlib, "decompressobj", Inflate)
    file = Watched(data)
    heads = list(warc.records(file, 0, len(data), lambda h: True, lambda h: False))
    assert len(heads) == 3 and all(b is None for _, b in heads)
    assert file.got < 10 * warc._CHUNK and sum(inflated) < 20_000
    assert [b for _, b in warc.records(io.BytesIO(data), 0, len(data), lambda h: True, lambda h: True)] == [noise] * 3


def test_damaged_archives_name_the_place(spark, scratch):
    data = foreign(False)
    with open(os.path.join(scratch, "cut.warc"), "wb") as f:
        f.write(data[:len(data) - 5000])
    with pytest.raises(Exception, match="cut.warc.*malformed WARC record at byte"):
        warc.read_warc(spark, scratch, "payload binary").collect()


def test_what_a_failed_task_left_is_not_read(spark, scratch):
    path = os.path.join(scratch, "w")
    warc.archive_pages(frame(spark), path)
    with open(os.path.join(path, "part-left.warc"), "wb") as f:
        f.write(foreign(False))
    assert result(warc.read_pages(spark, path)) == brute(ROWS)
