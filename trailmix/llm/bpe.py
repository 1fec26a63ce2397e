"""Byte-level BPE encoding and decoding by overlapping chunks.

A text of up to ``chunk_chars`` characters is one chunk.  A longer one is cut
into chunks that overlap by ``overlap`` characters, which separate tasks split
into pre-tokens.  The pattern is matched from left to right and a match
depends only on where it starts, so from the first boundary that two
neighbouring chunks have in common in their overlap they agree: there the text
is cut, if no white space stands before it (a run of white space is split by
what follows it, so it stays with the piece after).  The start of a match is a true boundary even near a chunk's end; only
the last match of a chunk may be cut short, and its end is not used.  Where
neighbours share no boundary (one piece longer than the overlap) the rest of
the text, from the last proven boundary on, stays in one piece.  Pieces are
then encoded one by one: byte pairs are merged in order of rank, least rank
and leftmost first.  Decoding joins the bytes of the ids.

Defined results.  Null text: as empty, no ids.  Null ids and repeated rows:
each row gets its ids.  Empty table: no rows.  Extra columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trailmix.llm.common import kept_in_worker, pick, ship

CHUNK_CHARS = 32_768
OVERLAP = 1_024
# Pieces remembered by one Python worker (about 130 MB).
CACHE_PIECES = 600_000
_KEEP_CHARS = 40


def merge_pairs(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token."""
    if piece in ranks:
        return [ranks[piece]]
    if len(piece) > 64:
        return _merge_long(piece, ranks)
    none = 1 << 40
    parts = [piece[i:i + 1] for i in range(len(piece))]
    found = [ranks.get(piece[i:i + 2], none) for i in range(len(piece) - 1)]   # of each neighbouring pair
    while found and (least := min(found)) < none:
        at = found.index(least)
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
        del found[at]
        if at < len(found):
            found[at] = ranks.get(parts[at] + parts[at + 1], none)
        if at:
            found[at - 1] = ranks.get(parts[at - 1] + parts[at], none)
    return [ranks[p] for p in parts]


def _merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same for long pieces, with a heap of pairs: n log n."""
    n = len(piece)
    end = list(range(1, n + 1))            # of the part that starts here, 0: merged away
    before = list(range(-1, n))            # start of the part before the one that starts here

    def pair(at):
        stop = end[at]
        if stop < n and (rank := ranks.get(piece[at:end[stop]])) is not None:
            heapq.heappush(heap, (rank, at, stop, end[stop]))

    heap: list = []
    for i in range(n):
        pair(i)
    while heap:
        _, at, mid, stop = heapq.heappop(heap)
        if end[at] != mid or end[mid] != stop:
            continue                       # one of the two has been merged since
        end[at], end[mid] = stop, 0
        if stop < n:
            before[stop] = at
        pair(at)
        if before[at] >= 0:
            pair(before[at])
    out, at = [], 0
    while at < n:
        out.append(ranks[piece[at:end[at]]])
        at = end[at]
    return out


class Codec:
    """Ranks and pattern of a vocabulary, with the pieces seen so far."""

    def __init__(self, path: str, pattern: str, cache_pieces: int = CACHE_PIECES):
        import regex

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for t, r in self.ranks.items():
            self.tokens[r] = t
        self.decimal = [b"%d" % r for r in range(len(self.tokens))]
        self.split = regex.compile(pattern)
        self.limit = cache_pieces
        self.known: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        """Ids (little-endian uint32) of a text that starts at a boundary."""
        pieces = self.split.findall(text)
        known = self.known
        ids = list(map(known.get, pieces))
        at = -1
        try:
            while True:
                at = ids.index(None, at + 1)
                p = pieces[at]
                ids[at] = found = known.get(p) or array("I", merge_pairs(p.encode(), self.ranks)).tobytes()
                if len(known) < self.limit and len(p) <= _KEEP_CHARS:
                    known[p] = found
        except ValueError:
            return b"".join(ids)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, memoryview(ids).cast("I")))

    def digests(self, ids: bytes) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of the ids in decimal, of the decoded bytes."""
        view = memoryview(ids).cast("I")
        return (len(view), hashlib.sha256(b" ".join(map(self.decimal.__getitem__, view))).hexdigest(),
                hashlib.sha256(self.decode(ids)).hexdigest())


def codec(path: str, pattern: str) -> Codec:
    """The Python worker's codec for a vocabulary file, kept between tasks."""
    return kept_in_worker("bpe", (path, pattern), lambda: Codec(path, pattern))


def _cuts(chunks: DataFrame, ranks: str, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """(key, start, stop): spans of each long text between proven boundaries."""

    def boundaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = codec(ranks, pattern).split
        for b in batches:
            heads, tails = [], []
            for text in b.column("chunk").to_pylist():
                starts = [s for m in split.finditer(text) if (s := m.start()) and not text[s - 1].isspace()]
                heads.append([s for s in starts if s <= overlap])
                tails.append([s - chunk for s in starts if s >= chunk])
            kind = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([b.column("key"), b.column("chars"), b.column("k"), pa.array(heads, kind), pa.array(tails, kind)],
                                             ["key", "chars", "k", "head", "tail"])

    edges = chunks.mapInArrow(boundaries, "key string, chars int, k int, head array<int>, tail array<int>")
    order = Window.partitionBy("key").orderBy("k")
    meets = F.when(F.col("k") == 0, F.lit(0)).otherwise(
        F.array_min(F.array_intersect("head", F.lag("tail").over(order))))
    lost = F.sum(F.col("at").isNull().cast("int")).over(order)
    kept = (edges.withColumn("at", meets).withColumn("lost", lost).filter("lost = 0")
            .select("key", "chars", "k", (F.col("k") * chunk + F.col("at")).alias("start")))
    return kept.select("key", "k", "start", F.coalesce(F.lead("start").over(order), F.col("chars")).alias("stop"))


def encode_documents(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                     chunk_chars: int = CHUNK_CHARS, overlap: int = OVERLAP, digest: bool = False) -> DataFrame:
    """One row per document: id and ids (little-endian uint32 bytes); with
    ``digest`` instead n_tokens, ids_sha256 and decoded_sha256, taken from the
    ids in the same pass."""
    if not 0 < overlap < chunk_chars:
        raise ValueError("the overlap must be shorter than a chunk")
    spark = docs.sparkSession
    ship(spark)
    kinds = "n_tokens long, ids_sha256 string, decoded_sha256 string" if digest else "ids binary"

    def columns(many: list[bytes]) -> list[pa.Array]:
        if not digest:
            return [pa.array(many, pa.binary())]
        rows = [codec(ranks, pattern).digests(ids) for ids in many]
        return [pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.int64(), pa.string(), pa.string()))]

    names = [k.split(" ")[0] for k in kinds.split(", ")]

    def encoded(key: str, text: str, finish: Callable) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for lo in range(0, b.num_rows, 256):
                    part = b.slice(lo, 256)
                    many = [codec(ranks, pattern).encode(t or "") for t in part.column(text).to_pylist()]
                    yield finish(part, key, many)
        return run

    def whole(part, key, many):
        return pa.RecordBatch.from_arrays([part.column(key), *columns(many)], [key, *names])

    def piece(part, key, many):
        return pa.RecordBatch.from_arrays([part.column(key), part.column("k"), pa.array(many, pa.binary())], [key, "k", "ids"])

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            many = [b"".join(p["ids"] for p in parts) for parts in b.column("parts").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("key"), *columns(many)], ["key", *names])

    rows = pick(docs, id=id_col, text=text_col)
    is_long = F.coalesce(F.char_length("text") > chunk_chars, F.lit(False))
    short = rows.filter(~is_long).mapInArrow(encoded("id", "text", whole), f"id long, {kinds}")
    keyed = rows.filter(is_long).withColumn("key", F.sha2(F.col("text").cast("binary"), 256))
    texts = keyed.groupBy("key").agg(F.max("text").alias("text"))
    last = F.floor((F.char_length("text") - 1) / chunk_chars).cast("int")
    chunks = (texts.select("key", "text", F.explode(F.sequence(F.lit(0), last)).alias("k"))
              .select("key", "k", F.char_length("text").alias("chars"),
                      F.col("text").substr(F.col("k") * chunk_chars + 1, F.lit(chunk_chars + overlap)).alias("chunk"))
              .repartition("key", "k"))
    spans = _cuts(chunks, ranks, pattern, chunk_chars, overlap)
    pieces = (spans.join(texts, "key").select("key", "k", F.col("text").substr(F.col("start") + 1, F.col("stop") - F.col("start")).alias("piece"))
              .repartition("key", "k"))
    done = (pieces.mapInArrow(encoded("key", "piece", piece), "key string, k int, ids binary")
            .groupBy("key").agg(F.array_sort(F.collect_list(F.struct("k", "ids"))).alias("parts"))  # one text's pieces
            .mapInArrow(joined, f"key string, {kinds}"))
    long = keyed.select("id", "key").join(done, "key").drop("key")
    return short.unionByName(long).withColumnRenamed("id", id_col)


def decode_documents(encoded: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """One row per document: id and bytes, from ids as above."""
    ship(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array([codec(ranks, pattern).decode(i or b"") for i in b.column("ids").to_pylist()], pa.binary())],
                ["id", "bytes"])

    return pick(encoded, id=id_col, ids="ids").mapInArrow(run, "id long, bytes binary").withColumnRenamed("id", id_col)
