"""Token ids in a bit-packed file format.

A token file is a Parquet folder with one row per block.  A block holds whole
documents (about ``block_ids`` ids; a longer document has a block to itself):

| column | meaning |
| --- | --- |
| part, block | writing task, block number in it; both ascend with the id |
| part_start | ids of the part before this block |
| n_ids, width | ids in the block, bits of each |
| doc_ids, doc_lens | its documents and their id counts, in order |
| payload | the ids, ``width`` bits each, least significant bit first |

``width`` is the least number of bits that holds the vocabulary, so id ``k``
of a block starts at bit ``k * width``: any span is unpacked without what lies
before it.  Eight ids fill ``width`` whole bytes, which is the lane layout that
``pack`` and ``unpack`` process as numpy columns; widths that are number types
(8, 16, 32) are copied whole.  Writing through Spark's
Parquet writer gives any store Spark can reach and its task commit.

Defined results.  Null text: as empty.  Null ids come first.  Equal ids are
ordered by text hash, then text.  Empty table: a file of no blocks.  Extra
columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trailmix.llm.common import pick, ship
from trailmix.llm.tokens import encoder

BLOCK_IDS = 1 << 16
_TYPES = {8: "<u1", 16: "<u2", 32: "<u4"}
BLOCK_SCHEMA = ("part int, block int, part_start long, n_ids long, width int, "
                "doc_ids array<bigint>, doc_lens array<bigint>, payload binary")


def id_width(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    """Ids as ``width``-bit numbers, least significant bit first."""
    if width in _TYPES:
        whole = np.zeros(-(-len(ids) // 8) * 8, _TYPES[width])
        whole[:len(ids)] = ids
        return whole.tobytes()
    lanes = np.zeros((-(-len(ids) // 8), 8), np.uint64)
    lanes.reshape(-1)[:len(ids)] = ids
    out = np.zeros((len(lanes), width), np.uint8)
    for j in range(8):
        at, shift = divmod(j * width, 8)
        moved = lanes[:, j] << np.uint64(shift)
        for b in range((shift + width + 7) // 8):
            out[:, at + b] |= (moved >> np.uint64(8 * b)).astype(np.uint8)
    return out.tobytes()


def unpack(payload: bytes, width: int, start: int, count: int) -> np.ndarray:
    """Ids ``start .. start + count`` of a payload, as little-endian uint32."""
    if count <= 0:
        return np.zeros(0, "<u4")
    if width in _TYPES:
        return np.frombuffer(payload, _TYPES[width], count, start * width // 8).astype("<u4")
    first, last = start // 8, -(-(start + count) // 8)
    raw = np.frombuffer(payload, np.uint8, (last - first) * width, first * width).reshape(-1, width)
    lanes = np.empty((last - first, 8), "<u4")
    mask = np.uint64((1 << width) - 1)
    for j in range(8):
        at, shift = divmod(j * width, 8)
        value = np.zeros(len(raw), np.uint64)
        for b in range((shift + width + 7) // 8):
            value |= raw[:, at + b].astype(np.uint64) << np.uint64(8 * b)
        lanes[:, j] = (value >> np.uint64(shift)) & mask
    return lanes.reshape(-1)[start - 8 * first:][:count]


def _block_writer(tokenizer: str, end_id: int, width: int, block_ids: int):
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(tokenizer, True), np.array([end_id], "<u4").tobytes()
        part, names = TaskContext.get().partitionId(), [f.split(" ")[0] for f in BLOCK_SCHEMA.split(", ")]
        number = start = held = 0
        ids: list[bytes] = []
        docs: list[int | None] = []

        def block():
            flat = np.frombuffer(b"".join(ids), "<u4")
            row = (part, number, start, len(flat), width, docs, [len(x) // 4 for x in ids], pack(flat, width))
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names)

        for batch in batches:
            keys = batch.column("id").to_pylist()
            for lo in range(0, len(keys), 2048):
                texts = batch.column("text").slice(lo, 2048).to_pylist()
                for key, body in zip(keys[lo:lo + 2048], enc.encode(texts), strict=True):
                    ids.append(body + end)
                    docs.append(key)
                    held += len(ids[-1]) // 4
                    if held >= block_ids:
                        yield block()
                        number, start, held, ids, docs = number + 1, start + held, 0, [], []
        if ids:
            yield block()

    return blocks


def write_token_file(docs: DataFrame, path: str, tokenizer: str, end_id: int, vocabulary: int,
                     id_col: str = "doc_id", text_col: str = "text", block_ids: int = BLOCK_IDS) -> None:
    """Encode every document, append ``end_id`` and write the token file, in
    ascending id order (one range shuffle of the texts)."""
    ship(docs.sparkSession)
    rows = pick(docs, id=id_col, text=text_col).withColumn("mix", F.xxhash64("text"))
    rows = rows.repartitionByRange("id", "mix").sortWithinPartitions("id", "mix", "text").select("id", "text")
    rows.mapInArrow(_block_writer(tokenizer, end_id, id_width(vocabulary), block_ids), BLOCK_SCHEMA).write.parquet(path)


def _part_starts(blocks: DataFrame) -> DataFrame:
    """Ids of all parts before each part: one small row for each writing task."""
    sizes = blocks.groupBy("part").agg(F.sum("n_ids").alias("part_ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("part", F.coalesce(F.sum("part_ids").over(before), F.lit(0)).alias("file_start"))


def _documents_of(batches: Iterator[pa.RecordBatch], with_ids: bool) -> Iterator[pa.RecordBatch]:
    names = ["part", "doc_id", "at", "n_tokens", "ids_crc32", *(["ids"] if with_ids else [])]
    for batch in batches:
        for b in batch.to_pylist():
            ids = unpack(b["payload"], b["width"], 0, b["n_ids"])
            lens = np.array(b["doc_lens"], np.int64)
            ends = np.cumsum(lens)
            spans = [ids[e - n:e] for e, n in zip(ends, lens, strict=True)]
            yield pa.RecordBatch.from_arrays([
                pa.array([b["part"]] * len(lens), pa.int32()), pa.array(b["doc_ids"], pa.int64()),
                pa.array(b["part_start"] + ends - lens), pa.array(lens),
                pa.array([zlib.crc32(s) for s in spans], pa.int64()),
                *([pa.array([s.tobytes() for s in spans], pa.binary())] if with_ids else [])], names)


def read_token_file(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """One row per document: doc_id, start, n_tokens, ids_crc32 and, on
    request, ids (little-endian uint32 bytes)."""
    ship(spark)
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(path)

    def rows_of(batches):
        return _documents_of(batches, ids)

    kinds = "part int, doc_id long, at long, n_tokens long, ids_crc32 long"
    rows = blocks.mapInArrow(rows_of, kinds + (", ids binary" if ids else ""))
    return (rows.join(_part_starts(blocks), "part").withColumn("start", F.col("file_start") + F.col("at"))
            .select("doc_id", "start", "n_tokens", "ids_crc32", *(["ids"] if ids else [])))


def read_ids(spark: SparkSession, path: str, start: int, count: int) -> np.ndarray:
    """Ids ``start .. start + count`` of the whole file: reads only the blocks
    that hold them (the caller asked for these ids, so they come back here)."""
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    first = F.col("file_start") + F.col("part_start")
    hit = (blocks.join(_part_starts(blocks), "part").withColumn("first", first)
           .filter((F.col("first") < start + count) & (F.col("first") + F.col("n_ids") > start))
           .select("first", "n_ids", "width", "payload").orderBy("first"))
    out = [np.zeros(0, "<u4")]
    for b in hit.toLocalIterator():
        lo = max(0, start - b["first"])
        out.append(unpack(bytes(b["payload"]), b["width"], lo, min(b["n_ids"], start + count - b["first"]) - lo))
    return np.concatenate(out)
