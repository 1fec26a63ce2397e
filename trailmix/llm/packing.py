"""Packing documents into fixed windows by minimum bin slack.

A document's ids are cut at multiples of the window; a whole window is a
sequence of its own and the rests are packed.  How many pieces there are of
each length is a histogram of at most ``window`` counts, whatever the corpus
size, and the plan is made from it alone: the longest remaining length opens a
window, a bitset subset-sum over the remaining lengths finds the multiset that
fills it closest to capacity, and backtracking the bitsets gives how many of
each length it takes.  The same filling is used as often as the counts allow.

The plan says which ranks of each length go to which sequences; pieces are
ranked within their length over ranges of a hash (``common.ranked``), so no
length, however common, meets in one task.

Defined results.  Null text: empty, its end id only.  Null ids and repeated
rows: each row is packed on its own.  Empty table: no rows.  Extra columns are
not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmix.llm.common import give_back, hash63, pick, rank_bits, ranked, ship, top_bits, written
from trailmix.llm.tokens import SLICE_CHARS, encoder

PIECES = "id long, start long, length long, ids_crc32 long, doc_tokens long"
# Documents encoded at a time.
SLICE_ROWS = 2048


def document_pieces(docs: DataFrame, window: int, tokenizer: str, end_id: int, id_col: str = "doc_id",
                    text_col: str = "text", with_ids: bool = False, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """One row per piece of at most ``window`` ids, on request with its ids
    (little-endian uint32 bytes).  Fewer ``slice_rows`` at a time, and with
    them fewer characters, take less memory."""
    ship(docs.sparkSession)
    slice_chars = SLICE_CHARS * slice_rows // SLICE_ROWS
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", *(["ids"] if with_ids else [])]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(tokenizer, False), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            keys = batch.column("id").to_pylist()
            for lo in range(0, len(keys), slice_rows):
                rows = []
                texts = batch.column("text").slice(lo, slice_rows).to_pylist()
                for key, body in zip(keys[lo:lo + slice_rows], enc.encode(texts, slice_chars), strict=True):
                    body += end
                    for at in range(0, len(body), 4 * window):
                        part = body[at:at + 4 * window]
                        rows.append((key, at // 4, len(part) // 4, zlib.crc32(part), len(body) // 4, part)[:len(names)])
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in cols[:5]] + [pa.array(c, pa.binary()) for c in cols[5:]], names)
            give_back()

    return pick(docs, id=id_col, text=text_col).mapInArrow(pieces, PIECES + (", ids binary" if with_ids else ""))


def fill(left: dict[int, int], room: int) -> dict[int, int]:
    """Which of the lengths left (length: count) to take so that their sum is
    as near to ``room`` as it can be, at most ``room``."""
    reach, steps = 1, []
    mask = (1 << (room + 1)) - 1
    for length in sorted(left, reverse=True):
        for _ in range(min(left[length], room // length)):
            more = reach | (reach << length) & mask
            if more == reach:
                break
            steps.append((length, reach))
            reach = more
        if reach >> room & 1:
            break
    take: dict[int, int] = {}
    total = reach.bit_length() - 1
    for length, before in reversed(steps):
        if not before >> total & 1:
            take[length] = take.get(length, 0) + 1
            total -= length
    return take


def plan_windows(counts: dict[int, int], window: int) -> list[tuple[int, dict[int, int]]]:
    """(times, {length: pieces}) fillings that use up all counts."""
    left, plan = {k: n for k, n in counts.items() if n}, []
    while left:
        longest = max(left)
        left[longest] -= 1
        need = fill({k: n for k, n in left.items() if n and k <= window - longest}, window - longest)
        left[longest] += 1
        need[longest] = need.get(longest, 0) + 1
        times = min(left[k] // n for k, n in need.items())
        plan.append((times, need))
        for k, n in need.items():
            left[k] -= times * n
            if not left[k]:
                del left[k]
    return plan


def _spans(plan: list[tuple[int, dict[int, int]]]) -> dict[int, np.ndarray]:
    """For each length, rows (first rank, pieces a window, first sequence,
    offset in the window), ascending by rank."""
    used: dict[int, int] = {}
    spans: dict[int, list] = {}
    sequence = 0
    for times, need in plan:
        offset = 0
        for length in sorted(need, reverse=True):
            spans.setdefault(length, []).append((used.get(length, 0), need[length], sequence, offset))
            used[length] = used.get(length, 0) + times * need[length]
            offset += length * need[length]
        sequence += times
    return {k: np.array(v, np.int64) for k, v in spans.items()}


def pack_pieces(pieces: DataFrame, window: int, seed: int = 11) -> DataFrame:
    """Pieces (as ``document_pieces`` gives them) with sequence_id and offset."""
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most `window` rows
    spans = _spans(plan_windows(counts, window))
    bits = rank_bits(pieces.sparkSession, sum(counts.values()))
    order = pieces.withColumn("order_key", hash63(seed, F.col("id"), F.col("start"), F.col("ids_crc32")))
    order = order.withColumn("order_range", top_bits(F.col("order_key"), bits))
    placed = ranked(order, ["length"], "order_range", ["order_key", "id", "start", "ids_crc32"], "rank")
    cols = pieces.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length = b.column("length").to_numpy()
            rank = b.column("rank").to_numpy() - 1
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            by = np.argsort(length, kind="stable")
            cuts = np.flatnonzero(np.diff(length[by])) + 1
            for rows in np.split(by, cuts) if len(by) else []:
                table = spans[int(length[rows[0]])]
                hit = table[np.searchsorted(table[:, 0], rank[rows], "right") - 1]
                copy, k = np.divmod(rank[rows] - hit[:, 0], hit[:, 1])
                sequence[rows] = hit[:, 2] + copy
                offset[rows] = hit[:, 3] + k * length[rows]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in cols), pa.array(sequence), pa.array(offset)],
                                             [*cols, "sequence_id", "offset"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema)
    return placed.select(*cols, "rank").mapInArrow(place, kinds + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, window: int, tokenizer: str, end_id: int, id_col: str = "doc_id",
                   text_col: str = "text", slice_rows: int = SLICE_ROWS) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset."""
    ship(docs.sparkSession)
    pieces = written(document_pieces(docs, window, tokenizer, end_id, id_col, text_col, slice_rows=slice_rows), "pieces")
    return pack_pieces(pieces, window).withColumnRenamed("id", id_col)


def packed_sequences(docs: DataFrame, window: int, tokenizer: str, end_id: int, pad_id: int = 0,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The sequences themselves: sequence_id, used, ids (``window`` ids as
    little-endian uint32 bytes, padded)."""
    pieces = written(document_pieces(docs, window, tokenizer, end_id, id_col, text_col, with_ids=True), "piece-ids")
    parts = pack_pieces(pieces, window).groupBy("sequence_id").agg(
        F.sum("length").alias("used"),
        F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))  # at most `window` ids

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pad = np.array([pad_id], "<u4").tobytes()
        for b in batches:
            ids = [(x := b"".join(p["ids"] for p in parts)) + pad * (window - len(x) // 4) for parts in b.column("parts").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("sequence_id"), b.column("used"), pa.array(ids, pa.binary())],
                                             ["sequence_id", "used", "ids"])

    return parts.mapInArrow(join, "sequence_id long, used long, ids binary")
