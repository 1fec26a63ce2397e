"""Substring de-duplication by hashing passages.

A stretch of ``min_words`` words that stands earlier (least id, then offset,
without overlap) goes, and nothing else: its words are all in the earlier place,
so unique words between repeated ones stay, and every repeated passage of that
length goes to its last word wherever it starts, inside a line, over several of
them or without any mark.  Words are lower case (A-Z) and cut at white space and
``. , ; : ! ?``; in scripts without spaces (Chinese, Japanese, Thai, Lao,
Burmese, Khmer) each character is a word.  Removed spans are given with their
offsets in the original text.

Whole lines or clauses as units can't give this result: a passage spliced into a
line shares no line with its original, and a repeated clause between unique
ones took these along (README).

1. Half as long runs of words are hashed, and of each stretch's runs the one of
   least hash stands for it (equal stretches pick equal runs).  Digests of
   these runs are counted over all texts, combined before they are shuffled.
2. A second pass hashes only stretches whose run occurs twice.  Which do, tasks
   see from a bitmap of the repeated digests, at most ``BITMAP_BITS`` bits; with
   more than a quarter as many digests they are joined instead.
3. Stretches are dealt by digest and sorted by place, in one shuffle; a task
   streams them, keeps the place that a digest is met first, and hands on all
   later ones, which are cut from their texts.  Stretches of a hot run, a
   passage of very many documents, are dealt by salts as well: what comes
   after the first place of its salt is settled, and the salts' first places
   are compared in a second round.

Defined results.  Null text: as it is, nothing removed.  Null ids rank after
all ids.  Repeated rows (same id and text) rank alike: each is treated as the
same document, so a passage they share is kept in all of them unless an earlier
document has it.  Empty table: no rows.  Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmix.llm.common import pick, release, ship, written

MIN_WORDS = 25
# Bits of the bitmap of repeated runs at most (8 MB).
BITMAP_BITS = 1 << 26
# A run in more places than this, and than a thousandth of all, is hot.
HOT_RUNS = 5_000
SALTS = 64
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))


_SPACES, _POINTS = " \t\n\r\x0b\x0c", "\n.,;:!?"
_GROUP_CHARS = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _flags(chars: str) -> np.ndarray:
    out = np.zeros(0x110000, bool)
    out[[ord(c) for c in chars]] = True
    return out


_CUT, _POINT = _flags(_SPACES + _POINTS), _flags(_POINTS)
_LONE = np.zeros(0x110000, bool)
for _a, _z in ((0xE00, 0xEFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3000, 0x30FF), (0x31F0, 0x31FF), (0x3400, 0x4DBF),
               (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF)):
    _LONE[_a:_z + 1] = True


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _runs_hash(values: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hash of values[start:stop] for each pair: sums of powers, moved to one
    origin by the inverse power."""
    powers = np.full(len(values) + 1, _BASE)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    back = np.full(len(values) + 1, np.uint64(pow(int(_BASE), -1, 1 << 64)))
    back[0] = 1
    back = np.multiply.accumulate(back)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * powers[:-1], dtype=np.uint64)])
    return _mix((sums[stop] - sums[start]) * back[start] + (stop - start).astype(np.uint64))


class _Words:
    """The words of some texts: ``text`` (its number), ``at`` (the word's
    number in it), ``start`` and ``stop`` (characters of it)."""

    def __init__(self, texts: list[str]):
        joined = "".join(t + "\n" for t in texts)
        chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        cut = np.concatenate([[True], _CUT[chars], [True]])
        lone = np.concatenate([[False], _LONE[chars], [False]])
        edge = cut[:-1] | cut[1:] | lone[:-1] | lone[1:]  # before each character
        begin, end = np.flatnonzero(edge & ~cut[1:]), np.flatnonzero(edge & ~cut[:-1])
        lower = chars + np.where((chars >= 65) & (chars <= 90), 32, 0).astype(np.uint32)
        self.hashes = _runs_hash(_mix(lower.astype(np.uint64) + _BASE), begin, end)
        origin = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
        self.text = np.searchsorted(origin, begin, side="right") - 1
        self.at = np.arange(len(begin)) - np.searchsorted(self.text, self.text)
        # A word's marks go with it, the space before it too.
        points = np.flatnonzero(~np.concatenate([_POINT[chars], [False]]))
        past = points[np.searchsorted(points, end)] if len(end) else end
        past = np.minimum(past, origin[self.text + 1] - 1)
        self.stop = past - origin[self.text]
        self.start = np.where(self.at == 0, 0, np.concatenate([[0], self.stop[:-1]]))

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(hash of the n words from each word on, whether one text has them all)."""
        first = np.arange(max(0, len(self.hashes) - n + 1))
        return _runs_hash(self.hashes, first, first + n), self.text[first] == self.text[first + n - 1]

    def stretches(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First words of all stretches of n words, and word and hash of the
        run that stands for each."""
        k = max(1, n // 2)
        runs, _ = self.grams(k)
        first = np.arange(max(0, len(self.hashes) - n + 1))
        first = first[self.text[first] == self.text[first + n - 1]]
        if not len(first):
            return first, first, runs[:0].astype(np.int64)
        least = np.lib.stride_tricks.sliding_window_view(runs, n - k + 1).argmin(1)
        chosen = first + least[first]
        return first, chosen, runs[chosen].astype(np.int64)


def _slices(b: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Parts of a batch of about ``_GROUP_CHARS`` characters."""
    texts = [t or "" for t in b.column("text").to_pylist()]
    lo = n = 0
    for hi, t in enumerate(texts, 1):
        n += len(t)
        if n >= _GROUP_CHARS or hi == len(texts):
            yield b.slice(lo, hi - lo), texts[lo:hi]
            lo, n = hi, 0


_KEYS = ["none", "id", "text_key"]


def _found(part: pa.RecordBatch, w: _Words, words: np.ndarray, digests: np.ndarray, hot: np.ndarray) -> pa.RecordBatch:
    row = pa.array(w.text[words])
    return pa.RecordBatch.from_arrays([*(part.column(c).take(row) for c in _KEYS), pa.array(w.at[words].astype(np.int32)),
                                       pa.array(digests), pa.array(hot)], [*_KEYS, "unit", "digest", "hot"])


_FOUND = "none boolean, id long, text_key long, unit int, digest long, hot boolean"


def _bitmap(digests: DataFrame, count: int) -> np.ndarray:
    """Bits set at the digests; a power of two of them, sixteen each if that
    many fit."""
    bits = 1 << 12
    while bits < min(BITMAP_BITS, 16 * count):
        bits *= 2
    slot = F.col("digest").bitwiseAND(F.lit(bits - 1))
    words = digests.groupBy(F.shiftright(slot, 6).alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(digest & 63 as int))")).alias("word")).toArrow()
    out = np.zeros(bits >> 6, np.uint64)
    out[words.column("at").to_numpy()] = words.column("word").to_numpy().view(np.uint64)
    return out


def _in_bitmap(bitmap: np.ndarray, digests: np.ndarray) -> np.ndarray:
    slot = digests.view(np.uint64) & np.uint64(64 * len(bitmap) - 1)
    return (bitmap[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


def _runs(min_words: int):
    """The digests of the runs that stand for a text's stretches, once each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, texts in _slices(b):
                _, chosen, digests = _Words(texts).stretches(min_words)
                chosen, one = np.unique(chosen, return_index=True)
                yield pa.RecordBatch.from_arrays([pa.array(digests[one])], ["digest"])

    return run


def _stretches(min_words: int, wanted, hot) -> object:
    """The stretches whose run is wanted, and whether it is hot; ``wanted`` gets
    the part of the batch, its words, and the chosen runs with their digests."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, texts in _slices(b):
                w = _Words(texts)
                first, chosen, digests = w.stretches(min_words)
                if len(first):
                    some = wanted(part, w, chosen, digests)
                    first, digests = first[some], digests[some]
                yield _found(part, w, first, w.grams(min_words)[0][first].astype(np.int64), _in_bitmap(hot.value, digests))

    return run


def _joined_runs(rows: DataFrame, twice: DataFrame, min_words: int, hot) -> DataFrame:
    """Stretches of repeated runs, found by joins: any number of digests."""
    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, texts in _slices(b):
                w = _Words(texts)
                _, chosen, digests = w.stretches(min_words)
                chosen, one = np.unique(chosen, return_index=True)
                yield _found(part, w, chosen, digests[one], np.zeros(len(one), bool))

    def marked(part: pa.RecordBatch, w: _Words, chosen: np.ndarray, digests: np.ndarray) -> np.ndarray:
        again = np.zeros(len(w.at), bool)
        origin = np.searchsorted(w.text, np.arange(part.num_rows))
        for i, units in enumerate(part.column("units").to_pylist()):
            again[origin[i] + np.array(units, np.int64)] = True
        return again[chosen]

    units = (rows.mapInArrow(sample, _FOUND).join(twice.select("digest"), "digest")
             .groupBy(*_KEYS).agg(F.collect_set("unit").alias("units")))  # one text's runs
    return rows.join(units, _KEYS).mapInArrow(_stretches(min_words, marked, hot), _FOUND)


def _after_first(min_words: int, settled: bool):
    """Of rows sorted by (digest, salt, place): those after the first place of
    their digest and salt, and, where that is not the first of all (salted and
    not ``settled``), the others as ``open``."""
    names = [*_KEYS, "unit", "digest", "open"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # digest, salt and first place of the group that a batch ended in
        for b in batches:
            if not b.num_rows:
                continue
            cols = [b.column(c).to_numpy(zero_copy_only=False) for c in ("digest", "salt", *_KEYS, "unit")]
            digest, salt = cols[:2]
            new = np.ones(b.num_rows, bool)
            new[1:] = (digest[1:] != digest[:-1]) | (salt[1:] != salt[:-1])
            if held is not None:
                new[0] = held[0] != digest[0] or held[1] != salt[0]
            at = np.maximum.accumulate(np.where(new, np.arange(b.num_rows), -1))
            first = []
            for k, c in enumerate(cols[2:], 2):
                f = c[np.maximum(at, 0)]
                if held is not None:
                    f = np.where(at < 0, held[k], f)
                first.append(f)
            same = (cols[2] == first[0]) & (cols[3] == first[1]) & (cols[4] == first[2])
            later = ~same | (cols[5] >= first[3] + min_words)
            waits = np.zeros(b.num_rows, bool) if settled else ~later & (salt > 0)
            keep = pa.array(later | waits)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in (*_KEYS, "unit", "digest")), pa.array(waits)], names).filter(keep)
            held = (digest[-1], salt[-1], *(f[-1] for f in first))

    return run


_AFTER = "none boolean, id long, text_key long, unit int, digest long, open boolean"


def repeated_stretches(rows: DataFrame, min_words: int) -> DataFrame:
    """(none, id, text_key, units): for each text the first words of the
    stretches that stand earlier.  ``rows`` has none, id, text_key and text."""
    spark = rows.sparkSession
    twice = written(rows.select("text").mapInArrow(_runs(min_words), "digest long").groupBy("digest")
                    .agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "repeated-runs")
    count, places = twice.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    # Fewer than a thousand of these.
    hot_runs = twice.filter(F.col("n") > max(HOT_RUNS, places // 1000))
    n_hot = hot_runs.count()
    hot = spark.sparkContext.broadcast(_bitmap(hot_runs, n_hot))
    if 4 * count <= BITMAP_BITS:
        shared = spark.sparkContext.broadcast(_bitmap(twice, count))
        found = rows.mapInArrow(_stretches(min_words, lambda part, w, chosen, digests: _in_bitmap(shared.value, digests), hot), _FOUND)
    else:
        found = _joined_runs(rows, twice, min_words, hot)
    place = [*_KEYS, "unit"]
    salt = F.when(F.col("hot"), 1 + F.pmod(F.xxhash64(*_KEYS), F.lit(SALTS))).otherwise(0).cast("int")
    dealt = found.withColumn("salt", salt).drop("hot").repartition("digest", "salt").sortWithinPartitions("digest", "salt", *place)
    after = dealt.mapInArrow(_after_first(min_words, False), _AFTER)
    if n_hot:
        after = written(after, "after-first")
        waits = after.filter("open").withColumn("salt", F.lit(0)).repartition("digest").sortWithinPartitions("digest", "salt", *place)
        later = after.filter("not open").select(*place).union(waits.mapInArrow(_after_first(min_words, True), _AFTER).select(*place))
    else:
        later = after.select(*place)
    out = written(later.groupBy(*_KEYS).agg(F.collect_set("unit").alias("units")), "repeated-stretches")  # one text's stretches
    release(twice, after)
    return out


def drop_repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, text without the passages that stand earlier,
    n_removed, removed (spans of the original text, in order)."""
    ship(docs.sparkSession)
    rows = pick(docs, id=id_col, text=text_col).withColumn("text_key", F.xxhash64("text"))
    rows = rows.withColumns({"none": F.col("id").isNull(), "id": F.coalesce("id", F.lit(0))})
    found = rows.join(repeated_stretches(rows, min_words), _KEYS, "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, removed = b.column("text").to_pylist(), []
            for i, units in enumerate(b.column("units").to_pylist()):
                spans = []
                if units:
                    w = _Words([texts[i]])
                    covered = np.zeros(len(w.at) + 2, np.int8)
                    for u in units:
                        covered[u + 1:u + 1 + min_words] = 1
                    edge = np.diff(covered)
                    for a, z in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True):
                        spans.append({"start": int(w.start[a]), "stop": int(w.stop[z - 1])})
                    kept, at = [], 0
                    for c in spans:
                        kept.append(texts[i][at:c["start"]])
                        at = c["stop"]
                    texts[i] = "".join(kept) + texts[i][at:]
                removed.append(spans)
            yield pa.RecordBatch.from_arrays([
                b.column("id"), pa.array(texts, pa.string()), pa.array([len(c) for c in removed], pa.int32()),
                pa.array(removed, _SPANS)], ["id", "text", "n_removed", "removed"])

    ident = F.when(~F.col("none"), F.col("id")).alias("id")
    return (found.select(ident, "text", "units")
            .mapInArrow(run, "id long, text string, n_removed int, removed array<struct<start:int,stop:int>>")
            .withColumnsRenamed({"id": id_col, "text": text_col}))
