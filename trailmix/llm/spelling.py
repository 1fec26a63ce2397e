"""Spelling variants grouped through an index of variable-length grams.

Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z in lower case,
that have at least ``MIN_LENGTH`` letters and ``min_count`` occurrences (n) in
all texts.  (The registered query damages one run in ``DAMAGE_MOD`` first, by a
checksum of document and run, to plant misspellings.)  Two words are near if one
letter inserted, deleted or replaced turns one into the other.  A word's form is
its near word of largest n, if that is at least ``ratio`` times its own; its
root is the last of the forms that follow each other.

Near words are found by a join over variable-length grams:

1. Dictionary.  Grams of 2 to ``LONGEST`` letters are counted over all words.
   A gram with more than ``total / PARENTS`` occurrences is too frequent to be
   selective, so the grams one letter longer that begin with it enter the
   dictionary; grams below an infrequent one are pruned away.  There are at
   most ``PARENTS`` frequent grams of each length and 90 letters, which bounds
   the dictionary (it goes to every task) at ``2 * 90 * PARENTS`` entries
   whatever the vocabulary, besides all pairs of letters.
2. Decomposition.  At each letter but the last, a word has the longest gram of
   the dictionary that begins there.
3. Affected grams.  One edit at a place changes the grams that span it, and
   those before it that a new letter could make longer (what stands between
   their start and the place begins a longer gram of the dictionary).  The most
   that any place affects is the word's bound NAG; all other grams of the word
   occur unchanged in any near word.  Grams have at most ``LONGEST`` = 4 letters
   and words at least 6, so one gram at least always survives.
4. Lists.  Of the grams that two near words share, the rarest (by dictionary
   counts, then gram, then place) has at most NAG rarer ones in either word, so
   a word is entered only under its NAG + 1 rarest grams.  The edit lies
   to the right or to the left of the shared gram, so the letters on the other
   side are equal: each entry goes to the list of (gram, letters before it) and
   to that of (gram, letters after it).
5. Merging and checking.  A task merges the lists of its keys: inside a list
   only entries whose rests agree after at most one deletion each meet, and
   each such pair is checked letter by letter.  Lists above ``LIST_WORDS`` are
   dealt over many tasks by those same rests.

No pair of words leaves a task unless it is near.  No partner is capped.

Defined results.  Null text: no words.  Null ids: their checksum is that of
the empty id.  Repeated rows count as often as they are there.  Ties in n take
the word that is smaller in code-point order.  Empty table: no rows.  Extra
columns are not read.  Texts of any length: counted in slices.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmix.llm.common import pick, release, ship, whole_groups, written

MIN_LENGTH = 6
MIN_COUNT = 5
RATIO = 5
DAMAGE_MOD = 199
SHORTEST, LONGEST = 2, 4
# Grams of one length that may be frequent.
PARENTS = 2000
# Entries of a list that one task merges (about 20 MB).
LIST_WORDS = 50_000
# Distinct words, or grams, that a task holds before it sends its counts on.
HELD = 400_000
_SLICE_CHARS = 1 << 22

# One byte for each letter (latin-1): letters in lower case, all others spaces.
_LETTERS = bytes((b + 32 if 65 <= b <= 90 else b) if 65 <= b <= 90 or 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))

Damage = Callable[[bytes, int], bytes]


def runs_of(text: str) -> Counter:
    """Runs of letters of a text in latin-1, how often each."""
    raw = text.encode("latin-1", "replace").translate(_LETTERS)
    if len(raw) <= _SLICE_CHARS:
        return Counter(raw.split())
    found, at = Counter(), 0
    while at < len(raw):
        end = raw.find(b" ", at + _SLICE_CHARS)
        end = len(raw) if end < 0 else end
        found.update(raw[at:end].split())
        at = end
    return found


def damaged(run: bytes, seed: int) -> bytes:
    """The run, without one letter where DAMAGE_MOD divides the checksum of
    "<doc_id>:<run>"; ``seed`` is the checksum of what stands before the run."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), seed)
    if h % DAMAGE_MOD:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def _task_words(damage: Damage | None):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[bytes, int] = {}
        for b in batches:
            for i, text in zip(b.column("id"), b.column("text"), strict=True):
                if not text.is_valid:
                    continue
                seed = zlib.crc32(f"{'' if not i.is_valid else i.as_py()}:".encode())
                for run, n in runs_of(text.as_py()).items():
                    # Damage only shortens.
                    if len(run) < MIN_LENGTH:
                        continue
                    if damage is not None:
                        run = damage(run, seed)
                        if len(run) < MIN_LENGTH:
                            continue
                    words[run] = words.get(run, 0) + n
                if len(words) > HELD:
                    yield from _sent(words)
                    words = {}
        yield from _sent(words)

    return count


def _sent(counts: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    keys, n = list(counts), list(counts.values())
    for lo in range(0, len(keys), 20_000):
        yield pa.RecordBatch.from_arrays([pa.array([k.decode("latin-1") for k in keys[lo:lo + 20_000]], pa.string()),
                                          pa.array(n[lo:lo + 20_000], pa.int64())], ["word", "n"])


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_count: int = MIN_COUNT,
               damage: Damage | None = None) -> DataFrame:
    """(word, n) of all words of the texts."""
    rows = pick(docs, id=id_col, text=text_col)
    return rows.mapInArrow(_task_words(damage), "word string, n long").groupBy("word") \
        .agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


# ------------------------------------------------------------- dictionary

def _task_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    grams: dict[bytes, int] = {}
    for b in batches:
        for w in b.column("word").to_pylist():
            raw = w.encode("latin-1")
            for q in range(SHORTEST, LONGEST + 1):
                for p in range(len(raw) - q + 1):
                    g = raw[p:p + q]
                    grams[g] = grams.get(g, 0) + 1
        if len(grams) > HELD:
            yield from _sent(grams)
            grams = {}
    yield from _sent(grams)


class Dictionary:
    """Grams that words are cut into, with their counts; ``open`` are those
    that a further letter may make longer."""

    def __init__(self, counts: dict[bytes, int], opened: set[bytes]):
        self.counts, self.open = counts, opened

    def longest(self, word: bytes, at: int) -> bytes:
        q = SHORTEST
        while q < LONGEST and at + q < len(word) and word[at:at + q] in self.open and word[at:at + q + 1] in self.counts:
            q += 1
        return word[at:at + q]

    def entries(self, word: bytes) -> list[tuple[int, bytes]]:
        """(place, gram) of the grams under which the word is entered: the
        NAG + 1 rarest."""
        grams = [self.longest(word, p) for p in range(len(word) - SHORTEST + 1)]
        counts = self.counts
        order = sorted(range(len(grams)), key=lambda p: (counts.get(grams[p], 0), grams[p], p))
        return [(p, grams[p]) for p in order[:self.bound(word, grams) + 1]]

    def bound(self, word: bytes, grams: list[bytes]) -> int:
        """Most grams that one inserted, deleted or replaced letter affects."""
        most, opened = 0, self.open
        for at in range(len(word) + 1):
            left = 0
            for p in range(max(0, at - LONGEST + 1), min(at, len(grams))):
                # It spans the border before ``at``, or may grow over it.
                end = p + len(grams[p])
                left += end > at or (end == at and grams[p] in opened)
            # A replaced or deleted letter also takes the gram that begins there.
            most = max(most, left + (at < len(grams)))
        return most


def dictionary(words: DataFrame, parents: int = PARENTS) -> Dictionary:
    """The frequency-pruned gram dictionary of a vocabulary."""
    counted = written(words.select("word").mapInArrow(_task_grams, "word string, n long")
                      .groupBy("word").agg(F.sum("n").alias("n")), "grams")
    q = F.length("word")
    most = {r["q"]: r["total"] // parents for r in counted.groupBy(q.alias("q")).agg(F.sum("n").alias("total")).collect()}
    limit = F.coalesce(*[F.when(q == k, F.lit(v)) for k, v in sorted(most.items())], F.lit(0)) if most else F.lit(0)
    opened = counted.filter((q < LONGEST) & (F.col("n") > limit)).select("word")  # at most ``parents`` of a length
    parent = F.broadcast(opened.withColumnRenamed("word", "parent"))
    longer = counted.filter(q > SHORTEST).withColumn("parent", F.expr("left(word, length(word) - 1)")).join(parent, "parent", "left_semi")
    kept = longer.select("word", "n").union(counted.filter(q == SHORTEST).select("word", "n"))
    counts = {r["word"].encode("latin-1"): r["n"] for r in kept.toLocalIterator()}
    out = Dictionary(counts, {r["word"].encode("latin-1") for r in opened.toLocalIterator()})
    release(counted)
    return out


# ------------------------------------------------------------------ lists

def _task_entries(cut: Dictionary):
    """(list, rest, word, n): the lists that a word is in, and the letters of
    the word that may differ in them."""
    names = ["list", "rest", "word", "n"]

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = [w.encode("latin-1") for w in b.column("word").to_pylist()]
            for lo in range(0, len(words), 5000):
                lists, rests, row = [], [], []
                for i, w in enumerate(words[lo:lo + 5000], lo):
                    for p, g in cut.entries(w):
                        end = p + len(g)
                        lists += (b"<%d %s" % (p, w[:end]), b">%d %s" % (len(g), w[p:]))
                        rests += (w[end:], w[:p])
                        row += (i, i)
                where = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays([
                    pa.array([x.decode("latin-1") for x in lists], pa.string()), pa.array([x.decode("latin-1") for x in rests], pa.string()),
                    b.column("word").take(where), b.column("n").take(where)], names)

    return entries


def rests_of(rest: str) -> set[str]:
    """The rest, and it without each one of its letters: two rests are at most
    one edit apart only if these have one in common."""
    return {rest, *(rest[:k] + rest[k + 1:] for k in range(len(rest)))}


def near(a: str, b: str) -> bool:
    """Exactly one letter inserted, deleted or replaced."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    k = 0
    while k < min(len(a), len(b)) and a[k] == b[k]:
        k += 1
    if len(a) == len(b):
        return a[k + 1:] == b[k + 1:]
    return a[k:] == b[k + 1:] if len(a) < len(b) else a[k + 1:] == b[k:]


_NEAR = "word string, near string, near_n long"


def _merged(keys: list, rests: list[str], words: list[str], counts: list[int], met: Callable) -> Iterator[pa.RecordBatch]:
    """Near pairs of the lists, both ways round, each once in a list."""
    out: tuple[list, list, list] = ([], [], [])
    at = 0
    while at < len(keys):
        end = at + 1
        while end < len(keys) and keys[end] == keys[at]:
            end += 1
        if end - at > 1:
            found: set[tuple[int, int]] = set()
            shared: dict[str, list[int]] = {}
            for i in range(at, end):
                for rest in met(rests[i]):
                    others = shared.setdefault(rest, [])
                    for j in others:
                        if (j, i) not in found and near(words[i], words[j]):
                            found.add((j, i))
                    others.append(i)
            for i, j in found:
                for x, y in ((i, j), (j, i)):
                    out[0].append(words[x])
                    out[1].append(words[y])
                    out[2].append(counts[y])
        at = end
        if len(out[0]) >= 20_000 or at >= len(keys):
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(out[0]), pa.array(out[1]), pa.array(out[2], pa.int64())], ["word", "near", "near_n"])
            out = ([], [], [])


def _task_lists(met: Callable):
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "list"):
            yield from _merged(*(table.column(c).to_pylist() for c in ("list", "rest", "word", "n")), met)

    return merge


def near_words(words: DataFrame, list_words: int | None = None, parents: int = PARENTS) -> DataFrame:
    """(word, near, near_n) of all near pairs, both ways round."""
    list_words = list_words or LIST_WORDS
    cut = dictionary(words, parents)
    entered = words.mapInArrow(_task_entries(cut), "list string, rest string, word string, n long")
    # A list goes by a hash of what its members share; the words themselves decide.
    entered = written(entered.withColumn("list", F.xxhash64("list")), "lists")
    # At most entries / list_words of them; each with more than list_words rows.
    long = written(entered.groupBy("list").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > list_words).select("list"), "long-lists")
    some = not long.isEmpty()
    short = entered.join(F.broadcast(long), "list", "left_anti") if some else entered
    found = short.repartition("list").sortWithinPartitions("list").mapInArrow(_task_lists(rests_of), _NEAR)
    if some:
        drop = F.udf(lambda rest: sorted(rests_of(rest)), "array<string>")
        dealt = entered.join(F.broadcast(long), "list", "left_semi").withColumn("rest", F.explode(drop("rest"))) \
            .withColumn("list", F.xxhash64("list", "rest"))
        found = found.union(dealt.repartition("list").sortWithinPartitions("list")
                            .mapInArrow(_task_lists(lambda rest: (rest,)), _NEAR))
    out = written(found.distinct(), "near-words")
    release(entered, long)
    return out


def variants(words: DataFrame, ratio: int = RATIO, **limits: int) -> DataFrame:
    """word, n, form, form_n, n_near, root of each row (word, n)."""
    ship(words.sparkSession)
    pairs = near_words(words, **limits)
    best = F.min(F.struct((-F.col("near_n")).alias("order"), F.col("near").alias("near")))
    around = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    form = F.when(-F.col("best.order") >= ratio * F.col("n"), F.col("best.near"))
    rows = written(words.join(around, "word", "left").select(
        "word", "n", form.alias("form"), F.when(form.isNotNull(), -F.col("best.order")).alias("form_n"),
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near")), "forms")
    release(pairs)
    # Along forms n grows by ``ratio`` each step, so pointers jump to the last
    # of them in a number of rounds that the largest n bounds.
    most = rows.agg(F.max("n")).first()[0] or 1
    steps, n = 1, 1
    while n * ratio <= most:
        n, steps = n * ratio, steps + 1
    links = rows.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while steps > 1:
        again = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        links = written(links.join(again, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots")
        steps = -(-steps // 2)
    return rows.join(links, "word", "left").select("word", "n", "form", "form_n", "n_near", F.coalesce("root", "word").alias("root"))


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_count: int = MIN_COUNT,
                      ratio: int = RATIO, damage: Damage | None = None, **limits: int) -> DataFrame:
    """The words of the texts with their variants; see the module docstring."""
    ship(docs.sparkSession)
    return variants(written(vocabulary(docs, id_col, text_col, min_count, damage), "vocabulary"), ratio, **limits)
