"""Near-duplicate groups by a chosen-path set similarity join.

A document's set is its distinct ``k``-word shingles (A-Z lower-cased; fewer
words: the whole sequence as one).  Documents whose sets have a Jaccard
similarity of at least ``percent`` / 100 are linked; a component of links is a
group.

1. *Sets.*  One pass makes 64 minwise tokens of every set.  Equal sets are one
   vertex from here on, so a group of copies costs one row.
2. *Chosen paths.*  Independent trees branch every vertex by selected tokens:
   a child holds the vertices that agree on one.  A child of one vertex is
   done, one of at most ``LEAF`` is compared exhaustively by its sketches.  In
   a larger one every vertex is compared with a few pivots.  What these join
   counts as one: of the node's largest cluster only ``REPRESENTATIVES`` branch
   again, beside all vertices outside it, so a group of a third of all
   documents is a few rows from the second level on.  Nodes branch by one or
   two tokens, ``DEPTH`` levels deep at every size; what one tree parts, others
   keep.  Candidate links are sketches that agree in ``ALIKE`` of 64 tokens (5
   standard deviations below 0.8); of a node's candidates only a spanning
   forest is kept.
3. *The rest.*  What pivots, representatives and the depth may have parted is
   the pairs of a large first child in different clusters.  All vertices of
   such children are compared by the prefixes of their full sets, rarest
   shingles first: two sets of that similarity share a shingle of their
   prefixes, in whatever order.  A shingle of more than ``LEAF`` vertices is
   compared with pivots and then every vertex outside its largest cluster with
   all of its vertices, in blocks.  So no cap of step 2 loses a pair.
4. *Confirmation.*  Candidate clusters are compared on their full sets.  Up to
   ``BLOCK`` vertices are compared at once; in a larger cluster every vertex
   is compared with pivots first and then the vertices that no pivot links are
   compared with all others, in blocks.  Pairs already joined need no further
   test, so a dense cluster costs about one test a vertex.

Two sets of similarity 0.8 miss each other in the ``TREES * ROOTS`` first
children with a probability of 0.2 ** 12.  The time of the rest is quadratic
only in vertices that share most of their sets without being linked.

Defined results.  Null text or none but white space: ``n_shingles`` 0, linked
with nothing, its own component.  Null ids: never a component's id while it
has another; a component of null ids only has id null and no row kept.
Repeated rows: equal sets, one component; rows that share the least id are all
``kept``.  Empty table: no rows.  Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmix.llm.common import Rows, give_back, hash63, kept_in_worker, pick, release, ship, whole_groups, written
from trailmix.llm.components import components

TOKENS = 64
# One or two branches a node: a pair of similarity 0.8 goes on along 1.2 paths
# on average, one under 0.66 along less than one.
TREES, ROOTS, DEPTH = 4, 3, 8
LEAF, BLOCK, PIVOTS, PIVOT_BLOCK, REPRESENTATIVES, REST_BLOCK = 256, 128, 16, 4096, 16, 1024
ALIKE = 35
# Shingles counted to order prefixes: those of a 64th of the vertices, of
# ORDER_SAMPLE at least; the ORDER_KEPT most frequent ones count.  Links don't
# depend on the order, only the time does.
ORDER_SAMPLE, ORDER_KEPT = 10_000, 500_000
# Bits of a sieve for each wanted key, in all at most (64 MB), and those that a
# key sets.  Results don't depend on them, only what is sent does.
SIEVE_BITS, SIEVE_MOST, SIEVE_HASHES, _BUCKET = 16, 1 << 29, 4, 1 << 15
_SLICE = 1 << 20
_SPAN = 1 << 14

_RNG = np.random.default_rng(20_240_607)
_BYTE = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_PLACE = _RNG.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MUL = _RNG.integers(0, 1 << 63, TOKENS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(0, 1 << 63, TOKENS, dtype=np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse; those of a usual slice are kept."""
    def made(size: int) -> tuple[np.ndarray, np.ndarray]:
        out = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            out.append(np.cumprod(p))
        return out[0], out[1]

    usual = _SLICE + (_SLICE >> 2)
    up, down = kept_in_worker("near dedup", "powers", lambda: made(usual)) if n <= usual else made(n)
    return up[:n], down[:n]


def shingle_sets(texts: list[str | None], k: int) -> list[np.ndarray]:
    """The sorted 64-bit hashes of each text's distinct shingles."""
    raw = [(t or "").encode().translate(_LOWER) for t in texts]
    buf = np.frombuffer(b"\n" + b"\n".join(raw) + b"\n", np.uint8)
    up, down = _powers(len(buf))
    gap = _SPACE[buf]
    edge = np.diff(gap.view(np.int8))
    start, stop = np.flatnonzero(edge == -1) + 1, np.flatnonzero(edge == 1) + 1
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[buf] * up)])
    word = _mix((total[stop] - total[start]) * down[start] + (stop - start).astype(np.uint64))
    ends = np.cumsum([len(r) + 1 for r in raw])
    last = np.searchsorted(start, ends + 1)
    first = np.concatenate([[0], last[:-1]])
    run = np.zeros(max(0, len(word) - k + 1), np.uint64)
    for j in range(k):
        run += word[j:len(run) + j] * _PLACE[j]
    run = _mix(run)
    out = []
    for a, b in zip(first, last, strict=True):
        n = b - a
        if n >= k:
            out.append(np.unique(run[a:b - k + 1]))
        elif n:
            out.append(_mix((word[a:b] * _PLACE[8:8 + n]).sum(keepdims=True) + np.uint64(n)))
        else:
            out.append(run[:0])
    return out


def sketch(grams: np.ndarray) -> np.ndarray:
    """The minwise tokens of a set."""
    out = np.empty(TOKENS, np.uint32)
    step = max(1, (1 << 18) // max(1, len(grams)))
    for j in range(0, TOKENS, step):
        out[j:j + step] = ((_MUL[j:j + step, None] * grams + _ADD[j:j + step, None]) >> np.uint64(32)).min(1)
    return out


def _sliced(column: pa.Array) -> Iterator[tuple[int, list]]:
    """A column's texts, about a million characters at a time; what is done
    with is given back."""
    for lo in range(0, len(column), 256):
        some, size, at = [], 0, lo
        for i, t in enumerate(column.slice(lo, 256).to_pylist(), lo):
            some.append(t)
            size += len(t or "")
            if size >= _SLICE:
                yield at, some
                some, size, at = [], 0, i + 1
        if some:
            yield at, some
    give_back()


def text_key(text: Column) -> Column:
    """A digest of the whole text, by which it is found again; null: that of none."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def document_sets(docs: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """(id, text_key, n, key, sketch): key is a digest of the set, null for none."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, texts in _sliced(b.column("text")):
                sets = shingle_sets(texts, k)
                part = b.slice(at, len(texts))
                yield pa.RecordBatch.from_arrays([
                    part.column("id"), part.column("text_key"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([hashlib.md5(s.tobytes()).digest() if len(s) else None for s in sets], pa.binary()),
                    pa.array([sketch(s).tobytes() if len(s) else None for s in sets], pa.binary())],
                    ["id", "text_key", "n", "key", "sketch"])

    rows = pick(docs, id=id_col, text=text_col).withColumn("text_key", text_key(F.col("text")))
    return rows.mapInArrow(run, "id long, text_key binary, n long, key binary, sketch binary")


def _sieve(wanted: DataFrame, key: str) -> Callable[[Column], Column]:
    """A test that holds for every wanted key and for about one in 400 of the
    others (a Bloom filter): rows that fail it need not be sent to a join with
    the wanted ones."""
    size = max(_BUCKET, min(SIEVE_MOST, SIEVE_BITS * wanted.count()))

    def places(column: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(F.lit(j), column), F.lit(size)) + 1 for j in range(SIEVE_HASHES)]

    place = wanted.select(F.explode(F.array(*places(F.col(key)))).alias("place"))
    place = place.select(F.bitmap_bucket_number("place").alias("bucket"), F.bitmap_bit_position("place").alias("bit"))
    made = place.repartition("bucket").groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).toArrow()
    bits = np.zeros((-(-size // _BUCKET), _BUCKET // 8), np.uint8)
    for bucket, some in zip(made.column("bucket").to_pylist(), made.column("bits").to_pylist(), strict=True):
        bits[bucket - 1] = np.frombuffer(some, np.uint8)
    shared = wanted.sparkSession.sparkContext.broadcast(bits.reshape(-1))

    def _set(places: pa.Array) -> np.ndarray:
        at = places.to_numpy(zero_copy_only=False) - 1
        return (shared.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1

    @F.arrow_udf("boolean")
    def holds(*places: pa.Array) -> pa.Array:
        return pa.array(np.logical_and.reduce([_set(p) for p in places]))

    return lambda column: holds(*places(column))


class Forest:
    """Joined items of one group, and the joins made."""

    def __init__(self, n: int):
        self.up = list(range(n))
        self.joins: list[tuple[int, int]] = []

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        if a != b:
            self.up[max(a, b)] = min(a, b)
            self.joins.append((i, j))


def _alike(sketches: list[bytes], forest: Forest, lefts: int) -> None:
    """Join items whose sketches agree in enough tokens."""
    s = np.frombuffer(b"".join(sketches), np.uint32).reshape(-1, TOKENS)
    for i in range(min(lefts, len(s) - 1)):
        for j in np.flatnonzero((s[i + 1:] == s[i]).sum(1) >= ALIKE):
            forest.join(i, i + 1 + int(j))


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets have that Jaccard similarity."""
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < percent * len(b):
        return False
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    common = int((b[at] == a).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def _common(sets: list[np.ndarray], lefts: int) -> np.ndarray:
    """Sizes of the intersections of the first ``lefts`` sets with all sets, as
    products of membership matrices, a span of members at a time."""
    out = np.zeros((lefts, len(sets)), np.float32)
    names, at, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = np.cumsum(count > 1) - 1                     # members of two sets or more, renumbered
    who = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    keep = count[at] > 1
    who, at = who[keep], shared[at[keep]]
    order = np.argsort(at, kind="stable")
    who, at = who[order], at[order]
    for lo in range(0, int(shared[-1]) + 1 if len(shared) else 0, _SPAN):
        a, b = np.searchsorted(at, [lo, lo + _SPAN])
        has = np.zeros((len(sets), _SPAN), np.float32)
        has[who[a:b], at[a:b] - lo] = 1
        out += has[:lefts] @ has.T
    return out


def _confirmed(percent: int) -> Callable:
    def test(grams: list[bytes], forest: Forest, lefts: int) -> None:
        """Join items whose full sets are similar enough."""
        sets = [np.frombuffer(g, np.uint64) for g in grams]
        lefts = min(lefts, len(sets) - 1)
        if len(sets) < 8:
            for i in range(lefts):
                for j in range(i + 1, len(sets)):
                    if forest.root(i) != forest.root(j) and _similar(sets[i], sets[j], percent):
                        forest.join(i, j)
            return
        sizes = np.array([len(s) for s in sets])
        common = _common(sets, lefts)
        for i in range(lefts):
            union = sizes[i] + sizes - common[i]
            for j in np.flatnonzero(100 * common[i, i + 1:] >= percent * union[i + 1:]):
                forest.join(i, i + 1 + int(j))
    return test


def _compare(rows: DataFrame, test: Callable, body: str) -> DataFrame:
    """Edges (a, b) within tasks of rows (task, side, key, body): rows of side
    0 are compared with each other and with those of side 1."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, "task"):
            task = table.column("task").to_numpy()
            cuts = [0, *(np.flatnonzero(task[1:] != task[:-1]) + 1), len(task)]
            side, key = table.column("side").to_numpy(), table.column("key").to_pylist()
            data = table.column(body).to_pylist()
            out: list[tuple[bytes, bytes]] = []
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if hi - lo < 2:
                    continue
                forest, n0 = Forest(hi - lo), int((side[lo:hi] == 0).sum())
                test(data[lo:hi], forest, n0)
                out += [(key[lo + i], key[lo + j]) for i, j in forest.joins]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.binary()) for i in (0, 1)], ["a", "b"])

    sent = rows.select("task", "side", "key", body).repartition("task").sortWithinPartitions("task", "side")
    return sent.mapInArrow(run, "a binary, b binary")


def _blocks(rows: DataFrame, group: str, size: str, block: int, body: str, left: str) -> DataFrame:
    """Tasks that compare the rows with ``left`` of each group with all of its
    rows, block by block.  A row is sent to one task for each block of left
    rows (and a left row also for each block of all rows)."""
    n = F.ceil(F.col(size) / block).cast("int")
    own = F.pmod(F.xxhash64("key"), n).cast("int")  # hashed below: of one type with `other`
    rows = rows.withColumns({"blocks": n, "own": own})

    def task(i, j):
        return F.xxhash64(F.col(group), i, j).alias("task")

    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    lefts = rows.filter(left).select("*", every).select(task(F.col("own"), F.col("other")), F.lit(0).alias("side"), "key", body)
    # Two left rows of different blocks meet in the task of the lower block.
    rights = (rows.select("*", every).filter(f"not ({left}) or other < own")
              .select(task(F.col("other"), F.col("own")), F.lit(1).alias("side"), "key", body))
    return lefts.unionByName(rights)


def _pivot_tasks(rows: DataFrame, group: str, size: str, body: str) -> DataFrame:
    """Tasks that compare all rows of each group with up to PIVOTS of them,
    chosen by key.  A task has one block of rows and all pivots."""
    part = F.pmod(F.xxhash64("key", F.lit(1)), F.lit(PIVOTS))
    pivots = (rows.groupBy(group, size, part.alias("part")).agg(F.min_by(F.struct("key", body), "key").alias("pivot"))
              .select(group, size, "pivot.*"))
    n = F.ceil(F.col(size) / PIVOT_BLOCK).cast("int")
    own = F.pmod(F.xxhash64("key", F.lit(2)), n).cast("int")
    each = F.explode(F.sequence(F.lit(0), n - 1)).alias("block")
    lefts = pivots.select("*", each).select(F.xxhash64(F.col(group), F.col("block")).alias("task"), F.lit(0).alias("side"), "key", body)
    return lefts.unionByName(rows.select(F.xxhash64(F.col(group), own).alias("task"), F.lit(1).alias("side"), "key", body))


def _children(rows: DataFrame, parent, picks: list, label: str | None) -> DataFrame:
    """Rows branched by selected tokens (null: not branched): (node, key,
    [label]); node is the token's value under its parent."""
    def value(i):
        return F.substring("sketch", 4 * i + 1, 4)

    made = F.array_compact(F.array(*[F.when(i.isNotNull(), F.xxhash64(parent, F.lit(j), i, value(i))) for j, i in enumerate(picks)]))
    return rows.select(F.explode(made).alias("node"), "key", *([label] if label else []))


def _branched_on(level: DataFrame) -> DataFrame:
    """Of the rows (node, key, label) of large nodes those that branch again: all
    outside the node's main label, and REPRESENTATIVES of that one.  Nodes of one
    label are done."""
    counts = level.groupBy("node", "label").agg(F.count(F.lit(1)).alias("n"))
    main = (counts.groupBy("node").agg(F.max_by("label", F.struct("n", "label")).alias("main"), F.count(F.lit(1)).alias("labels"))
            .filter("labels > 1").select("node", "main"))
    rows = level.join(main, "node")
    part = F.pmod(F.xxhash64("key", F.lit(3)), F.lit(REPRESENTATIVES)).alias("part")
    some = rows.filter("label = main").groupBy("node", "label", part).agg(F.min("key").alias("key")).select("node", "key", "label")
    return rows.filter("label <> main").select("node", "key", "label").unionByName(some)


def _mixed(nodes: DataFrame, vertices: DataFrame, name: str) -> DataFrame:
    """(node, size, key, sketch) of the nodes that hold more than one label."""
    sizes = (nodes.groupBy("node").agg(F.count(F.lit(1)).alias("size"), F.min("label").alias("low"), F.max("label").alias("high"))
             .filter("size > 1 and low <> high").select("node", "size"))
    return written(nodes.join(sizes, "node").join(vertices, "key").select("node", "size", "key", "sketch"), name)


def _labelled(rows: DataFrame, clusters: DataFrame) -> DataFrame:
    """The rows (node, key, [size]) with their cluster, or their own key, as
    label, written once: a vertex is looked up once, in however many nodes it is."""
    own = rows.select("key").distinct().join(clusters, "key", "left").select("key", F.coalesce("cluster", "key").alias("label"))
    return written(rows.join(own, "key"), "labels")


def _still_apart(rows: DataFrame, clusters: DataFrame) -> DataFrame:
    """(key, label) of the rows of nodes that hold more than one cluster."""
    own = _labelled(rows.select("node", "key"), clusters)
    many = own.groupBy("node").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low <> high")
    return own.join(many, "node", "left_semi").select("key", "label").distinct()


def _rest(shared: DataFrame, apart: DataFrame, vertices: DataFrame, clusters: DataFrame, leaf: int) -> DataFrame:
    """Edges between vertices of different labels (key, label) that share a
    node of their prefixes (node, key), each pair compared."""
    many = shared.groupBy("node").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("node")
    rows = _mixed(shared.join(many, "node").join(apart, "key"), vertices, "rest")
    small = rows.filter(F.col("size") <= leaf).select(F.col("node").alias("task"), F.lit(0).alias("side"), "key", "sketch")
    found = _compare(small, _alike, "sketch")
    large = rows.filter(F.col("size") > leaf)
    if large.isEmpty():
        return found
    found = written(found.union(_compare(_pivot_tasks(large, "node", "size", "sketch"), _alike, "sketch")), "rest-links")
    level = _labelled(large.select("node", "size", "key"), components(clusters.toDF("a", "b").union(found)).toDF("key", "cluster"))
    main = (level.groupBy("node", "label").agg(F.count(F.lit(1)).alias("n")).groupBy("node")
            .agg(F.max_by("label", F.struct("n", "label")).alias("main"), F.count(F.lit(1)).alias("labels")).filter("labels > 1"))
    level = level.join(main, "node").select("node", "size", "key", (F.col("label") != F.col("main")).alias("apart"))
    level = written(level.join(vertices, "key").select("node", "size", "key", "sketch", "apart"), "rest-apart")
    return found.union(_compare(_blocks(level, "node", "size", REST_BLOCK, "sketch", "apart"), _alike, "sketch"))


def candidate_clusters(vertices: DataFrame, leaf: int = LEAF, depth: int = DEPTH,
                       prefixes: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(key, cluster) of vertices (key, sketch) whose sketches agree with
    another one's, from chosen-path trees.  After each level, vertices already
    in one cluster need no comparison with each other.

    ``prefixes`` gives (node, key) for the shingles of the prefixes of the
    vertices (key, label) it is given; by these all pairs are compared that
    large nodes may have left apart.  Without it such pairs meet by chance."""
    roots = [F.lit(5 * i % TOKENS) for i in range(TREES * ROOTS)]
    nodes = _children(vertices, F.lit(0), roots, None).withColumn("label", F.col("key"))
    edges = clusters = None
    for d in range(depth + 1):
        rows = _mixed(nodes, vertices, f"nodes-{d}")
        small = rows.filter(F.col("size") <= leaf).select(F.col("node").alias("task"), F.lit(0).alias("side"), "key", "sketch")
        found = _compare(small, _alike, "sketch")
        large = rows.filter(F.col("size") > leaf)
        deeper = not large.isEmpty()
        if d == 0:
            first_rows, capped = rows, large if deeper else None
        if deeper:
            found = found.union(_compare(_pivot_tasks(large, "node", "size", "sketch"), _alike, "sketch"))
        edges = found if edges is None else clusters.toDF("a", "b").union(found)
        clusters = components(edges).toDF("key", "cluster")
        if not deeper or d == depth:
            break
        level = written(_branched_on(_labelled(large.select("node", "key"), clusters)).join(vertices, "key"), f"level-{d}")
        if d or prefixes is None:
            release(rows)
        if level.isEmpty():
            break
        first, step = (F.pmod(F.xxhash64("node", F.lit(j)), F.lit(n)) for j, n in ((0, TOKENS), (1, TOKENS - 1)))
        # Half of the nodes branch twice.
        second = F.when(F.pmod(F.xxhash64("node", F.lit(2)), F.lit(2)) == 0, F.pmod(first + step + 1, F.lit(TOKENS)).cast("int"))
        nodes = _children(level, F.col("node"), [first.cast("int"), second], "label")
    if prefixes is None or capped is None:
        return clusters
    apart = written(_still_apart(capped, clusters), "apart")
    release(first_rows)
    if apart.isEmpty():
        return clusters
    shared = written(prefixes(apart), "prefixes")
    clusters = components(clusters.toDF("a", "b").union(_rest(shared, apart, vertices, clusters, leaf))).toDF("key", "cluster")
    release(shared)
    return clusters


def confirmed_edges(sets: DataFrame, percent: int, block: int = BLOCK) -> DataFrame:
    """Links between full sets (cluster, size, key, grams), as a forest."""
    small = sets.filter(F.col("size") <= block).select(F.xxhash64("cluster").alias("task"), F.lit(0).alias("side"), "key", "grams")
    edges = _compare(small, _confirmed(percent), "grams")
    large = sets.filter(F.col("size") > block)
    if large.isEmpty():
        return edges
    test = _confirmed(percent)
    linked = written(_compare(_pivot_tasks(large, "cluster", "size", "grams"), test, "grams"), "pivot-links")
    # Of the parts that pivots make of a cluster the one with most rows is
    # done; every other row is compared with all rows of its cluster.
    roots = components(linked).toDF("key", "root")
    rows = large.select("cluster", "key").join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    main = (rows.groupBy("cluster", "root").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("cluster").agg(F.max_by("root", F.struct("n", "root")).alias("main")))
    rows = written(rows.join(main, "cluster").select("cluster", "key", (F.col("root") != F.col("main")).alias("apart")), "parts")
    open_clusters = rows.filter("apart").select("cluster").distinct()
    rest = large.join(rows, ["cluster", "key"]).join(open_clusters, "cluster", "left_semi")
    return edges.union(linked).union(_compare(_blocks(rest, "cluster", "size", block, "grams", "apart"), test, "grams"))


def near_groups(docs: DataFrame, k: int, percent: int, id_col: str, text_col: str,
                leaf: int = LEAF, block: int = BLOCK) -> DataFrame:
    """One row per document: id, n, text_key and the root of its group's sets
    (null: a document without words)."""
    ship(docs.sparkSession)
    rows = written(document_sets(docs, k, id_col, text_col), "sets")
    classes = written(rows.filter("key is not null").groupBy("key").agg(
        F.min("text_key").alias("text_key"), F.min_by("sketch", "text_key").alias("sketch")), "classes")

    def prefixes(apart: DataFrame) -> DataFrame:
        return prefix_shingles(docs, written(apart.join(classes, "key").select("key", "text_key"), "apart-texts"), k, percent, text_col)

    clusters = candidate_clusters(classes.select("key", "sketch"), leaf, prefixes=prefixes)
    sizes = clusters.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
    wanted = written(clusters.join(sizes, "cluster").join(classes.select("key", "text_key"), "key"), "wanted")
    sets = written(_full_sets(docs, wanted, k, id_col, text_col), "full-sets")
    roots = components(confirmed_edges(sets, percent, block)).select(F.col("node").alias("key"), "root")
    return rows.join(roots, "key", "left").select("id", "n", "text_key", F.coalesce("root", "key").alias("root"))


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text",
                    leaf: int = LEAF, block: int = BLOCK) -> DataFrame:
    """One row per document: id, n_shingles, component_id, kept."""
    rows = written(near_groups(docs, k, percent, id_col, text_col, leaf, block), "groups")
    least = rows.filter("root is not null").groupBy("root").agg(F.min("id").alias("least"))
    component = F.when(F.col("root").isNull(), F.col("id")).otherwise(F.col("least"))
    return rows.join(least, "root", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns: of each group the least id
    (then text hash; null ids last), every document without words.  Rows equal
    in id and text stay or go together (drop exact duplicates first)."""
    rows = written(near_groups(docs, k, percent, id_col, text_col), "groups")
    place = F.struct(F.col("id").isNull().alias("none"), F.coalesce("id", F.lit(0)).alias("id"), "text_key")
    first = rows.filter("root is not null").groupBy("root").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("members"))
    going = written(rows.join(first.filter("members > 1"), "root").filter(place != F.col("first"))
                    .select(place.alias("place")).distinct(), "going")
    sealed = Rows(docs)
    ident, text = sealed[id_col], sealed[text_col]
    own = F.struct(ident.isNull().alias("none"), F.coalesce(ident, F.lit(0)).alias("id"),
                   text_key(text).alias("text_key"))
    placed, may = sealed.df.withColumn("place", own), _sieve(going, "place")(F.col("place"))
    return sealed.restore(placed.filter(~may)).union(sealed.restore(placed.filter(may).join(going, "place", "left_anti")))


def _texts(docs: DataFrame, wanted: DataFrame, text_col: str) -> DataFrame:
    """(text_key, text) of the wanted keys, once each."""
    rows = pick(docs, text=text_col).withColumn("text_key", text_key(F.col("text")))
    return (rows.filter(_sieve(wanted, "text_key")(F.col("text_key")))
            .join(wanted.select("text_key"), "text_key", "left_semi")
            .groupBy("text_key").agg(F.max("text").alias("text")))


def _frequent(docs: DataFrame, wanted: DataFrame, k: int, text_col: str) -> tuple[np.ndarray, np.ndarray]:
    """The shingles that many of a sample of the wanted vertices have, sorted,
    and their counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, some in _sliced(b.column("text")):
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(shingle_sets(some, k)).view(np.int64))], ["node"])

    share = max(1 / 64, ORDER_SAMPLE / max(1, wanted.count()))
    some = wanted if share >= 1 else wanted.filter(hash63(23, F.col("key")) < share * float(2**63))
    found = (_texts(docs, some, text_col).select("text").mapInArrow(run, "node long").groupBy("node").agg(F.count(F.lit(1)).alias("n"))
             .filter("n > 3").orderBy(F.desc("n"), "node").limit(ORDER_KEPT).toArrow())
    names, counts = found.column("node").to_numpy().view(np.uint64), found.column("n").to_numpy()
    order = np.argsort(names)
    return names[order], counts[order]


def prefix_shingles(docs: DataFrame, wanted: DataFrame, k: int, percent: int, text_col: str = "text") -> DataFrame:
    """(node, key): the shingles of the prefixes of the wanted vertices (key,
    text_key).  Sets that are similar enough share at least ``percent`` of
    either one's shingles, so the least shingle they share, in an order that
    holds for all, has at most the others before it: it is in both prefixes."""
    shared = docs.sparkSession.sparkContext.broadcast(_frequent(docs, wanted, k, text_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, counts = shared.value
        for b in batches:
            for at, some in _sliced(b.column("text")):
                firsts = []
                for grams in shingle_sets(some, k):
                    seen = np.zeros(len(grams), np.int64)
                    if len(names):
                        i = np.minimum(np.searchsorted(names, grams), len(names) - 1)
                        seen = np.where(names[i] == grams, counts[i], 0)
                    firsts.append(grams[np.argsort(seen, kind="stable")][:prefix_length(len(grams), percent)])
                key = b.column("key").slice(at, len(some)).take(pa.array(np.repeat(np.arange(len(some)), [len(f) for f in firsts])))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(firsts).view(np.int64)), key], ["node", "key"])

    return _texts(docs, wanted, text_col).join(wanted, "text_key").select("key", "text").mapInArrow(run, "node long, key binary")


def prefix_length(n: int, percent: int) -> int:
    """Shingles of a set of ``n`` of which a similar enough set shares one."""
    return min(n, n - -(-percent * n // 100) + 1)


def _full_sets(docs: DataFrame, wanted: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """(cluster, size, key, grams) of the wanted vertices, from one text each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, some in _sliced(b.column("text")):
                sets = shingle_sets(some, k)
                part = b.slice(at, len(some))
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array([s.tobytes() for s in sets], pa.binary())],
                                                 ["cluster", "size", "key", "grams"])

    # Joined before the sets are made: texts and wanted rows lie by text_key.
    rows = _texts(docs, wanted, text_col).join(wanted, "text_key").select("cluster", "size", "key", "text")
    return rows.mapInArrow(run, "cluster binary, size long, key binary, grams binary")
