"""Connected components of an edge table, as Spark jobs."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmix.llm.common import ship, written

MAX_ROUNDS = 60
# Edges that one task contracts at a time (about 100 MB).
EDGES_PER_TASK = 200_000


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The task's edges as stars: every node linked to the least one it reaches."""
    up: dict = {}

    def root(x):
        while (y := up.setdefault(x, x)) != x:
            up[x] = up[y]
            x = y
        return x

    schema = None
    for b in batches:
        schema = b.schema
        for x, y in zip(b.column("hi").to_pylist(), b.column("lo").to_pylist(), strict=True):
            x, y = root(x), root(y)
            if x != y:
                up[max(x, y)] = min(x, y)
    if schema is not None:
        pairs = [(x, r) for x in up if (r := root(x)) != x]
        for lo in range(0, len(pairs), 10_000):
            part = pairs[lo:lo + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in part], schema.field(i).type) for i in (0, 1)], ["hi", "lo"])


def components(edges: DataFrame, rounds: int = MAX_ROUNDS, per_task: int = EDGES_PER_TASK) -> DataFrame:
    """(node, root) for every node of an edge other than a loop, root included;
    root is the least node of the component.

    ``edges`` has columns a and b of one ordered type.  A round contracts the
    edges of each task to stars; while there is more than one task, it then
    links every neighbour to the least node known around it, first over larger
    neighbours, then over smaller ones.  Rounds go on until one task holds what
    is left or nothing changes.  A neighbourhood is only ever aggregated to its
    minimum, never collected, and no task holds more than ``per_task`` edges.
    """
    ship(edges.sparkSession)
    kind = dict(edges.dtypes)["a"]

    def oriented(e):
        return (e.filter("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")))

    def state(e):
        return tuple(e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo"))).first())

    now = written(oriented(edges), "edges")
    seen = state(now)
    for _ in range(rounds):
        tasks = max(1, -(-seen[0] // per_task))
        stars = now.coalesce(tasks).mapInArrow(_contracted, f"hi {kind}, lo {kind}")
        if tasks == 1:
            return _rooted(written(stars, "stars"))
        both = written(stars.distinct(), "edges")
        both = both.union(both.select("lo", "hi")).toDF("a", "b")
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = oriented(both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi")
        now = written(oriented(small.select(F.col("lo").alias("a"), F.col("m").alias("b"))
                               .union(least.select("hi", "m"))).distinct(), "edges")
        was, seen = seen, state(now)
        if was == seen:
            return _rooted(now)
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def _rooted(stars: DataFrame) -> DataFrame:
    found = stars.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return found.union(found.select("root", "root").distinct())
