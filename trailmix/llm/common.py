"""Shared helpers of the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
import weakref
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trailmix.session import ensure_checkpoint_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SHIPPED: set[str] = set()
_KEPT: dict[str, dict] = {}
# Tables of ``written`` that this process still holds, and their folders.
_WRITTEN: dict[int, tuple[weakref.ref, str]] = {}


def pick(df: DataFrame, **names: str) -> DataFrame:
    """Only the named input columns, under the names given.

    Columns are found by exact name (first match), so extra columns, also such
    that differ only in case or carry an output's name, never get in the way.
    A missing column is a ``ValueError``.
    """
    own = [f"c{i}" for i in range(len(df.columns))]
    at = {c: own[i] for i, c in reversed(list(enumerate(df.columns)))}
    if gone := [c for c in names.values() if c not in at]:
        raise ValueError(f"no column {', '.join(gone)} in {df.columns}")
    return df.toDF(*own).select(*[F.col(at[c]).alias(n) for n, c in names.items()])


class Rows:
    """A table whose columns are renamed by position, so that working columns
    and look-alike names cannot clash; ``restore`` gives the names back."""

    def __init__(self, df: DataFrame):
        self.names = df.columns
        self.own = [f"c{i}" for i in range(len(self.names))]
        self.df = df.toDF(*self.own)

    def __getitem__(self, name: str) -> Column:
        if name not in self.names:
            raise ValueError(f"no column {name} in {self.names}")
        return F.col(self.own[self.names.index(name)])

    def restore(self, df: DataFrame) -> DataFrame:
        return df.select(*self.own).toDF(*self.names)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is; null: empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once as Parquet under ``spark.checkpoint.dir`` and
    read back: cuts lineage, so that a lost executor costs no earlier stage."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{uuid.uuid4().hex}-{name}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _WRITTEN[id(out)] = (weakref.ref(out, lambda _, key=id(out): _WRITTEN.pop(key, None)), path)
    return out


def release(*tables: DataFrame) -> None:
    """Remove tables of ``written`` that nothing will read again: what was made
    from them has itself been written."""
    for table in tables:
        found = _WRITTEN.pop(id(table), None)
        if found and found[0]() is table:
            remove(table.sparkSession, found[1])


def remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def ship(spark: SparkSession) -> None:
    """Send this package's sources to the executors, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="trailmix-ship-"), "trailmix_src.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _SHIPPED.add(sc.applicationId)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def give_back() -> None:
    """Return freed memory of Arrow and of the C library to the machine, where
    they can: workers live on between tasks and stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass


def kept_in_worker(owner: str, key, make):
    """What an operator keeps in a Python worker between tasks (an encoder, a
    model).  One operator's things are kept at a time: those of others go when
    it asks for its own, so stages that share workers don't add up."""
    others = [o for o in _KEPT if o != owner]
    for other in others:
        del _KEPT[other]
    if others:
        gc.collect()
        give_back()
    own = _KEPT.setdefault(owner, {})
    if key not in own:
        own[key] = make()
    return own[key]


def rank_bits(spark: SparkSession, rows: int, rows_per_task: int = 1_000_000) -> int:
    """Bits of a uniform order key that cut it into ranges of about
    ``rows_per_task`` rows, at least one for each shuffle partition."""
    return max(1, (max(partitions(spark), rows // rows_per_task) - 1).bit_length())


def top_bits(key: Column, bits: int) -> Column:
    """The top bits of a 63-bit order key: a range number, ascending with it."""
    return F.shiftright(key, 63 - bits)


def hash63(seed: int, *cols: Column) -> Column:
    """A uniform non-negative long from a seed and columns."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 1)


def ranked(df: DataFrame, group: list[str], part: str, order: list[str],
           rank: str, total: str | None = None) -> DataFrame:
    """Rank from 1 within each group, without one task per group.

    ``part`` cuts each group's order into ranges (ascending with ``order``).
    Rows are ranked inside (group, range); a small table of range counts gives
    each range's start.  ``group`` columns must not be null.
    """
    counts = df.groupBy(*group, part).agg(F.count(F.lit(1)).alias("range_n"))
    before = Window.partitionBy(*group).orderBy(part)
    starts = counts.select(
        *group, part,
        (F.sum("range_n").over(before.rowsBetween(Window.unboundedPreceding, 0)) - F.col("range_n")).alias("range_at"),
        *([F.sum("range_n").over(Window.partitionBy(*group)).alias(total)] if total else []))
    inside = Window.partitionBy(*group, part).orderBy(*order)
    local = df.withColumn("range_k", F.row_number().over(inside).cast("long"))
    return (local.join(starts, [*group, part])
            .withColumn(rank, F.col("range_at") + F.col("range_k"))
            .drop("range_k", "range_at"))


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Batches of rows sorted by ``key``, cut again so that no key's rows lie
    in two of them.  Holds one batch and the rows of its last key."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        keys = b.column(key).to_numpy(zero_copy_only=False)
        other = np.flatnonzero(keys != keys[-1])
        at = int(other[-1]) + 1 if len(other) else 0
        if held and last != keys[0]:
            yield pa.Table.from_batches(held)
            held = []
        if at:
            yield pa.Table.from_batches([*held, b.slice(0, at)])
            held = []
        held.append(b.slice(at))
        last = keys[-1]
    if held:
        yield pa.Table.from_batches(held)
