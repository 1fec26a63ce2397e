"""A process function with several outputs of different types.

One pass makes a tagged union: a column ``tag`` and one struct column per
output, filled where the tag names it.  ``tagged`` builds it from expressions,
``tagged_by`` from a user's function over records; both are narrow.

``write_outputs`` writes the union of each micro-batch by one Spark job, a
folder per output, and then names the micro-batch's folder in a manifest: an
empty file, created at once.  So

* all outputs of an epoch become visible together, and none before it is whole;
* a replayed epoch that is in the manifest is left as it is, one that is not is
  written to a folder of its own, and what a failed attempt left is never read.

``read_output`` reads one output of the epochs in the manifest.
"""

from __future__ import annotations

import uuid
from collections import namedtuple
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StreamingQuery

from trailmix.session import checkpoint_location
from trailmix.streaming import sinks

TAG, EPOCH = "tag", "epoch"


def tagged(df: DataFrame, outputs: dict[str, tuple[Column | None, Sequence[Column]]]) -> DataFrame:
    """Union of ``{name: (predicate, columns)}``: a row goes to each output whose
    predicate holds (None: always; null: does not hold), in no order."""
    shapes = {name: df.select(*cols).schema for name, (_, cols) in outputs.items()}
    made = []
    for name, (predicate, cols) in outputs.items():
        entry = F.struct(F.lit(name).alias(TAG), *[
            (F.struct(*cols) if other == name else F.lit(None)).cast(shapes[other]).alias(other) for other in outputs])
        made.append(entry if predicate is None else F.when(predicate, entry))
    rows = df.select(F.explode(F.filter(F.array(*made), lambda e: e.isNotNull())).alias("__o"))
    return rows.select("__o.*")


def tagged_by(df: DataFrame, fn: Callable[[tuple], Iterable[tuple[str, tuple]]], outputs: dict[str, str]) -> DataFrame:
    """Union of what ``fn(record)`` yields: pairs of an output's name and a tuple
    of its fields (``outputs``: name -> DDL).  Records are named tuples; a field
    whose name Python can't use is read by its place."""
    shapes = {name: T._parse_datatype_string(ddl) for name, ddl in outputs.items()}
    shape = T.StructType([T.StructField(TAG, T.StringType()), *[T.StructField(n, s) for n, s in shapes.items()]])
    arrow = to_arrow_schema(shape)
    fields = {n: [f.name for f in s.fields] for n, s in shapes.items()}
    record = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = namedtuple("Record", record, rename=True)
        for batch in batches:
            tags: list[str] = []
            columns: dict[str, list] = {n: [] for n in fields}
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for name, values in fn(kind(*row)) or ():
                    if name not in fields:
                        raise ValueError(f"no output {name}")
                    tags.append(name)
                    for other, held in columns.items():
                        held.append(dict(zip(fields[name], values, strict=True)) if other == name else None)
            if tags:
                arrays = [pa.array(tags, pa.string()), *[pa.array(columns[n], arrow.field(n).type) for n in columns]]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.mapInArrow(run, shape)


class _Folder:
    """A folder of epochs and their manifest, through Hadoop's file systems."""

    def __init__(self, spark: SparkSession, root: str):
        self.data, self.manifest = f"{root}/data", f"{root}/manifest"
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._path(root).getFileSystem(self._conf)

    def make(self) -> None:
        self._fs.mkdirs(self._path(self.data))
        self._fs.mkdirs(self._path(self.manifest))

    def visible(self) -> dict[int, str]:
        """Epoch number -> its folder's name."""
        if not self._fs.exists(self._path(self.manifest)):
            return {}
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(self.manifest))]
        return {int(n.split("_")[0]): n for n in names if n[0].isdigit()}

    def publish(self, name: str) -> None:
        self._fs.createNewFile(self._path(f"{self.manifest}/{name}"))


def write_outputs(union: DataFrame, root: str, name: str, *, trigger: dict | None = None,
                  checkpoint: str | None = None) -> StreamingQuery:
    """Writes each micro-batch of a tagged union under ``root``; one checkpoint
    writes to a folder, another's folder is refused."""
    spark = union.sparkSession
    folder = _Folder(spark, root)
    checkpoint = checkpoint or checkpoint_location(spark, name)
    sinks._refuse_foreign(spark, checkpoint, folder.manifest)
    folder.make()

    def write(batch: DataFrame, epoch: int) -> None:
        if epoch in folder.visible():
            return
        attempt = f"{epoch}_{uuid.uuid4().hex}"
        batch.write.partitionBy(TAG).parquet(f"{folder.data}/{EPOCH}={attempt}")
        folder.publish(attempt)

    return sinks.write_batches(union, name, write, trigger=trigger, checkpoint=checkpoint)


def read_output(spark: SparkSession, root: str, name: str, shape: str | T.StructType, *,
                epochs: tuple[int, int] | None = None) -> DataFrame:
    """Rows of output ``name`` with its ``shape``, of all published epochs or of
    those from ``epochs[0]`` to ``epochs[1]``, with the epoch's number.  One call
    sees one state of the manifest, so two outputs read by ``epochs`` agree."""
    shape = T._parse_datatype_string(shape) if isinstance(shape, str) else shape
    lo, hi = epochs or (0, float("inf"))
    shown = [n for e, n in _Folder(spark, root).visible().items() if lo <= e <= hi]
    kept = T.StructType([T.StructField(name, shape), T.StructField(EPOCH, T.StringType()), T.StructField(TAG, T.StringType())])
    folder = _Folder(spark, root)
    folder.make()
    rows = spark.read.schema(kept).parquet(folder.data).filter((F.col(TAG) == name) & F.col(EPOCH).isin(shown))
    return rows.select(F.substring_index(EPOCH, "_", 1).cast("long").alias(EPOCH), *[F.col(f"{name}.{f.name}") for f in shape.fields])


def last_epoch(spark: SparkSession, root: str) -> int | None:
    """The latest published epoch."""
    return max(_Folder(spark, root).visible(), default=None)
