"""Sharding by proportional stratified interleaving.

The rows of each source are put in a seeded random order; a row's fractional
rank is ``(rank - u) / rows of its source``, where ``u`` is a seeded number
between 0 and 1 for each source (``offset``): sources of few rows, of which there
may be many, spread over the whole order instead of meeting at its middle.
Sorting all rows by fractional rank interleaves the sources in proportion, so
every cut of that order has the corpus's mixture; shard ``s`` of ``n`` takes the positions
``[ceil(s * N / n), ceil((s + 1) * N / n))``: counts differ by one at most
(law ``rows``).

Both orders are ranked over ranges of a uniform key (``common.ranked``), so a
source with most of the rows, or the whole table, never meets in one task.

Defined results.  Null source: a source of its own.  Null id: ordered by its
text's checksum.  Null text: size 8.  Repeated rows: each gets its own slot.
Empty table: no rows.  Extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmix.llm.common import hash63, pick, rank_bits, ranked, top_bits, written


def offset(seed: int, stratum: Column) -> Column:
    """Where a source's first row stands between 0 and its step: 32 bits of a hash."""
    return (top_bits(hash63(seed, stratum["none"], stratum["name"]), 32) + 0.5) / float(1 << 32)


def stratified_shards(docs: DataFrame, n_shards: int, seed: int = 7, id_col: str = "doc_id",
                      text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: id, source, size, text_crc32, position, shard, slot."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = pick(docs, id=id_col, text=text_col, source=source_col).select(
        "id", "source",
        F.struct(F.col("source").isNull().alias("none"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("name")).alias("stratum"),
        (F.octet_length(text).cast("long") + 8).alias("size"), F.crc32(text).alias("text_crc32"))
    rows = written(rows.withColumn("order_key", hash63(seed, F.col("id"), F.col("text_crc32"))), "shard-rows")
    total = rows.count()
    bits = rank_bits(spark, total)
    rows = ranked(rows.withColumn("order_range", top_bits(F.col("order_key"), bits)), ["stratum"], "order_range",
                  ["order_key", "id", "text_crc32", "size"], "rank", "stratum_n")
    mixed = written(rows.select("id", "source", "stratum", "size", "text_crc32", "rank",
                                ((F.col("rank") - offset(seed, F.col("stratum"))) / F.col("stratum_n")).alias("fraction")), "shard-mixed")
    mixed = mixed.withColumns({"one": F.lit(0), "part": F.floor(F.col("fraction") * (1 << bits))})
    placed = ranked(mixed, ["one"], "part", ["fraction", "stratum", "rank"], "position")
    at = F.col("position") - 1
    return placed.withColumn("shard_no", F.expr(f"(position - 1) * {n_shards} div {max(1, total)}")).select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "text_crc32",
        at.alias("position"), F.col("shard_no").cast("int").alias("shard"),
        (at - F.expr(f"(shard_no * {total} + {n_shards - 1}) div {n_shards}")).alias("slot"))


def write_shards(docs: DataFrame, path: str, n_shards: int, seed: int = 7, id_col: str = "doc_id",
                 text_col: str = "text", source_col: str = "source") -> None:
    """Write all rows, one folder ``shard=<k>`` each, sorted by slot.

    Rows are joined to their place on the id, which must be unique and not
    null here.
    """
    places = stratified_shards(docs, n_shards, seed, id_col, text_col, source_col).select(id_col, "shard", "slot")
    (docs.join(places, id_col).repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
