"""Exact de-duplication by skew-safe combining (DataFrame operations only).

Equal texts (after lower-casing A-Z; null counts as empty) form a group, of
which the row with the largest id stays.  Rows are combined in three steps,
each of which groups by the digest *and* the whole normalised text, so the
full content is compared every time:

1. inside each input partition (the map side of the aggregation);
2. over (digest, salt): a group of any size is dealt over ``salts`` tasks;
3. over digest: at most ``salts`` winners of a group meet.

Each row then looks up its group by digest.  Should a digest ever stand for
two contents, the rows of that digest are looked up by digest and content.

Defined results.  Null text: as empty text.  Null id: never stays while the
group has an id; a group with null ids only keeps one such row (``keep_id``
null).  Repeated rows (same id, same text): one of them is ``kept``.  Empty
table: no rows.  Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmix.llm.common import Rows, lower_ascii, pick, written

SALTS = 64


def sha256_hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _winners(rows: DataFrame, by_content: bool) -> DataFrame:
    """(digest, [norm], keep_id, group_size, contents) of each group."""
    salted = rows.groupBy("digest", "salt", "norm").agg(F.max("id").alias("best"), F.count(F.lit(1)).alias("n"))
    groups = (salted.repartition("digest").groupBy("digest", "norm")
              .agg(F.max("best").alias("best"), F.sum("n").alias("n")))
    if by_content:
        return groups.select("digest", "norm", F.col("best").alias("keep_id"), F.col("n").alias("group_size"))
    return groups.groupBy("digest").agg(
        F.max("best").alias("keep_id"), F.sum("n").alias("group_size"), F.count(F.lit(1)).alias("contents"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     salts: int = SALTS, digest: Callable[[Column], Column] = sha256_hex) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256 and
    copies (rows with this id and text)."""
    rows = pick(docs, id=id_col, text=text_col).select("id", lower_ascii(F.col("text")).alias("norm"))
    rows = rows.withColumns({"digest": digest(F.col("norm")),
                             "salt": F.pmod(F.xxhash64("id"), F.lit(salts))})
    won = written(_winners(rows, by_content=False), "exact-winners")
    clashes = won.filter("contents > 1").select("digest")
    keyed = rows.groupBy("digest", "id", *([] if digest is sha256_hex else [sha256_hex(F.col("norm")).alias("sha")])) \
        .agg(F.count(F.lit(1)).alias("copies"))
    sha = "digest" if digest is sha256_hex else "sha"
    found = keyed.join(won.filter("contents = 1"), "digest")
    cols = ["id", "keep_id", "group_size", "copies", F.col(sha).alias("text_sha256")]
    found = found.select(*cols)
    if not clashes.isEmpty():
        some = rows.join(clashes, "digest", "left_semi")
        same = (some.groupBy("digest", "norm", "id").agg(F.count(F.lit(1)).alias("copies"))
                .join(_winners(some, by_content=True), ["digest", "norm"])
                .withColumn("sha", sha256_hex(F.col("norm"))))
        found = found.unionByName(same.select("id", "keep_id", "group_size", "copies", F.col("sha").alias("text_sha256")))
    each = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")
    return found.select("*", each).select(
        F.col("id").alias(id_col), "keep_id", "group_size",
        (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        "text_sha256", "copies")


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns.

    Rows that go are taken out by an anti join on (id, digest).  Where a row
    that stays is there several times, the one with the greatest columns (in
    column order) is taken.
    """
    rows = Rows(docs)

    def row_key(ident, digest):
        return F.struct(ident.isNull().alias("none"), F.coalesce(ident, F.lit(0)).alias("id"), digest.alias("digest"))

    marks = written(exact_duplicates(docs, id_col, text_col).select(
        row_key(F.col(id_col), F.col("text_sha256")).alias("row_key"), "kept", "copies"), "exact-marks")
    keyed = rows.df.withColumn("row_key", row_key(rows[id_col], sha256_hex(lower_ascii(rows[text_col]))))
    # A key with one row either stays or goes; a repeated row that stays has
    # one kept mark among its copies.
    going = marks.filter("copies = 1 and not kept or copies > 1").select("row_key").distinct()
    again = marks.filter("copies > 1 and kept").select("row_key")
    single = rows.restore(keyed.join(going, "row_key", "left_anti"))
    if again.isEmpty():
        return single
    one = (keyed.join(again, "row_key", "left_semi").groupBy("row_key")
           .agg(F.max(F.struct(*rows.own)).alias("best")).select("best.*"))
    return single.union(rows.restore(one))
