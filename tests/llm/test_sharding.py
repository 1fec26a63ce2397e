import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tests.llm.cases import awkward, awkward_rows, empty
from trailmix.llm import queries
from trailmix.llm.sharding import offset, stratified_shards, write_shards


def check_law(rows, n):
    by = defaultdict(list)
    for r in rows:
        by[r["shard"]].append(r)
    sizes = [len(by[s]) for s in range(n)]
    assert max(sizes) - min(sizes) <= 1
    for s in by.values():
        assert sorted(r["slot"] for r in s) == list(range(len(s)))
    assert sorted(r["position"] for r in rows) == list(range(len(rows)))


def brute(spark, rows, seed=7):
    """Positions by sorting all rows by fractional rank, given each source's order."""
    names = spark.createDataFrame([(r["source"],) for r in rows], "source string").distinct()
    u = {r["source"]: r["u"] for r in names.withColumn("s", F.struct(
        F.col("source").isNull().alias("none"), F.coalesce("source", F.lit("")).alias("name"))).withColumn("u", offset(seed, F.col("s"))).collect()}
    assert all(0 < x < 1 for x in u.values()) and len(set(u.values())) == len(u)
    total, by = Counter(r["source"] for r in rows), defaultdict(list)
    for r in sorted(rows, key=lambda r: r["position"]):
        by[r["source"]].append(r)
    order = [((k + 1 - u[s]) / total[s], (s is None, s or ""), r) for s, rs in by.items() for k, r in enumerate(rs)]
    return [r["position"] for *_, r in sorted(order, key=lambda x: (x[0], x[1][0], x[1][1]))]


def test_interleaving(spark):
    rows = [r.asDict() for r in stratified_shards(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), 24).collect()]
    check_law(rows, 24)
    assert brute(spark, rows) == list(range(len(rows)))


def test_mixture_with_a_hot_source(spark):
    df = spark.range(9000).selectExpr("id AS doc_id", "'t' AS text", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('s', id % 7) END AS source")
    rows = [r.asDict() for r in stratified_shards(df, 10).collect()]
    check_law(rows, 10)
    share = Counter(r["source"] for r in rows)
    for s in range(10):
        here = Counter(r["source"] for r in rows if r["shard"] == s)
        assert all(abs(here[k] - n / 10) <= 2 for k, n in share.items())
    again = {r["doc_id"]: r["position"] for r in stratified_shards(df.repartition(7), 10).collect()}
    assert again == {r["doc_id"]: r["position"] for r in rows}
    other = {r["doc_id"]: r["position"] for r in stratified_shards(df, 10, seed=8).collect()}
    assert other != again


def test_many_sources_of_one_row_spread_evenly(spark):
    df = spark.range(1000).selectExpr("id AS doc_id", "'t' AS text", "CASE WHEN id < 400 THEN concat('one', id) WHEN id < 700 THEN 'a' ELSE 'b' END AS source")
    rows = [r.asDict() for r in stratified_shards(df, 10).collect()]
    check_law(rows, 10)
    assert brute(spark, rows) == list(range(len(rows)))
    for s in range(10):
        here = Counter(r["source"][:3] for r in rows if r["shard"] == s)
        assert abs(here["one"] - 40) <= 18 and abs(here["a"] - 30) <= 12 and abs(here["b"] - 30) <= 12


def test_awkward(spark):
    rows = [r.asDict() for r in stratified_shards(awkward(spark), 4).collect()]
    check_law(rows, 4)
    raw = [(r[0], r[1] or "") for r in awkward_rows()]
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter(
        (i, len(t.encode()) + 8, zlib.crc32(t.encode())) for i, t in raw)
    assert brute(spark, rows) == list(range(len(rows)))
    assert stratified_shards(empty(spark), 4).count() == 0


def test_write(spark, scratch):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    write_shards(df, f"{scratch}/s", 5)
    back = spark.read.parquet(f"{scratch}/s")
    assert back.count() == df.count() and back.select("shard").distinct().count() == 5


def test_query(spark):
    out = queries.op1_sharding(spark, SF_SMALL)
    assert out.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert out.count() == 200
