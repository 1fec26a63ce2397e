"""Registered queries: each operator over its whole table, with production
parameters, reduced to the columns that its contract names."""

from __future__ import annotations

import os
import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmix.llm import (bpe, divergence, exact_dedup, language, lines, near_dedup, packing, pii, quality, sharding, spelling,
                          token_file, warc)
from trailmix.llm.common import documents
from trailmix.session import ensure_checkpoint_dir

SHARDS = 24
WINDOW = 4096
# Key of the surrogates; a production run passes its own.
KEY = b"trailmix-surrogates"


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.stratified_shards(documents(spark, sf_dir), SHARDS)
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir)).drop("copies")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), WINDOW, public_tokenizers.path("word_bpe_49k.json"), 2)


def op7_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{uuid.uuid4().hex}-token-file"
    token_file.write_token_file(documents(spark, sf_dir), path, public_tokenizers.path("byte_bpe_50k.json"), 0, 50_257)
    return token_file.read_token_file(spark, path, ids=False)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                                public_tokenizers.PATTERN, digest=True)


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(documents(spark, sf_dir), k=4, percent=80)


def op10_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.drop_repeated_passages(documents(spark, sf_dir))


def op5_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace_personal_data(documents(spark, sf_dir), KEY).select("doc_id", "text", "n_replaced", "kinds")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(documents(spark, sf_dir))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(os.path.join(sf_dir, "labels.parquet"))
    return quality.quality(documents(spark, sf_dir), labels)


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(documents(spark, sf_dir))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc.warc_folder(spark)
    warc.archive_pages(spark.read.parquet(os.path.join(sf_dir, "pages.parquet")), path)
    return warc.read_pages(spark, path)


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(documents(spark, sf_dir), damage=spelling.damaged)


QUERIES = {f.__name__: f for f in (op1_sharding, op2_near_dedup, op3_exact_dedup, op4_packing, op5_surrogates, op6_language,
                                    op7_token_file, op8_quality, op9_bpe, op10_lines, op11_divergence,
                                    op12_warc, op13_spelling)}

ORACLE = {
    "op2_near_dedup": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
e AS (SELECT doc_id, w, len(w) AS k, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM d WHERE len(w) > 0),
g AS (SELECT DISTINCT doc_id, CASE WHEN k < 4 THEN array_to_string(w, ' ')
                                   ELSE w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] END AS x FROM e),
s AS (SELECT d.doc_id, coalesce(max(z.n), 0) AS n FROM d LEFT JOIN (SELECT doc_id, count(*) AS n FROM g GROUP BY 1) z ON d.doc_id = z.doc_id GROUP BY 1),
p AS (SELECT g.doc_id, s.n, g.x FROM g JOIN s ON g.doc_id = s.doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS i
      FROM p a JOIN p b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY 1, 2, 3, 4),
l AS (SELECT a, b FROM c WHERE 100 * i >= 80 * (na + nb - i)),
r(id, reach) AS (SELECT doc_id, doc_id FROM s UNION SELECT r.id, l.b FROM r JOIN l ON r.reach = l.a),
m AS (SELECT id, min(reach) AS component_id FROM r GROUP BY id)
SELECT s.doc_id, s.n AS n_shingles, m.component_id, s.doc_id = m.component_id AS kept
FROM s JOIN m ON s.doc_id = m.id
""",
    "op3_exact_dedup": """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g ON d.t = g.t
""",
    "op11_divergence": r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
e AS (SELECT r, lang, source, unnest(w) AS term FROM d),
c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS docs FROM e GROUP BY ALL),
k AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY ALL HAVING sum(docs) >= 3),
g AS (SELECT DISTINCT lang, source FROM d),
t AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS all_n
      FROM g JOIN k ON g.lang = k.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
s AS (SELECT lang, source, term, n,
             1 + (CAST(1000000000 AS HUGEINT) * (n + 1)) // (sum(n) OVER w + count(*) OVER w) AS p,
             1 + (CAST(1000000000 AS HUGEINT) * (all_n + 1)) // (sum(all_n) OVER w + count(*) OVER w) AS q
      FROM t WINDOW w AS (PARTITION BY lang, source)),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
      FROM s a JOIN s b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
v AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
      UNION ALL
      SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM s WHERE n > 0 AND p > q),
o AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM v)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM o WHERE part = 'pair' OR rank <= 200
""",
    "op12_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
s AS (SELECT page_id, strlen(html) AS n, sha1(html) AS digest, max(page_id) OVER (PARTITION BY html) AS best FROM p)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> best THEN 'revisit' ELSE 'response' END AS record_type,
       CAST(CASE WHEN n >= 1000 AND page_id <> best THEN best END AS BIGINT) AS refers_to
FROM s
""",
}
