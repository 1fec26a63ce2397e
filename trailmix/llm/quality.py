"""Quality rules and a log-likelihood ratio (DataFrame operations only).

Base rules are expressions over a text's words ``[^\\x20\\x09-\\x0D]+`` and
lines.  The verdict on top of them compares two multinomials over hashed
n-grams: each word and each pair of neighbouring words.  One is estimated from
trusted documents (``labels`` with quality 1), the other from every document of
the raw corpus.  A document's score is the mean over its n-grams of

    log((trusted[b] + 1) / (trusted + buckets)) - log((raw[b] + 1) / (raw + buckets))

and every document at or above ``THRESHOLD`` (nats per n-gram) is kept.

Counts cover all documents and all trusted ones.  The raw side is counted where
it is read; only for the trusted side are ids and texts joined with the labels,
by the same sort-merge plan at every size.  N-grams are counted in
``MAX_BUCKETS`` buckets and folded to the power of two that has room for those
that occur, so the model grows with the corpus up to that bound.  The weights
are one number for each bucket and become part of the scoring expression, so
scoring is one projection: no shuffle, no row identity.

Defined results.  Null text: no words.  A text without words: score 0, base
failed.  No trusted documents: all scores 0, so the base rules decide.  Null
ids are never trusted.  Repeated rows and copies count as often as they occur.
Empty table: no rows.  Extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmix.llm.common import pick

# Buckets of a model at most (a number each in the scoring expression).
MAX_BUCKETS, MIN_BUCKETS = 1 << 17, 1 << 12
THRESHOLD = -0.2
SPACE = r"[ \t-\r]"
SYMBOLS = "[^#*$%&|<>]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once for each row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")


def repeated_words(w: Column) -> Column:
    """Words inside 3-word windows that occur twice or more, first included."""
    def windows(i):
        return F.xxhash64(w[i], w[i + 1], w[i + 2])

    def covered(p):
        steps = F.transform(p, lambda x, j: F.when(j == 0, F.lit(3)).otherwise(F.least(F.lit(3), x - F.get(p, j - 1))))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    def again(s):
        twin = F.filter(s, lambda x, j: (x["h"] == F.get(s, j - 1)["h"]) | (x["h"] == F.get(s, j + 1)["h"]))
        return let(F.array_sort(F.transform(twin, lambda x: x["i"])), covered)

    def of(g):
        some = let(F.array_sort(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), again)
        return F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0).cast("long")).otherwise(some)

    grams = F.transform(F.sequence(F.lit(0), F.size(w) - 3), windows)
    return F.when(F.size(w) < 4, F.lit(0).cast("long")).otherwise(let(grams, of))


def base_columns(text: Column) -> dict[str, Column]:
    """The rules' figures, given a column ``words`` beside the text."""
    body = F.coalesce(text, F.lit(""))
    w = F.col("words")
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike("[^ \t-\r]"))
    return {
        "n_words": F.size(w).cast("long"),
        "word_chars": F.char_length(F.array_join(w, "")).cast("long"),
        "n_symbols": F.char_length(F.regexp_replace(body, SYMBOLS, "")).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": repeated_words(w),
    }


def word_bucket(word: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(0), word), F.lit(n)).cast("int")


def pair_bucket(word: Column, after: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(1), word, after), F.lit(n)).cast("int")


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids of the documents of quality 1."""
    return pick(labels, id="doc_id", quality="quality").filter("quality = 1 and id is not null").select("id").distinct()


def bucket_counts(rows: DataFrame, name: str, buckets: int) -> DataFrame:
    """(bucket, <name>): n-grams of the texts in each bucket."""
    def buckets_of(w):
        firsts = F.slice(w, 1, F.greatest(F.size(w) - 1, F.lit(0)))
        return F.concat(F.transform(w, lambda x: word_bucket(x, buckets)),
                        F.transform(firsts, lambda x, i: pair_bucket(x, F.get(w, i + 1), buckets)))

    return (rows.select(F.explode(let(words(F.col("text")), buckets_of)).alias("bucket"))
            .groupBy("bucket").agg(F.count(F.lit(1)).alias(name)))


def model_counts(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, buckets: int) -> DataFrame:
    """(bucket, raw, trusted): n-grams of all documents and of trusted ones."""
    rows = pick(docs, id=id_col, text=text_col)
    raw = bucket_counts(rows.select("text"), "raw", buckets)
    trusted = bucket_counts(rows.filter("id is not null").join(trusted_ids(labels).hint("merge"), "id"), "trusted", buckets)
    return raw.join(trusted, "bucket", "left").select("bucket", "raw", F.coalesce("trusted", F.lit(0)).alias("trusted"))


def folded(counts: list[tuple[int, int, int]], buckets: int | None) -> tuple[list[tuple[int, int, int]], int]:
    """Counts in as many buckets as there is use for, and that number."""
    if buckets is None:
        buckets = MIN_BUCKETS
        while buckets < MAX_BUCKETS and buckets < 2 * len(counts):
            buckets *= 2
    sums: dict[int, tuple[int, int]] = {}
    for b, r, t in counts:
        x, y = sums.get(b % buckets, (0, 0))
        sums[b % buckets] = (x + r, y + t)
    return [(b, r, t) for b, (r, t) in sums.items()], buckets


def weights(counts: list[tuple[int, int, int]], buckets: int) -> list[float]:
    """Log ratio of each bucket from (bucket, raw, trusted) rows."""
    n_raw, n_trusted = sum(c[1] for c in counts), sum(c[2] for c in counts)
    if not n_trusted:
        return [0.0] * buckets
    by = {b: (r, t) for b, r, t in counts}
    out = []
    for b in range(buckets):
        r, t = by.get(b, (0, 0))
        out.append(round(math.log((t + 1) / (n_trusted + buckets)) - math.log((r + 1) / (n_raw + buckets)), 6))
    return out


def score(w: Column, table: list[float]) -> Column:
    """Mean weight of the n-grams of a word list."""
    values = F.split(F.lit(",".join(map(str, table))), ",").cast("array<double>")  # folded to one constant
    n = len(table)

    def of(x, i):
        pair = F.get(values, pair_bucket(x, F.get(w, i + 1), n))
        return F.get(values, word_bucket(x, n)) + F.when(i + 1 < F.size(w), pair).otherwise(F.lit(0.0))

    total = F.aggregate(F.transform(w, of), F.lit(0.0), lambda a, x: a + x)
    return F.when(F.size(w) == 0, F.lit(0.0)).otherwise(total / (2 * F.size(w) - 1))


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            buckets: int | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: id, the base figures, base_failed, score, kept.
    ``buckets``: a power of two up to MAX_BUCKETS (default: as many as the
    n-grams need)."""
    counts = model_counts(docs, labels, id_col, text_col, MAX_BUCKETS)
    table = weights(*folded([tuple(r) for r in counts.collect()], buckets))  # at most MAX_BUCKETS rows
    rows = pick(docs, id=id_col, text=text_col).withColumn("words", words(F.col("text")))
    figures = rows.select("id", F.struct(*[c.alias(n) for n, c in base_columns(F.col("text")).items()],
                                         score(F.col("words"), table).alias("score")).alias("f")).select("id", "f.*")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (figures.withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold)).withColumnRenamed("id", id_col))
