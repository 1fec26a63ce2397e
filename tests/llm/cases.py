"""Small tables with the awkward cases every operator must define."""

import random

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType())])

# Extra columns that carry names the operators use themselves.
CLASH = ["ID", "Text", "digest", "shard", "slot", "size", "kept", "component_id", "rank", "n", "sequence_id"]


def words(rng, n, k=400):
    return " ".join(f"w{rng.randrange(k)}" for _ in range(n))


def awkward_rows(seed=5):
    rng = random.Random(seed)
    long_text = words(rng, 30_000, 5000) + " ééé ñ"
    rows = [
        (0, None, "en", "a", 0), (1, "", "en", "a", 0), (2, "  \n \t", None, None, 4), (3, "!!! ...", "en", None, 7),
        (4, "One two three four five six", "en", "b", 1), (5, "one TWO three four five six", "en", "b", 1),
        (5, "one TWO three four five six", "en", "b", 1), (None, "one two three four five six", None, "b", 1),
        (None, None, None, None, None), (None, "alone without id", "de", None, None),
        (6, "É é É", "fr", "b", 5), (7, "é é É", "fr", "b", 5), (8, "x", "en", "a", 1), (9, "a b", "en", "a", 3),
        (10, long_text, "en", "a", len(long_text)), (11, long_text, "en", "a", len(long_text)),
        (12, "line\n\nline\r\nline  \n", "en", "a", 9), (13, "tab\tsep  double  space ", "en", "a", 9),
        (14, "a\x1cb c　d don't <|endoftext|> ½²", "en", "a", 9),
    ]
    rows += [(100 + i, words(rng, 40), "en", "hot", 1) for i in range(60)]
    rows += [(200 + i, "the same copy of a text that is here many times", "en", "hot", 1) for i in range(50)]
    return rows


def awkward(spark):
    """The rows, with extra columns of clashing names."""
    rows = [r + tuple(f"{c}-{i}" for c in CLASH) for i, r in enumerate(awkward_rows())]
    schema = T.StructType(SCHEMA.fields + [T.StructField(c, T.StringType()) for c in CLASH])
    return spark.createDataFrame(rows, schema).repartition(5)


def plain(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
