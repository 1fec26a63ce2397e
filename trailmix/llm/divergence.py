"""Audit of how the sources of a language differ, by Gustavson row accumulation.

Terms are maximal runs of letters A-Z and of characters from U+0080 on; A-Z is
lower-cased.  Each language keeps the terms of at least ``min_docs`` of its
documents (V of them).  A group (language, source), and a language as a whole,
gives every kept term the smoothed share

    p = 1 + floor(SCALE * (count + 1) / (N + V))

N being its count over all kept terms.  Two shares differ by
``f(p, q) = floor((p - q)^2 / q)``.  All of it is whole-number arithmetic.

Part ``pair``: for each group and each other source of its language, f summed
over all kept terms.  Part ``term``: for each group, its terms with a larger
share than in the language, the ``top`` largest f.

Pairs of groups.  Nearly all counts are zero, and a zero count has the group's
base share b.  So the sum over all terms is

    V f(b_g, b_h) + sum over g's terms of f(p_g, b_h) - f(b_g, b_h)
                  + sum over h's terms of f(b_g, p_h) - f(b_g, b_h)
                  + sum over common terms of
                        f(p_g, p_h) - f(p_g, b_h) - f(b_g, p_h) + f(b_g, b_h)

The first three need only how often a group has each share (``_bases``).  The
last is a sparse product: a task holds the term-major index of a block of one
language's terms, and each group in turn scatters its terms through that index
into a dense accumulator with one cell for each peer.  A posting pair is a
numpy addition and never a row; a task gives at most one row for each pair of
groups that meet in its block.

A term of all sources or a source of a third of all rows is spread by the
blocks: rows go by (language, hash of the term).  The table of groups is
broadcast only up to ``MAX_BROADCAST_GROUPS`` rows, else joined by salted keys.

Defined results.  Null text, language or source: as ''.  Groups without terms
have base shares only.  No kept term in a language: all its pairs have value 0
and it has no ``term`` rows.  Ties rank by the item's UTF-8 bytes.  Repeated
rows count as documents of their own.  Empty table: no rows.  Extra columns
are not read.  Texts of any length: cut at ``_SLICE_BYTES`` between terms.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trailmix.llm.common import pick, release, ship, whole_groups, written

SCALE = 1_000_000_000
MIN_DOCS = 3
TOP = 200
# Rows of the groups table (about 100 bytes each) up to which it is broadcast.
MAX_BROADCAST_GROUPS = 50_000
# Distinct (group, term) entries that a task holds before it sends them on.
HELD_TERMS = 400_000
# Index entries of one block of terms, about.
BLOCK_ROWS = 50_000
# Posting pairs that are added at a time.
_SCATTER = 1 << 20
_SLICE_BYTES = 1 << 22
_PEERS = 4096
_SALTS = 32
_DF = (1 << 40) - 1

# Bytes of terms, A-Z in lower case; all others become spaces.
_TERM_BYTES = bytes((b + 32 if 65 <= b <= 90 else b) if 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _counted(raw: bytes) -> Counter:
    """How often each term occurs in a text."""
    if len(raw) <= _SLICE_BYTES:
        return Counter(raw.translate(_TERM_BYTES).split())
    clean, found, at = raw.translate(_TERM_BYTES), Counter(), 0
    while at < len(clean):
        end = clean.find(b" ", at + _SLICE_BYTES)
        end = len(clean) if end < 0 else end
        found.update(clean[at:end].split())
        at = end
    return found


def _task_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs) sums of a task's documents."""
    names = ["lang", "source", "term", "n", "docs"]
    groups: dict[tuple[str, str], dict[bytes, int]] = {}
    held = 0

    def sent() -> Iterator[pa.RecordBatch]:
        for (lang, source), terms in groups.items():
            both, keys = list(terms.values()), list(terms)
            for lo in range(0, len(keys), 20_000):
                part = both[lo:lo + 20_000]
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(part), pa.string()), pa.array([source] * len(part), pa.string()),
                    pa.array(keys[lo:lo + 20_000], pa.binary()), pa.array([x >> 40 for x in part], pa.int64()),
                    pa.array([x & _DF for x in part], pa.int64())], names)

    for b in batches:
        for lang, source, text in zip(*(b.column(c) for c in ("lang", "source", "text")), strict=True):
            into = groups.setdefault((lang.as_py(), source.as_py()), {})
            before = len(into)
            get = into.get
            for term, n in _counted(text.as_py()).items():
                into[term] = get(term, 0) + (n << 40) + 1
            held += len(into) - before
            if held > HELD_TERMS:
                yield from sent()
                groups, held = {}, 0
    yield from sent()


def kept_terms(docs: DataFrame, lang_col: str, source_col: str, text_col: str, min_docs: int) -> DataFrame:
    """(lang, source, term, n, n_lang, head) of every kept term that a group
    has; ``head`` marks one row for each term of a language."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")
    rows = pick(docs, lang=lang_col, source=source_col, text=text_col).select(*_group_cols(), text)
    sent = rows.mapInArrow(_task_counts, "lang string, source string, term binary, n long, docs long")
    # Tasks have combined their own rows; one shuffle serves all that follows.
    dealt = sent.withColumn("term", F.col("term").cast("string")).repartition("lang", "term")
    counts = dealt.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    over = Window.partitionBy("lang", "term")
    marked = counts.select("lang", "source", "term", "n", F.sum("n").over(over).alias("n_lang"),
                           F.sum("docs").over(over).alias("docs_lang"),
                           (F.min("source").over(over) == F.col("source")).alias("head"))
    return marked.filter(F.col("docs_lang") >= min_docs).drop("docs_lang")


def _group_cols() -> list[Column]:
    return [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]


def share(count: str, total: str) -> Column:
    """1 + floor(SCALE * (count + 1) / total), exact for any count."""
    return F.expr(f"1 + (CAST({SCALE} AS DECIMAL(10, 0)) * CAST({count} + 1 AS DECIMAL(20, 0))) div CAST({total} AS DECIMAL(20, 0))")


def f(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / q); shares are below 2^30, so squares fit."""
    gap = p - q
    return gap * gap // q


def _groups(docs: DataFrame, lang_col: str, source_col: str, terms: DataFrame) -> DataFrame:
    """(lang, source, gid, peers, total, base, V, lang_total): every group,
    numbered from 0 within its language; base and total are those of its shares."""
    every = pick(docs, lang=lang_col, source=source_col).select(*_group_cols()).distinct()
    sums = terms.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    langs = terms.groupBy("lang").agg(F.sum("n").alias("lang_n"), F.sum(F.col("head").cast("long")).alias("V"))
    full = every.join(sums, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0)
    within = Window.partitionBy("lang")
    rows = full.select(
        "lang", "source", (F.row_number().over(within.orderBy("source")) - 1).alias("gid"),
        F.count(F.lit(1)).over(within).cast("int").alias("peers"), (F.col("n") + F.col("V")).alias("total"), "V",
        (F.col("lang_n") + F.col("V")).alias("lang_total"))
    return rows.withColumn("base", F.when(F.col("V") > 0, share("0L", "greatest(total, 1)")).otherwise(1))


def _with_groups(terms: DataFrame, groups: DataFrame, small: bool) -> DataFrame:
    if small:
        return terms.join(F.broadcast(groups), ["lang", "source"])
    salted = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))))
    return terms.withColumn("salt", F.pmod(F.xxhash64("term"), F.lit(_SALTS)).cast("int")) \
        .join(salted, ["lang", "source", "salt"]).drop("salt")


_PAIRS = "lang string, g int, h int, part long"
_PAIR_NAMES = ["lang", "g", "h", "part"]


def _pair_rows(lang: str, g: np.ndarray, h: np.ndarray, part: np.ndarray) -> pa.RecordBatch:
    some = g != h
    return pa.RecordBatch.from_arrays([
        pa.array([lang] * int(some.sum()), pa.string()), pa.array(g[some].astype(np.int32)),
        pa.array(h[some].astype(np.int32)), pa.array(part[some])], _PAIR_NAMES)


def accumulate(new_term: np.ndarray, gid: np.ndarray, p: np.ndarray, base: np.ndarray, peers: int) -> Iterator[tuple[int, np.ndarray]]:
    """(group, its dense accumulator over all peers) of one block of terms.

    Rows are the index, term by term; ``new_term`` marks where a term begins.
    """
    first = np.flatnonzero(new_term)
    term = np.cumsum(new_term) - 1
    ends = np.append(first[1:], len(gid))
    order = np.argsort(gid, kind="stable")
    cuts = np.flatnonzero(np.diff(gid[order])) + 1
    for own in np.split(order, cuts):
        acc = np.zeros(peers, np.int64)
        size = (ends - first)[term[own]]
        at = 0
        while at < len(own):
            upto = at + max(1, int(np.searchsorted(np.cumsum(size[at:]), _SCATTER, side="right")))
            rows, n = own[at:upto], size[at:upto]
            peer = np.repeat(first[term[rows]] - np.cumsum(n) + n, n) + np.arange(n.sum())
            pg, bg, ph, bh = np.repeat(p[rows], n), base[rows[0]], p[peer], base[peer]
            np.add.at(acc, gid[peer], f(pg, ph) - f(pg, bh) - f(bg, ph) + f(bg, bh))
            at = upto
        yield int(gid[own[0]]), acc


def _changes(values: pa.Array) -> np.ndarray:
    """True at each value that differs from the one before it, and at the first."""
    new = np.ones(len(values), bool)
    if len(values) > 1:
        new[1:] = pc.not_equal(values.slice(1), values.slice(0, len(values) - 1)).to_numpy(zero_copy_only=False)
    return new


def _scattered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in whole_groups(batches, "cell"):
        table = table.combine_chunks()
        cells = np.flatnonzero(_changes(table.column("cell").combine_chunks()))
        for at, end in zip(cells, [*cells[1:], len(table)], strict=True):
            block = table.slice(at, end - at)
            new = _changes(block.column("term").combine_chunks())
            gid, p, base = (block.column(c).to_numpy() for c in ("gid", "p", "base"))
            lang, peers = block.column("lang")[0].as_py(), block.column("peers")[0].as_py()
            for g, acc in accumulate(new, gid, p, base, peers):
                met = np.flatnonzero(acc)
                yield _pair_rows(lang, np.full(len(met), g), met, acc[met])


def _bases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each group's terms add to its pairs with peers that lack them, in
    both directions; the row without shares adds the terms that both lack."""
    for b in batches:
        for r in b.to_pylist():
            h = np.array([x["gid"] for x in r["others"]], np.int64)
            bh = np.array([x["base"] for x in r["others"]], np.int64)
            bg, g = np.int64(r["base"]), np.full(len(h), r["gid"])
            out = np.int64(r["V"]) * f(bg, bh) if r["shares"] is None else np.zeros(len(h), np.int64)
            back = np.zeros(len(h), np.int64)
            shares = r["shares"] or []
            for lo in range(0, len(shares), 128):
                p = np.array([x["p"] for x in shares[lo:lo + 128]], np.int64)[:, None]
                m = np.array([x["m"] for x in shares[lo:lo + 128]], np.int64)[:, None]
                out += (m * (f(p, bh) - f(bg, bh))).sum(0)
                back += (m * (f(bh, p) - f(bh, bg))).sum(0)
            yield _pair_rows(r["lang"], g, h, out)
            if shares:
                yield _pair_rows(r["lang"], h, g, back)


def pair_values(points: DataFrame, groups: DataFrame, small: bool, blocks: int) -> DataFrame:
    """(lang, g, h, value) of all ordered pairs of a language's groups."""
    # Shares of a group and how many terms have each; at most _PEERS counts a row.
    shares = (points.groupBy("lang", "gid", "base", "V", "n", "p").agg(F.count(F.lit(1)).alias("m"))
              .groupBy("lang", "gid", "base", "V", F.shiftright("n", 12).alias("cell"))
              .agg(F.collect_list(F.struct("p", "m")).alias("shares")).drop("cell"))
    none = F.lit(None).cast(shares.schema["shares"].dataType).alias("shares")
    rows = shares.unionByName(groups.select("lang", "gid", "base", "V", none))
    others = (groups.groupBy("lang", F.floor(F.col("gid") / _PEERS).alias("cell"))
              .agg(F.collect_list(F.struct("gid", "base")).alias("others")).drop("cell"))  # at most _PEERS
    base = rows.join(F.broadcast(others) if small else others, "lang") \
        .select("lang", "gid", "base", "V", "shares", "others").mapInArrow(_bases, _PAIRS)
    cell = F.concat_ws(":", F.pmod(F.xxhash64("term"), F.lit(blocks)), "lang")
    index = points.select(cell.alias("cell"), "lang", "term", "gid", "peers", "p", "base")
    met = index.repartition("cell").sortWithinPartitions("cell", "term").mapInArrow(_scattered, _PAIRS)
    return base.unionByName(met).groupBy("lang", "g", "h").agg(F.sum("part").alias("value"))


def source_divergence(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
                      min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank."""
    spark = docs.sparkSession
    ship(spark)
    terms = written(kept_terms(docs, lang_col, source_col, text_col, min_docs), "kept-terms")
    groups = written(_groups(docs, lang_col, source_col, terms), "groups")
    small = groups.count() <= MAX_BROADCAST_GROUPS
    points = written(_with_groups(terms, groups, small)
                     .withColumns({"p": share("n", "total"), "q": share("n_lang", "lang_total")})
                     .drop("total", "lang_total", "head", "n_lang"), "shares")
    release(terms)

    blocks = max(1, points.count() // BLOCK_ROWS)
    values = pair_values(points, groups, small, blocks)
    name = F.broadcast if small else (lambda df: df)
    names = groups.select("lang", "gid", "source")
    pairs = (values.join(name(names.withColumnRenamed("gid", "g")), ["lang", "g"])
             .join(name(names.select("lang", F.col("gid").alias("h"), F.col("source").alias("item"))), ["lang", "h"])
             .select("lang", "source", F.lit("pair").alias("part"), "item", "value"))
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.withColumn("rank", F.row_number().over(ranked))

    over = points.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                         F.expr("(p - q) * (p - q) div q").alias("value"),
                                         F.pmod(F.xxhash64("term"), F.lit(_SALTS)).alias("salt"))
    # A group's best terms are among the best of each part of it.
    local = Window.partitionBy("lang", "source", "salt").orderBy(F.desc("value"), "item")
    best = over.withColumn("rank", F.row_number().over(local)).filter(F.col("rank") <= top).drop("rank", "salt")
    best = best.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= top)
    return pairs.unionByName(best).select(
        F.col("lang").alias(lang_col), F.col("source").alias(source_col), "part", "item", "value", "rank")
