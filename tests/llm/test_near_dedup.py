import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.cases import awkward, awkward_rows, empty, plain, words
from trailmix.llm import near_dedup, queries
from trailmix.llm.components import components
from trailmix.llm.near_dedup import drop_near_duplicates, near_duplicates, shingle_sets, sketch

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def low(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def shingles(text, k):
    w = WORD.findall(low(text))
    if len(w) >= k:
        return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    return frozenset([tuple(w)]) if w else frozenset()


def brute(rows, k, percent):
    """(id, n, component, kept) of every row, from all pairs of distinct sets."""
    sets = [shingles(r[1], k) for r in rows]
    kinds = sorted({s for s in sets if s}, key=lambda s: sorted(s))
    up = {s: s for s in kinds}

    def root(s):
        while up[s] is not s:
            s = up[s]
        return s

    for i, a in enumerate(kinds):
        for b in kinds[:i]:
            if 100 * len(a & b) >= percent * len(a | b) and root(a) is not root(b):
                up[root(a)] = root(b)
    ids = defaultdict(list)
    for r, s in zip(rows, sets, strict=True):
        if s:
            ids[root(s)].append(r[0])
    out = Counter()
    for r, s in zip(rows, sets, strict=True):
        c = min((i for i in ids[root(s)] if i is not None), default=None) if s else r[0]
        out[r[0], len(s), c, r[0] is not None and r[0] == c] += 1
    return out


def got(df):
    return Counter(tuple(r) for r in df.collect())


def near_rows(seed, n=60, copies=25):
    """Texts, near copies of them at many distances, and chains of edits."""
    rng = random.Random(seed)
    texts = []
    for _ in range(n // 4):
        w = words(rng, rng.randrange(8, 120)).split()
        for _ in range(rng.randrange(1, 6)):
            v = list(w)
            for _ in range(rng.randrange(0, 1 + len(w) // 12)):
                v[rng.randrange(len(v))] = f"x{rng.randrange(99)}"
            texts.append(" ".join(v))
    base = words(rng, 200).split()
    for i in range(copies):
        v = list(base)
        v[(7 * i) % 200] = f"edit{i}"
        texts.append("  ".join(v).upper() if i % 3 else "\n".join(v))
    chain = list(base)
    for i in range(copies):
        chain[(11 * i) % 200] = f"step{i}"
        chain[(13 * i + 5) % 200] = f"more{i}"
        texts.append(" ".join(chain))
    rng.shuffle(texts)
    return [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]


def test_sets_equal_brute_force():
    rng = random.Random(2)
    texts = [None, "", " \t\n", "a", "A a", "a b c", "É é", "a\x0bb\x0cc d  e", "x" * 3000, "a\x1cb c　d"]
    texts += ["".join(rng.choice("aB \n\té") for _ in range(rng.randrange(200))) for _ in range(300)]
    for k in (1, 4, 5):
        sets = shingle_sets(texts, k)
        want = [shingles(t, k) for t in texts]
        assert [len(s) for s in sets] == [len(s) for s in want]
        names = {}
        for s, w in zip(sets, want, strict=True):
            assert names.setdefault(s.tobytes(), w) == w
        assert len(names) == len(set(want))


def test_sketches_estimate_similarity():
    rng = np.random.default_rng(0)
    for share in (0.5, 0.8, 0.95):
        agree = []
        for _ in range(60):
            u = np.unique(rng.integers(0, 1 << 63, 400, dtype=np.uint64) * np.uint64(2))
            n = int(len(u) * (1 - share) / 2)
            agree.append((sketch(u[n:]) == sketch(u[:len(u) - n])).mean())
        assert abs(np.mean(agree) - share) < 0.03


def test_common_sizes():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 40_000, rng.integers(0, 9000), dtype=np.uint64)) for _ in range(12)] + [np.zeros(0, np.uint64)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets[:7]]
    got_sizes = near_dedup._common(sets, 7)
    for i in range(7):
        assert [got_sizes[i, j] for j in range(13) if j != i] == [want[i][j] for j in range(13) if j != i]


def test_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(500, 560)] + [(900, x) for x in range(901, 1200)]
    up = list(range(1300))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        up[y] = x
    for per_task in (200_000, 150, 20):
        rows = components(spark.createDataFrame(edges, "a long, b long").repartition(30), per_task=per_task).collect()
        assert len(rows) == len({r["node"] for r in rows})
        assert {r["node"]: r["root"] for r in rows} == {x: root(x) for e in edges for x in e if e[0] != e[1]}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("leaf,block", [(256, 128), (6, 5)])
def test_equals_brute_force(spark, leaf, block):
    rows = near_rows(7)
    assert got(near_duplicates(plain(spark, rows), 4, 80, leaf=leaf, block=block)) == brute(rows, 4, 80)


def test_awkward(spark):
    assert got(near_duplicates(awkward(spark))) == brute(awkward_rows(), 5, 80)
    assert near_duplicates(empty(spark)).count() == 0


def test_rows_that_stay(spark):
    rows = near_rows(8, copies=8)
    df = plain(spark, rows)
    keep = sorted(i for (i, n, c, k), _ in brute(rows, 5, 80).items() if k)
    kept = drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == keep
    assert drop_near_duplicates(empty(spark)).count() == 0
    assert drop_near_duplicates(awkward(spark)).filter("doc_id is null").count() >= 2


def test_hot_group_makes_few_rows(spark):
    """A group of copies is one vertex, a dense group of near copies a forest."""
    rng = random.Random(9)
    base = words(rng, 100).split()
    rows = [(i, " ".join(base), "en", "s", 1) for i in range(200)]
    for i in range(200):
        v = list(base)
        v[i % 100] = f"edit{i}"
        rows.append((1000 + i, " ".join(v), "en", "s", 1))
    df = plain(spark, rows)
    sets = near_dedup.document_sets(df, 4, "doc_id", "text")
    vertices = sets.groupBy("key").agg({"sketch": "max"}).toDF("key", "sketch")
    assert vertices.count() == 201
    for leaf in (256, 20):
        clusters = near_dedup.candidate_clusters(vertices, leaf).collect()
        assert len(clusters) == 201 and len({r["cluster"] for r in clusters}) == 1
    out = near_duplicates(df, 4, 80).collect()
    assert {r["component_id"] for r in out} == {0}


def test_recall_in_large_nodes(spark):
    """Pairs of 0.8 to 0.85 among vertices that all share a third of their set,
    so that nodes stay large: at least 0.9 of them meet, at every leaf size."""
    rng = np.random.default_rng(11)
    new = lambda n: rng.integers(1, 1 << 63, n, dtype=np.uint64)
    core, sets, pairs = new(155), [], []
    for i in range(1300):
        one = np.concatenate([core, new(145)])
        sets.append(one)
        if i % 20 == 0:
            other = one.copy()
            n = int(rng.integers(24, 33))
            other[rng.permutation(300)[:n]] = new(n)
            pairs.append((len(sets) - 1, len(sets)))
            sets.append(other)
    rows = [(i.to_bytes(16, "big"), sketch(np.unique(s)).tobytes()) for i, s in enumerate(sets)]
    vertices = spark.createDataFrame(rows, "key binary, sketch binary")
    for leaf in (256, 40):
        of = {int.from_bytes(r["key"], "big"): bytes(r["cluster"]) for r in near_dedup.candidate_clusters(vertices, leaf).collect()}
        met = sum(of.get(a, a) == of.get(b, b) for a, b in pairs)
        assert met >= 0.9 * len(pairs), (leaf, met, len(pairs))


def test_caps_lose_nothing(spark, monkeypatch):
    """One tree of one root whose token all texts share: pairs of 0.8 and more
    in it meet, though only one pivot and one representative of each cluster
    stand for the rest."""
    for name in ("TREES", "ROOTS", "PIVOTS", "REPRESENTATIVES"):
        monkeypatch.setattr(near_dedup, name, 1)
    rng = random.Random(21)
    first, texts = 1 << 32, []
    while first > 1 << 23:                # a token so small that most texts have it
        core = words(rng, 60).split()
        first = sketch(shingle_sets([" ".join(core)], 4)[0])[0]
    for _ in range(60):
        v = core + words(rng, 90, 10**6).split()
        texts.append(" ".join(v))
        for j in rng.sample(range(60, 150), 3):
            v[j] = f"other{j}"
        texts.append(" ".join(v))
    texts = [t for t, s in zip(texts, shingle_sets(texts, 4), strict=True) if sketch(s)[0] == first]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)]
    want = brute(rows, 4, 80)
    assert sum(1 for (_, _, _, kept) in want if not kept) > 30
    assert got(near_duplicates(plain(spark, rows), 4, 80, leaf=20, block=5)) == want


def test_similar_sets_share_a_prefix_shingle(spark):
    rows = near_rows(31)
    df = plain(spark, rows)
    sets = near_dedup.document_sets(df, 4, "doc_id", "text")
    wanted = near_dedup.written(sets.groupBy("key").agg({"text_key": "min"}).toDF("key", "text_key"), "wanted")
    nodes = defaultdict(set)
    for r in near_dedup.prefix_shingles(df, wanted, 4, 80).collect():
        nodes[bytes(r["key"])].add(r["node"])
    of = {r["id"]: bytes(r["key"]) for r in sets.collect()}
    assert set(nodes) == set(of.values())
    for a, b in itertools.combinations(rows, 2):
        x, y = shingles(a[1], 4), shingles(b[1], 4)
        if 100 * len(x & y) >= 80 * len(x | y):
            assert nodes[of[a[0]]] & nodes[of[b[0]]]
    assert sum(map(len, nodes.values())) < 0.3 * sum(r["n"] for r in sets.dropDuplicates(["key"]).collect())


def test_a_hot_group_branches_by_a_few_rows(spark):
    """Beyond the first level the largest cluster of a node is a few rows."""
    rows = [(b"n", i.to_bytes(4, "big"), bytes(256), b"hot" if i % 10 else i.to_bytes(4, "big")) for i in range(2000)]
    level = spark.createDataFrame(rows + [(b"done", b"k%d" % i, bytes(256), b"one") for i in range(300)],
                                  "node binary, key binary, sketch binary, label binary")
    out = near_dedup._branched_on(level)
    assert out.filter("label = cast('hot' as binary)").count() == near_dedup.REPRESENTATIVES
    assert out.count() == 200 + near_dedup.REPRESENTATIVES


def test_only_wanted_texts_are_sent(spark):
    """Before a text goes to the join with the wanted ones a sieve takes most
    others out, and none that is wanted."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = [(i, f"text {i}", "en", "s", 1) for i in range(8000)]
        keyed = plain(spark, rows).withColumn("text_key", near_dedup.text_key(F.col("text")))
        wanted = near_dedup.written(keyed.filter("doc_id % 4 = 0").select("text_key"), "wanted")
        df = near_dedup._texts(plain(spark, rows), wanted, "text")
        assert sorted(r["text"] for r in df.collect()) == sorted(f"text {i}" for i in range(0, 8000, 4))
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"Exchange hashpartitioning\(text_key(?:(?!Exchange|Join).)*ArrowEvalPython \[holds", plan, re.S)
        passed = keyed.filter(near_dedup._sieve(wanted, "text_key")(F.col("text_key")))
        assert passed.filter("doc_id % 4 = 0").count() == 2000
        assert passed.filter("doc_id % 4 > 0").count() < 6000 / 50
        none = near_dedup._sieve(wanted.limit(0), "text_key")
        assert keyed.filter(none(F.col("text_key"))).count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_vertex_is_looked_up_once(spark):
    """Labels of a vertex in many nodes come from one row of the left join."""
    rows = spark.createDataFrame([(b"n%d" % n, b"k%d" % i) for n in range(12) for i in range(50)], "node binary, key binary")
    clusters = spark.createDataFrame([(b"k%d" % i, b"k0") for i in range(20)], "key binary, cluster binary")
    asked = []
    real, near_dedup.written = near_dedup.written, lambda df, name: asked.append(df) or real(df, name)
    try:
        out = near_dedup._labelled(rows, clusters).collect()
    finally:
        near_dedup.written = real
    assert len(asked) == 1
    assert Counter((bytes(r["key"]), bytes(r["label"])) for r in out) == {(b"k%d" % i, b"k0" if i < 20 else b"k%d" % i): 12 for i in range(50)}
    plan = asked[0]._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Join LeftOuter[^\n]*\n[ :+-]*Aggregate \[key", plan), plan


def test_rows_that_stay_do_not_go_to_the_join(spark):
    """Only rows that may go are sent; all columns of the others stay."""
    rows = near_rows(12, copies=10)
    df = plain(spark, rows)
    kept = drop_near_duplicates(df)
    keep = {i for (i, n, c, k), _ in brute(rows, 5, 80).items() if k}
    assert sorted(tuple(r) for r in kept.collect()) == sorted(r for r in rows if r[0] in keep)
    assert "holds" in kept._jdf.queryExecution().optimizedPlan().toString()


def test_query(spark):
    from tests.conftest import SF_SMALL
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    assert got(queries.op2_near_dedup(spark, SF_SMALL)) == brute(rows, 4, 80)
