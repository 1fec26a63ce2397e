import hashlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tests.llm.cases import CLASH, awkward, awkward_rows, empty, plain
from trailmix.llm.exact_dedup import drop_exact_duplicates, exact_duplicates


def low(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def brute(rows):
    groups, out, seen = defaultdict(list), [], set()
    for r in rows:
        groups[low(r[1])].append(r[0])
    for r in rows:
        t = low(r[1])
        ids = groups[t]
        keep = max((i for i in ids if i is not None), default=None)
        first = r[0] == keep and (t, keep) not in seen
        if first:
            seen.add((t, keep))
        out.append((r[0], keep, len(ids), first, hashlib.sha256(t.encode()).hexdigest()))
    return Counter(out)


def result(df):
    return Counter(tuple(r) for r in df.drop("copies").collect())


def test_awkward_equals_brute_force(spark):
    assert result(exact_duplicates(awkward(spark))) == brute(awkward_rows())
    assert exact_duplicates(empty(spark)).count() == 0


def test_any_salts(spark):
    for salts in (1, 3):
        assert result(exact_duplicates(awkward(spark), salts=salts)) == brute(awkward_rows())


def test_clashing_digests_compare_contents(spark):
    short = lambda norm: F.substring(F.sha2(norm.cast("binary"), 256), 1, 1)
    assert result(exact_duplicates(awkward(spark), digest=short)) == brute(awkward_rows())


def test_rows_that_stay(spark):
    df = awkward(spark)
    kept = drop_exact_duplicates(df)
    assert kept.columns == df.columns
    got = Counter((r[0], low(r[1])) for r in kept.collect())
    want = Counter((k[0], k[4]) for k, n in brute(awkward_rows()).items() if k[3] for _ in range(n))
    assert Counter((i, hashlib.sha256(t.encode()).hexdigest()) for i, t in got.elements()) == want
    assert set(got.values()) == {1} and CLASH[0] in kept.columns
    assert drop_exact_duplicates(empty(spark)).count() == 0


def test_keeps_the_largest_id(spark):
    rows = [(1, "Same", "en", "a", 1), (9, "same", "en", "a", 1), (3, "SAME", "en", "a", 1), (2, "other", "en", "a", 1)]
    assert sorted(r["doc_id"] for r in drop_exact_duplicates(plain(spark, rows)).collect()) == [2, 9]
