import random
import re
import zlib
from collections import Counter

import pytest

from tests.llm.cases import awkward, awkward_rows, empty, plain
from trailmix.llm import spelling
from trailmix.llm.spelling import Dictionary, spelling_variants

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def low(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def edit_one(a, b):
    """Exactly one insertion, deletion or replacement, by trying all of them."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute_words(rows, min_count=5):
    n = Counter()
    for i, text, *_ in rows:
        for run in map(low, RUN.findall(text or "")):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 6 and k >= min_count}


def brute(words):
    form, out = {}, {}
    for w, n in words.items():
        around = [x for x in words if abs(len(x) - len(w)) <= 1 and x != w and edit_one(w, x)]
        best = min(around, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 5 * n else None
        out[w] = len(around)
    rows = set()
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        rows.add((w, form[w], root, n, out[w], words.get(form[w])))
    return rows


def result(df):
    rows = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def some_words(seed, size=700, letters="abé", most=9):
    """Few letters, so that near words, chains and ties abound."""
    rng = random.Random(seed)
    words = {}
    while len(words) < size:
        words["".join(rng.choice(letters) for _ in range(rng.randint(6, most)))] = rng.choice([5, 5, 6, 30, 200, 200, 1100, 6000])
    return words


def frame(spark, words):
    return spark.createDataFrame(sorted(words.items()), "word string, n long").repartition(5)


def test_awkward_equals_brute_force(spark):
    got = spelling_variants(awkward(spark), damage=spelling.damaged)
    assert result(got) == brute(brute_words(awkward_rows()))
    assert spelling_variants(empty(spark), damage=spelling.damaged).count() == 0


def test_texts_equal_brute_force(spark, monkeypatch):
    rng = random.Random(4)
    stems = ["remember", "Straße", "étonnant", "spelling", "variant", "grouping", "ÀÈÌÒÙÝ", "naïveté×÷x", "colour", "organise"]
    rows = []
    for i in range(500):
        words = []
        for _ in range(rng.randint(0, 60)):
            w = rng.choice(stems)
            if rng.random() < 0.2:
                k = rng.randrange(len(w))
                w = w[:k] + rng.choice(["", "a", "é"]) + w[k + rng.randint(0, 1):]
            words.append(rng.choice([w, w.upper() if w.isascii() else w]))
        rows.append((None if i % 50 == 0 else i % 400, rng.choice([" ", ", ", "\n", "4", "Ā", "¿"]).join(words), "en", "a", 0))
    want = brute(brute_words(rows))
    assert len(want) > 50 and any(r[1] for r in want)
    assert result(spelling_variants(plain(spark, rows).repartition(4), damage=spelling.damaged)) == want
    monkeypatch.setattr(spelling, "_SLICE_CHARS", 7)
    rows[3] = (3, "remember " * 9, "en", "a", 0)
    assert spelling.runs_of("Remember, rememberĀ Straße") == Counter({b"remember": 2, "straße".encode("latin-1"): 1})


@pytest.mark.parametrize("limits", [{}, {"parents": 3}, {"parents": 100_000}, {"list_words": 3}])
def test_near_words_equal_brute_force(spark, limits):
    for seed, letters in ((1, "ab"), (2, "abcdé")):
        words = some_words(seed, 400, letters)
        assert result(spelling.variants(frame(spark, words), **limits)) == brute(words)


def test_long_chains_reach_their_root(spark):
    words = {"a" * (6 + k): 5 ** (k + 1) for k in range(12)}
    got = result(spelling.variants(frame(spark, words)))
    assert got == brute(words) and {r[2] for r in got} == {"a" * 17}


def test_bound_holds_for_every_edit():
    """Whatever one edit does, all but ``bound`` grams of a word stay, and the
    rarest shared one is among the entries of both words."""
    rng = random.Random(9)
    for trial in range(400):
        letters = "abc" if trial % 2 else "abcdefgh"
        counts, opened = {}, set()
        for a in letters:
            for b in letters:
                counts[(a + b).encode()] = rng.randint(1, 50)
                if rng.random() < 0.5:
                    opened.add((a + b).encode())
        for q in (3, 4):
            for g in [g for g in list(opened) if len(g) == q - 1]:
                for c in letters:
                    if rng.random() < 0.7:
                        counts[g + c.encode()] = rng.randint(1, 20)
                        if q == 3 and rng.random() < 0.5:
                            opened.add(g + c.encode())
        cut = Dictionary(counts, opened)
        w = "".join(rng.choice(letters) for _ in range(rng.randint(6, 11)))
        at, kind = rng.randrange(len(w)), rng.choice("idr")
        x = w[:at] + ("" if kind == "d" else rng.choice(letters)) + w[at + (kind != "i"):]
        if len(x) < 6 or x == w:
            continue
        a, b = w.encode(), x.encode()
        own = [cut.longest(a, p) for p in range(len(a) - 1)]
        shift = len(b) - len(a)
        stay = sum(g == (cut.longest(b, p) if p < at else cut.longest(b, p + shift) if 0 <= p + shift < len(b) - 1 else None)
                   for p, g in enumerate(own) if p + len(g) <= at or p > at - (kind == "i"))
        assert stay >= len(own) - cut.bound(a, own) >= 1
        lists = [{(p, v[:p + len(g)]) for p, g in cut.entries(v)} | {(-len(g), v[p:]) for p, g in cut.entries(v)} for v in (a, b)]
        assert lists[0] & lists[1]
