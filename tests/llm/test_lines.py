import random
from collections import Counter

from tests.llm.cases import plain, words
from trailmix.llm.lines import drop_repeated_passages


def got(df):
    return Counter((r["doc_id"], r["text"], tuple((s["start"], s["stop"]) for s in r["removed"])) for r in df.collect())


def sentence(rng, n):
    return words(rng, n, 10_000).capitalize() + "."


def test_passages_inside_lines_go_and_clean_texts_stay(spark):
    rng = random.Random(4)
    passage = " ".join(sentence(rng, rng.randrange(6, 14)) for _ in range(7))
    common = "All rights reserved under the usual terms of this site."
    rows = []
    for i in range(40):
        body = [sentence(rng, 9) for _ in range(12)]
        if i % 4 == 1:
            cut = body[5].split(" ")
            body[5] = " ".join([*cut[:4], passage, *cut[4:]])
        rows.append((i, common + "\n" + " ".join(body), None, None, 0))
    inner = passage.split(". ", 1)[1].rsplit(". ", 1)[0]
    out = {r["doc_id"]: r for r in drop_repeated_passages(plain(spark, rows)).collect()}
    assert [i for i in out if inner in out[i]["text"]] == [1]
    for i, r in out.items():
        assert (r["text"] == rows[i][1]) == (i % 4 != 1 or i == 1) and common in r["text"]
        for s in r["removed"]:
            assert inner in rows[i][1][s["start"]:s["stop"]]
