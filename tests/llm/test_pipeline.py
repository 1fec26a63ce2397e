import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SF_SMALL
from tests.llm.cases import awkward_rows, empty, plain
from tests.llm.test_exact_dedup import low
from tests.llm.test_near_dedup import brute as near_brute
from tests.llm.test_packing import check, encode
from trailmix.llm.common import documents, written
from trailmix.llm.pii import detect


def stages(spark, docs):
    out = [docs]
    for name, f in corpus_pipeline.STAGES:
        out.append(written(f(spark, out[-1], SF_SMALL), f"test-{name}"))
    return out


def test_each_stage_on_its_own_input(spark):
    raw, spoken, single, apart, safe, packed = stages(spark, documents(spark, SF_SMALL))
    assert all(s.columns == raw.columns for s in (spoken, single, apart, safe))
    ids = lambda df: {r["doc_id"] for r in df.collect()}
    # Every generated document is in a learned language; those without letters go.
    assert ids(spoken) == {r["doc_id"] for r in raw.collect() if any(c.isalpha() for c in r["text"] or "")}
    best = {}
    for r in spoken.collect():
        best[low(r["text"])] = max(best.get(low(r["text"]), -1), r["doc_id"])
    assert ids(single) == set(best.values())
    rows = [tuple(r) for r in single.collect()]
    assert ids(apart) == {i for (i, _, c, kept), _ in near_brute(rows, 5, 80).items() if kept}
    before = {r["doc_id"]: r for r in apart.collect()}
    for r in safe.collect():
        old = before[r["doc_id"]]
        assert [e[2] for e in detect(r["text"])] == [e[2] for e in detect(old["text"])]
        assert r["n_chars"] == (len(r["text"]) if detect(old["text"]) else old["n_chars"])
        assert not {e[2:] for e in detect(r["text"])} & {e[2:] for e in detect(old["text"])}
    assert len(before) == safe.count()
    kept = safe.collect()
    check([r.asDict() for r in packed.collect()], {r["doc_id"]: [t] for r, t in zip(kept, encode([r["text"] for r in kept]), strict=True)}, 4096)


def test_run_equals_stages(spark):
    out = corpus_pipeline.run(spark, SF_SMALL)
    want = stages(spark, documents(spark, SF_SMALL))[-1]
    cols = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert sorted(map(tuple, out.select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))
    assert public_tokenizers.path("word_bpe_49k.json")


def test_awkward_and_empty(spark):
    for df in (plain(spark, awkward_rows()), empty(spark)):
        last = stages(spark, df)
        assert last[-1].filter(F.col("length") > 4096).count() == 0
    assert last[-1].count() == 0
