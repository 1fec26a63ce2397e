import itertools
import random
import zlib
from array import array
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pyarrow as pa
from tokenizers import Tokenizer

import corpus_pipeline
from tests.conftest import SF_SMALL
from tests.llm.cases import awkward, awkward_rows, empty
from trailmix.llm import packing, queries
from trailmix.llm.packing import document_pieces, fill, pack_documents, packed_sequences, plan_windows

WORDS = P.path("word_bpe_49k.json")


def encode(texts):
    tok = Tokenizer.from_file(WORDS)
    return [[*tok.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]


def check(rows, docs, window):
    """docs: id -> list of id lists (repeated rows)."""
    spans = defaultdict(list)
    for r in rows:
        assert 0 < r["length"] <= window
        spans[r["sequence_id"]].append((r["offset"], r["length"]))
    for s in spans.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at <= window
    want = Counter()
    for i, many in docs.items():
        for ids in many:
            for at in range(0, len(ids), window):
                part = array("I", ids[at:at + window])
                want[i, at, len(part), zlib.crc32(part.tobytes()), len(ids)] += 1
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows) == want
    return len(spans)


def test_fill_is_the_best_sum():
    rng = random.Random(3)
    for _ in range(300):
        left = {rng.randrange(1, 30): rng.randrange(1, 4) for _ in range(rng.randrange(1, 6))}
        room = rng.randrange(0, 60)
        take = fill(left, room)
        assert all(n <= left[k] for k, n in take.items())
        items = [k for k, n in left.items() for _ in range(n)]
        best = max(s for r in range(len(items) + 1) for c in itertools.combinations(items, r) if (s := sum(c)) <= room)
        assert sum(k * n for k, n in take.items()) == best


def test_plan_uses_every_piece():
    rng = random.Random(4)
    counts = {rng.randrange(1, 4097): rng.randrange(1, 500) for _ in range(900)}
    used = Counter()
    plan = plan_windows(counts, 4096)
    for times, need in plan:
        assert sum(k * n for k, n in need.items()) <= 4096
        for k, n in need.items():
            used[k] += n * times
    assert used == counts
    tokens = sum(k * n for k, n in counts.items())
    assert sum(t for t, _ in plan) <= 1.03 * tokens / 4096 + 1
    assert plan_windows({}, 4096) == []


def test_awkward(spark):
    docs = defaultdict(list)
    raw = awkward_rows()
    for r, ids in zip(raw, encode([r[1] for r in raw]), strict=True):
        docs[r[0]].append(ids)
    check([r.asDict() for r in pack_documents(awkward(spark), 64, WORDS, 2).collect()], docs, 64)
    assert pack_documents(empty(spark), 64, WORDS, 2).count() == 0


def test_sequences_hold_the_ids(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = packed_sequences(df, 256, WORDS, 2, pad_id=7).collect()
    ids = Counter(itertools.chain(*encode([r["text"] for r in df.collect()])))
    got = Counter()
    for r in rows:
        seq = np.frombuffer(bytes(r["ids"]), "<u4")
        assert len(seq) == 256 and (seq[r["used"]:] == 7).all()
        got.update(seq[:r["used"]].tolist())
    assert got == ids


def test_query(spark):
    raw = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    docs = {r["doc_id"]: [ids] for r, ids in zip(raw, encode([r["text"] for r in raw]), strict=True)}
    n = check([r.asDict() for r in queries.op4_packing(spark, SF_SMALL).collect()], docs, 4096)
    tokens = sum(len(x[0]) for x in docs.values())
    assert n == -(-tokens // 4096)


def test_few_documents_are_encoded_at_a_time(monkeypatch):
    class Docs:
        sparkSession = None

        def mapInArrow(self, f, schema):
            return f

    class Encoder:
        def encode(self, texts, slice_chars):
            assert slice_chars == 1_000_000
            sizes.append(len(texts))
            return [bytes(4)] * len(texts)

    sizes, given = [], []
    monkeypatch.setattr(packing, "ship", lambda spark: None)
    monkeypatch.setattr(packing, "pick", lambda docs, **names: docs)
    monkeypatch.setattr(packing, "encoder", lambda path, spaced: Encoder())
    monkeypatch.setattr(packing, "give_back", lambda: given.append(len(sizes)), raising=False)
    batch = pa.RecordBatch.from_pydict({"id": list(range(1300)), "text": ["a"] * 1300})
    out = list(document_pieces(Docs(), 64, WORDS, 2, slice_rows=512)(iter([batch, batch.slice(0, 0), batch])))
    assert [i for b in out for i in b.column("id").to_pylist()] == [*range(1300)] * 2
    assert max(sizes) <= 512 and sum(sizes) == 2600
    assert given == [3, 3, 6]  # freed memory goes back after every batch


def test_the_pipeline_encodes_few_documents_at_a_time(monkeypatch):
    monkeypatch.setattr(packing, "pack_documents", lambda *args, **more: more)
    assert corpus_pipeline.pack(None, None, "") == {"slice_rows": 512}
