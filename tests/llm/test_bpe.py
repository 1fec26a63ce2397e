import base64
import hashlib
import random
from collections import Counter

import public_tokenizers as P
import pytest
import tiktoken

from tests.conftest import SF_SMALL
from tests.llm.cases import awkward, awkward_rows, empty, plain
from tests.llm.test_tokens import ODD
from trailmix.llm import queries
from trailmix.llm.bpe import Codec, decode_documents, encode_documents, merge_pairs

RANKS = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def enc():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(row):
    return memoryview(bytes(row["ids"])).cast("I").tolist()


def test_merges(enc):
    rng = random.Random(1)
    for n in (1, 2, 5, 40, 64, 65, 300, 3000):
        for alphabet in ("ab", "abcdefghijklmnop", "aé漢"):
            piece = "".join(rng.choice(alphabet) for _ in range(n))
            assert merge_pairs(piece.encode(), enc._mergeable_ranks) == enc._core_bpe.encode_single_piece(piece.encode())


def test_codec(enc):
    for limit in (300_000, 3):
        c = Codec(RANKS, P.PATTERN, limit)
        for t in [*ODD, *(r[1] or "" for r in awkward_rows()), "\x1c\x1d \x85\x85  a", "\r\n\r\n x"] * 2:
            ids = c.encode(t)
            assert memoryview(ids).cast("I").tolist() == enc.encode_ordinary(t)
            assert c.decode(ids) == t.encode()


@pytest.mark.parametrize("chunk,overlap", [(32_768, 1_024), (7, 3), (50, 10), (64, 63)])
def test_chunks_stitch(spark, enc, chunk, overlap):
    rng = random.Random(chunk)
    texts = ["".join(rng.choice(["a", "b", " ", " ", "\n", "1", "'s", "'", "!", "é", "漢 "]) for _ in range(rng.randrange(300))) for _ in range(40)]
    texts += ["x" * 500, " " * 400, "a " * 100 + "y" * 200 + " b" * 100, " " * 90 + "z", "one two " * 60, None, ""]
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)] + [(7, texts[7], "again", None, None)]
    out = encode_documents(plain(spark, rows), RANKS, P.PATTERN, chunk_chars=chunk, overlap=overlap)
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        assert ids_of(r) == enc.encode_ordinary(texts[r["doc_id"]] or "")
    back = {r["doc_id"]: bytes(r["bytes"]) for r in decode_documents(out, RANKS, P.PATTERN).collect()}
    assert back == {i: (t or "").encode() for i, t in enumerate(texts)}


def test_awkward(spark, enc):
    got = Counter((r["doc_id"], tuple(ids_of(r))) for r in encode_documents(awkward(spark), RANKS, P.PATTERN).collect())
    assert got == Counter((r[0], tuple(enc.encode_ordinary(r[1] or ""))) for r in awkward_rows())
    assert encode_documents(empty(spark), RANKS, P.PATTERN).count() == 0


def test_query(spark, enc):
    got = {r["doc_id"]: r for r in queries.op9_bpe(spark, SF_SMALL).collect()}
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()
    assert len(got) == len(docs)
    for r in docs:
        ids, g = enc.encode_ordinary(r["text"]), got[r["doc_id"]]
        assert g["n_tokens"] == len(ids)
        assert g["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert g["decoded_sha256"] == hashlib.sha256(r["text"].encode()).hexdigest()
