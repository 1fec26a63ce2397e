import zlib
from array import array

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from tests.conftest import SF_SMALL
from tests.llm.cases import awkward, awkward_rows, empty
from trailmix.llm import queries, token_file

BPE = "byte_bpe_50k.json"


@pytest.fixture(scope="module")
def tok():
    t = Tokenizer.from_file(P.path(BPE))
    return t


@pytest.mark.parametrize("width", [1, 3, 7, 8, 11, 15, 16, 17, 24, 31, 32])
def test_pack_round_trip(width):
    rng = np.random.default_rng(width)
    for n in (0, 1, 7, 8, 9, 1000):
        ids = rng.integers(0, 1 << width, n, dtype=np.uint64).astype("<u4")
        body = token_file.pack(ids, width)
        assert len(body) == -(-n // 8) * width
        for start, count in ((0, n), (n // 3, n // 2), (n - 1, 1) if n else (0, 0)):
            assert (token_file.unpack(body, width, start, count) == ids[start:start + count]).all()
        whole = int.from_bytes(body, "little")
        assert [whole >> (k * width) & ((1 << width) - 1) for k in range(n)] == ids.tolist()


def test_width():
    assert [token_file.id_width(v) for v in (1, 2, 3, 256, 257, 50_257, 65_537)] == [1, 1, 2, 8, 9, 16, 17]


def test_file_equals_encoding(spark, scratch, tok):
    token_file.write_token_file(awkward(spark), f"{scratch}/f", P.path(BPE), 0, 50_257, block_ids=500)
    rows = token_file.read_token_file(spark, f"{scratch}/f").orderBy("start").collect()
    want = {}
    for i, t, *_ in awkward_rows():
        want.setdefault(i, []).append(array("I", [*tok.encode(t or "", add_special_tokens=False).ids, 0]).tobytes())
    assert [r["doc_id"] is None for r in rows] == sorted((r["doc_id"] is None for r in rows), reverse=True)
    ids = [r["doc_id"] for r in rows if r["doc_id"] is not None]
    assert ids == sorted(ids)
    at, flat = 0, b""
    for r in rows:
        body = bytes(r["ids"])
        want[r["doc_id"]].remove(body)
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(body) // 4, zlib.crc32(body))
        at += r["n_tokens"]
        flat += body
    assert not any(want.values())
    whole = np.frombuffer(flat, "<u4")
    for start, count in ((0, 5), (321, 1777), (at - 3, 3), (at, 4)):
        assert (token_file.read_ids(spark, f"{scratch}/f", start, count) == whole[start:start + count]).all()


def test_empty(spark, scratch):
    token_file.write_token_file(empty(spark), f"{scratch}/f", P.path(BPE), 0, 50_257)
    assert token_file.read_token_file(spark, f"{scratch}/f").count() == 0


def test_query(spark, tok):
    got = {r["doc_id"]: r for r in queries.op7_token_file(spark, SF_SMALL).collect()}
    at = 0
    for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").orderBy("doc_id").collect():
        body = array("I", [*tok.encode(r["text"], add_special_tokens=False).ids, 0]).tobytes()
        g = got[r["doc_id"]]
        assert (g["start"], g["n_tokens"], g["ids_crc32"]) == (at, len(body) // 4, zlib.crc32(body))
        at += len(body) // 4
