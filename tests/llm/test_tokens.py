"""Cached piece encoding equals whole-text encoding."""

from array import array

import public_tokenizers as P
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from tests.conftest import SF_SMALL
from tests.llm.cases import awkward_rows
from trailmix.llm.tokens import TextEncoder

ODD = ["a  b", " x", "x ", "\n\n  word\n \n x", "don't  <|endoftext|> <|endoftext|>x", "", " ", "É　a \x1c b",
       "e ́x  y é", " " * 50 + "z" + " " * 3, "İSTANBUL ΣΑΣ ς ſs K", "a'S 'LL 12345 ½²", "word.,! word. WORD, 'word'",
       "à. b́, straße. Ｆull", "ʼn ŉ Ÿ ÿ, ﬁ"]


@pytest.mark.parametrize("name,spaced", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
@pytest.mark.parametrize("limit", [500_000, 50, 1])
def test_equals_whole_text(name, spaced, limit):
    tok = Tokenizer.from_file(P.path(name))
    texts = ODD + [r[1] or "" for r in awkward_rows()] + pq.read_table(f"{SF_SMALL}/documents.parquet")["text"].to_pylist()
    enc = TextEncoder(P.path(name), spaced, limit)
    for some in (texts[:7], texts, texts[::-1]):
        got = enc.encode(some)
        assert got == [array("I", tok.encode(t, add_special_tokens=False).ids).tobytes() for t in some]
    assert enc.encode([None]) == [b""]


@pytest.mark.parametrize("name,spaced,want", [("byte_bpe_50k.json", True, [437, 286, 340, 220, 50256, 1306]), ("word_bpe_49k.json", False, None)])
def test_special_token_strings(name, spaced, want):
    text = "end of it <|endoftext|> next"
    tok = Tokenizer.from_file(P.path(name))
    got = list(array("I", TextEncoder(P.path(name), spaced).encode([text])[0]))
    assert got == tok.encode(text, add_special_tokens=False).ids and (want is None or got == want)
    assert (50256 if spaced else 49407) in got
    tok.encode_special_tokens = True
    plain = list(array("I", TextEncoder(P.path(name), spaced, special=False).encode([text])[0]))
    assert plain == tok.encode(text, add_special_tokens=False).ids != got


def test_memory_is_bounded():
    enc = TextEncoder(P.path("byte_bpe_50k.json"), True, 200)
    for k in range(60):
        enc.encode([" ".join(f"w{k}x{i} common" for i in range(60))])
        assert len(enc.known) + len(enc.old) < 2 * (100 + 130)
    assert "common" in enc.known or "common" in enc.old
    assert len(enc.seen) < 10_000_000


def test_one_operator_is_kept_at_a_time():
    from trailmix.llm.common import _KEPT, kept_in_worker
    kept_in_worker("a", 1, list).append(5)
    assert kept_in_worker("a", 1, list) == [5]
    kept_in_worker("b", 1, list)
    assert set(_KEPT) == {"b"} and kept_in_worker("a", 1, list) == []


def test_texts_are_encoded_a_slice_at_a_time(monkeypatch):
    enc, sizes, few = TextEncoder(P.path("word_bpe_49k.json"), False), [], TextEncoder._few
    monkeypatch.setattr(TextEncoder, "_few", lambda self, texts: sizes.append(sum(map(len, texts))) or few(self, texts))
    texts = [f"word{k % 7} of the text " * 5_000 for k in range(40)]
    got = enc.encode(texts, 1_000_000)
    assert sum(sizes) == sum(map(len, texts)) > 3_000_000
    assert max(sizes) < 1_000_000 + len(texts[0])
    assert got == [array("I", enc.tok.encode(t, add_special_tokens=False).ids).tobytes() for t in texts]


@pytest.mark.parametrize("name,spaced", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_a_word_is_remembered_once_whatever_marks_follow(name, spaced, monkeypatch):
    enc, sent, joined = TextEncoder(P.path(name), spaced), [], TextEncoder._joined
    monkeypatch.setattr(TextEncoder, "_joined", lambda self, words: sent.extend(words) or joined(self, words))
    texts = ["a word", "a word, word. word?!", "a word; 12. , ..", "a", ""]
    for _ in range(3):
        assert enc.encode(texts) == [array("I", enc.tok.encode(t, add_special_tokens=False).ids).tobytes() for t in texts]
    assert "word" in enc.known and sent.count("word") == 2
    assert not {"word,", "word.", "word?!", "word;"} & {w for w in [*sent, *(enc.known.words.to_pylist())]}
