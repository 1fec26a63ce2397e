"""Token ids of whole texts, one remembered piece at a time.

Both public vocabularies used here cut a text before every U+0020 that a
non-space character follows: a byte-level pattern lets a piece start with at
most one U+0020 and never continue across one, and the word vocabulary drops
white space altogether.  So a text is cut there, each distinct piece goes to
the tokenizers library once, and a text's ids are the pieces' ids joined.
Repeated words cost a dictionary lookup; results equal those of encoding the
whole text (``tests/llm/test_tokens.py``).

New pieces go to the library joined, a thousand at a time, and their ids are
told apart by the tokens that begin (byte-level) or end (word ends) a piece.
Pieces that were missed twice are remembered, in two generations: what is met
again moves to the new one, and when that is full the old one goes, so rare
words pass through and memory has a bound.

Special-token strings inside a text become special tokens, as the library does
by itself; ``special=False`` makes them ordinary text.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from trailmix.llm.common import kept_in_worker

_CUT = re.compile(r" (?=\S)")
_ODD = re.compile(r" (?:\s|$)")
# Marks that form a token run of their own after a letter.
_MARKS = ".,;:!?%$#&*|"
# Pieces longer than this are encoded but not remembered: they rarely recur.
_KEEP_CHARS = 40
# Pieces remembered by one Python worker.
CACHE_PIECES = 300_000
# Places of the table of pieces that were missed once.
_SEEN = (1 << 23) - 1
# Pieces that go to the library as one text.
_JOINED = 1000
# Characters of text encoded at a time: more at a time find more pieces that
# come again, fewer take less memory.
SLICE_CHARS = 4_000_000


def _binary(ids: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Ids cut into runs of the given sizes, as bytes."""
    ends = np.append(0, 4 * np.cumsum(sizes, dtype=np.int64))
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(ids)])


def _flat(found: list) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the library's results, one after the other, and how many each has."""
    ids = [np.array(e.ids, "<u4") for e in found]
    return np.concatenate([np.zeros(0, "<u4"), *ids]), np.fromiter(map(len, ids), np.int64, len(ids))


class Pieces:
    """Distinct pieces and their ids, in Arrow arrays."""

    def __init__(self, words: pa.Array, ids: pa.Array):
        self.words, self.ids = words, ids

    def __len__(self) -> int:
        return len(self.words)

    def __contains__(self, word: str) -> bool:
        return pc.index(self.words, word).as_py() >= 0

    def filter(self, wanted: np.ndarray) -> Pieces:
        mask = pa.array(wanted)
        return Pieces(self.words.filter(mask), self.ids.filter(mask))

    def slice(self, start: int) -> Pieces:
        return Pieces(self.words.slice(start), self.ids.slice(start))

    @staticmethod
    def joined(*parts: Pieces) -> Pieces:
        return Pieces(pa.concat_arrays([p.words for p in parts]), pa.concat_arrays([p.ids for p in parts]))


class TextEncoder:
    """Texts to little-endian unsigned 32-bit ids with a tokenizers file.

    ``spaced``: the vocabulary marks a leading space (byte-level), so every
    piece after the first is encoded with its space; otherwise without.
    """

    def __init__(self, path: str, spaced: bool, cache_pieces: int = CACHE_PIECES, special: bool = True):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = not special
        self.lead = " " if spaced else ""
        self.limit = max(1, cache_pieces // 2)
        # The empty piece has no ids and stays the first.
        self.none = Pieces(pa.array([""], pa.string()), pa.array([b""], pa.large_binary()))
        self.known, self.old = self.none, self.none.slice(1)
        self.seen, self.marks = np.zeros(_SEEN + 1, bool), 0
        # Tokens that begin a piece (its space) or end a word.
        edge = np.zeros(self.tok.get_vocab_size(with_added_tokens=True), bool)
        for token, i in self.tok.get_vocab(with_added_tokens=False).items():
            edge[i] = token.startswith("\u0120") if spaced else token.endswith("</w>")
        self.edge = edge

    def _alone(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return _flat(self.tok.encode_batch_fast(pieces, add_special_tokens=False))

    def _joined(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that have one edge token each, and how many each has."""
        ids, sizes = [np.zeros(0, "<u4")], [np.zeros(0, np.int64)]
        groups = [words[lo:lo + _JOINED] for lo in range(0, len(words), _JOINED)]
        texts = [" " + " ".join(g) if self.lead else " ".join(g) for g in groups]
        for group, found in zip(groups, self.tok.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            some = np.array(found.ids, "<u4")
            at = np.flatnonzero(self.edge[some])
            if len(at) == len(group):
                n = np.diff(np.append(at, len(some)) if self.lead else np.append(-1, at))
            else:  # not expected: one by one
                some, n = self._alone([self.lead + w for w in group])
            ids.append(some)
            sizes.append(n)
        return np.concatenate(ids), np.concatenate(sizes)

    def _words(self, words: list[str]) -> pa.Array:
        """Ids of pieces.  A piece without U+0020 has one token with a space in
        it, its first; a word of letters has one end of a word."""
        plain = np.array([" " not in w for w in words] if self.lead else [w.isalpha() and w.isascii() for w in words], bool)
        if plain.all():
            return _binary(*self._joined(words))
        order = np.argsort(~plain, kind="stable")
        cut = int(plain.sum())
        joined = _binary(*self._joined([words[k] for k in order[:cut]]))
        rest = _binary(*self._alone([self.lead + words[k] for k in order[cut:]]))
        return pa.concat_arrays([joined, rest]).take(pa.array(np.argsort(order)))

    def _few(self, texts: list[str]) -> list[bytes]:
        odd = [bool(_ODD.search(t)) for t in texts]
        plain = iter(self._cut([t for t, o in zip(texts, odd, strict=True) if not o], False))
        rest = iter(self._cut([t for t, o in zip(texts, odd, strict=True) if o], True))
        return [next(rest) if o else next(plain) for o in odd]

    def _cut(self, texts: list[str], odd: bool) -> list[bytes]:
        if not texts:
            return []
        pieces = pa.array(map(_CUT.split, texts), pa.list_(pa.string())) if odd else pc.split_pattern(pa.array(texts, pa.string()), " ")
        firsts = _binary(*self._alone([_CUT.split(t, 1)[0] for t in texts]))
        words = pieces.flatten().dictionary_encode()
        ids = self._distinct(words.dictionary)
        # Each word's ids, one after the other; a text's first piece has no
        # space before it.
        index, at = words.indices.to_numpy().copy(), pieces.offsets.to_numpy()
        index[at[:-1]] = np.arange(len(ids), len(ids) + len(firsts))
        found = pa.concat_arrays([ids, firsts]).take(pa.array(index))
        _, ends, raw = found.buffers()
        ends = np.frombuffer(ends, np.int64, len(found) + 1)[at].tolist()
        raw = memoryview(raw) if raw else b""
        return [bytes(raw[a:z]) for a, z in zip(ends[:-1], ends[1:], strict=True)]

    def _distinct(self, words: pa.Array) -> pa.Array:
        """Ids of distinct pieces, from memory or anew.  A trailing run of
        plain marks is a token run of its own after a letter, so "word",
        "word," and "word." are one."""
        stems = pc.ascii_rtrim(words, _MARKS)
        size = pc.binary_length(stems).to_numpy()
        last = pc.utf8_slice_codeunits(stems, -1).dictionary_encode()
        letter = np.array([c.isalpha() for c in last.dictionary.to_pylist()], bool)
        marked = letter[last.indices.to_numpy()] & (size < pc.binary_length(words).to_numpy())
        mask = pa.array(marked)
        # What is remembered stands first, so that places from there on are new.
        known, old = len(self.known), len(self.old)
        all_pieces = pa.concat_arrays([self.known.words, self.old.words, pc.if_else(mask, stems, words)]).dictionary_encode()
        at = all_pieces.indices.to_numpy()[known + old:]
        new = all_pieces.dictionary.slice(known + old)
        names = new.to_pylist()
        fresh = Pieces(new, self._words(names))
        ids = pa.concat_arrays([self.known.ids, self.old.ids, fresh.ids]).take(pa.array(at))
        self._remember(at, fresh, names)
        if not marked.any():
            return ids
        long = [w[len(w.rstrip(_MARKS)):] for w in words.filter(mask).to_pylist()]
        runs = pa.array(long, pa.string()).dictionary_encode()
        tails = _binary(*self._alone(runs.dictionary.to_pylist())).take(runs.indices)
        ends = pc.replace_with_mask(pa.array([b""], pa.large_binary()).take(pa.array(np.zeros(len(ids), np.int64))), mask, tails)
        return pc.binary_join_element_wise(ids, ends, pa.scalar(b"", pa.large_binary()))

    def _remember(self, at: np.ndarray, fresh: Pieces, names: list[str]) -> None:
        """Old pieces that were met move to the known ones.  A new piece is
        remembered from its second miss on: most of the rare ones never come
        again."""
        known, old = len(self.known), len(self.old)
        met = np.zeros(old, bool)
        met[at[(at >= known) & (at < known + old)] - known] = True
        places = np.fromiter(map(hash, names), np.int64, len(names)) & _SEEN
        again = self.seen[places]
        self.marks += len(names) - int(again.sum())
        self.seen[places] = True
        short = pc.utf8_length(fresh.words).to_numpy() <= _KEEP_CHARS
        self.known, self.old = Pieces.joined(self.known, self.old.filter(met), fresh.filter(again & short)), self.old.filter(~met)
        if self.marks > _SEEN // 4:
            self.seen, self.marks = np.zeros(_SEEN + 1, bool), 0
        if len(self.known) > self.limit:
            self.old, self.known = self.known.slice(1), self.none

    def encode(self, texts: list[str | None], slice_chars: int = SLICE_CHARS) -> list[bytes]:
        """Ids of each text (null: none), as bytes."""
        out: list[bytes] = []
        some: list[str] = []
        size = 0
        for t in texts:
            some.append(t or "")
            size += len(some[-1])
            if size >= slice_chars:
                out += self._few(some)
                some, size = [], 0
        return out + (self._few(some) if some else [])


def encoder(path: str, spaced: bool) -> TextEncoder:
    """The Python worker's encoder for a vocabulary file, kept between tasks."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return kept_in_worker("tokens", (path, spaced), lambda: TextEncoder(path, spaced))
