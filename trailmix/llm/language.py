"""Language identification with a linear-chain conditional random field.

Words (runs of letters) are labelled with a language each.  A word's features
are its prefixes and suffixes of up to three letters, its letter 2-, 3- and
4-grams with word ends, the word itself, and the lexicons (one learned word
list for each language) that hold it; feature weights live in ``FEATURES`` hashed
slots.  Transitions between the languages of neighbouring words are learned
with them, on sequences that join stretches of different languages as
code-switched text does.  The forward-backward pass gives each word's
posterior over languages; a document's language is the one with the greatest
mean posterior, which is its score.  ``tag_words`` gives the word labels.

``keep_identified`` does not judge by the score, which is a share: in a text of
several learned languages no language has a large one, and a text of none may
have a label with a large one.  The field gives each word its languages, by the
posteriors of the forward-backward pass, and the text is judged by how much of
its words' features the training words of those languages have (``Judge``).

Bounds: training takes about ``TRAIN_DOCS`` documents for each language (least
hash of the id) and ``TRAIN_CHARS`` characters from a hashed place in each,
the only rows that reach the driver.  Prediction reads every whole text.

Defined results.  Null text or no letter: ``und``, score 0.  No training rows:
``und`` everywhere.  Null ids: predicted, never learned from, not held out.
Repeated rows: equal predictions.  Empty table: no rows.  Extra columns are
not read.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmix.llm.common import Rows, give_back, hash63, kept_in_worker, pick, ship

FEATURES = 1 << 16
SEEN_FEATURES = 1 << 23
LEAST_SEEN = 0.6
FIELD_SLOTS = 1 << 22
TRAIN_DOCS = 400
TRAIN_CHARS = 800
STRETCH = 40
ROUNDS = 40
LEXICON = 5_000
CACHE_WORDS = 400_000
# Words that a worker of the pipeline's stage remembers (about 100 bytes each).
FAMILIAR_WORDS = 250_000
UNKNOWN = "und"
_WORD = re.compile(r"[^\W\d_]+")
_GROUP_WORDS = 400_000
_LEARNED_AT_ONCE = 8_192


def _features(word: str, lexicon: dict[str, int]) -> list[int]:
    """Hashed features of a word; empty if it has no letter."""
    if not (word.isalpha() or any(map(str.isalpha, word))):
        return []
    w = word.lower()
    if w.isascii() and w not in lexicon:
        raw, n = w.encode(), len(w)
        marked, crc = b"<" + raw + b">", zlib.crc32
        out = [crc(b"w" + raw), *(crc(b"p" + raw[:k]) for k in (1, 2, 3) if k <= n), *(crc(b"s" + raw[-k:]) for k in (1, 2, 3) if k <= n)]
        for k in (2, 3, 4):
            out += [crc(marked[i:i + k]) for i in range(n + 3 - k)]
        return out
    marked = f"<{w}>"
    names = [f"w{w}", *(f"p{w[:k]}" for k in (1, 2, 3) if k <= len(w)), *(f"s{w[-k:]}" for k in (1, 2, 3) if k <= len(w))]
    names += [marked[i:i + k] for k in (2, 3, 4) for i in range(len(marked) - k + 1)]
    if w in lexicon:
        names.append(f"l{lexicon[w]}")
    return [zlib.crc32(n.encode()) for n in names]


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1).astype(np.uint32)
    return c


_CRC, _ONES = _crc_table(), np.uint32(0xFFFFFFFF)


def _feature_table(words: list[str], lexicon: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """``_features`` of many words: all in one array, and how many each has.
    ASCII words outside the lexicon are hashed a letter of all of them at once."""
    low = [w.lower() if w.isascii() else w for w in words]
    fast = np.fromiter((w.isascii() and w.isalpha() and w not in lexicon for w in low), bool, len(low))
    raw = [w.encode() for w, f in zip(low, fast, strict=True) if f]
    slow = [_features(w, lexicon) for w, f in zip(words, fast, strict=True) if not f]
    n = np.fromiter(map(len, raw), np.int64, len(raw))
    sizes = np.zeros(len(words), np.int64)
    sizes[fast], sizes[~fast] = 1 + 2 * np.minimum(n, 3) + 3 * n, [len(f) for f in slow]
    ends = np.cumsum(sizes)
    flat = np.empty(int(ends[-1]) if len(ends) else 0, np.int64)
    if slow:
        at = ends[~fast] - sizes[~fast]
        for a, f in zip(at.tolist(), slow, strict=True):
            flat[a:a + len(f)] = f
    if not raw:
        return flat, sizes
    buf = np.frombuffer(b"<" + b"><".join(raw) + b">   ", np.uint8)
    first, at = np.cumsum(n + 2) - n - 1, ends[fast] - sizes[fast]     # a word's first letter, its first feature

    def fed(state, byte):
        return _CRC[(state ^ byte) & 255] ^ (state >> 8)

    flat[at] = [zlib.crc32(b"w" + r) for r in raw]
    at = at + 1
    for mark, from_end in ((b"p", False), (b"s", True)):
        marked = fed(_ONES, np.uint32(mark[0]))
        for k in (1, 2, 3):
            some = n >= k
            state, start = marked, (first + n - k if from_end else first)[some]
            for j in range(k):
                state = fed(state, buf[start + j])
            flat[at[some]] = state ^ _ONES
            at = at + some
    last = len(buf) - 3
    state = fed(fed(_ONES, buf[:last]), buf[1:last + 1])
    for k in (2, 3, 4):
        if k > 2:
            state = fed(state, buf[k - 1:last + k - 1])
        count = n + 3 - k
        step = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        flat[np.repeat(at, count) + step] = state[np.repeat(first - 1, count) + step] ^ _ONES
        at = at + count
    return flat, sizes


def word_features(word: str, lexicon: dict[str, int]) -> list[int]:
    """Feature slots of a word; empty if it has no letter."""
    return [x % FEATURES for x in _features(word, lexicon)]


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray            # FEATURES x labels
    moves: np.ndarray              # labels x labels, log weights
    lexicon: dict[str, int]
    name: str = field(default_factory=lambda: uuid.uuid4().hex)


def _grown(table: np.ndarray, rows: int) -> np.ndarray:
    while rows > len(table):
        table = np.concatenate([table, np.zeros_like(table)])
    return table


class Tagger:
    """A model with the words scored so far."""

    def __init__(self, model: Model, words: int = CACHE_WORDS):
        self.model, self.limit = model, words
        self.known: dict[str, int] = {}
        self.used = 0
        self.scores = np.zeros((1024, len(model.labels)), np.float32)
        self.step = np.exp(model.moves).astype(np.float32)

    def _learn(self, new: list[str]) -> None:
        for lo in range(0, len(new), _LEARNED_AT_ONCE):
            self._score(new[lo:lo + _LEARNED_AT_ONCE])

    def _score(self, new: list[str]) -> None:
        flat, sizes = _feature_table(new, self.model.lexicon)
        some = np.flatnonzero(sizes)
        if len(some) < len(new):
            self.known.update((new[k], -1) for k in np.flatnonzero(sizes == 0))
        if not len(some):
            return
        starts = np.cumsum(sizes[some]) - sizes[some]
        made = np.add.reduceat(self.model.weights[flat % FEATURES], starts, axis=0)
        at, to = self.used, self.used + len(some)
        self.scores = _grown(self.scores, to)
        self.scores[at:to] = np.exp(made - made.max(1, keepdims=True))
        self.known.update(zip((new[k] for k in some), range(at, to), strict=True))
        self.used = to
        self._noted(flat, starts, at, to)

    def _noted(self, flat: np.ndarray, starts: np.ndarray, at: int, to: int) -> None:
        """What else is kept for words ``at`` to ``to``, from their features."""

    def word_ids(self, texts: list[str | None]) -> list[np.ndarray]:
        """Score rows of each text's words with letters."""
        if len(self.known) > self.limit:
            self.known, self.used = {}, 0
        cut = [_WORD.findall(t or "") for t in texts]
        new = set()
        for c in cut:
            new.update(c)
        new.difference_update(self.known)
        if new:
            self._learn(list(new))
        rows = [np.fromiter(map(self.known.__getitem__, c), np.int64, len(c)) for c in cut]
        return [r[r >= 0] if len(r) and r.min() < 0 else r for r in rows]

    def posteriors(self, rows: list[np.ndarray], each: bool = False, worth: np.ndarray | None = None) -> list[np.ndarray]:
        """Posterior over labels, summed over each sequence (or of each word);
        ``worth`` has a weight for each word's score row and label."""
        order = sorted(range(len(rows)), key=lambda k: -len(rows[k]))
        order = [k for k in order if len(rows[k])]
        n_labels = len(self.model.labels)
        out = [np.zeros((len(r), n_labels) if each else n_labels) for r in rows]
        if not order:
            return out
        lens = np.array([len(rows[k]) for k in order])
        # Words by place: the words at place t of all sequences that reach it.
        reach = len(lens) - np.searchsorted(lens[::-1], np.arange(1, lens[0] + 1))
        at = np.concatenate([[0], np.cumsum(reach)])
        ids = np.empty(at[-1], np.int64)
        for d, k in enumerate(order):
            ids[at[:lens[d]] + d] = rows[k]
        emit = self.scores[ids]
        ahead = np.empty_like(emit)
        ahead[:reach[0]] = emit[:reach[0]]
        ahead[:reach[0]] /= ahead[:reach[0]].sum(1, keepdims=True)
        for t in range(1, len(reach)):
            n, now, was = reach[t], at[t], at[t - 1]
            a = (ahead[was:was + n] @ self.step) * emit[now:now + n]
            ahead[now:now + n] = a / a.sum(1, keepdims=True)
        back = np.ones((len(order), n_labels), np.float32)
        total = np.zeros((len(order), n_labels))
        flipped = np.ascontiguousarray(self.step.T)
        for t in range(len(reach) - 1, -1, -1):
            n, now = reach[t], at[t]
            g = ahead[now:now + n] * back[:n]
            g /= g.sum(1, keepdims=True)
            if each:
                for d in range(n):
                    out[order[d]][t] = g[d]
            total[:n] += g if worth is None else g * worth[ids[now:now + n]]
            b = (emit[now:now + n] * back[:n]) @ flipped
            back[:n] = b / b.sum(1, keepdims=True)
        if not each:
            for d, k in enumerate(order):
                out[k] = total[d]
        return out

    def _summed(self, rows: list[np.ndarray], worth: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Each sequence with its sum of posteriors, some words at a time."""
        lo = 0
        while lo < len(rows):
            hi, n = lo, 0
            while hi < len(rows) and (hi == lo or n + len(rows[hi]) <= _GROUP_WORDS):
                n += len(rows[hi])
                hi += 1
            yield from zip(rows[lo:hi], self.posteriors(rows[lo:hi], worth=worth), strict=True)
            lo = hi

    def languages(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out: list[tuple[str, float]] = []
        for r, total in self._summed(self.word_ids(texts)):
            best = int(total.argmax())
            out.append((self.model.labels[best], min(1.0, float(total[best] / len(r)))) if len(r) else (UNKNOWN, 0.0))
        return out


def seen_by_language(samples: list[tuple[str, str]], model: Model) -> np.ndarray:
    """FIELD_SLOTS x labels, packed: which languages' training words have a
    feature of that slot."""
    seen = np.zeros((FIELD_SLOTS, len(model.labels)), bool)
    for k, label in enumerate(model.labels):
        words = sorted({w for t, lang in samples if lang == label for w in _WORD.findall(t)})
        seen[_feature_table(words, model.lexicon)[0] % FIELD_SLOTS, k] = True
    return np.packbits(seen, axis=1)


class Judge(Tagger):
    """The field, with the share of each word's features that the training
    words of each language have."""

    def __init__(self, model: Model, seen: np.ndarray, words: int = FAMILIAR_WORDS):
        super().__init__(model, words)
        self.seen = seen
        self.shares = np.zeros_like(self.scores)

    def _noted(self, flat: np.ndarray, starts: np.ndarray, at: int, to: int) -> None:
        has = np.unpackbits(self.seen[flat % FIELD_SLOTS], axis=1, count=len(self.model.labels))
        self.shares = _grown(self.shares, to)
        sizes = np.diff(np.append(starts, len(flat)))
        self.shares[at:to] = np.add.reduceat(has, starts, axis=0, dtype=np.float32) / sizes[:, None]

    def evidence(self, texts: list[str | None]) -> list[float | None]:
        """Mean over a text's words of the share of their features known from
        the language that the field gives them (by its posterior); None for a
        text without letters."""
        rows = self.word_ids(texts)
        return [float(total.sum() / len(r)) if len(r) else None for r, total in self._summed(rows, self.shares)]


def _sequences(samples: list[tuple[list[str], int]], rng) -> list[tuple[list[str], list[int]]]:
    """Training sequences of STRETCH words: half from one text, half that
    switch between texts every few words."""
    out = []
    for words, label in samples:
        for lo in range(0, len(words), STRETCH):
            part = words[lo:lo + STRETCH]
            if rng.random() < 0.5:
                out.append((part, [label] * len(part)))
                continue
            mixed, labels = [], []
            while len(mixed) < STRETCH:
                other, its = (part, label) if not mixed else samples[rng.integers(len(samples))]
                n = int(rng.integers(3, 16))
                start = int(rng.integers(max(1, len(other) - n)))
                mixed += other[start:start + n]
                labels += [its] * len(other[start:start + n])
            out.append((mixed[:STRETCH], labels[:STRETCH]))
    return out


def train(samples: list[tuple[str, str]], rounds: int = ROUNDS, seed: int = 1) -> Model | None:
    """Fit the field to (text, language) samples by maximum likelihood."""
    labels = sorted({lang for _, lang in samples})
    cut = [(_WORD.findall(t), labels.index(lang)) for t, lang in sorted(samples)]
    cut = [(w, lab) for w, lab in cut if w]
    if not cut:
        return None
    n = len(labels)
    seen = Counter((w.lower(), lab) for words, lab in cut for w in words)
    every = Counter()
    for (w, _), c in seen.items():
        every[w] += c
    lexicon: dict[str, int] = {}
    for lab in range(n):
        own = sorted(((c, w) for (w, k), c in seen.items() if k == lab and c >= 3 and c >= 0.8 * every[w]), reverse=True)
        lexicon.update((w, lab) for _, w in own[:LEXICON])
    rng = np.random.default_rng(seed)
    data = _sequences(cut, rng)
    vocab = {w: k for k, w in enumerate(sorted({w for s, _ in data for w in s}))}
    feats = [word_features(w, lexicon) or [0] for w in vocab]
    flat = np.array([x for f in feats for x in f])
    starts = np.cumsum([0, *(len(f) for f in feats[:-1])])
    reps = np.array([len(f) for f in feats])
    longest = max(len(s) for s, _ in data)
    word = np.zeros((len(data), longest), np.int64)
    gold = np.full((len(data), longest), -1)
    for k, (s, ys) in enumerate(data):
        word[k, :len(s)], gold[k, :len(s)] = [vocab[w] for w in s], ys
    real = gold >= 0
    weights, moves = np.zeros((FEATURES, n)), np.zeros((n, n))
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (weights, moves)]
    held = np.eye(n)[np.where(real, gold, 0)] * real[..., None]
    gold_moves = np.einsum("bti,btj->ij", held[:, :-1], held[:, 1:])
    size = real.sum()
    for r in range(rounds):
        emit = np.add.reduceat(weights[flat], starts, axis=0)[word]
        emit = np.exp(emit - emit.max(2, keepdims=True))
        step = np.exp(moves)
        ahead, back = np.zeros_like(emit), np.ones_like(emit)
        ahead[:, 0] = emit[:, 0] / emit[:, 0].sum(1, keepdims=True)
        for t in range(1, longest):
            a = (ahead[:, t - 1] @ step) * emit[:, t]
            ahead[:, t] = np.where(real[:, t, None], a / a.sum(1, keepdims=True), ahead[:, t - 1])
        for t in range(longest - 2, -1, -1):
            b = (emit[:, t + 1] * back[:, t + 1]) @ step.T
            back[:, t] = np.where(real[:, t + 1, None], b / b.sum(1, keepdims=True), 1.0)
        post = ahead * back
        post = post / post.sum(2, keepdims=True) * real[..., None]
        pair = np.zeros((n, n))
        for t in range(longest - 1):
            joint = ahead[:, t, :, None] * step * (emit[:, t + 1] * back[:, t + 1])[:, None, :]
            pair += (joint / joint.sum((1, 2), keepdims=True))[real[:, t + 1]].sum(0)
        miss = (held - post).reshape(-1, n)
        by_word = np.stack([np.bincount(word.reshape(-1), miss[:, k], len(vocab)) for k in range(n)], 1)
        spread = np.repeat(by_word, reps, axis=0)
        grads = (np.stack([np.bincount(flat, spread[:, k], FEATURES) for k in range(n)], 1) / size - 1e-6 * weights,
                 (gold_moves - pair) / size - 1e-6 * moves)
        for p, g, s in zip((weights, moves), grads, state, strict=True):
            s[0] = 0.9 * s[0] + 0.1 * g
            s[1] = 0.99 * s[1] + 0.01 * g * g
            p += 0.1 * (s[0] / (1 - 0.9 ** (r + 1))) / (np.sqrt(s[1] / (1 - 0.99 ** (r + 1))) + 1e-8)
    return Model(labels, weights.astype(np.float32), moves, lexicon)


def remainder(ident: Column) -> Column:
    """crc32 of the id as text, mod 4; null for a null id."""
    return F.pmod(F.crc32(ident.cast("string").cast("binary")), F.lit(4))


def training_sample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                    per_language: int = TRAIN_DOCS, chars: int = TRAIN_CHARS) -> list[tuple[str, str]]:
    """About ``per_language`` stretches for each language, from documents that
    are not held out."""
    rows = pick(docs, id=id_col, text=text_col, lang=lang_col)
    rows = rows.filter("id is not null and text is not null and lang is not null").filter(remainder(F.col("id")) != 2)
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return []
    share = F.element_at(F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, per_language / n))]), F.col("lang"))
    key = hash63(17, F.col("id"))
    at = F.pmod(hash63(19, F.col("id")), F.greatest(F.char_length("text") - chars, F.lit(0)) + 1).cast("int") + 1
    taken = rows.filter(key < share * float(2**63)).select(F.col("text").substr(at, F.lit(chars)).alias("text"), "lang")
    return [(r["text"], r["lang"]) for r in taken.collect()]


def _tagger(shared) -> Tagger:
    model = shared.value
    return kept_in_worker("language", model.name, lambda: Tagger(model))


def _predicted(rows: DataFrame, text: str, model: Model) -> DataFrame:
    """The rows with lang_pred and score; ``text`` names the text column."""
    spark = rows.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)  # FEATURES x languages and the lexicons
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = _tagger(shared)
        for b in batches:
            for lo in range(0, b.num_rows, 1024):
                part = b.slice(lo, 1024)
                got = tagger.languages(part.column(text).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())],
                    [*names, "lang_pred", "score"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{kinds}, lang_pred string, score double")


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, lang_pred, score."""
    rows = pick(docs, id=id_col, text=text_col)
    if model is None:
        return rows.select(F.col("id").alias(id_col), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    return _predicted(rows, "text", model).select(F.col("id").alias(id_col), "lang_pred", "score")


def seen_features(samples: list[tuple[str, str]]) -> np.ndarray:
    """Slots of the features that the words of (text, language) samples have."""
    seen = np.zeros(SEEN_FEATURES, bool)
    for w in {w for t, _ in samples for w in _WORD.findall(t)}:
        seen[[x % SEEN_FEATURES for x in _features(w, {})]] = True
    return seen


class Familiar:
    """Mean over a text's words of the share of their features that are seen;
    None for a text without letters.  Words met again are remembered in two
    generations."""

    def __init__(self, seen: np.ndarray, words: int = FAMILIAR_WORDS):
        self.seen, self.limit = seen.astype(np.uint8).tobytes(), words // 2
        self.known: dict[str, float] = {}
        self.old: dict[str, float] = {}

    def share(self, word: str) -> float:
        if word in self.old:
            return self.old[word]
        f, seen = _features(word, {}), self.seen
        return sum([seen[x % SEEN_FEATURES] for x in f]) / len(f) if f else -1.0

    def of(self, texts: list[str | None]) -> list[float | None]:
        cut = [_WORD.findall(t or "") for t in texts]
        known = self.known
        for w in {w for c in cut for w in c}.difference(known):
            known[w] = self.share(w)
        out: list[float | None] = []
        for c in cut:
            shares = [x for x in map(known.__getitem__, c) if x >= 0]
            out.append(sum(shares) / len(shares) if shares else None)
        if len(known) > self.limit:
            self.old, self.known = known, {}
        return out


def familiar(texts: list[str | None], seen: np.ndarray) -> list[float | None]:
    return Familiar(seen).of(texts)


def keep_identified(docs: DataFrame, least_seen: float = LEAST_SEEN, id_col: str = "doc_id", text_col: str = "text",
                    lang_col: str = "lang") -> DataFrame:
    """The rows, with all their columns, whose text is in learned languages,
    one or several: training words of the languages that the field gives its
    words have at least that share of their features."""
    samples = training_sample(docs, id_col, text_col, lang_col)
    model = train(samples)
    rows = Rows(docs)
    if model is None:
        return docs.limit(0)
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast((model, seen_by_language(samples, model)))  # and FIELD_SLOTS x languages bits
    own, model_name = rows.own[rows.names.index(text_col)], model.name

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = kept_in_worker("language stage", model_name, lambda: Judge(*shared.value))
        for b in batches:
            keep: list[bool] = []
            for lo in range(0, b.num_rows, 512):
                keep += [x is not None and x >= least_seen for x in judge.evidence(b.column(own).slice(lo, 512).to_pylist())]
            yield b.filter(pa.array(keep, pa.bool_()))
            give_back()

    return rows.restore(rows.df.mapInArrow(run, rows.df.schema))


def tag_words(texts: list[str], model: Model) -> list[list[tuple[str, str]]]:
    """(word, language) of every word with letters, for code-switched text."""
    tagger = Tagger(model)
    rows = tagger.word_ids(texts)
    out = []
    for t, r, post in zip(texts, rows, tagger.posteriors(rows, each=True), strict=True):
        found = [w for w in _WORD.findall(t) if tagger.known[w] >= 0]
        out.append([(w, model.labels[int(p.argmax())]) for w, p in zip(found, post, strict=True)])
    return out


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Learn from the labelled documents that are not held out, predict all:
    id, held_out, lang_pred, score."""
    model = train(training_sample(docs, id_col, text_col, lang_col))
    return predict(docs, model, id_col, text_col).select(
        id_col, F.coalesce(remainder(F.col(id_col)) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")
