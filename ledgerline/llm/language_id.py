"""Language identification with a linear-chain conditional random field over words.

Each word of a text gets a distribution over languages by forward-backward, so a text
that switches languages is labelled word by word; the text's language is the one with
the most expected words, and the score is its share.

Features of a word: itself, prefixes and suffixes of one to three letters, all its letter
trigrams (a line without spaces is one word, however long, and is read whole), and the lexicon entry (the language that a frequent training word is most
often seen in).  They are hashed into ``FEATURES`` weights per language; transition
weights are learned with them.  A word without a letter has no features: its place only
carries transitions.

Training takes a bounded sample: about ``docs_per_language`` texts per language, chosen
by hash, and from each ``WINDOWS`` windows of ``WINDOW_WORDS`` words at hashed places.
Windows of different texts are strung together, so that switches occur and the
transitions are learned.  The sample trains in numpy on the driver; its size depends on
those parameters and the number of languages, not on the corpus.  Prediction reads whole
texts, in Arrow batches on the executors, with a broadcast model of
``FEATURES * languages`` numbers.

Defined cases: null texts and texts without a letter get ``und`` and score 0; rows with a
null language don't train; without any training row all texts get ``und``, and
``drop_unidentified`` keeps those with a letter; ties go to the first language in order.  Extra columns are ignored by ``identify`` and kept by
``drop_unidentified``.
"""

from __future__ import annotations

import itertools
import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructType

from ledgerline.llm.common import WORD, words

FEATURES = 1 << 16
DOCS_PER_LANGUAGE, WINDOWS, WINDOW_WORDS, STRUNG = 300, 3, 24, 3
STEPS, RATE, L2 = 30, 0.15, 1e-5
PART_FEATURES = 100_000
CHUNK = 64
BATCH_WORDS = 400_000
CACHE_WORDS, CACHE_LETTERS, CACHE_NAMES = 300_000, 6_000_000, 2_000_000
UNKNOWN = "und"
_WORD = re.compile(WORD)
_LETTERS = re.compile(r"[^\W\d_]+")


def normal(word: str) -> str:
    """The letters of a word in lower case; empty if it has none."""
    low = word.lower()
    return low if low.isalpha() else "".join(_LETTERS.findall(low))


class _Hashes(dict):
    """Feature name to weight number; affixes and trigrams come again and again."""

    def __missing__(self, name: str) -> int:
        i = self[name] = zlib.crc32(name.encode()) % FEATURES
        return i


def word_features(word: str, lexicon: dict[str, int], hashes: _Hashes) -> list[int]:
    names = ["<" + word[:1], ">" + word[-1:], "<" + word[:2], ">" + word[-2:], "<" + word[:3], ">" + word[-3:]]
    if word in lexicon:
        names.append(f"@{lexicon[word]}")
    names += [word[i:i + 3] for i in range(len(word) - 2)]
    return [zlib.crc32(b"=" + word.encode()) % FEATURES, *[hashes[x] for x in names]]


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray  # (FEATURES, languages)
    moves: np.ndarray  # (languages, languages), log potentials
    lexicon: dict[str, int] = field(default_factory=dict)

    def emissions(self, found: list[str], hashes: _Hashes) -> np.ndarray:
        """(words, languages) potentials, the largest 1."""
        e = np.zeros((len(found), len(self.languages)))
        done, flat, starts = 0, [], []
        for n, w in enumerate(found, 1):
            starts.append(len(flat))
            flat += word_features(w, self.lexicon, hashes)
            if len(flat) >= PART_FEATURES or n == len(found):
                e[done:n] = np.add.reduceat(self.weights[np.array(flat)], starts, axis=0)
                done, flat, starts = n, [], []
        return np.exp(e - e.max(axis=1, keepdims=True))


def _potentials(moves: np.ndarray) -> np.ndarray:
    p = np.exp(moves - moves.max())
    return p / p.sum(axis=1).max()


def forward_backward(e: np.ndarray, moves: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word posteriors, expected moves and log-likelihood normalisers of padded sequences.

    e: (sequences, longest, languages), potentials of the words.
    """
    a = _potentials(moves)
    n, longest, k = e.shape
    alpha, beta = np.zeros_like(e), np.ones_like(e)
    scale = np.ones((n, longest))
    state = np.full((n, k), 1.0 / k)
    for t in range(longest):
        on = t < lengths
        state = np.where(on[:, None], (state @ a) * e[:, t] if t else e[:, 0] / k, state)
        scale[:, t] = np.where(on, state.sum(axis=1), 1.0)
        state = state / state.sum(axis=1, keepdims=True)
        alpha[:, t] = state
    back = np.ones((n, k))
    pair = np.zeros((k, k))
    for t in range(longest - 1, -1, -1):
        on = t < lengths
        beta[:, t] = np.where(on[:, None], back, 1.0)
        if t:
            ahead = e[:, t] * back
            both = alpha[:, t - 1][:, :, None] * a[None] * ahead[:, None, :]
            pair += (both / np.maximum(both.sum(axis=(1, 2), keepdims=True), 1e-300) * on[:, None, None]).sum(axis=0)
            new = ahead @ a.T
            back = np.where(on[:, None], new / new.sum(axis=1, keepdims=True), back)
    post = alpha * beta
    post /= post.sum(axis=2, keepdims=True)
    post *= (np.arange(longest)[None, :] < lengths[:, None])[:, :, None]
    return post, pair, np.log(scale).sum(axis=1)


def posteriors(e: np.ndarray, moves: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Word posteriors of texts of any length; text i has the words starts[i]:starts[i+1] of ``e``.

    Texts are cut into chunks; matrix products carry the messages exactly across the cuts,
    so the number of steps depends on CHUNK and the number of chunks, not on the words.
    """
    a = _potentials(moves)
    k = e.shape[1]
    lengths = np.diff(starts)
    per = -(-lengths // CHUNK)
    first = np.concatenate([[0], np.cumsum(per)])
    total = int(first[-1])
    text_of = np.repeat(np.arange(len(lengths)), per)
    nth = np.arange(total) - first[text_of]
    place = starts[text_of][:, None] + (nth * CHUNK)[:, None] + np.arange(CHUNK)[None, :]
    on = place < starts[text_of + 1][:, None]
    x = e[np.where(on, place, 0)]
    product = np.broadcast_to(np.eye(k), (total, k, k)).copy()
    for t in range(CHUNK):
        new = (product @ a) * x[:, t, None, :]
        product = np.where(on[:, t, None, None], new / new.sum(axis=(1, 2), keepdims=True), product)
    into = np.full((total, k), 1.0 / k)
    outof = np.ones((total, k))
    most = int(per.max(initial=0))
    by_size = np.argsort(-per, kind="stable")
    ranked = per[by_size]
    for c in range(1, most):
        at = first[by_size[:np.searchsorted(-ranked, -c)]] + c
        v = (into[at - 1][:, None, :] @ product[at - 1])[:, 0]
        if c == 1:
            v = _first_chunk(x[at - 1], a)
        into[at] = v / v.sum(axis=1, keepdims=True)
    for c in range(most - 2, -1, -1):
        at = first[by_size[:np.searchsorted(-ranked, -(c + 1))]] + c
        v = (product[at + 1] @ outof[at + 1][:, :, None])[:, :, 0]
        outof[at] = v / v.sum(axis=1, keepdims=True)
    alpha = np.empty((total, CHUNK, k))
    state, opening = into, nth == 0
    for t in range(CHUNK):
        moved = state @ a
        if t == 0:  # no move leads into the first word of a text
            moved = np.where(opening[:, None], 1.0 / k, moved)
        new = moved * x[:, t]
        state = np.where(on[:, t, None], new / new.sum(axis=1, keepdims=True), state)
        alpha[:, t] = state
    back = outof
    out = np.zeros_like(e)
    for t in range(CHUNK - 1, -1, -1):
        post = alpha[:, t] * back
        post /= post.sum(axis=1, keepdims=True)
        rows = on[:, t]
        out[place[rows, t]] = post[rows]
        new = (x[:, t] * back) @ a.T
        back = np.where(rows[:, None], new / new.sum(axis=1, keepdims=True), back)
    return out


def _first_chunk(x: np.ndarray, a: np.ndarray) -> np.ndarray:
    """Messages out of full first chunks, whose first word has no move before it."""
    state = x[:, 0] / x[:, 0].sum(axis=1, keepdims=True)
    for t in range(1, CHUNK):
        state = (state @ a) * x[:, t]
        state /= state.sum(axis=1, keepdims=True)
    return state


def train(samples: list[tuple[str, list[str]]], seed: int = 3) -> Model | None:
    """Fit on (language, words) windows; None if there are none."""
    samples = [(lang, [w for w in map(normal, ws) if w]) for lang, ws in samples]
    samples = sorted((lang, ws) for lang, ws in samples if ws)
    if not samples:
        return None
    languages = sorted({lang for lang, _ in samples})
    k = len(languages)
    label = {x: i for i, x in enumerate(languages)}
    seen: dict[str, np.ndarray] = {}
    for lang, ws in samples:
        for w in ws:
            seen.setdefault(w, np.zeros(k))[label[lang]] += 1
    lexicon = {w: int(c.argmax()) for w, c in seen.items() if c.sum() >= 5 and c.max() >= 0.6 * c.sum()}
    ids = {w: i for i, w in enumerate(seen)}
    hashes = _Hashes()
    lists = [word_features(w, lexicon, hashes) for w in ids]
    sizes = np.array([len(x) for x in lists], np.int64)
    index, firsts = np.fromiter(itertools.chain.from_iterable(lists), np.int64, int(sizes.sum())), np.cumsum(sizes) - sizes
    order = np.random.default_rng(seed).permutation(len(samples))
    groups = [order[i:i + STRUNG] for i in range(0, len(order), STRUNG)]
    lengths = np.array([sum(len(samples[i][1]) for i in g) for g in groups])
    token = np.zeros((len(groups), lengths.max()), np.int64)
    truth = np.zeros_like(token)
    for r, g in enumerate(groups):
        t = 0
        for i in g:
            lang, ws = samples[i]
            token[r, t:t + len(ws)] = [ids[w] for w in ws]
            truth[r, t:t + len(ws)] = label[lang]
            t += len(ws)
    on = np.arange(token.shape[1])[None, :] < lengths[:, None]
    empirical = np.zeros((len(ids), k))
    np.add.at(empirical, (token[on], truth[on]), 1)
    empirical_moves = np.zeros((k, k))
    np.add.at(empirical_moves, (truth[:, :-1][on[:, 1:]], truth[:, 1:][on[:, 1:]]), 1)
    weights, moves = np.zeros((FEATURES, k)), np.zeros((k, k))
    sums = [[np.zeros_like(p), np.zeros_like(p)] for p in (weights, moves)]
    for step in range(1, STEPS + 1):
        by_type = np.add.reduceat(weights[index], firsts, axis=0)
        by_type = np.exp(by_type - by_type.max(axis=1, keepdims=True))
        post, pair, _ = forward_backward(by_type[token], moves, lengths)
        expected = np.stack([np.bincount(token[on], post[on][:, j], len(ids)) for j in range(k)], axis=1)
        by_word = empirical - expected
        grad = np.stack([np.bincount(index, np.repeat(by_word[:, j], sizes), FEATURES)
                         for j in range(k)], axis=1) / len(groups) - L2 * weights
        grad_moves = (empirical_moves - pair) / len(groups) - L2 * moves
        for p, g, (m, v) in zip((weights, moves), (grad, grad_moves), sums):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p += RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return Model(languages, weights.astype(np.float32), moves, lexicon)


def sample_windows(docs: DataFrame, learn: Column, text: str = "text", lang: str = "lang",
                   key: str = "doc_id", docs_per_language: int = DOCS_PER_LANGUAGE) -> list[tuple[str, list[str]]]:
    """The bounded training sample: (language, words) windows of the rows where ``learn`` holds."""
    usable = docs.where(learn & F.col(f"`{lang}`").isNotNull() & F.col(f"`{text}`").isNotNull())
    counts = {r[0]: r[1] for r in usable.groupBy(F.col(f"`{lang}`")).count().collect()}
    if not counts:
        return []
    place = F.pmod(F.xxhash64(F.col(f"`{key}`"), F.lit("language")), F.lit(1 << 30)) / float(1 << 30)
    wanted = None
    for x, n in sorted(counts.items()):
        chosen = (F.col(f"`{lang}`") == x) & (place < min(1.0, docs_per_language / n))
        wanted = chosen if wanted is None else wanted | chosen
    w = usable.where(wanted).select(F.col(f"`{lang}`").alias("lang"), F.col(f"`{key}`").alias("key"),
                                    words(F.col(f"`{text}`")).alias("w"))
    room = F.greatest(F.size("w") - WINDOW_WORDS + 1, F.lit(1))
    windows = [F.slice("w", (F.pmod(F.xxhash64("key", F.lit(i)), room) + 1).cast("int"), WINDOW_WORDS)
               for i in range(WINDOWS)]
    return [(r.lang, list(x)) for r in w.select("lang", F.array(*windows).alias("ws")).collect() for x in r.ws]


class _Words(dict):
    """Word to the number of its letters in lower case, -1 without a letter; new ones wait in ``new``."""

    def __init__(self) -> None:
        super().__init__()
        self.numbers: dict[str, int] = {}
        self.new: list[str] = []
        self.letters = 0

    def __missing__(self, word: str) -> int:
        self.letters += len(word)
        n = normal(word)
        i = -1
        if n:
            i = self.numbers.get(n, -1)
            if i < 0:
                i = self.numbers[n] = len(self.numbers)
                self.new.append(n)
        self[word] = i
        return i


def _label(model: Model):
    def score(texts: list[str | None], cache: _Words, table: np.ndarray, hashes: _Hashes):
        ids = [[cache[w] for w in _WORD.findall(text or "")] for text in texts]
        sizes = np.array([len(x) for x in ids], np.int64)
        flat = np.fromiter(itertools.chain.from_iterable(ids), np.int64, int(sizes.sum()))
        if cache.new:
            table = np.concatenate([table, model.emissions(cache.new, hashes)])
            cache.new.clear()
        lettered = flat >= 0
        text_of = np.repeat(np.arange(len(texts)), sizes)[lettered]
        starts = np.concatenate([[0], np.cumsum(np.bincount(text_of, minlength=len(texts)))])
        share = np.zeros((len(texts), len(model.languages)))
        full = np.flatnonzero(np.diff(starts))
        if len(full):
            post = posteriors(table[flat[lettered]], model.moves, starts)
            share[full] = np.add.reduceat(post, starts[full], axis=0) / np.diff(starts)[full][:, None]
        best = share.argmax(axis=1)
        known = share.sum(axis=1) > 0
        return ([model.languages[b] if ok else UNKNOWN for b, ok in zip(best, known)],
                np.clip(share[np.arange(len(texts)), best], 0, 1), table)

    def run(batches):
        nothing = np.zeros((0, len(model.languages)))
        cache, table, hashes = _Words(), nothing, _Hashes()
        for batch in batches:
            texts = batch.column(0).to_pylist()
            names, scores, part, held = [], [], [], 0
            for text in [*texts, ...]:
                if text is not ...:
                    part.append(text)
                    held += len(text or "") // 5
                if part and (text is ... or held > BATCH_WORDS):
                    if len(cache) > CACHE_WORDS or cache.letters > CACHE_LETTERS:
                        cache, table = _Words(), nothing
                    if len(hashes) > CACHE_NAMES:
                        hashes = _Hashes()
                    n, s, table = score(part, cache, table, hashes)
                    names += n
                    scores.append(s)
                    part, held = [], 0
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(names, pa.string()),
                 pa.array(np.concatenate(scores) if scores else np.zeros(0), pa.float64())],
                names=[*batch.schema.names[1:], "_lang", "_score"])

    return run


def identify(docs: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, lang_pred, score per input row."""
    slim = docs.select(F.col(f"`{text}`").alias("_text"), F.col(f"`{key}`").alias("_key"))
    if model is None:
        return slim.select(F.col("_key").alias(key), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    kind = docs.select(F.col(f"`{key}`")).schema[0].dataType.simpleString()
    return slim.mapInArrow(_label(model), f"_key {kind}, _lang string, _score double").select(
        F.col("_key").alias(key), F.col("_lang").alias("lang_pred"), F.col("_score").alias("score"))


def _keep_lettered(batches):
    for batch in batches:
        yield batch.filter(pa.array([bool(_LETTERS.search(t or "")) for t in batch.column(0).to_pylist()], pa.bool_()))


def drop_unidentified(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text isn't ``und``, columns as they were.

    A text of several languages stays, whatever the share of each; without a model every
    text with a letter stays.
    """
    # The columns go through Arrow by place, so extra or clashing names don't matter.
    inner = docs.select(F.col(f"`{text}`"), *[F.col(f"`{c}`") for c in docs.columns]).toDF(
        "_text", *[f"c{i}" for i in range(len(docs.columns))])
    if model is None:
        return inner.mapInArrow(_keep_lettered, inner.schema).drop("_text").toDF(*docs.columns)
    schema = StructType(inner.schema.fields[1:]).add("_lang", StringType()).add("_score", DoubleType())
    out = inner.mapInArrow(_label(model), schema).where(F.col("_lang") != UNKNOWN)
    return out.drop("_lang", "_score").toDF(*docs.columns)
