"""Language-model scores from a log-bilinear model trained with noise-contrastive estimation.

The model predicts the next token's class from the classes of the ``CONTEXT`` tokens
before it.  Frequent words and the end of the text are classes of their own; the other
words share ``RARE_CLASSES`` classes by their last two letters, and a word's probability
within its class comes from the corpus counts.  Probabilities are normalised: a softmax
over the classes, computed as batched matrix products, times the share within the class.

Counts and gradient steps cover all training texts.  Texts are split once: a table in the shared folder
holds the number of every token, which training and scoring read.  Training runs where the data is:
each task fits the model with numpy on its part of the texts, Spark averages the tasks'
parameters weighted by their tokens, and ``ROUNDS`` rounds repeat that from the average, so scores depend
a little on how the input is cut (a bound is tested).  Equal contexts of a part take a step together,
weighted by how often each target follows them: the sums are those over all tokens, at a fraction
of the work.

Scoring needs each token's count.  The ``COMMON_WORDS`` most frequent are broadcast (a
fixed bound); the others of each text are listed, joined with the counts by a shuffle,
where no key is hot, as none is among the most frequent, and summed per text.

Defined cases: a null or blank text has one token, its end; rows that repeat an id are
scored each by its own text; null ids are ids like others; without training texts every
token has the base probability 1 and the classes are equally likely.  Extra columns are
ignored.
"""

from __future__ import annotations

import functools
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import checkpointed
from ledgerline.session import shared_folder

END = "\n"  # no word holds white space
CONTEXT, DIMENSIONS, VOCABULARY, RARE_CLASSES = 3, 24, 255, 64
COMMON_WORDS = 20_000
ROUNDS, EPOCHS, BATCH, NOISE, RATE = 2, 2, 1024, 48, 0.05
# Contexts of a gradient step; a context seen more often than HEAVY takes part in several.
CONTEXTS, HEAVY = 384, 1024
SMOOTH = 0.1
SCORE_BYTES, TRAIN_TOKENS = 1 << 22, 1 << 21
CACHE_WORDS = 400_000
SAFE = 60.0  # exp of a score up to this, and sums of such, are ordinary float32 numbers


def rare_class(token: Column) -> Column:
    return F.pmod(F.crc32(F.right(token, F.lit(2))), F.lit(RARE_CLASSES)).cast("int")


@dataclass
class Corpus:
    """Counts: all tokens as a table, and what of them has a bounded size."""

    counts: DataFrame  # token, c
    total: int
    distinct: int
    common: dict[str, int]  # the COMMON_WORDS most frequent
    classes: dict[str, int]  # END and the VOCABULARY most frequent words
    rare_sizes: np.ndarray  # per rare class: tokens, distinct tokens

    @property
    def n_classes(self) -> int:
        return len(self.classes) + RARE_CLASSES

    def numbered(self) -> list[str]:
        """Tokens with a number of their own, in order; the rare classes follow."""
        return [END, *(w for w in self.common if w != END)]

    def class_of(self) -> np.ndarray:
        """The class of each number."""
        base = len(self.classes)
        return np.array([self.classes.get(w, base + _rare(w)) for w in self.numbered()]
                        + [base + i for i in range(RARE_CLASSES)], dtype=np.int16)

    def class_counts(self) -> np.ndarray:
        out = np.zeros(self.n_classes)
        for w, i in self.classes.items():
            out[i] = self.common.get(w, 0)
        out[len(self.classes):] = self.rare_sizes[:, 0]
        return out


def _counted(batches):
    """Counts of a task's tokens, handed on whenever they are many."""
    held: list[pa.Table] = []

    def close():
        merged = pa.concat_tables(held).group_by("token", use_threads=False).aggregate([("c", "sum")])
        held.clear()
        return pa.Table.from_arrays([merged["token"], merged["c_sum"]], names=["token", "c"]).combine_chunks().to_batches()

    for batch in batches:
        for texts in _some(batch.column(0)):
            words = _words(texts)[0].value_counts()
            held.append(pa.table([words.field(0), words.field(1)], names=["token", "c"]))
            held.append(pa.table([pa.array([END]), pa.array([len(texts)], pa.int64())], names=["token", "c"]))
            if sum(t.num_rows for t in held) > CACHE_WORDS:
                yield from close()
    if held:
        yield from close()


def count_corpus(docs: DataFrame, text: str = "text") -> Corpus:
    counts = checkpointed(docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(_counted, "token string, c long")
                          .groupBy("token").agg(F.sum("c").alias("c")))
    total, distinct = counts.agg(F.sum("c"), F.count("*")).first()
    # Only words of the levels that the first COMMON_WORDS reach are sorted and sent: else
    # every task would send that many, and the driver's share would grow with the tasks.
    level = F.floor(F.log2("c") * 8)
    least = reached = 0
    for r in counts.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():
        least, reached = r["level"], reached + r["count"]
        if reached >= COMMON_WORDS:
            break
    top = counts.where(level >= least).orderBy(F.desc("c"), "token").limit(COMMON_WORDS).collect()
    common = {r.token: r.c for r in top}
    vocabulary = [w for w in (r.token for r in top) if w != END][:VOCABULARY]
    classes = {w: i for i, w in enumerate([END, *vocabulary])}
    sizes = np.zeros((RARE_CLASSES, 2))
    kept = F.broadcast(docs.sparkSession.createDataFrame([(w,) for w in classes], "token string"))
    for r in (counts.join(kept, "token", "left_anti").groupBy(rare_class(F.col("token")).alias("k"))
              .agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()):
        sizes[r.k] = r.n, r.v
    return Corpus(counts, total or 0, distinct, common, classes, sizes)


@dataclass
class Parameters:
    """Word vectors as context and as target, a diagonal matrix per context place, biases."""

    context: np.ndarray  # (classes, DIMENSIONS)
    places: np.ndarray  # (CONTEXT, DIMENSIONS)
    target: np.ndarray  # (classes, DIMENSIONS)
    bias: np.ndarray  # (classes,)

    @staticmethod
    def start(class_counts: np.ndarray, seed: int = 11) -> "Parameters":
        rng = np.random.default_rng(seed)
        k = len(class_counts)
        share = (class_counts + SMOOTH) / (class_counts + SMOOTH).sum()
        return Parameters(rng.normal(0, 0.1, (k, DIMENSIONS)), np.ones((CONTEXT, DIMENSIONS)),
                          rng.normal(0, 0.1, (k, DIMENSIONS)), np.log(share))

    def flat(self) -> np.ndarray:
        return np.concatenate([self.context.ravel(), self.places.ravel(), self.target.ravel(), self.bias])

    def like(self, flat: np.ndarray) -> "Parameters":
        out, at = [], 0
        for p in (self.context, self.places, self.target, self.bias):
            out.append(flat[at:at + p.size].reshape(p.shape))
            at += p.size
        return Parameters(*out)

    def log10(self, context: np.ndarray, target: np.ndarray) -> np.ndarray:
        """log10 P(target class | context classes) per token; equal contexts and pairs are computed once."""
        k = len(self.bias)
        pairs, of = np.unique(_key(context, k) * k + target, return_inverse=True)
        first = _firsts(pairs // k)
        contexts, at = pairs[first] // k, np.repeat(np.arange(len(first)), np.diff(np.append(first, len(pairs))))
        # One table per place: a context's prediction is a sum of CONTEXT rows; its last cell is 1, for the bias.
        tables = [np.hstack([self.context * p, np.full((k, 1), i == 0)]).astype(np.float32) for i, p in enumerate(self.places)]
        out_t = np.vstack([self.target.T, self.bias]).astype(np.float32)
        ones, edges = np.ones(k, np.float32), np.searchsorted(at, np.arange(0, len(contexts) + BATCH, BATCH))
        value, room = np.empty(len(pairs)), np.empty((BATCH, k), np.float32)
        longest = float(np.sqrt((out_t * out_t).sum(axis=0)).max())
        for n, a in enumerate(range(0, len(contexts), BATCH)):
            c = _classes(contexts[a:a + BATCH], k)
            rows = slice(edges[n], edges[n + 1])
            q = sum(table.take(c[i], axis=0) for i, table in enumerate(tables))
            s = np.matmul(q, out_t, out=room[:len(q)])
            own = s[at[rows] - a, pairs[rows] % k]
            top = np.zeros(len(s), np.float32)
            # No product exceeds that of the lengths: only long vectors need their largest score taken off before exp.
            if not np.sqrt((q * q).sum(axis=1).max()) * longest < SAFE:
                top = s.max(axis=1)
                s -= top[:, None]
            np.exp(s, out=s)
            value[rows] = (own - (top + np.log(s @ ones))[at[rows] - a]) / np.log(10)
        return value.take(of)


def _key(context: np.ndarray, k: int) -> np.ndarray:
    """One number for the classes of a context."""
    key = np.zeros(len(context), np.int64)
    for i in range(CONTEXT):
        key = key * k + context[:, i]
    return key


def _classes(key: np.ndarray, k: int) -> list[np.ndarray]:
    """The classes of ``_key``, by place."""
    return [key // k ** (CONTEXT - 1 - i) % k for i in range(CONTEXT)]


def _firsts(ordered: np.ndarray) -> np.ndarray:
    """Where each run of equal numbers begins."""
    return np.flatnonzero(np.concatenate([[len(ordered) > 0], ordered[1:] != ordered[:-1]]))


@functools.lru_cache(maxsize=8)
def _cells(n: int) -> np.ndarray:
    return np.arange(n * DIMENSIONS // 2).reshape(n, DIMENSIONS // 2)


def _add_rows(out: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """Add ``rows`` to the rows of ``out`` that ``at`` numbers, each as often as it is named (float32, whole arrays).

    Two cells are added at once, as the parts of a complex number, which are added apart.
    """
    np.add.at(out.reshape(-1).view(np.complex64), _cells(len(out)).take(at, axis=0).ravel(), rows.reshape(-1).view(np.complex64))


def _sum_rows(at: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """(n, DIMENSIONS) sums of the ``rows`` that belong to each number."""
    out = np.zeros((n, DIMENSIONS), np.float32)
    _add_rows(out, at, np.ascontiguousarray(rows, np.float32))
    return out


def train_part(start: Parameters, context: np.ndarray, target: np.ndarray, share: np.ndarray, seed: int) -> Parameters:
    """Noise-contrastive estimation by AdaGrad; the noise words are shared by a step.

    A step takes CONTEXTS distinct contexts with all their targets and how often each occurs.  All parameters are views
    of one vector, as are their gradients, so that a step updates them at once; what a step takes is laid out
    for the whole epoch.
    """
    k = len(share)
    values = start.flat().astype(np.float32)
    p, gradient, squares = start.like(values), np.empty_like(values), np.full_like(values, 1e-6)
    g = start.like(gradient)
    log_noise = np.log(NOISE * share).astype(np.float32)
    rng = np.random.default_rng(seed)
    edges = np.cumsum(share)
    pairs, times = np.unique(_key(context, k) * k + target, return_counts=True)
    first = _firsts(pairs // k)
    sizes, weights = np.diff(np.append(first, len(pairs))), np.add.reduceat(times, first)
    classes = np.stack(_classes(pairs[first] // k, k)).astype(np.int16)
    targets = (pairs % k).astype(np.int16)
    del pairs
    parts = -(-weights // HEAVY)  # a frequent context is dealt over several steps
    times = (times / np.repeat(parts, sizes)).astype(np.float32)
    weights = (weights / parts).astype(np.float32)
    entries = np.repeat(np.arange(len(first)), parts)
    ones, scratch = np.ones(DIMENSIONS, np.float32), np.empty_like(values)
    for _ in range(EPOCHS):
        order = rng.permutation(entries)
        steps = range(0, len(order), CONTEXTS)
        noises = np.minimum(np.searchsorted(edges, rng.random((len(steps), NOISE))), k - 1)
        n, weight_of, class_of = sizes.take(order), weights.take(order), classes.take(order, axis=1)
        begin = np.concatenate([[0], np.cumsum(n)])
        at = np.arange(begin[-1]) + np.repeat(first.take(order) - begin[:-1], n)
        target_of, times_of = targets.take(at), times.take(at)
        del at
        row_of = np.repeat((np.arange(len(order)) % CONTEXTS).astype(np.int16), n)
        for a, noise in zip(steps, noises):
            rows = slice(a, a + CONTEXTS)
            of = slice(begin[a], begin[min(a + CONTEXTS, len(order))])
            t, c, row = (x.astype(np.intp) for x in (target_of[of], class_of[:, rows], row_of[of]))
            w, weight = times_of[of], weight_of[rows]
            total = weight.sum()
            tables = p.context * p.places[:, None]
            q = tables[0].take(c[0], axis=0)
            for table, x in zip(tables[1:], c[1:]):
                q += table.take(x, axis=0)
            wide, own, others = q.take(row, axis=0), p.target.take(t, axis=0), p.target.take(noise, axis=0)
            offset = p.bias - log_noise
            up = (wide * own) @ ones
            up += offset.take(t)
            np.exp(up, out=up)
            up += 1
            up *= total
            np.divide(w, up, out=up)
            down = q @ others.T
            np.subtract(-offset.take(noise), down, out=down)
            np.exp(down, out=down)
            down += 1
            np.divide((weight / -total)[:, None], down, out=down)
            gradient.fill(0)
            own *= up[:, None]
            g_q = down @ others
            _add_rows(g_q, row, own)
            wide *= up[:, None]
            _add_rows(g.target, t, wide)
            _add_rows(g.target, noise, down.T @ q)
            np.add.at(g.bias, t, up)
            np.add.at(g.bias, noise, down.sum(axis=0))
            # Per place the gradients of a context class's rows add up before its vector comes in.
            by_class = np.stack([_sum_rows(x, g_q, k) for x in c])
            np.einsum("pkd,pd->kd", by_class, p.places, out=g.context)
            np.einsum("pkd,kd->pd", by_class, p.context, out=g.places)
            np.multiply(gradient, gradient, out=scratch)
            squares += scratch
            gradient *= RATE
            np.sqrt(squares, out=scratch)
            gradient /= scratch
            values += gradient
    return p


def _rare(word: str) -> int:
    return zlib.crc32(word[-2:].encode()) % RARE_CLASSES


@functools.cache
def _rare_by_tail() -> np.ndarray:
    """The rare class of a word by its last two bytes, where both are letters of one byte."""
    return np.array([zlib.crc32(bytes(divmod(i, 128))) % RARE_CLASSES for i in range(128 * 128)], np.int16)


def _rare_classes(words: pa.Array) -> np.ndarray:
    """``_rare`` of words in UTF-8."""
    ends = np.frombuffer(words.buffers()[1], np.int32, len(words) + 1)
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
    if not len(words):
        return np.zeros(0, np.int16)
    last, before = data[ends[1:] - 1], data[np.maximum(ends[1:] - 2, 0)]
    plain = (last < 128) & (before < 128) & (np.diff(ends) > 1)
    out = _rare_by_tail()[np.where(plain, before.astype(np.int32) * 128 + last, 0)]
    for i in np.flatnonzero(~plain):
        out[i] = _rare(words[i].as_py().decode())
    return out


def _some(texts: pa.Array):
    """Some texts at a time, about ``SCORE_BYTES`` (a longer text alone)."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(texts):
        done = int(sizes[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(sizes, done + SCORE_BYTES, side="right")))
        yield texts.slice(at, to - at)
        at = to


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, A-Z in lower case, and how many each text has; a null text has none.

    Both functions of Arrow know ASCII only: other letters stay, and the white space is
    that which parts words, no other.
    """
    lower = pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), ""))
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(lower))
    words, edges = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    filled = pc.binary_length(words).to_numpy() > 0
    if not filled.all():  # a blank text leaves an empty piece
        words = words.filter(pa.array(filled))
    before = np.concatenate([[0], np.cumsum(filled, dtype=np.int64)])
    return words, np.diff(before[edges - edges[0]])


def _contexts(ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Classes of the CONTEXT tokens before each token; before a text stand ends."""
    out = np.zeros((len(ids), CONTEXT), ids.dtype)
    for i in range(CONTEXT):
        out[i + 1:, i] = ids[:max(0, len(ids) - i - 1)]
        for j in range(i + 1):  # the first tokens of a text see nothing of the text before
            first = starts[:-1] + j
            out[first[first < starts[1:]], i] = 0
    return out


def _packed(numbers: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The texts' numbers (16 bits each) as a binary cell each: Spark copies those whole, arrays by element."""
    return pa.Array.from_buffers(pa.binary(), len(starts) - 1, [
        None, pa.py_buffer(np.array(starts, np.int32) * np.int32(2)), pa.py_buffer(np.ascontiguousarray(numbers, np.int16))])


def _flat(packed: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the texts, and where each text starts and the last ends."""
    if not len(packed):
        return np.zeros(0, np.int16), np.zeros(1, np.int64)
    _, offsets, data = packed.buffers()
    starts = np.frombuffer(offsets, np.int32, len(packed) + 1, packed.offset * 4).astype(np.int64)
    return np.frombuffer(data, np.int16, (starts[-1] - starts[0]) // 2, starts[0]), (starts - starts[0]) // 2


def _pieces(packed: pa.Array, most: int):
    """Numbers and starts of some texts at a time, about ``most`` tokens (a longer text alone)."""
    numbers, starts = _flat(packed)
    at = 0
    while at < len(starts) - 1:
        to = max(at + 1, int(np.searchsorted(starts, starts[at] + most, side="right")) - 1)
        yield numbers[starts[at]:starts[to]], starts[at:to + 1] - starts[at]
        at = to


def train(numbered: DataFrame, corpus: Corpus) -> Parameters:
    """``numbered``: the training texts' numbers; every one of them is fitted on in each round."""
    counts = corpus.class_counts()
    share = (counts + SMOOTH) / (counts + SMOOTH).sum()
    params, class_of = Parameters.start(counts), corpus.class_of()
    for round_ in range(ROUNDS):
        def fit(batches, start=params, round_=round_):
            now, seen, held = start, 0, []

            def step(now):
                ids = np.concatenate([x for x, _ in held])
                starts = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(x) for _, x in held]))])
                return train_part(now, _contexts(ids, starts), ids, share, round_), len(ids)

            for batch in batches:
                for numbers, starts in _pieces(batch.column("numbers"), TRAIN_TOKENS):
                    held.append((class_of[numbers], starts))
                    if sum(len(x) for x, _ in held) >= TRAIN_TOKENS:
                        now, n = step(now)
                        seen, held = seen + n, []
            if held:
                now, n = step(now)
                seen += n
            if seen:
                flat = now.flat().astype(np.float64)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat)), pa.int32()), pa.array(flat * seen),
                                                  pa.array(np.full(len(flat), seen, np.int64))], names=["i", "x", "n"])

        mean = numbered.select("numbers").mapInArrow(fit, "i int, x double, n long").groupBy("i").agg(
            (F.sum("x") / F.sum("n")).alias("x")).toPandas().sort_values("i")
        if len(mean):
            params = params.like(mean["x"].to_numpy())
    return params


def _number(words_: list[str]):
    def run(batches):
        known = pa.array(words_, pa.string())

        def numbered(rows):
            words, sizes = _words(rows.column("text"))
            found = pc.index_in(words, value_set=known)
            rest = words.filter(pc.is_null(found))
            of_words = pc.fill_null(found, -1).to_numpy().astype(np.int16)
            rare = np.flatnonzero(of_words < 0)
            of_words[rare] = len(words_) + _rare_classes(rest.cast(pa.binary()))
            starts = np.concatenate([[0], np.cumsum(sizes + 1)])
            is_word = np.ones(starts[-1], bool)
            is_word[starts[1:] - 1] = False
            ids = np.zeros(starts[-1], np.int16)  # words_ begins with END
            ids[is_word] = of_words
            edges = np.searchsorted(rare, np.concatenate([[0], np.cumsum(sizes)]))
            return pa.RecordBatch.from_arrays(
                [rows.column("id"), rows.column("row"), rows.column("held_out"), _packed(ids, starts),
                 pa.ListArray.from_arrays(pa.array(edges, pa.int32()), rest)],
                names=["id", "row", "held_out", "numbers", "rest"])

        for batch in batches:
            at = 0
            for texts in _some(batch.column("text")):
                yield numbered(batch.slice(at, len(texts)))
                at += len(texts)

    return run


def _score(corpus: Corpus, params: Parameters):
    words_, common, class_of = corpus.numbered(), corpus.common, corpus.class_of()
    base = len(corpus.classes)
    log = np.array([np.log10(common.get(w, 0) + SMOOTH) for w in words_] + [0.0] * RARE_CLASSES)
    known = np.array([int(w in common) for w in words_] + [0] * RARE_CLASSES)
    # A word that shares a class: its log count, less what its whole class counts.
    whole = np.log10(corpus.rare_sizes[:, 0] + SMOOTH * (corpus.rare_sizes[:, 1] + 1))
    inside = np.where(class_of < base, 0.0, log - whole[np.maximum(class_of - base, 0)])

    def run(batches):
        for batch in batches:
            cells = []
            for a, s in _pieces(batch.column("numbers"), TRAIN_TOKENS):  # the more tokens, the more contexts are equal
                c = class_of[a]
                per = params.log10(_contexts(c, s), c) + inside[a]
                cells.append([np.diff(s), *(np.add.reduceat(x, s[:-1]) for x in (known[a], log[a], per))])
            if cells:
                done = [np.concatenate(x) for x in zip(*cells)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c) for c in ("id", "row", "held_out")]
                    + [pa.array(x, pa.int64()) for x in done[:2]] + [pa.array(x, pa.float64()) for x in done[2:]],
                    names=["id", "row", "held_out", "n_tokens", "known", "log_common", "log_model"])

    return run


def score(docs: DataFrame, held_out: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, held_out, n_tokens, n_known, train_tokens, base_score, score per input row.

    Rows where ``held_out`` isn't true train the model.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col(f"`{key}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"), held_out.alias("held_out"))
    corpus = count_corpus(slim.where(~F.coalesce("held_out", F.lit(False))))
    kind = slim.schema["id"].dataType.simpleString()
    # Parquet, not checkpoint(): the numbers compress well, and each use reads only its columns.
    folder = shared_folder(spark, "lm")
    # Rows are told apart by a number that is stored with them: ids may repeat.
    slim.withColumn("row", F.monotonically_increasing_id()).mapInArrow(
        _number(corpus.numbered()), f"id {kind}, row long, held_out boolean, numbers binary, rest array<string>").write.parquet(folder)
    numbered = spark.read.parquet(folder)
    params = train(numbered.where(~F.coalesce("held_out", F.lit(False))), corpus)

    scored = numbered.select("id", "row", "held_out", "numbers").mapInArrow(
        _score(corpus, params), f"id {kind}, row long, held_out boolean, n_tokens long, known long, "
        "log_common double, log_model double")
    known = corpus.counts.select("token", F.log10(F.col("c") + SMOOTH).alias("log"))
    logs = (numbered.select("row", F.explode("rest").alias("token")).join(known, "token", "left")
            .groupBy("row").agg(F.sum(F.coalesce("log", F.log10(F.lit(SMOOTH)))).alias("log_rare"),
                                F.count("log").alias("rare_known")))
    joined = scored.join(logs, "row", "left")
    rare = F.coalesce(F.col("log_rare"), F.lit(0.0))
    norm = float(np.log10(corpus.total + SMOOTH * (corpus.distinct + 1)))
    return joined.select(
        F.col("id").alias(key), "held_out", "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(corpus.total).cast("long").alias("train_tokens"),
        (F.col("log_common") + rare - F.col("n_tokens") * norm).alias("base_score"),
        (F.col("log_model") + rare).alias("score"))
