"""Spelling variant grouping by dense prefix-suffix tiling (op 13).

Words one inserted, deleted or replaced code point apart: the longest common prefix and suffix
together reach the longer length minus one.  That is tested densely, tile against tile,
on padded code-point matrices (once aligned left, once right).

Which tiles meet: an edit of two words, the shorter of length L, leaves either the first
L // 2 code points or the last L - L // 2 alone.  So words meet in groups by L and a hash of that
prefix, or of that suffix; a word belongs to four groups (as the shorter or as the longer
word, by prefix or by suffix), and pairs are not sought elsewhere.  Hashes are folded until a
group holds about one tile of words; larger groups are cut into tiles that meet pairwise, each pair a
group of its own for Spark to place.  A pair found by its prefix is not reported by its suffix.

Defined cases: a null text has no words, a null id counts as the empty text; repeated rows
count each; words of any length take part (tiles of long words hold fewer); an empty table gives
no rows.  Further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import checkpointed

RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Words of a tile, and code points of a tile's matrix at most.
TILE, TILE_CELLS = 512, 1 << 21
# Lengths from this on share one count when groups are made: the table of counts has 2 * LENGTHS rows at most.
LENGTHS = 64
PAIR = "word string, near string, near_n bigint"


def word_counts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", every: int = 97,
                least_length: int = 5, least_count: int = 3) -> DataFrame:
    """(word, n): the letter runs of whole texts, every so many of them with a code point deleted."""
    doc = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
    runs = docs.select(doc.alias("doc"), F.explode(F.regexp_extract_all(
        F.translate(F.col(text_column), UPPER, LOWER), F.lit(RUN), F.lit(0))).alias("run"))
    h = F.crc32(F.concat("doc", F.lit(":"), "run").cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    return runs.select("run", h.alias("h")) \
        .select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("run")).alias("word")) \
        .where(F.length("word") >= least_length) \
        .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def _tile(size: Column) -> Column:
    """Words of a tile at a length: TILE, fewer for long words."""
    return F.greatest(F.lit(1), F.least(F.lit(TILE), F.floor(F.lit(TILE_CELLS) / size)))


def _entries(vocabulary: DataFrame) -> DataFrame:
    """Four rows a word: (size, side, key, longer); size is the shorter word's length."""
    length = F.length("word")

    def entry(size: Column, side: str, longer: bool) -> Column:
        half = F.floor(size / 2).cast("int")
        part = F.substr("word", F.lit(1), half) if side == "prefix" else F.right("word", size - half)
        return F.struct(size.alias("size"), F.lit(side).alias("side"), F.xxhash64(part).alias("key"),
                        F.lit(longer).alias("longer"))

    return vocabulary.select("word", "n", F.inline(F.array(*[
        entry(length - int(longer), side, longer) for side in ("prefix", "suffix") for longer in (False, True)])))


def _grouped(vocabulary: DataFrame) -> DataFrame:
    """Entries dealt to tile pairs (size, side, part, a, b); ``tile`` is the entry's own tile, a or b."""
    entries = _entries(vocabulary).withColumn("_length", F.least("size", F.lit(LENGTHS)))
    parts = entries.groupBy("_length", "side").agg(F.count(F.lit(1)).alias("_n")) \
        .select("_length", "side", F.ceil(F.col("_n") / _tile(F.col("_length"))).alias("parts"))
    entries = entries.join(F.broadcast(parts), ["_length", "side"]).withColumn("part", F.expr("pmod(key, parts)"))
    tiles = entries.groupBy("size", "side", "part").agg(
        F.count(F.lit(1)).alias("_n"), F.min("longer").alias("_all_longer")) \
        .where((F.col("_n") > 1) & ~F.col("_all_longer")) \
        .select("size", "side", "part", F.ceil(F.col("_n") / (2 * _tile(F.col("size")))).cast("int").alias("tiles"))
    entries = entries.join(tiles, ["size", "side", "part"]) \
        .withColumn("tile", F.expr("cast(pmod(xxhash64(word, 7), tiles) as int)")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    return entries.select("size", "side", "part", F.least("tile", "other").alias("a"),
                          F.greatest("tile", "other").alias("b"), "tile", "longer", "word", "n")


def code_points(words: list[str], width: int, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """The words as rows of code points, aligned left and aligned right, padded with ``pad``."""
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    flat = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.int32)
    row = np.repeat(np.arange(len(words)), lengths)
    column = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    left = np.full((len(words), width), pad, dtype=np.int32)
    right = left.copy()
    left[row, column] = flat
    right[row, column + np.repeat(width - lengths, lengths)] = flat
    return left, right


def common_runs(a: np.ndarray, b: np.ndarray, backwards: bool = False) -> np.ndarray:
    """Length of the common prefix (or suffix) of every row of ``a`` with every row of ``b``."""
    out = np.zeros((len(a), len(b)), dtype=np.int32)
    alive = np.ones((len(a), len(b)), dtype=bool)
    columns = range(a.shape[1])
    for j in reversed(columns) if backwards else columns:
        alive &= a[:, j, None] == b[None, :, j]
        if not alive.any():
            break
        out += alive
    return out


def single_edits(size: int, shorter: list[str], others: list[str], side: str) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) with shorter[i] one edit from others[j], found by ``side``.

    The words of ``shorter`` have ``size`` code points, those of ``others`` as many or one more.
    """
    if not shorter or not others:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    a, b = code_points(shorter, size + 1, -1), code_points(others, size + 1, -2)
    prefix = common_runs(a[0], b[0])
    longest = np.array([len(w) for w in others])
    edits = (prefix + common_runs(a[1], b[1], backwards=True) >= longest - 1) & (prefix < longest)
    return np.nonzero(edits & ((prefix >= size // 2) == (side == "prefix")))


def _near(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Pairs of one tile pair, both ways round."""
    size, side, _, a, b = key
    words, counts = rows["word"].to_numpy(), rows["n"].to_numpy()
    tile, longer = rows["tile"].to_numpy(), rows["longer"].to_numpy()

    def of(t: int, long: bool) -> np.ndarray:
        return np.flatnonzero((tile == t) & (longer == long))

    meet = [(of(a, False), of(b, False)), (of(a, False), of(b, True))]
    if a != b:
        meet.append((of(b, False), of(a, True)))
    found = []
    for at, to in meet:
        i, j = single_edits(size, list(words[at]), list(words[to]), side)
        i, j = at[i], to[j]
        if a == b:  # two words of one length meet twice here
            once = longer[j] | (i < j)
            i, j = i[once], j[once]
        found += [(i, j), (j, i)]
    i, j = (np.concatenate(x) for x in zip(*found))
    return pd.DataFrame({"word": words[i], "near": words[j], "near_n": counts[j]})


def near_words(vocabulary: DataFrame) -> DataFrame:
    """(word, near, near_n): every two words one edit apart, both ways round."""
    return _grouped(vocabulary).groupBy("size", "side", "part", "a", "b").applyInPandas(_near, PAIR)


def _roots(forms: DataFrame, most: int, least_count: int) -> DataFrame:
    """(word, root) of words with a form.  A form is at least twice as frequent, so a chain has at
    most log2(most / least) steps; every round doubles the steps taken."""
    steps = max(1, math.floor(math.log2(max(2, most / least_count))))
    roots = forms.select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps)) if steps > 1 else 0):
        on = roots.select(F.col("word").alias("_at"), F.col("root").alias("_to"))
        roots = checkpointed(roots.join(on, roots["root"] == on["_at"], "left").select(
            "word", F.coalesce("_to", "root").alias("root")))
    return roots


def spelling_variants(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", every: int = 97,
                      least_length: int = 5, least_count: int = 3) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word."""
    vocabulary = checkpointed(word_counts(docs, id_column, text_column, every, least_length, least_count))
    best = near_words(vocabulary).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct(-F.col("near_n"), F.col("near"))).alias("best"))
    best = best.select("word", "n_near", (-F.col("best")["col1"]).alias("near_n"), F.col("best")["near"].alias("near"))
    leads = F.coalesce(F.col("near_n") >= 2 * F.col("n"), F.lit(False))
    forms = checkpointed(vocabulary.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(leads, F.col("near")).alias("form"), F.when(leads, F.col("near_n")).alias("form_n")))
    most = vocabulary.agg(F.max("n")).first()[0] or 0
    roots = _roots(forms.where(F.col("form").isNotNull()), most, least_count)
    return forms.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
