"""N-gram Jaccard join by MinHash banding, with exact verification.

The 5-word shingles of a text form a set of 64-bit hashes.  Texts with equal sets are
copies and collapse into one class first (map-side combine).  ``plan_bands`` chooses
bands and rows for a target recall at the similarity threshold; band hashes are
shuffled, and sets that share one meet.  They are not paired: sets that meet are
joined into candidate components through the smallest member of each band bucket, so
rows stay linear in the input.  Then each component is verified on the full sets: as
products of 0/1 matrices in blocks, which give all pairs' intersections without
writing pairs.  Each set gets the number of documents linked with it and the smallest
member it is connected with; connected components of these links are the groups.

A component is cut by hash into blocks of bounded size and every pair of blocks is one
task, so a component of any size is verified whole, without a cap, and no task holds
more than two blocks.  What is quadratic in the size of a group of different near
copies is arithmetic, not rows.

Set ids are 64-bit hashes of a 128-bit digest; sets are told apart by the digest.

Defined cases: null and blank texts have no shingles, are linked with nothing and form
groups of their own; texts of one to four words have one shingle, the whole text; rows
that repeat an id are documents of their own; a document with a null id counts in the
links of others, and its group is named by the smallest id that isn't null.  An empty
table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import checkpointed, unused, words

SHINGLE, THRESHOLD, RECALL, MAX_HASHES = 5, 0.8, 0.9999, 128
BLOCK_SETS, BLOCK_WORDS, PACK_WORDS = 512, 400_000, 400_000
MATRIX_COLUMNS = 4096


def plan_bands(threshold: float = THRESHOLD, recall: float = RECALL,
               max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows a band whose bands, for this recall, stay in max_hashes."""
    plans = []
    for rows in range(1, max_hashes + 1):
        miss = 1 - threshold ** rows
        bands = max(1, math.ceil(math.log(1 - recall) / math.log(miss))) if miss > 0 else 1
        if bands * rows <= max_hashes:
            plans.append((bands, rows))
    if not plans:
        raise ValueError("no plan reaches this recall with so few hashes")
    return plans[-1]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _odd(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(starts: np.ndarray, values: np.ndarray, size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes per text; text i has the word hashes values[starts[i]:starts[i+1]]."""
    v = values.view(np.uint64)
    place = _odd(size, 5)
    n = max(0, len(v) - size + 1)
    rolled = np.zeros(n, np.uint64)
    for k in range(size):
        rolled += v[k:k + n] * place[k]
    rolled = _mix(rolled)
    out = []
    for a, b in zip(starts[:-1], starts[1:]):
        if b - a >= size:
            out.append(np.unique(rolled[a:b - size + 1]))
        elif b > a:
            out.append(_mix((v[a:b] * place[:b - a]).sum(keepdims=True) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _word_hashes(text):
    return F.transform(words(text), lambda w: F.xxhash64(w))


def _sign(bands: int, rows: int):
    mul, add = _odd(bands * rows, 1), _odd(bands * rows, 2)
    fold = _odd(rows, 3)

    def run(batches):
        for batch in batches:
            lists = batch.column("words")
            starts = lists.offsets.to_numpy()
            values = lists.values.to_numpy()
            sets = shingle_sets(starts, values)
            sizes = np.array([len(s) for s in sets], np.int64)
            full = np.flatnonzero(sizes)
            band = np.zeros((len(sets), bands), np.uint64)
            if len(full):
                flat = np.concatenate([sets[i] for i in full])
                at = np.concatenate([[0], np.cumsum(sizes[full])[:-1]])
                for b in range(bands):
                    mixed = np.full(len(full), b, np.uint64)
                    for r in range(rows):
                        k = b * rows + r
                        mixed = mixed * fold[r] + np.minimum.reduceat(flat * mul[k] + add[k], at)
                    band[full, b] = _mix(mixed)
            hi = np.array([_mix(s).sum(dtype=np.uint64) for s in sets], np.uint64)
            lo = np.array([_mix(s ^ np.uint64(0x9E3779B97F4A7C15)).sum(dtype=np.uint64) for s in sets], np.uint64)
            cells = pa.array(band.ravel().view(np.int64))
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), batch.column("text_hash"), pa.array(hi.view(np.int64)),
                pa.array(lo.view(np.int64)), pa.array(sizes),
                pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1, dtype=np.int32) * bands), cells)],
                names=["id", "text_hash", "hi", "lo", "n", "bands"])

    return run


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of the nodes of edges (u, v); a component's name is its smallest node.

    Large-star and small-star steps in turn: each links a node's neighbours with the
    smallest of them.  The edges stay linear; each round is written to the shared folder.
    """
    def least(e: DataFrame) -> DataFrame:
        return e.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m")).withColumnRenamed("u", "k")

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first())

    e = checkpointed(edges.where("u != v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = state(e)
    while seen[0]:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (both.join(least(both), F.col("u") == F.col("k")).where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "k")
        small = large.join(low, F.col("u") == F.col("k")).select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                              F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.*")
        e = checkpointed(small.where("u != v").distinct())
        now = state(e)
        if now == seen:
            break
        seen = now
    heads = e.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(heads).distinct()


def _intersections(sets: list[np.ndarray]) -> np.ndarray:
    """All pairs' intersection sizes, by products of 0/1 matrices over blocks of shingles."""
    n = len(sets)
    flat = np.concatenate(sets)
    row = np.repeat(np.arange(n), [len(s) for s in sets])
    _, column, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = count >= 2
    place = np.cumsum(shared) - 1
    use = shared[column]
    row, column = row[use], place[column[use]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((n, n), np.float64)
    total = int(shared.sum())
    for a in range(0, total, MATRIX_COLUMNS):
        lo, hi = np.searchsorted(column, [a, a + MATRIX_COLUMNS])
        m = np.zeros((n, min(MATRIX_COLUMNS, total - a)), np.float32)
        m[row[lo:hi], column[lo:hi] - a] = 1
        out += m @ m.T
    return out


def _linked(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    size = np.array([len(s) for s in sets], np.float64)
    inter = _intersections(sets)
    near = inter >= threshold * (size[:, None] + size[None, :] - inter) - 1e-9
    np.fill_diagonal(near, False)
    return near


def _heads(near: np.ndarray, name: np.ndarray) -> np.ndarray:
    """Per row the smallest name it is connected with."""
    head = name.copy()
    while True:
        reach = np.where(near, head[None, :], np.iinfo(np.int64).max).min(axis=1, initial=np.iinfo(np.int64).max)
        new = np.minimum(head, reach)
        if (new == head).all():
            return head
        head = new


def _verify(threshold: float):
    def run(table: pa.Table) -> pa.Table:
        lists = table.column("words").combine_chunks()
        sets = shingle_sets(lists.offsets.to_numpy(), lists.values.to_numpy())
        sid, copies, comp, block = (table.column(c).to_numpy() for c in ("sid", "copies", "component", "block"))
        i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        order = np.argsort(comp, kind="stable")
        out_sid, out_head, out_links = [], [], []
        for part in np.split(order, np.flatnonzero(np.diff(comp[order])) + 1):
            part = part[np.unique(sid[part], return_index=True)[1]]  # rows that repeat a document
            near = _linked([sets[p] for p in part], threshold)
            if i != j:  # pairs inside a block are counted where it meets itself
                near &= block[part][:, None] != block[part][None, :]
            out_sid.append(sid[part])
            out_head.append(_heads(near, sid[part]))
            out_links.append(near @ copies[part].astype(np.int64))
        return pa.table({"sid": np.concatenate(out_sid), "head": np.concatenate(out_head),
                         "links": np.concatenate(out_links)})

    return run


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
                    recall: float = RECALL, max_hashes: int = MAX_HASHES) -> DataFrame:
    """One row per input row: key, text_hash, class_id (smallest id of its group), n_links, n_copies.

    n_links counts the other documents whose shingle sets reach the threshold,
    copies included; n_copies those with an equal set, itself included.
    """
    return _grouped(docs, key, text, threshold, recall, max_hashes).select(
        F.col("id").alias(key), "text_hash", F.coalesce("class_id", "id").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"))


def _grouped(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
             recall: float = RECALL, max_hashes: int = MAX_HASHES) -> DataFrame:
    """id, text_hash, group, class_id, n_links, n_copies per input row; all but the first two null without shingles."""
    bands, rows = plan_bands(threshold, recall, max_hashes)
    t = F.col(f"`{text}`")
    slim = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.xxhash64(t).alias("text_hash"), t.alias("_text"))
    signed = checkpointed(
        slim.select("id", "text_hash", _word_hashes(F.col("_text")).alias("words"))
        .mapInArrow(_sign(bands, rows), "id long, text_hash long, hi long, lo long, n long, bands array<long>"))
    sets = checkpointed(
        signed.where("n > 0").groupBy("hi", "lo", "n")
        .agg(F.min("id").alias("rep"), F.count("*").alias("copies"), F.first("bands").alias("bands"),
             F.min(F.struct(F.col("id").isNull(), "id", "text_hash")).alias("one"))
        .withColumn("sid", F.xxhash64("hi", "lo", "n")))

    cells = sets.select("sid", F.explode("bands").alias("cell"))
    buckets = cells.groupBy("cell").agg(F.min("sid").alias("low"), F.max("sid").alias("high")).where("low != high")
    met = cells.join(buckets.select("cell", "low"), "cell").where("sid != low")
    comps = checkpointed(components(met.select(F.col("sid").alias("u"), F.col("low").alias("v"))))

    members = checkpointed(comps.join(sets.drop("bands"), F.col("node") == F.col("sid")).select(
        "sid", "component", "n", "copies", F.col("one.id").alias("mid"), F.col("one.text_hash").alias("mtext")))
    sizes = members.groupBy("component").agg(F.greatest(
        F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_WORDS)).alias("blocks"))
    packs = max(1, math.ceil((members.agg(F.sum("n")).first()[0] or 0) / PACK_WORDS))
    placed = (members.join(sizes, "component")
              .withColumn("block", F.pmod(F.xxhash64("sid", F.lit("block")), "blocks")))
    # The rows stay whole; a component of one block goes into a pack with others.
    held = (placed.join(slim, F.col("mid").eqNullSafe(F.col("id")) & (F.col("mtext") == F.col("text_hash")))
            .select("sid", "component", "copies", "block", "blocks", _word_hashes(F.col("_text")).alias("words")))
    meets = held.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    one = F.col("blocks") == 1
    keyed = meets.select(
        F.when(one, F.pmod(F.xxhash64("component"), F.lit(packs))).otherwise(F.col("component")).alias("g"),
        F.when(one, -1).otherwise(F.least("block", "k")).cast("long").alias("i"),
        F.when(one, -1).otherwise(F.greatest("block", "k")).cast("long").alias("j"),
        "sid", "component", "copies", "block", "words")
    links = checkpointed(keyed.groupBy("g", "i", "j").applyInArrow(
        _verify(threshold), "sid long, head long, links long"))

    groups = components(links.select(F.col("sid").alias("u"), F.col("head").alias("v")))
    linked = links.groupBy("sid").agg(F.sum("links").alias("links"))
    judged = (sets.drop("bands").join(linked, "sid", "left")
              .join(groups, F.col("sid") == F.col("node"), "left")
              .withColumn("group", F.coalesce("component", "sid")))
    judged = checkpointed(judged)
    names = judged.groupBy("group").agg(F.min("rep").alias("class_id"))
    found = judged.join(names, "group").select(
        "hi", "lo", "n", "group", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.col("copies").alias("n_copies"))
    return signed.drop("bands").join(found, ["hi", "lo", "n"], "left").select(
        "id", "text_hash", "group", "class_id", "n_links", "n_copies")


def keep_one_per_group(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each group, that with the smallest id (a null id comes last).

    A document is an id and a text: rows that repeat an id with other texts are judged each
    by its own text, and of rows equal in both one stays, the first by its other columns.
    """
    found = _grouped(docs, key, text, **options)
    # Texts without shingles form groups of their own, by id and text.
    alone = F.col("group").isNull()
    of_text, kept_id, kept_text = (unused(c, docs) for c in ("_text_hash", "_kept_id", "_kept_text"))
    kept = checkpointed(found.groupBy("group", F.when(alone, F.col("id")), F.when(alone, F.col("text_hash")))
                        .agg(F.min(F.struct(F.col("id").isNull(), "id", "text_hash")).alias("one"))
                        .select(F.col("one.id").alias(kept_id), F.col("one.text_hash").alias(kept_text)))
    named = docs.withColumn(of_text, F.xxhash64(F.col(f"`{text}`"))).join(
        kept, F.col(f"`{key}`").cast("long").eqNullSafe(F.col(kept_id)) & (F.col(of_text) == F.col(kept_text)),
        "left_semi")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rest = F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]))
    return named.groupBy(F.col(f"`{key}`").alias("_k"), of_text).agg(F.min_by(row, rest).alias("_row")).select(
        *[F.col("_row").getField(c).alias(c) for c in docs.columns])
