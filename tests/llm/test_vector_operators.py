"""Centroids, nearest vectors and spelling variants against brute force, and their defined cases."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_ORACLE, SF_SMALL
from ledgerline.llm import centroids, projection_search, spelling
from ledgerline.llm.oracles import SPELLING_SQL, centroid_sql
from ledgerline.llm.queries import queries
from ledgerline.session import read_table
from oracle import compare, duck

VECTORS = "vec_id long, embedding array<float>, cluster string, score int"


def vectors(spark, *cells):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], "c", 1)
                                  for i, v in cells], VECTORS)


@pytest.mark.parametrize("name, sql", [("op11_centroid_cluster", centroid_sql()), ("op13_spelling_variants", SPELLING_SQL)])
def test_queries_match_sql(spark, name, sql):
    res = compare(queries()[name](spark, SF_ORACLE), duck(SF_ORACLE), sql)
    assert res["spark_rows"] > 0 and res["columns_match"] and res["match"], res


# --- centroids ---------------------------------------------------------------

def brute_clusters(cells, k, rounds, size, scale=64):
    """Plain Python: [(vec_id, cluster, distance)] and the final centroids."""
    kept = [(i, [math.floor(float(np.float32(x)) * scale) for x in v]) for i, v in cells
            if v is not None and len(v) == size and all(x is not None and math.isfinite(x) for x in v)]
    start = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    cents = [z for _, z in start]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(z, c)), n) for n, c in enumerate(cents)) for _, z in kept]

    for _ in range(rounds):
        own = assign()
        for c in range(len(cents)):
            members = [z for (_, z), (_, n) in zip(kept, own) if n == c]
            if members:
                cents[c] = [sum(col) // len(members) for col in zip(*members)]
    return [(i, n, d) for (i, _), (d, n) in zip(kept, assign())], cents


def test_clusters_match_brute_force_on_odd_rows(spark):
    rng = np.random.default_rng(3)
    cells = [(i, list(rng.normal(size=4))) for i in range(40)] + [(7, [0.5, 0.5, 0.5, 0.5])] * 6
    cells += [(None, [1, 2, 3, 4]), (50, None), (51, []), (52, [1, 2, 3]), (53, [1, None, 3, 4]),
              (54, [1, float("nan"), 3, 4]), (55, [float("inf"), 0, 0, 0]), (56, [0, 0, 0, 0]), (57, [-0.0, 0, 0, 0])]
    out = centroids.cluster_vectors(vectors(spark, *cells).repartition(5), k=6, rounds=3, size=4).collect()
    want, cents = brute_clusters(cells, 6, 3, 4)
    key = lambda r: (str(r[0]), r[1], r[2])
    assert sorted([(r.vec_id, r.cluster, r.distance) for r in out], key=key) == sorted(want, key=key)
    inertia = collections.Counter()
    for _, c, d in want:
        inertia[c] += d
    for r in out:
        assert r.centroid == cents[r.cluster] and r.cluster_inertia == inertia[r.cluster]
        assert r.inertia == sum(inertia.values())
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, cents[r.cluster])).encode()).hexdigest()


def test_empty_clusters_stay_and_few_vectors_give_few_centroids(spark):
    same = [(i, [1, 1]) for i in range(5)]
    out = centroids.cluster_vectors(vectors(spark, *same), k=4, size=2).collect()
    assert {(r.cluster, r.distance, r.cluster_size) for r in out} == {(0, 0, 5)}
    assert len(centroids.cluster_vectors(vectors(spark, *same[:2]), k=16, size=2).collect()) == 2
    empty = centroids.cluster_vectors(vectors(spark).limit(0), size=2)
    assert empty.count() == 0 and empty.columns == centroids.cluster_vectors(vectors(spark, *same), size=2).columns


def test_update_touches_changed_components_only():
    rng = np.random.default_rng(1)
    z, old, new = rng.integers(-9, 9, (20, 5)), rng.integers(-9, 9, (3, 5)), rng.integers(-9, 9, (3, 5))
    new[1], new[2, :4] = old[1], old[2, :4]
    assert (centroids.updated(z @ old.T, z, new - old) == z @ new.T).all()


def test_components_beyond_the_range_are_an_error(spark):
    with pytest.raises(Exception, match="2\\^27"):
        centroids.cluster_vectors(vectors(spark, (1, [1e20, 0])), size=2).collect()


# --- nearest vectors -----------------------------------------------------------

def brute_nearest(cells, k, every=20):
    ok = []
    for i, v in cells:
        if v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v):
            row = (i, tuple(float(np.float32(x)) for x in v))
            if row not in ok:
                ok.append(row)
    out = {}
    for i, q in ok:
        if i is not None and i % every == 0:
            others = [(-sum(a * b for a, b in zip(q, v)), j is None, j or 0, j) for j, v in ok
                      if (j, v) != (i, q) and len(v) == len(q)]
            out.setdefault(i, []).extend([(j, -s) for s, _, _, j in sorted(others, key=lambda o: o[:3])[:k]])
    return out


def got_nearest(df):
    out = collections.defaultdict(list)
    for r in df.orderBy("query_id", "rank").collect():
        out[r.query_id].append((r.vec_id, r.score))
    return dict(out)


def test_nearest_defined_cases(spark):
    rng = np.random.default_rng(5)
    cells = [(i, list(rng.normal(size=3))) for i in range(30)]
    cells += [(100 + i, [1, 0, 0]) for i in range(30)]  # more copies than k
    cells += [(40, [1, 0, 0]), (40, [1, 0, 0]), (41, [2, 0, 0]), (None, [1, 0, 0]), (200, None), (220, []), (240, [0, 0, 0]),
              (260, [1, None, 0]), (280, [float("nan"), 0, 0]), (300, [1, 1]), (301, [2, 1]), (320, [1e30, 1, 0]),
              (400, [5, 5, 5, 5])]
    out = got_nearest(projection_search.nearest_vectors(vectors(spark, *cells).repartition(4), F.col("vec_id") % 20 == 0, k=5))
    want = brute_nearest(cells, 5)
    assert set(out) == set(want) - {400}  # 400 has no other vector of its length
    for q, best in out.items():
        assert [s for _, s in best] == [s for _, s in want[q]] and [i for i, _ in best] == [i for i, _ in want[q]], q
    assert projection_search.nearest_vectors(vectors(spark).limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_recall_against_brute_force(spark, monkeypatch):
    """Also with blocks and query parts so small that a cell is dealt to many."""
    table = read_table(spark, SF_ORACLE, "embeddings")
    rows = table.collect()
    x, ids = np.array([r.embedding for r in rows], dtype=float), np.array([r.vec_id for r in rows])

    def recall():
        out = got_nearest(projection_search.nearest_vectors(table, F.col("vec_id") % 20 == 0))
        hits = 0
        for i in np.flatnonzero(ids % 20 == 0):
            score = x @ x[i]
            score[i] = -np.inf
            best = out[ids[i]]
            assert len(best) == 20 and [s for _, s in best] == sorted((s for _, s in best), reverse=True)
            hits += len(set(ids[np.lexsort((ids, -score))[:20]]) & {j for j, _ in best})
        return hits / 20 / (ids % 20 == 0).sum()

    assert recall() >= 0.9
    monkeypatch.setattr(projection_search, "BLOCK", 7)
    monkeypatch.setattr(projection_search, "QUERY_PART", 3)
    monkeypatch.setattr(projection_search, "CELLS", 8)
    assert recall() >= 0.9


def test_clustered_vectors_are_pruned():
    """Where vectors cluster, the stopping test ends the search long before all points are verified."""
    rng = np.random.default_rng(2)
    centers = rng.normal(size=(32, 16))
    x = np.repeat(centers, 256, axis=0) + rng.normal(scale=0.01, size=(32 * 256, 16))
    x /= np.linalg.norm(x, axis=1)[:, None]
    model = projection_search.Model(1.0, projection_search.chi2_quantile(0.95, 8), 8, 7, {})
    q = x[::257]
    scores, rows = projection_search.search(q, np.full(len(q), -np.inf), x, 10, model)
    best = np.sort(q @ x.T, axis=1)[:, -10:]
    assert (np.sort(scores, axis=1) == pytest.approx(best, abs=1e-12))
    away = model.radius(q, scores.min(axis=1))
    gap = ((model.project_queries(q)[:, None] - model.project_points(x)[None]) ** 2).sum(axis=2)
    assert (gap <= away[:, None]).mean() < 0.1


def test_chi_square():
    draws = (np.random.default_rng(0).standard_normal((200_000, 8)) ** 2).sum(axis=1)
    for p in (0.5, 0.9, 0.95):
        assert (draws < projection_search.chi2_quantile(p, 8)).mean() == pytest.approx(p, abs=0.005)


# --- spelling variants ------------------------------------------------------------

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(cells, every=97, least_length=5, least_count=3):
    n = collections.Counter()
    for doc, text in cells:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= least_length and c >= least_count}
    near = {w: [v for v in n if abs(len(v) - len(w)) < 2 and one_edit(w, v)] for w in n}
    form = {w: min(near[w], key=lambda v: (-n[v], v)) if near[w] else None for w in n}
    form = {w: f if f and n[f] >= 2 * n[w] else None for w, f in form.items()}

    def root(w):
        return root(form[w]) if form[w] else w

    return {w: (form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n}


def got_variants(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


TEXTS = "doc_id long, text string, word string, n long"


def test_variants_match_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in read_table(spark, SF_SMALL, "documents").collect()][:40]
    docs += [(None, "Straße straße STRASSE Straße Straße"), (900, None), (901, ""), (902, "1 2 3"), (903, "ÉCOLE école École ecole " * 3),
             (904, "abcdefg " * 64 + "abcdefgh " * 32 + "abcdefghi " * 16 + "abcdefghij " * 8 + "abcdefghijk " * 4),
             (905, ("x" * 3000 + " ") * 4 + ("x" * 3001 + " ") * 8), (906, "twins twins twins"), (906, "twins twins twins")]
    out = spelling.spelling_variants(spark.createDataFrame([(*d, "w", 1) for d in docs], TEXTS).repartition(3), every=5)
    assert got_variants(out) == brute_variants(docs, every=5)
    empty = spelling.spelling_variants(spark.createDataFrame([], TEXTS))
    assert empty.count() == 0 and empty.columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_small_tiles_find_the_same(spark, monkeypatch):
    """Groups of many tiles: words that share their halves."""
    words = [f"stem{chr(97 + i)}{chr(97 + j)}tail" for i in range(9) for j in range(9)] + ["stematail", "stemtail", "xstemtail"]
    docs = [(1, " ".join(w for i, w in enumerate(words) for _ in range(3 + i % 5)))]
    df = spark.createDataFrame([(*d, "w", 1) for d in docs], TEXTS)
    want = brute_variants(docs)
    assert got_variants(spelling.spelling_variants(df)) == want
    monkeypatch.setattr(spelling, "TILE", 4)
    assert got_variants(spelling.spelling_variants(df)) == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("abé", min_size=4, max_size=7), min_size=2, max_size=12, unique=True))
def test_single_edits_are_found_once(words):
    found = collections.Counter()
    for size in range(4, 8):
        shorter = [w for w in words if len(w) == size]
        others = [w for w in words if len(w) in (size, size + 1)]
        for side in ("prefix", "suffix"):
            for i, j in zip(*spelling.single_edits(size, shorter, others, side)):
                found[frozenset((shorter[i], others[j]))] += 1 if len(others[j]) > size else 0.5
    assert found == {frozenset((a, b)): 1 for a in words for b in words if a < b and one_edit(a, b)}
