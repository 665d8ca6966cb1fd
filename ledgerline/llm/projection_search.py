"""Approximate nearest neighbours by stable projections and kd-trees (op 12).

Nearness is the inner product.  With M the largest norm of all vectors, a vector x becomes the unit
vector (x / M, rest) and a query q becomes (q / |q|, 0): their squared distance is
2 - 2 <q, x> / (|q| M), so that nearest by distance is nearest by inner product.

Unit vectors are projected to a few dimensions with Gaussian (2-stable) weights: for a pair
at distance d the squared projected distance is d^2 times a chi-square variable.  So once the search has passed the
projected distance r and its k-th best is at distance d, a better one was missed with a chance of
1 - CHI2(r^2 / d^2): the search stops when that CDF reaches ``confidence``.

1. Equal vectors are folded to one point with its k + 1 smallest ids (more can't be
   needed: a query takes k and leaves itself out).
2. A kd-tree over the projections of a bounded sample cuts the space into cells; every point
   is indexed: it goes to its cell, and a cell of more than BLOCK points is dealt to several blocks.
3. Home search: each query searches the block that holds it, leaf by leaf of a kd-tree over the block's
   projections, nearest leaf first; what the stopping radius holds is verified on the original vectors.
   That gives an upper bound of its k-th distance.
4. Visits: a query goes to every other block whose cell the stopping radius of that bound reaches
   (queries in parts of QUERY_PART), and brings back only what beats the bound.
5. The best of all visits are merged; scores are summed in component order in double precision.

The sample (SAMPLE points, fixed by a hash of the vector) only places the cuts.  Recall is
measured against brute force in the tests.

Defined cases: vectors that are null, empty, zero or hold a null or non-finite component take no
part; only vectors of equal length are compared; a null id is a candidate (last among equals) and never
a query; rows equal in id and vector count once; a row with a query's id and another vector is a candidate of
its own.  Fewer candidates than k are all returned; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.session import shared_folder

PROJECTIONS = 8
CONFIDENCE = 0.95
SAMPLE = 4096
CELLS = 32
LEAF = 256
BLOCK = 32768
QUERY_PART = 8192
BATCH = 512
FOUND = "array<struct<score: double, own: boolean, ids: array<struct<missing: boolean, id: {id}>>>>"


def chi2_cdf(x: float, dims: int) -> float:
    """CDF of the chi-square distribution with an even number of degrees of freedom."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(dims // 2))


def chi2_quantile(confidence: float, dims: int) -> float:
    low, high = 0.0, 1.0
    while chi2_cdf(high, dims) < confidence:
        high *= 2
    for _ in range(60):
        low, high = ((low + high) / 2, high) if chi2_cdf((low + high) / 2, dims) < confidence else (low, (low + high) / 2)
    return high


def split(points: np.ndarray, depth: int) -> list[tuple[int, float]]:
    """Cuts of a kd-tree in heap order: (dimension, value) at the median of the widest dimension."""
    cuts, groups = [], [np.arange(len(points))]
    for _ in range(depth):
        halves = []
        for g in groups:
            own = points[g]
            d = int(np.ptp(own, axis=0).argmax()) if len(g) else 0
            value = float(np.median(own[:, d])) if len(g) else 0.0
            cuts.append((d, value))
            right = own[:, d] > value if len(g) else np.empty(0, bool)
            halves += [g[~right], g[right]]
        groups = halves
    return cuts


def place(points: np.ndarray, cuts: list[tuple[int, float]]) -> np.ndarray:
    """The cell of each point."""
    node = np.zeros(len(points), dtype=np.int64)
    if cuts:
        dims, values = np.array([c[0] for c in cuts]), np.array([c[1] for c in cuts])
        for _ in range(int(math.log2(len(cuts) + 1))):
            node = 2 * node + 1 + (points[np.arange(len(points)), dims[node]] > values[node])
    return node - len(cuts)


def cell_bounds(cuts: list[tuple[int, float]], dims: int) -> tuple[np.ndarray, np.ndarray]:
    """(low, high) of each cell; outer sides are infinite."""
    low, high = [np.full(dims, -np.inf)], [np.full(dims, np.inf)]
    for i, (d, value) in enumerate(cuts):
        for right in (False, True):
            lo, hi = low[i].copy(), high[i].copy()
            (lo if right else hi)[d] = value
            low.append(lo)
            high.append(hi)
    return np.array(low[len(cuts):]), np.array(high[len(cuts):])


def box_distances(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of each point to each box."""
    p = points[:, None, :]
    return (np.maximum(0, np.maximum(low - p, p - high)) ** 2).sum(axis=2)


@dataclass(frozen=True)
class Model:
    """What the tasks need: the largest norm, the radius factor and the cells of each vector length."""

    largest: float
    factor: float
    dims: int
    seed: int
    cuts: dict

    def weights(self, size: int) -> np.ndarray:
        return np.random.default_rng([self.seed, size]).standard_normal((size + 1, self.dims))

    def project_points(self, x: np.ndarray) -> np.ndarray:
        w, scaled = self.weights(x.shape[1]), x / self.largest
        rest = np.sqrt(np.maximum(0, 1 - (scaled * scaled).sum(axis=1)))
        return scaled @ w[:-1] + rest[:, None] * w[-1]

    def project_queries(self, q: np.ndarray) -> np.ndarray:
        return unit(q) @ self.weights(q.shape[1])[:-1]

    def radius(self, q: np.ndarray, score: np.ndarray) -> np.ndarray:
        """Squared stopping radius of queries whose k-th best score is known (infinite before)."""
        known = np.flatnonzero(score > -np.inf)
        out = np.full(len(score), np.inf)
        out[known] = np.maximum(0, 2 - 2 * score[known] / norms(q[known]) / self.largest) * self.factor
        return out


def norms(x: np.ndarray) -> np.ndarray:
    most = np.abs(x).max(axis=1)
    return most * np.sqrt(((x / most[:, None]) ** 2).sum(axis=1))


def unit(x: np.ndarray) -> np.ndarray:
    scaled = x / np.abs(x).max(axis=1)[:, None]
    return scaled / np.sqrt((scaled * scaled).sum(axis=1))[:, None]


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of paired rows, summed in component order."""
    out = np.zeros(len(q))
    for j in range(q.shape[1]):
        out += q[:, j] * x[:, j]
    return out


def search(q: np.ndarray, bound: np.ndarray, x: np.ndarray, k: int, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """(scores, rows of x) of the k best found for each query, -inf where there are fewer.

    ``bound``: a score that k points known elsewhere reach, or -inf; only better ones or equals count.
    """
    projected = model.project_points(x)
    cuts = split(projected, max(0, math.ceil(math.log2(max(1, len(x) / LEAF)))))
    cell = place(projected, cuts)
    leaves = [g for g in np.split(np.argsort(cell, kind="stable"), np.cumsum(np.bincount(cell, minlength=len(cuts) + 1))[:-1])
              if len(g)]
    low = np.array([projected[g].min(axis=0) for g in leaves])
    high = np.array([projected[g].max(axis=0) for g in leaves])
    leaf_x, leaf_p = [x[g] for g in leaves], [projected[g] for g in leaves]
    all_scores, all_rows = np.full((len(q), k), -np.inf), np.full((len(q), k), -1)
    for start in range(0, len(q), BATCH):
        part = slice(start, start + BATCH)
        qs, qp = q[part], model.project_queries(q[part])
        scores, rows = all_scores[part], all_rows[part]
        away = box_distances(qp, low, high)
        order = away.argsort(axis=1)
        active = np.arange(len(qs))
        radius = model.radius(qs, bound[part])
        for step in range(len(leaves)):
            leaf = order[active, step]
            active = active[away[active, leaf] <= radius[active]]  # leaves come nearest first: the rest is done
            leaf = order[active, step]
            for i in np.unique(leaf):
                at = active[leaf == i]
                gap = ((qp[at] ** 2).sum(axis=1)[:, None] + (leaf_p[i] ** 2).sum(axis=1) - 2 * qp[at] @ leaf_p[i].T)
                got = qs[at] @ leaf_x[i].T
                got[(gap > radius[at, None]) | (got < bound[part][at, None])] = -np.inf
                merged = np.hstack([scores[at], got])
                owner = np.hstack([rows[at], np.broadcast_to(leaves[i], got.shape)])
                best = np.argpartition(-merged, k - 1, axis=1)[:, :k]
                scores[at] = np.take_along_axis(merged, best, axis=1)
                rows[at] = np.take_along_axis(owner, best, axis=1)
                radius[at] = model.radius(qs[at], np.maximum(bound[part][at], scores[at].min(axis=1)))
    return all_scores, all_rows


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _one_chunk(column: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)


def _found(q: np.ndarray, bound: np.ndarray, x: np.ndarray, ids: pa.Array, own: np.ndarray | None, k: int,
           model: Model, kind: pa.DataType) -> tuple[pa.Array, np.ndarray]:
    """The FOUND column of the queries, and the k-th best score of each."""
    scores, rows = search(q, bound, x, k, model)
    worst = scores.min(axis=1)
    query, column = np.nonzero(scores > -np.inf)
    row = rows[query, column]
    offsets = np.concatenate([[0], np.cumsum(np.bincount(query, minlength=len(q)))]).astype(np.int32)
    values = pa.StructArray.from_arrays(
        [pa.array(exact_scores(q[query], x[row])), pa.array(row == own[query] if own is not None else np.zeros(len(row), bool)),
         ids.take(pa.array(row))], fields=list(kind.value_type))
    return pa.ListArray.from_arrays(pa.array(offsets), values, type=kind), worst


def usable(vectors: DataFrame, id_column: str, vector_column: str, is_query: Column) -> DataFrame:
    """(id, vec, is_query) of the rows that take part, each (id, vec) once."""
    vec = F.col(vector_column).cast("array<double>")
    finite = F.forall(vec, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return vectors.where(F.coalesce(finite & F.exists(vec, lambda v: v != 0), F.lit(False))).select(
        F.col(id_column).alias("id"), vec.alias("vec"),
        F.coalesce(is_query, F.lit(False)).alias("is_query")).groupBy("id", "vec").agg(F.max("is_query").alias("is_query"))


def points_of(rows: DataFrame, keep: int) -> DataFrame:
    """(vec, ids, is_query): distinct vectors with their ``keep`` smallest ids, null last."""
    first = Window.partitionBy("vec").orderBy(F.asc_nulls_last("id"))
    ids = rows.select("vec", "id", F.row_number().over(first).alias("_n")).where(F.col("_n") <= keep) \
        .groupBy("vec").agg(F.sort_array(F.collect_list(F.struct(
            F.col("id").isNull().alias("missing"), F.col("id").alias("id")))).alias("ids"))
    asked = rows.where("is_query").select(F.col("vec").alias("_asked")).distinct()
    return ids.join(asked, ids["vec"] == asked["_asked"], "left").select(
        "vec", "ids", F.col("_asked").isNotNull().alias("is_query"))


def fit(points: DataFrame, dims: int, confidence: float, seed: int) -> Model | None:
    """Largest norm over all points; cuts from a sample of about SAMPLE points."""
    scale = F.array_max(F.transform("vec", F.abs))
    norm = scale * F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, v: s + (v / scale) * (v / scale)))
    n, largest = points.agg(F.count(F.lit(1)), F.max(norm)).first()
    if not n:
        return None
    share = F.pmod(F.xxhash64("vec", F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    # about SAMPLE rows, chosen by hash alone; the limit is a bound that chance doesn't reach
    sample = points.where(share < SAMPLE / n).select("vec").limit(2 * SAMPLE).collect()
    by_size: dict[int, list] = {}
    for r in sample:
        by_size.setdefault(len(r["vec"]), []).append(r["vec"])
    model = Model(largest, chi2_quantile(confidence, dims), dims, seed, {})
    for size, own in by_size.items():
        depth = int(math.log2(max(1, min(CELLS, len(own) // 8))))
        model.cuts[size] = split(model.project_points(np.array(own)), depth)
    return model


def _placed(points: DataFrame, model: Model, kind: str) -> DataFrame:
    """The points with their vector length and cell."""
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes = b["vec"].value_lengths().to_numpy()
            cells = np.zeros(b.num_rows, dtype=np.int32)
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                x = _matrix(b["vec"].take(pa.array(at)))
                cells[at] = place(model.project_points(x), model.cuts.get(int(size), []))
            yield pa.RecordBatch.from_arrays(
                [b["vec"], b["ids"], b["is_query"], pa.array(sizes.astype(np.int32)), pa.array(cells)],
                names=["vec", "ids", "is_query", "size", "cell"])

    return points.mapInArrow(assign, f"vec array<double>, ids {kind}, is_query boolean, size int, cell int")


def nearest_vectors(vectors: DataFrame, is_query: Column, k: int = 20, id_column: str = "vec_id",
                    vector_column: str = "embedding", dims: int = PROJECTIONS, confidence: float = CONFIDENCE,
                    seed: int = 7) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query row, nearest first."""
    spark, keep = vectors.sparkSession, k + 1
    folder = shared_folder(spark, "neighbours")
    usable(vectors, id_column, vector_column, is_query).write.parquet(f"{folder}/rows")
    rows = spark.read.parquet(f"{folder}/rows")
    id_type = rows.schema["id"].dataType.simpleString()
    found_type = FOUND.format(id=id_type)
    points_of(rows, keep).write.parquet(f"{folder}/points")
    points = spark.read.parquet(f"{folder}/points")
    model = fit(points, dims, confidence, seed)
    if model is None:
        return rows.limit(0).select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"),
                                    F.lit(0.0).alias("score"))
    place_columns = ["size", "cell"]
    placed = _placed(points, model, f"array<struct<missing: boolean, id: {id_type}>>")
    blocks = placed.groupBy(*place_columns).agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    placed = placed.join(blocks, place_columns).withColumn("block", F.expr("cast(pmod(xxhash64(vec), blocks) as int)"))
    placed.write.parquet(f"{folder}/placed")
    placed = spark.read.parquet(f"{folder}/placed")

    def home(table: pa.Table) -> pa.Table:
        asked = np.flatnonzero(_one_chunk(table["is_query"]).to_numpy(zero_copy_only=False))
        t = table.take(pa.array(asked))
        x = _matrix(_one_chunk(table["vec"]))
        kind = home_schema.field("found").type
        found, worst = _found(x[asked], np.full(len(asked), -np.inf), x, _one_chunk(table["ids"]), asked, keep, model, kind) \
            if len(asked) else (pa.array([], kind), np.empty(0))
        return pa.Table.from_arrays([_one_chunk(t[c]) for c in ("vec", "size", "cell", "block")] + [found, pa.array(worst)],
                                    schema=home_schema)

    home_ddl = f"vec array<double>, size int, cell int, block int, found {found_type}, bound double"
    home_schema = _arrow(spark, home_ddl)
    placed.select("size", "cell", "block", "vec", "ids", "is_query").groupBy("size", "cell", "block") \
        .applyInArrow(home, home_ddl).write.parquet(f"{folder}/home")
    at_home = spark.read.parquet(f"{folder}/home")

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes = b["size"].to_numpy()
            for size in np.unique(sizes):
                own = b.take(pa.array(np.flatnonzero(sizes == size)))
                cuts = model.cuts.get(int(size), [])
                q = _matrix(own["vec"])
                away = box_distances(model.project_queries(q), *cell_bounds(cuts, model.dims))
                row, cell = np.nonzero(away <= model.radius(q, own["bound"].to_numpy())[:, None])
                t = own.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [t["vec"], t["size"], pa.array(cell.astype(np.int32)), t["bound"], t["cell"], t["block"]],
                    names=["vec", "size", "cell", "bound", "home_cell", "home_block"])

    visits = at_home.select("vec", "size", "cell", "block", "bound").mapInArrow(
        reach, "vec array<double>, size int, cell int, bound double, home_cell int, home_block int")
    # the read table, not the frame it was written from: nothing is computed twice
    blocks = placed.select(*place_columns, "blocks").distinct()
    visits = visits.join(blocks, place_columns) \
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .where((F.col("cell") != F.col("home_cell")) | (F.col("block") != F.col("home_block"))) \
        .select("vec", "size", "cell", "block", "bound")
    visits.write.parquet(f"{folder}/visits")
    visits = spark.read.parquet(f"{folder}/visits")
    where = ["size", "cell", "block"]
    parts = visits.groupBy(*where).agg(F.ceil(F.count(F.lit(1)) / QUERY_PART).cast("int").alias("parts"))
    asking = visits.join(parts, where).withColumn("part", F.expr("cast(pmod(xxhash64(vec), parts) as int)"))
    asked = placed.select(*where, "vec", "ids").join(parts, where) \
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))

    def visit(key: tuple, queries: pa.Table, block: pa.Table) -> pa.Table:
        kind = visit_schema.field("found").type
        if not len(queries) or not len(block):
            return pa.Table.from_arrays([pa.array([], f.type) for f in visit_schema], schema=visit_schema)
        vec = _one_chunk(queries["vec"])
        found, _ = _found(_matrix(vec), queries["bound"].to_numpy(), _matrix(_one_chunk(block["vec"])),
                          _one_chunk(block["ids"]), None, keep, model, kind)
        some = pa.array(found.value_lengths().to_numpy() > 0)
        return pa.Table.from_arrays([vec.filter(some), found.filter(some)], schema=visit_schema)

    visit_ddl = f"vec array<double>, found {found_type}"
    visit_schema = _arrow(spark, visit_ddl)
    by = [*where, "part"]
    better = asking.select(*by, "vec", "bound").groupBy(*by).cogroup(asked.select(*by, "vec", "ids").groupBy(*by)) \
        .applyInArrow(visit, visit_ddl)
    return _ranked(rows, at_home.select("vec", "found").unionByName(better), k)


def _ranked(rows: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """The k best of each query row, without the row itself."""
    each = found.select("vec", F.inline("found")).select("vec", "score", "own", F.inline("ids"))
    order = Window.partitionBy("vec").orderBy(F.desc("score"), "missing", "id")
    best = each.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1).groupBy("vec").agg(
        F.sort_array(F.collect_list(F.struct("n", "id", "score", "own"))).alias("best"))
    asked = rows.where("is_query").select(F.col("id").alias("query_id"), "vec")
    others = F.filter("best", lambda b: ~(b["own"] & b["id"].eqNullSafe(F.col("query_id"))))
    return asked.join(best, "vec").select("query_id", F.posexplode(F.slice(others, 1, k)).alias("at", "b")) \
        .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("b.id").alias("vec_id"), F.col("b.score").alias("score"))


def _arrow(spark, ddl: str) -> pa.Schema:
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(T.StructType.fromDDL(ddl))
