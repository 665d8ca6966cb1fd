"""Centroid clustering over an incremental distance matrix (op 11).

Every kept vector carries its exact integer dot product with every centroid.  A round
changes the dot products only by the nonzero component changes of each centroid
(``dot += z[changed] . change[changed]``); with the vector's own squared length and the
centroids' they give all squared distances, and the nearest centroid follows by argmin.
All numbers are integers, so the result doesn't depend on how rows are dealt out.

The state (vector, squared length, dot products, cluster, distance) is a Parquet table in the
shared folder, one for each assignment; a superseded one is removed once the next is
written.  The driver sees per round one row a cluster: its size and component sums, which Spark
combines map-side, so a cluster of any size costs no task more than its share.

Defined cases: a vector that is null, has another number of components, or holds a null or
non-finite one is left out; a null id counts as the empty text in the start order; equal start
hashes are ordered by the vector; repeated rows are vectors of their own, so equal
centroids can occur (the smaller number gets all).  Fewer vectors than k give as many
centroids; an empty table gives no rows.  A component of 2^27 or more after scaling is an
error: squared distances would not fit a long.  Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.session import shared_folder
from ledgerline.sources.files import delete

LARGEST = float(2 ** 27)
STATE = "vec_id {id}, z array<int>, length bigint, dots array<bigint>, cluster int, distance bigint"


def integer_vectors(vectors: DataFrame, id_column: str, vector_column: str, size: int, scale: int) -> DataFrame:
    """(vec_id, z) of the vectors that take part; z holds floor(scale * x)."""
    vector = F.col(vector_column).cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    small = F.forall(vector, lambda x: F.abs(x * scale) < LARGEST)
    z = F.transform(vector, lambda x: F.floor(x * scale).cast("int"))
    return vectors.where((F.size(vector) == size) & F.coalesce(finite, F.lit(False))).select(
        F.col(id_column).alias("vec_id"),
        F.when(small, z).otherwise(F.raise_error(F.lit("a scaled component of 2^27 or more"))).alias("z"))


def start_centroids(kept: DataFrame, k: int, size: int) -> np.ndarray:
    """The k vectors with the smallest sha256 of ``1:<vec_id>``, in that order."""
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    rows = kept.select(digest.alias("digest"), "z").orderBy("digest", "z").limit(k).collect()
    return np.array([r["z"] for r in rows], dtype=np.int64).reshape(len(rows), size)


def nearest(dots: np.ndarray, lengths: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centroid, squared distance); ties go to the smaller number."""
    part = (centroids * centroids).sum(axis=1) - 2 * dots
    cluster = part.argmin(axis=1)
    return cluster, lengths + np.take_along_axis(part, cluster[:, None], axis=1)[:, 0]


def updated(dots: np.ndarray, z: np.ndarray, change: np.ndarray) -> np.ndarray:
    """Dot products after the centroids moved by ``change``; unchanged components cost nothing."""
    out = dots.copy()
    for c, moved in enumerate(change):
        at = np.flatnonzero(moved)
        if len(at):
            out[:, c] += z[:, at] @ moved[at]
    return out


def _numbers(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel(), type=kind))


def _assigned(state: DataFrame, change: np.ndarray, centroids: np.ndarray) -> DataFrame:
    """The state with dot products moved by ``change`` and every vector assigned anew."""
    size = centroids.shape[1]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            z = _numbers(b["z"], size)
            if "dots" in b.schema.names:
                dots, lengths = _numbers(b["dots"], len(change)), b["length"].to_numpy()
            else:
                dots, lengths = np.zeros((len(z), len(change)), np.int64), (z * z).sum(axis=1)
            dots = updated(dots, z, change)
            cluster, distance = nearest(dots, lengths, centroids)
            yield pa.RecordBatch.from_arrays(
                [b["vec_id"], _lists(z, pa.int32()), pa.array(lengths), _lists(dots, pa.int64()),
                 pa.array(cluster.astype(np.int32)), pa.array(distance)],
                names=["vec_id", "z", "length", "dots", "cluster", "distance"])

    return state.mapInArrow(assign, STATE.format(id=state.schema["vec_id"].dataType.simpleString()))


def _moved(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each centroid's componentwise floor(sum / count); empty ones stay."""
    sums = state.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.sum(F.col("z")[j]) for j in range(centroids.shape[1])]).alias("sums"))
    out = centroids.copy()
    for r in sums.collect():  # one row a cluster
        out[r["cluster"]] = [s // r["n"] for s in r["sums"]]
    return out


def _of_cluster(values: list) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), F.col("cluster"))


def cluster_vectors(vectors: DataFrame, k: int = 16, rounds: int = 3, size: int = 64, scale: int = 64,
                    id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, cluster_size, centroid, centroid_sha256)."""
    spark = vectors.sparkSession
    kept = integer_vectors(vectors, id_column, vector_column, size, scale)
    centroids = start_centroids(kept, k, size)
    if not len(centroids):
        return kept.limit(0).select("vec_id", *[F.lit(None).cast(t).alias(c) for c, t in (
            ("cluster", "int"), ("distance", "bigint"), ("cluster_inertia", "bigint"), ("inertia", "bigint"),
            ("cluster_size", "bigint"), ("centroid", "array<bigint>"), ("centroid_sha256", "string"))])
    folder = shared_folder(spark, "centroids")
    state, change = kept, centroids
    for r in range(rounds + 1):
        if r:
            moved = _moved(state, centroids)
            change, centroids = moved - centroids, moved
        _assigned(state, change, centroids).write.parquet(f"{folder}/{r}")
        state = spark.read.parquet(f"{folder}/{r}")
        if r:
            delete(spark, f"{folder}/{r - 1}")
    found = {r["cluster"]: r for r in state.groupBy("cluster").agg(
        F.sum("distance").alias("inertia"), F.count(F.lit(1)).alias("n")).collect()}  # one row a cluster
    inertia = [found[c]["inertia"] if c in found else 0 for c in range(len(centroids))]
    sizes = [found[c]["n"] if c in found else 0 for c in range(len(centroids))]
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    return state.select(
        "vec_id", "cluster", "distance", _of_cluster(inertia).cast("bigint").alias("cluster_inertia"),
        F.lit(sum(inertia)).cast("bigint").alias("inertia"), _of_cluster(sizes).cast("bigint").alias("cluster_size"),
        F.get(F.array(*[F.array(*[F.lit(x) for x in c]) for c in centroids.tolist()]), F.col("cluster"))
        .cast("array<bigint>").alias("centroid"), _of_cluster(digests).alias("centroid_sha256"))
