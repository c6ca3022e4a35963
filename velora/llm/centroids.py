"""Centroid clustering by delta Lloyd, exact in integers.

Vectors, their owners and their distances are a written table; the sums and counts of each centroid's vectors are
another.  A round compares a vector whose owner stayed where it was with the changed centroids alone, as its distance to
the owner is known and no unchanged centroid can have come nearer; a vector whose owner moved is compared with all.
Vectors that change their owner leave one and join another: each task adds up its transfers as signed integers, and the
sums take the differences.  Integer sums do not depend on the order, so a lost task changes nothing.

Centroids and sums have the size of the parameters (``k`` times the components); nothing else reaches the driver.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from velora.llm.common import scratch, shared_table, small_batches

STATE = "vec_id long, v array<int>, owner int, was int, distance long"
TRANSFERS = "cluster int, pos int, total long"
#: Components beyond it could carry a squared distance out of 64 bits.
MOST = 1 << 26


def quantised(vectors: DataFrame, id_col: str, vec_col: str, dims: int, scale: int) -> DataFrame:
    """``vec_id, v`` of the vectors with ``dims`` components, none null or non-finite; a component is floor(scale * x)."""
    x = F.col(vec_col).cast("array<double>")
    finite = lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != F.lit(float("inf")))
    whole = F.coalesce((F.size(x) == dims) & F.forall(x, finite), F.lit(False))
    held = lambda e: F.when(F.abs(e * scale) < MOST, F.floor(e * scale)).otherwise(F.raise_error(F.lit("a component is too large for 64-bit distances")).cast("long")).cast("int")
    return vectors.where(whole).select(F.col(id_col).cast("long").alias("vec_id"), F.transform(x, held).alias("v"))


def squared_distances(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of ``v`` and ``c``."""
    most = max(int(np.abs(v).max(initial=0)), int(np.abs(c).max(initial=0)))
    if v.shape[1] * most * most < 1 << 53:  # every partial sum is an integer that doubles hold
        dots = (v.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    else:
        dots = v @ c.T
    return (v * v).sum(axis=1)[:, None] - 2 * dots + (c * c).sum(axis=1)


def nearest(v: np.ndarray, owner: np.ndarray, distance: np.ndarray, centroids: np.ndarray, changed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """New owners and distances; of equally near centroids the smaller number."""
    owner, distance = owner.copy(), distance.copy()
    moved = (owner < 0) | changed[owner]
    if moved.any():
        d = squared_distances(v[moved], centroids)
        owner[moved], distance[moved] = d.argmin(axis=1), d.min(axis=1)
    rest, some = np.flatnonzero(~moved), np.flatnonzero(changed)
    if len(rest) and len(some):
        d = squared_distances(v[rest], centroids[some])
        best, near = some[d.argmin(axis=1)], d.min(axis=1)
        better = (near < distance[rest]) | ((near == distance[rest]) & (best < owner[rest]))
        owner[rest[better]], distance[rest[better]] = best[better], near[better]
    return owner, distance


def _components(b: pa.RecordBatch, dims: int) -> np.ndarray:
    return b.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dims)


def assigned(state: DataFrame, centroids: np.ndarray, changed: np.ndarray) -> DataFrame:
    """The state after one comparison with the centroids."""

    def task(batches):
        for b in batches:
            if not b.num_rows:
                continue
            was = b.column("owner").to_numpy(zero_copy_only=False)
            owner, distance = nearest(_components(b, centroids.shape[1]), was, b.column("distance").to_numpy(zero_copy_only=False), centroids, changed)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("v"), pa.array(owner, pa.int32()), pa.array(was, pa.int32()), pa.array(distance, pa.int64())], ["vec_id", "v", "owner", "was", "distance"])

    return state.mapInArrow(task, STATE)


def transfers(state: DataFrame, k: int, dims: int) -> DataFrame:
    """Signed sums of the vectors that changed their owner, by centroid and component; component -1 is their number."""

    def task(batches):
        sums = np.zeros((k, dims + 1), np.int64)
        for b in batches:
            v = np.pad(_components(b, dims), ((0, 0), (1, 0)), constant_values=1)
            was = b.column("was").to_numpy(zero_copy_only=False)
            np.add.at(sums, b.column("owner").to_numpy(zero_copy_only=False), v)
            np.subtract.at(sums, was[was >= 0], v[was >= 0])
        c, p = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32()), pa.array(p - 1, pa.int32()), pa.array(sums[c, p], pa.int64())], ["cluster", "pos", "total"])

    return state.where("owner <> was").mapInArrow(task, TRANSFERS)


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors whose hash of seed and id is smallest, in that order; ``vectors`` may have fewer."""
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    return np.array([r.v for r in vectors.orderBy(rank, "v").limit(k).collect()], np.int64)  # k rows


def _summed(sums: DataFrame, k: int, dims: int) -> np.ndarray:
    out = np.zeros((k, dims + 1), np.int64)
    for r in sums.collect():  # at most k * (dims + 1) rows
        out[r.cluster, r.pos + 1] = r.total
    return out


def delta_lloyd(vectors: DataFrame, k: int, rounds: int, seed: int, dims: int) -> tuple[DataFrame, np.ndarray]:
    """The written state after ``rounds`` updates and a last assignment, and the centroids."""
    spark: SparkSession = vectors.sparkSession
    with scratch(spark) as keep:
        start = shared_table(vectors, "vectors")
        centroids = first_centroids(start, k, seed)
        state = start.select("vec_id", "v", F.lit(-1).alias("owner"), F.lit(-1).alias("was"), F.lit(0).cast("long").alias("distance"))
        if not len(centroids):
            return keep(shared_table(state, "assigned")), centroids.reshape(0, dims)
        changed, sums = np.ones(len(centroids), bool), None
        for step in range(rounds + 1):
            state = shared_table(assigned(state, centroids, changed), "assigned")
            if step == rounds:
                break
            delta = transfers(state, len(centroids), dims)
            both = delta if sums is None else sums.unionByName(delta)
            sums = shared_table(both.groupBy("cluster", "pos").agg(F.sum("total").alias("total")), "sums")
            totals = _summed(sums, len(centroids), dims)
            filled = totals[:, 0] > 0
            new = centroids.copy()
            new[filled] = totals[filled, 1:] // totals[filled, :1]
            changed, centroids = (new != centroids).any(axis=1), new
            if not changed.any():  # every further round would give the same
                break
        return keep(state), centroids


def centroid_clusters(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 16, rounds: int = 3, seed: int = 1, dims: int = 64, scale: int = 64) -> DataFrame:
    """Per kept vector: ``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256``.

    Vectors with another number of components, or with a null or non-finite one, are left out; so are null vectors.
    Repeated rows count as vectors of their own, and a null id hashes as the empty text; vectors with one hash start in
    the order of their components.  With fewer than ``k`` vectors each starts a centroid.  A centroid without vectors
    stays where it is.  Components of 2**26 and more after scaling raise an error, as distances may pass 64 bits.  An
    empty table gives an empty result; other columns are not read.
    """
    spark = vectors.sparkSession
    small_batches(spark, rows=10_000)
    state, centroids = delta_lloyd(quantised(vectors, id_col, vec_col, dims, scale), k, rounds, seed, dims)
    own = {r.owner: r.s for r in state.groupBy("owner").agg(F.sum("distance").alias("s")).collect()}  # k rows
    named = [(i, own.get(i, 0), sum(own.values()), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(centroids.tolist())]
    clusters = spark.createDataFrame(named, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    out = state.select("vec_id", F.col("owner").alias("cluster"), "distance").join(F.broadcast(clusters), "cluster")
    return out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
