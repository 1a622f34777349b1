"""Centroid clustering by a delta form of Lloyd's rounds, over exact integers.

Every round writes the vectors with their owners to the shared folder, and the driver
holds the clusters' counts and sums (one row for each centroid).  A round compares an
owner that stayed where it was with the changed centroids only; vectors whose owner
moved meet all centroids.  Vectors that change hands are read back, and their signed
sums (added to the new owner, taken from the old one) are what alters the global sums.

Scale: nothing is shuffled but one row of signed sums for each task and touched
cluster, so a cluster that holds a third of all vectors costs no more than others.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import stage, unstage

CLUSTERS, ROUNDS, DIMS, SCALE = 40, 5, 64, 256
#: Integers up to 2**22 multiply exactly as doubles over up to 512 components, others as longs.
EXACT, LARGEST = 1 << 22, 1 << 26
_STATE = "id long, v binary, cluster int, distance long, was int"


def quantised(vectors: DataFrame, id_col: str, vector_col: str, dims: int, scale: int) -> DataFrame:
    """(id, v, cluster, distance, was): rows of ``dims`` finite components, each as the
    integer floor(scale * x), packed as 32-bit numbers; no owner yet (cluster -1)."""

    def run(batches):
        for b in batches:
            lists = b.column(1)
            x = np.floor(lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), dims) * float(scale))
            if len(x) and np.abs(x).max() > LARGEST:
                raise ValueError(f"a component times {scale} is beyond {LARGEST}: its squared distances don't fit")
            packed = x.astype("<i4").tobytes()
            v = pa.array([packed[k : k + 4 * dims] for k in range(0, len(packed), 4 * dims)], pa.binary())
            none = pa.array(np.full(len(x), -1, np.int32))
            yield pa.record_batch([b.column(0), v, none, pa.array(np.zeros(len(x), np.int64)), none], ["id", "v", "cluster", "distance", "was"])

    v = F.col(vector_col).cast("array<double>")
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(F.coalesce((F.size("v") == dims) & finite, F.lit(False)))
    return rows.mapInArrow(run, _STATE)


def first_centroids(state: DataFrame, k: int, dims: int) -> np.ndarray:
    """The vectors of the ``k`` smallest hashes of their ids, in that order."""
    place = F.sha2(F.concat(F.lit("2:"), F.col("id").cast("string")), 256)
    rows = state.where("id is not null").orderBy(place, "v").limit(k).select("v").collect()
    return np.array([np.frombuffer(r["v"], "<i4") for r in rows], np.int64).reshape(-1, dims)


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer rows."""
    kind = np.int64 if max(np.abs(x).max(initial=0), np.abs(c).max(initial=0)) > EXACT or x.shape[1] > 512 else float
    x, c = x.astype(kind), c.astype(kind)
    return ((x * x).sum(1)[:, None] + (c * c).sum(1)[None] - 2 * (x @ c.T)).astype(np.int64)


def owned(x: np.ndarray, cluster: np.ndarray, distance: np.ndarray, c: np.ndarray, changed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cluster, distance) now.  ``changed`` marks the centroids that moved; an owner of -1 counts as moved."""
    new, least = cluster.copy(), distance.copy()
    lost = (cluster < 0) | changed[cluster]
    if lost.any():
        d = distances(x[lost], c)
        new[lost], least[lost] = d.argmin(1), d.min(1)  # ties: the first is the smaller number
    at = np.flatnonzero(changed)
    if len(at) and not lost.all():
        stay = np.flatnonzero(~lost)
        d = distances(x[stay], c[at])
        best = d.argmin(1)
        rival, away = at[best], d.min(1)
        win = (away < least[stay]) | ((away == least[stay]) & (rival < new[stay]))
        new[stay[win]], least[stay[win]] = rival[win], away[win]
    return new.astype(np.int32), least


def reassigned(state: DataFrame, c: np.ndarray, changed: np.ndarray) -> DataFrame:
    """The state after one comparison with the centroids ``c``."""
    dims, shared = c.shape[1], state.sparkSession.sparkContext.broadcast((c, changed))

    def run(batches):
        c, changed = shared.value
        for b in batches:
            cluster = b.column(2).to_numpy()
            x = np.frombuffer(b"".join(b.column(1).to_pylist()), "<i4").reshape(-1, dims)
            new, least = owned(x, cluster, b.column(3).to_numpy(), c, changed)
            yield pa.record_batch([b.column(0), b.column(1), pa.array(new), pa.array(least), pa.array(cluster)], ["id", "v", "cluster", "distance", "was"])

    return state.mapInArrow(run, _STATE)


def transfers(state: DataFrame, k: int, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """(counts, sums) to add to the clusters': what moved, signed, summed in tasks first."""

    def run(batches):
        n, s = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for b in batches:
            x = np.frombuffer(b"".join(b.column(0).to_pylist()), "<i4").reshape(-1, dims)
            for column, sign in ((1, 1), (2, -1)):
                owner = b.column(column).to_numpy()
                for at in np.unique(owner[owner >= 0]):
                    rows = owner == at
                    n[at] += sign * int(rows.sum())
                    s[at] += sign * x[rows].sum(0, dtype=np.int64)
        touched = np.flatnonzero(n.astype(bool) | s.any(1))
        yield pa.record_batch([pa.array(touched.astype(np.int32)), pa.array(n[touched]), pa.array(s[touched].tolist(), pa.list_(pa.int64()))], ["cluster", "n", "s"])

    parts = state.where("cluster <> was").select("v", "cluster", "was").mapInArrow(run, "cluster int, n long, s array<long>")
    total = parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("s")[i]) for i in range(dims)]).alias("s")).collect()  # a row for each cluster
    counts, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
    for r in total:
        counts[r["cluster"]], sums[r["cluster"]] = r["n"], r["s"]
    return counts, sums


def digest(c: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()


def clusters(vectors: DataFrame, k: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256): a row for
    each vector of just ``dims`` components, none of them null or non-finite.

    Components are the integers floor(scale * x).  The first centroids are the vectors
    whose ids hash smallest; each of ``rounds`` rounds assigns every vector to the
    nearest one (ties: smaller number) and moves each centroid that has vectors to the
    floor of their mean; then vectors are assigned once more.  A round in which no
    centroid moves ends them, as all further ones would repeat it.

    A repeated id counts as often as it stands there (of two as first centroids, the one
    of smaller packed components comes first); a vector without an id is assigned but is
    never a first centroid.  With fewer than ``k`` vectors with an id there are fewer
    clusters, and with none nothing can be assigned: the result is empty, as it is for
    an empty table.  Other columns are not read.  A component beyond 2**26 is an error.
    """
    state = stage(quantised(vectors, id_col, vector_col, dims, scale), "vectors")
    c = first_centroids(state, k, dims)
    k = len(c)
    if not k:
        return state.limit(0).select(F.col("id").alias("vec_id"), "cluster", "distance", F.lit(0).cast("long").alias("cluster_inertia"), F.lit(0).cast("long").alias("inertia"), F.lit("").alias("centroid_sha256"))
    changed, counts, sums = np.ones(k, bool), np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
    for r in range(rounds + 1):
        before, state = state, stage(reassigned(state, c, changed), "owners")
        unstage(before)
        if r == rounds:
            break
        n, s = transfers(state, k, dims)
        counts, sums = counts + n, sums + s
        new = np.where(counts[:, None] > 0, sums // np.maximum(counts, 1)[:, None], c)
        changed, c = (new != c).any(1), new
        if not changed.any():
            break
    per = {r["cluster"]: r["d"] for r in state.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}  # a row for each cluster
    about = state.sparkSession.createDataFrame([(j, d, sum(per.values()), digest(c[j])) for j, d in per.items()], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return state.join(F.broadcast(about), "cluster").select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
