"""Latent reductions and how well clusters stand apart."""

from __future__ import annotations

import warnings

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .matrix import depth_normalise, idf, moments, normalised_dispersion, select
from .staged import settle
from .topics import Rounds


def lsa(m: DataFrame, k: int, seed: int = 5, tolerance: float = 1e-4, features: int | None = None, fit_on: DataFrame | None = None) -> DataFrame:
    """(barcode_id, score): the IDF-weighted matrix times its k leading feature vectors.

    ``features`` keeps the most dispersed ones for the fit, ``fit_on`` (barcode_id) some
    barcodes; all barcodes are projected."""
    barcodes = m.select("barcode_id").distinct()

    def weighted(some):
        n = some.select("barcode_id").distinct().count()
        return settle(idf(some, n).select("feature_id", "barcode_id", "value"))

    x = weighted(m)
    fit = x if features is None and fit_on is None else weighted(_part(m, features, fit_on))
    return project(x, barcodes, leading(fit, k, seed, tolerance))


def pca(m: DataFrame, k: int, seed: int = 5, tolerance: float = 1e-4, features: int | None = None, fit_on: DataFrame | None = None) -> DataFrame:
    """(barcode_id, score): the first k principal components of log counts.

    Barcodes are brought to the median depth, counts become log2(1 + x), and features
    are centred and scaled to a variance of one; centring is done in the products, so the
    matrix stays sparse.  ``features`` and ``fit_on`` as in ``lsa``."""
    barcodes = m.select("barcode_id").distinct()

    def scaled(some):
        n = some.select("barcode_id").distinct().count()
        logs = settle(depth_normalise(some).select("feature_id", "barcode_id", F.log2(F.col("value") + 1.0).alias("value")))
        size = moments(logs, "feature_id", n).select("feature_id", "mean", F.sqrt(F.when(F.col("var") > 1e-12, F.col("var")).otherwise(1.0)).alias("sd"))
        x = settle(logs.join(size, "feature_id").select("feature_id", "barcode_id", (F.col("value") / F.col("sd")).alias("value")))
        return x, size.select("feature_id", (F.col("mean") / F.col("sd")).alias("mean")), n

    x, means, n = scaled(m)
    fit = (x, means, n) if features is None and fit_on is None else scaled(_part(m, features, fit_on))
    return project(x, barcodes, leading(fit[0], k, seed, tolerance, fit[1], fit[2]), means)


def _part(m: DataFrame, features: int | None, barcodes: DataFrame | None) -> DataFrame:
    """Entries of the most dispersed features and of some barcodes."""
    if features is not None:
        n = m.select("barcode_id").distinct().count()
        z = normalised_dispersion(moments(depth_normalise(m), "feature_id", n))
        m = select(m, z.orderBy(F.desc_nulls_last("z"), "feature_id").limit(features), "feature_id")
    return settle(m if barcodes is None else select(m, barcodes, "barcode_id"))


# --- leading vectors of a sparse matrix

#: Of so few barcodes the products of all pairs are summed and solved at once.
SMALL = 512


def leading(x: DataFrame, k: int, seed: int = 5, tolerance: float = 1e-4, means: DataFrame | None = None, n: int = 0, most_rounds: int = 50) -> DataFrame:
    """(feature_id, v): the k leading right singular vectors of a barcode by feature matrix.

    Block Krylov iteration: a feature's row holds its numbers in a basis ``v`` and in the
    basis' image ``w`` under the matrix and its transpose.  A round finds the best vectors
    within the basis, and what their images leave over widens it, through joins with the
    entries.  Only products of columns, some 100 by 100 numbers summed by Spark, reach
    the driver.  It ends when every vector's residual is below ``tolerance`` times the
    largest singular value; with ``most_rounds`` passed it warns.  ``means`` centres the
    features over ``n`` barcodes without filling the matrix.  A matrix of lower rank
    gives fewer vectors.  Signs are arbitrary.  Up to SMALL barcodes are solved at once."""
    few = [r[0] for r in x.select("barcode_id").distinct().limit(SMALL + 1).collect()]
    if 0 < len(few) <= SMALL:
        return _of_few(x, k, few, means is not None)
    names = x.select("feature_id").distinct()
    width = 2 * k + 4
    start = F.array(*[F.pmod(F.xxhash64("feature_id", F.lit(seed + j)), F.lit(2001)) / 1000.0 - 1.0 for j in range(width)])
    mean = names.withColumn("mean", F.lit(0.0)) if means is None else names.join(means, "feature_id")
    t = settle(mean.select("feature_id", F.array("mean").alias("extra"), start.alias("v"), F.array().cast("array<double>").alias("w")))
    g = products(t)
    if not len(g):
        return names.withColumn("v", F.array().cast("array<double>"))
    turn = whitened(g[1:, 1:])
    t, along = turned(t, {"v": [], "w": [], "p": [("v", turn)]}), g[0, 1:] @ turn
    for r in range(most_rounds):
        t = settle(_with_image(t, x, along * n))
        g = products(t)
        j = len(g) // 2
        basis, image = slice(1, 1 + j), slice(1 + j, 1 + 2 * j)
        free = whitened(g[basis, basis])
        inner = free.T @ g[basis, image] @ free
        values, best = np.linalg.eigh((inner + inner.T) / 2)
        values, best = np.maximum(values[::-1], 0), free @ best[:, ::-1]
        kept, own = best[:, :width], np.sqrt(values[:width])
        left, top = kept.T @ g[image, image] @ kept - np.diag(own**4), own[0]
        far = np.sqrt(np.maximum(np.diag(left), 0)) > tolerance * top * np.maximum(own, 1e-3 * top)
        if not far[:k].any() or r == most_rounds - 1:
            break
        # At five blocks the basis begins again from its best vectors, images included.
        stay = best[:, :width] if j + width > 5 * width else np.eye(j)
        rest = left[np.ix_(far, far)]
        size = 1 / np.sqrt(np.diag(rest))
        out = whitened(rest * size[:, None] * size)
        over_w, over_v = (kept[:, far] * size) @ out, -(kept[:, far] * values[:width][far] * size) @ out
        along = g[0, image] @ over_w + g[0, basis] @ over_v
        t = turned(t, {"v": [("v", stay)], "w": [("w", stay)], "p": [("w", over_w), ("v", over_v)]})
    if far[:k].any():
        warnings.warn(f"{int(far[:k].sum())} of {k} vectors are not within {tolerance} after {most_rounds} rounds", stacklevel=2)
    kept = kept[:, :k][:, values[:k] > 1e-12 * values[0]]
    return turned(t, {"v": [("v", kept)]}, extra=False).select("feature_id", "v")


def _of_few(x: DataFrame, k: int, barcodes: list, centred: bool) -> DataFrame:
    """``leading`` from the products of all pairs of ``barcodes``, which a feature's entries bound."""
    n = len(barcodes)
    key = x.schema["barcode_id"].dataType.simpleString()
    at = x.sparkSession.createDataFrame([(b, i) for i, b in enumerate(barcodes)], f"barcode_id {key}, at int")
    rows = x.join(F.broadcast(at), "barcode_id").groupBy("feature_id").agg(F.collect_list(F.struct("at", "value")).alias("r")).select("r.at", "r.value")

    def run(batches):
        total = np.zeros((n, n))
        for b in batches:
            for some in (b.slice(lo, 1024) for lo in range(0, b.num_rows, 1024)):
                places = some.column(0)
                dense = np.zeros((some.num_rows, n))
                sizes = np.diff(places.offsets.to_numpy())
                np.add.at(dense, (np.repeat(np.arange(some.num_rows), sizes), places.flatten().to_numpy()), some.column(1).flatten().to_numpy())
                total += dense.T @ dense
        yield _pairs(total)

    g = _summed(rows.mapInArrow(run, _PAIRS))
    if centred:
        g = g - g.mean(0) - g.mean(1)[:, None] + g.mean()
    values, own = np.linalg.eigh(g)
    values, own = values[::-1][:k], own[:, ::-1][:, :k]
    good = values > 1e-12 * max(values[0], 1e-300)
    turn = own[:, good] / np.sqrt(values[good])
    if not turn.shape[1]:
        return x.select("feature_id").distinct().withColumn("v", F.array().cast("array<double>"))
    sides = x.sparkSession.createDataFrame([(b, r.tolist()) for b, r in zip(barcodes, turn)], f"barcode_id {key}, v array<double>")
    return _times(x, F.broadcast(sides), "barcode_id", "feature_id", turn.shape[1])


def project(x: DataFrame, barcodes: DataFrame, vectors: DataFrame, means: DataFrame | None = None) -> DataFrame:
    """(barcode_id, score): each barcode's row times the vectors; one without entries counts as well."""
    vectors = settle(vectors)
    k = vectors.agg(F.max(F.size("v"))).first()[0] or 0
    if not k:
        return barcodes.select("barcode_id", F.array().cast("array<double>").alias("score"))
    middle = [0.0] * k
    if means is not None:
        middle = list(vectors.join(means, "feature_id").agg(*[F.sum(F.col("mean") * F.col("v")[j]) for j in range(k)]).first())
    sums = barcodes.join(_times(x, vectors, "feature_id", "barcode_id", k), "barcode_id", "left")
    return sums.select("barcode_id", F.array(*[F.coalesce(F.col("v")[j], F.lit(0.0)) - F.lit(float(middle[j])) for j in range(k)]).alias("score"))


def _times(x: DataFrame, vectors: DataFrame, over: str, to: str, k: int) -> DataFrame:
    sums = x.join(vectors, over).groupBy(to).agg(*[F.sum(F.col("value") * F.col("v")[j]).alias(f"s{j}") for j in range(k)])
    return sums.select(to, F.array(*[f"s{j}" for j in range(k)]).alias("v"))


def _with_image(t: DataFrame, x: DataFrame, along: np.ndarray) -> DataFrame:
    """``t`` with its new columns ``p`` added to the basis and their image to ``w``."""
    k = len(along)
    there = _times(x, t.select("feature_id", F.col("p").alias("v")), "feature_id", "barcode_id", k)
    back = _times(x, there, "barcode_id", "feature_id", k).withColumnRenamed("v", "z")
    centred = F.array(*[F.col("z")[j] - F.col("extra")[0] * F.lit(float(along[j])) for j in range(k)])
    return t.join(back, "feature_id").select("feature_id", "extra", F.concat("v", "p").alias("v"), F.concat("w", centred).alias("w"))


def _table(column) -> np.ndarray:
    return np.asarray(column.flatten(), float).reshape(len(column), -1)


def products(t: DataFrame) -> np.ndarray:
    """Products of all columns (extra, v, w), summed by Spark, one number of each task and pair."""

    def run(batches):
        total = 0
        for b in batches:
            if b.num_rows:
                rows = np.concatenate([_table(c) for c in b.columns if len(c.flatten())], 1)
                total = total + rows.T @ rows
        if not np.isscalar(total):
            yield _pairs(total)

    return _summed(t.select("extra", "v", "w").mapInArrow(run, _PAIRS))


_PAIRS = "i int, j int, s double"


def _pairs(total: np.ndarray):
    i, j = np.indices(total.shape)
    return pa.record_batch([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())], ["i", "j", "s"])


def _summed(parts: DataFrame) -> np.ndarray:
    """The sum of the tasks' matrices, one row for each pair."""
    sums = parts.groupBy("i", "j").agg(F.sum("s").alias("s")).toPandas()
    size = int(sums["i"].max()) + 1 if len(sums) else 0
    g = np.zeros((size, size))
    g[sums["i"], sums["j"]] = sums["s"]
    return g


def turned(t: DataFrame, to: dict, extra: bool = True) -> DataFrame:
    """``t`` with columns replaced by sums of its columns times matrices; no matrix: no numbers."""
    have = ["feature_id", "extra", "v", "w"]

    def run(batches):
        for b in batches:
            old = {c: _table(b.column(i)) for i, c in enumerate(have) if i and len(b.column(i).flatten())}
            new = []
            for parts in to.values():
                rows = sum((old[c] @ m for c, m in parts), np.zeros((b.num_rows, parts[0][1].shape[1] if parts else 0)))
                ends = np.arange(b.num_rows + 1, dtype=np.int32) * rows.shape[1]
                new.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(rows.ravel())))
            yield pa.record_batch([b.column(0), *([b.column(1)] if extra else []), *new], ["feature_id", *(["extra"] if extra else []), *to])

    key = t.schema["feature_id"].dataType.simpleString()
    schema = ", ".join([f"feature_id {key}", *(["extra array<double>"] if extra else []), *[f"{c} array<double>" for c in to]])
    return t.select(*have).mapInArrow(run, schema)


def whitened(g: np.ndarray) -> np.ndarray:
    """A matrix that makes columns of these products orthonormal, dependent ones left out."""
    size = np.sqrt(np.maximum(np.diag(g), 0))
    used = size > 1e-12 * size.max()
    scaled = g[np.ix_(used, used)] / np.outer(size[used], size[used])
    values, vectors = np.linalg.eigh((scaled + scaled.T) / 2)
    good = values > 1e-10 * values[-1]
    out = np.zeros((len(g), int(good.sum())))
    out[used] = vectors[:, good] / np.sqrt(values[good]) / size[used][:, None]
    return out


# --- latent topics


def plsa(m: DataFrame, k: int, seed: int = 3, tolerance: float = 0.02, most_rounds: int = 3000) -> DataFrame:
    """(barcode_id, topics): shares of k latent topics, fitted by expectation-maximisation.

    Each round spreads every entry over the topics and adds up by feature and by
    barcode (``topics.Rounds``).  It ends after more than ten rounds when no barcode's
    shares changed by ``tolerance`` in all; with ``most_rounds`` passed it warns.  On a
    flat matrix 0.002 takes hundreds of rounds more."""
    x = settle(m.where("value > 0").select("feature_id", "barcode_id", F.col("value").cast("double").alias("value")))
    if x.isEmpty():
        return x.select(F.col("barcode_id").cast("long").alias("barcode_id"), F.array(F.col("value")).alias("topics"))
    rounds = Rounds(x, k, seed)
    for r in range(11, most_rounds):
        if rounds.changed(r) < tolerance:
            break
    else:
        r = most_rounds
        warnings.warn(f"topics still change by {rounds.changed(r):.4f} after {most_rounds} rounds", stacklevel=2)
    whole = F.aggregate("p", F.lit(0.0), lambda a, b: a + b)
    return rounds.topics(r).select("barcode_id", F.transform("p", lambda v: v / F.greatest(whole, F.lit(1e-300))).alias("topics"))


def davies_bouldin(points: DataFrame, labels: DataFrame, key: str, vector: str) -> DataFrame:
    """(index): mean over clusters of the worst ratio of scatters to centre distance.

    Scatter is the root of the mean squared distance to the centre; distances count
    as 1e-3 at least.  Points are unrolled by coordinate, so sums are Spark's; only
    clusters meet each other."""
    x = points.join(labels, key).select("label", key, F.posexplode(vector).alias("i", "x")).withColumn("x", F.col("x").cast("double"))
    centre = x.groupBy("label", "i").agg(F.avg("x").alias("c"))
    scatter = x.join(centre, ["label", "i"]).groupBy("label").agg(F.sqrt(F.sum(F.pow(F.col("x") - F.col("c"), 2)) / F.count_distinct(key)).alias("s"))
    other = centre.select(F.col("label").alias("label2"), "i", F.col("c").alias("c2"))
    gap = centre.join(other, "i").where("label <> label2").groupBy("label", "label2").agg(F.greatest(F.sqrt(F.sum(F.pow(F.col("c") - F.col("c2"), 2))), F.lit(1e-3)).alias("d"))
    both = gap.join(scatter, "label").join(scatter.select(F.col("label").alias("label2"), F.col("s").alias("s2")), "label2")
    return both.groupBy("label").agg(F.max((F.col("s") + F.col("s2")) / F.col("d")).alias("r")).agg(F.avg("r").alias("index"))


def shared_neighbours(edges: DataFrame, k: int) -> DataFrame:
    """(a, b, share) of nodes that have a neighbour in common, a < b.

    Nodes meet on a common neighbour: its in-degree bounds what one task holds."""
    one, two = edges.select(F.col("src").alias("a"), "dst"), edges.select(F.col("src").alias("b"), "dst")
    return one.join(two, "dst").where("a < b").groupBy("a", "b").agg((F.count("*") / k).alias("share"))
