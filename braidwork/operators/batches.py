"""Batch correction by mutual nearest neighbours.

Pairs that are among each other's nearest across two sets tell how far one set lies
from the other; a vector is moved by the mean of the pairs' differences, weighted by a
Gaussian kernel of its distance to them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .neighbours import BLOCK, PARTNERS, nearest_across
from .staged import settle

#: Vectors of the set that is moved, in a block at most, and blocks that they make at
#: least: each block is met by all pairs, so few blocks shuffle little.
MOVED, PARTS = 32768, 24


def mutual_pairs(a: DataFrame, b: DataFrame, key: str, vector: str, k: int, block: int = BLOCK) -> DataFrame:
    """(a, b): keys of vectors that are among each other's k nearest of the other set."""
    there = nearest_across(a, b, key, vector, k, block).select(F.col("src").alias("a"), F.col("dst").alias("b"))
    back = nearest_across(b, a, key, vector, k, block).select(F.col("dst").alias("a"), F.col("src").alias("b"))
    return there.join(back, ["a", "b"])


def _packed(rows: DataFrame, block: int) -> DataFrame:
    """(block, keys, x, w, s): rows (key, v, w, s) in runs of up to ``block``."""

    def out(held):
        part = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        cells = [part.column(0).to_numpy().tobytes()] + [part.column(c).flatten().to_numpy(zero_copy_only=False).astype(float).tobytes() for c in (1, 3)]
        w = part.column(2).to_numpy().astype(float).tobytes()
        return pa.record_batch([pa.array([v], pa.binary()) for v in (cells[0], cells[1], w, cells[2])], ["keys", "x", "w", "s"])

    def run(batches):
        held, n = [], 0
        for b in batches:
            lo = 0
            while lo < b.num_rows:
                part = b.slice(lo, block - n)
                held.append(part)
                n, lo = n + part.num_rows, lo + part.num_rows
                if n == block:
                    yield out(held)
                    held, n = [], 0
        if held:
            yield out(held)

    return settle(rows.mapInArrow(run, "keys binary, x binary, w binary, s binary").withColumn("block", F.monotonically_increasing_id()))


class Mean:
    """Kernel-weighted sums for one block, each kept relative to its largest weight so
    far, so that no distance is too far for the mean."""

    def __init__(self, keys: np.ndarray, x: np.ndarray, sigma: float):
        self.keys, self.x, self.sigma = keys, x, sigma
        self.top, self.sum, self.weight = np.full(len(x), -np.inf), np.zeros(x.shape), np.zeros(len(x))

    def meet(self, y: np.ndarray, w: np.ndarray, s: np.ndarray) -> None:
        for lo in range(0, len(self.x), 1024):
            at = slice(lo, lo + 1024)
            x = self.x[at]
            power = -0.5 * self.sigma * np.maximum((x * x).sum(1)[:, None] + (y * y).sum(1)[None] - 2 * (x @ y.T), 0)
            top = np.maximum(self.top[at], power.max(1))
            old, new = np.exp(self.top[at] - top), np.exp(power - top[:, None])
            self.sum[at] = self.sum[at] * old[:, None] + new @ s
            self.weight[at] = self.weight[at] * old + new @ w
            self.top[at] = top

    def rows(self) -> pa.RecordBatch:
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(self.x) + 1) * self.x.shape[1], pa.int32()), pa.array(self.sum.ravel()))
        return pa.record_batch([pa.array(self.keys), pa.array(self.top), pa.array(self.weight), lists], ["key", "top", "weight", "s"])


def shifts(points: DataFrame, reference: DataFrame, pairs: DataFrame, key: str, vector: str, sigma: float) -> DataFrame:
    """(key, shift) for each of ``points``: the kernel-weighted mean of the pairs' differences.
    Without pairs there are no rows.

    Every vector weighs every pair, block against block; a task takes up to PARTNERS
    blocks of pairs and leaves one row for each vector of its block."""
    p = points.where(F.col(vector).isNotNull()).select(F.col(key).cast("long").alias("key"), F.col(vector).cast("array<double>").alias("v"))
    r = reference.select(F.col(key).cast("long").alias("b"), F.col(vector).cast("array<double>").alias("to"))
    ends = pairs.join(p.select(F.col("key").alias("a"), F.col("v").alias("from")), "a").join(r, "b")
    apart = ends.select("a", "from", F.posexplode(F.zip_with("to", "from", lambda t, f: t - f)).alias("i", "x"))
    # Pairs with the same vector weigh the same, so their differences are added first.
    s = apart.groupBy("a", "i").agg(F.sum("x").alias("x"), F.count("*").alias("w"))
    s = s.groupBy("a").agg(F.max("w").alias("w"), F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda z: z.x).alias("s"))
    anchors = _packed(s.join(p, F.col("a") == F.col("key")).select("key", "v", "w", "s").repartition(int(p.sparkSession.conf.get("spark.sql.shuffle.partitions")), "key"), BLOCK)
    size = min(MOVED, max(BLOCK, -(-p.count() // PARTS)))
    moved = _packed(p.select("key", "v", F.lit(0).alias("w"), F.array(F.lit(0.0)).alias("s")), size)
    runs = anchors.select("block").orderBy("block").collect()  # an id for each block
    dealt = p.sparkSession.createDataFrame([(r["block"], k // PARTNERS, k % PARTNERS + 1) for k, r in enumerate(runs)], "block long, part int, at int")
    parts = -(-len(runs) // PARTNERS)
    heads = moved.select(F.col("block").alias("a"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part") if parts else F.lit(0).alias("part"), F.lit(0).alias("at"), "keys", "x", "w", "s")
    light = heads.select("a", "part").join(F.broadcast(dealt.withColumnRenamed("block", "b")), "part")
    rest = light.join(anchors, F.col("b") == F.col("block")).select("a", "part", "at", "keys", "x", "w", "s")
    tasks = int(p.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = heads.unionByName(rest).repartition(tasks, "a", "part").sortWithinPartitions("a", "part", "at")

    def run(batches):
        mean = None
        for b in batches:
            for k in range(b.num_rows):
                keys, x, w, s = (np.frombuffer(b.column(c)[k].as_py(), t) for c, t in ((3, np.int64), (4, float), (5, float), (6, float)))
                if b.column(2)[k].as_py() == 0:
                    if mean is not None:
                        yield mean.rows()
                    mean = Mean(keys, x.reshape(len(keys), -1), sigma)
                else:
                    mean.meet(x.reshape(len(keys), -1), w, s.reshape(len(keys), -1))
        if mean is not None:
            yield mean.rows()

    some = settle(rows.select("a", "part", "at", "keys", "x", "w", "s").mapInArrow(run, "key long, top double, weight double, s array<double>"))
    some = some.where("weight > 0")
    most = some.groupBy("key").agg(F.max("top").alias("most"))
    scaled = some.join(most, "key").withColumn("f", F.exp(F.col("top") - F.col("most")))
    weight = scaled.groupBy("key").agg(F.sum(F.col("f") * F.col("weight")).alias("weight"))
    added = scaled.select("key", "f", F.posexplode("s").alias("i", "x")).groupBy("key", "i").agg(F.sum(F.col("f") * F.col("x")).alias("x"))
    whole = added.groupBy("key").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda z: z.x).alias("s")).join(weight, "key")
    return whole.select("key", F.transform("s", lambda x: x / F.col("weight")).alias("shift"))


def correct(points: DataFrame, reference: DataFrame, key: str, vector: str, k: int = 20, sigma: float = 1.0, block: int = BLOCK) -> DataFrame:
    """``points`` (key, vector) moved towards ``reference``; without a mutual pair they stay."""
    points = settle(points.select(key, vector))
    pairs = settle(mutual_pairs(points, reference, key, vector, k, block))
    by = shifts(points, reference, pairs, key, vector, sigma)
    moved = F.when(F.col("shift").isNotNull(), F.zip_with(F.col(vector).cast("array<double>"), "shift", lambda a, b: a + b)).otherwise(F.col(vector).cast("array<double>"))
    return points.join(by.withColumnRenamed("key", "_key"), F.col(key).cast("long") == F.col("_key"), "left").select(key, moved.alias(vector))


def correct_batches(points: DataFrame, key: str, vector: str, batch: str, k: int = 20, sigma: float = 1.0, block: int = BLOCK) -> DataFrame:
    """(key, vector, batch): all batches moved, from the second largest down, towards
    what has been brought together before; the largest stays (ties: smaller name)."""
    sizes = points.groupBy(batch).agg(F.count("*").alias("n")).orderBy(F.desc("n"), batch).collect()  # batches are few
    done = None
    for r in sizes:
        part = points.where(F.col(batch).eqNullSafe(F.lit(r[batch]))).select(key, F.col(vector).cast("array<double>").alias(vector))
        part = part if done is None else correct(part, done, key, vector, k, sigma, block)
        part = part.withColumn(batch, F.lit(r[batch]).cast(points.schema[batch].dataType))
        done = settle(part if done is None else done.unionByName(part))
    return points.select(key, F.col(vector).cast("array<double>").alias(vector), batch) if done is None else done
