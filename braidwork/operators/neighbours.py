"""Exact nearest neighbours with pruning, within a set or across two.

Vectors go to cells around pivots and are cut, in order of their distance to the
pivot, into blocks that are rings of a cell.  Each block knows how far the k-th
neighbour of its queries is at most, from its own vectors or from the sizes of the
cells around; by the triangle inequality only blocks within that distance are met.
Neighbouring blocks ask as a team: its partners are sent to it once, nearest first, and
one task keeps the k best of each query while they pass, so what goes on is k rows for
a query and run of partners.

Scale: pivots (at most PIVOTS, from a bounded sample, which sets the speed and not the
result) and the distances between them are broadcast; pairs are
planned from one small row for each block, and only planned partners are shuffled.
There are at most TEAMS teams until one holds TOGETHER blocks, so what is shuffled
grows with the vectors up to about three million, though every pair be met.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .staged import settle

#: Vectors in a block, pivots at most, vectors drawn for each pivot, and partners that
#: one task takes for a team.
BLOCK, PIVOTS, SAMPLE, PARTNERS = 2048, 1024, 8, 64
#: Teams at most, and blocks in one at most, which wins.
TEAMS, TOGETHER = 24, 64
ASKS, GIVEN = 1, 2
_FOUND = "src long, dst long, distance double"


def _kth(x: np.ndarray, flags: np.ndarray, keys: np.ndarray, k: int, apart: bool) -> np.ndarray:
    """For each vector that asks: the distance of its k-th neighbour inside the block."""
    given = np.flatnonzero(flags & GIVEN)
    out = np.full(len(x), np.inf)
    if len(given) < k:
        return out
    y = x[given]
    for lo in range(0, len(x), 256):
        d2 = _squares(x[lo : lo + 256], y)
        if not apart:
            d2[keys[lo : lo + 256, None] == keys[given][None]] = np.inf
        out[lo : lo + 256] = np.sqrt(np.partition(d2, k - 1, axis=1)[:, k - 1])
    return out


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] + (y * y).sum(1)[None] - 2 * (x @ y.T), 0)


def _rows(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(lists), -1)


def spread(sample: np.ndarray, n: int, rounds: int = 3) -> np.ndarray:
    """Up to ``n`` pivots for a sample: the next is always the farthest from those before;
    then a few rounds of moving each to the mean of its own."""
    if not len(sample):
        return sample
    at, away = [0], _squares(sample, sample[:1])[:, 0]
    while len(at) < n and away.max() > 0:
        at.append(int(away.argmax()))
        away = np.minimum(away, _squares(sample, sample[at[-1:]])[:, 0])
    pivots = sample[at]
    for _ in range(rounds):
        own = _squares(sample, pivots).argmin(1)
        size = np.bincount(own, minlength=len(pivots))
        mean = np.zeros(pivots.shape)
        np.add.at(mean, own, sample)
        pivots = np.where(size[:, None] > 0, mean / np.maximum(size, 1)[:, None], pivots)
    return pivots


class Layout:
    """Blocks of the vectors, and what the driver knows of their cells."""

    def __init__(self, rows: DataFrame, k: int, block: int, apart: bool):
        self.k, self.apart, spark = k, apart, rows.sparkSession
        given = rows.where(F.col("flags").bitwiseAND(F.lit(GIVEN)) != 0)
        most = min(PIVOTS, -(-rows.count() // block))
        chosen = given.orderBy(F.xxhash64("key"), "key").limit(SAMPLE * most).select("v").collect()
        self.pivots = spread(np.array([r["v"] for r in chosen], float), most)
        self.empty = not len(self.pivots)
        if self.empty:
            return
        self.shared = spark.sparkContext.broadcast(self.pivots)
        self.blocks = settle(self._cut(settle(self._celled(rows)), block).withColumn("block", F.monotonically_increasing_id()))
        stats = self.blocks.where("n_given > 0").groupBy("cell").agg(F.sum("n_given").alias("n"), F.max("hi").alias("hi")).collect()  # a row for each pivot at most
        self.size, self.reach = np.zeros(len(self.pivots), np.int64), np.full(len(self.pivots), -np.inf)
        for r in stats:
            self.size[r["cell"]], self.reach[r["cell"]] = r["n"], r["hi"]
        self.apart_by = np.sqrt(_squares(self.pivots, self.pivots))
        scale = float(self.apart_by.max() + max(self.reach.max(), 0))
        self.slack = 1e-7 * scale  # wider than what rounding does to a distance from products

    def _celled(self, rows: DataFrame) -> DataFrame:
        shared = self.shared

        def run(batches):
            p = shared.value
            for b in batches:
                x = _rows(b.column(1))
                cell = np.concatenate([_squares(x[lo : lo + 4096], p).argmin(1) for lo in range(0, max(len(x), 1), 4096)]).astype(np.int32)
                r = np.sqrt(((x - p[cell]) ** 2).sum(1))
                yield pa.record_batch([b.column(0), b.column(1), b.column(2), pa.array(cell), pa.array(r)], ["key", "v", "flags", "cell", "r"])

        return rows.select("key", "v", "flags").mapInArrow(run, "key long, v array<double>, flags int, cell int, r double")

    def _cut(self, celled: DataFrame, block: int) -> DataFrame:
        k, apart = self.k, self.apart

        def out(cell, parts):
            keys, x, flags, r = (np.concatenate(p) for p in zip(*parts))
            kth = _kth(x, flags, keys, k, apart)
            asks = (flags & ASKS) > 0
            row = {"cell": int(cell), "lo": float(r[0]), "hi": float(r[-1]), "n_given": int(((flags & GIVEN) > 0).sum()), "tau": float(kth[asks].max()) if asks.any() else None}
            row |= {"keys": keys.tobytes(), "x": x.tobytes(), "flags": flags.astype(np.uint8).tobytes(), "kth": kth.tobytes()}
            return pa.record_batch([pa.array([v]) if v is not None else pa.nulls(1, pa.float64()) for v in row.values()], list(row)).cast(kind)

        kind = pa.schema([("cell", pa.int32()), ("lo", pa.float64()), ("hi", pa.float64()), ("n_given", pa.int32()), ("tau", pa.float64()), *((c, pa.binary()) for c in ("keys", "x", "flags", "kth"))])

        def run(batches):
            held, at, n = [], None, 0
            for b in batches:
                cell, r = b.column(3).to_numpy(), b.column(4).to_numpy()
                keys, flags = b.column(0).to_numpy(), b.column(2).to_numpy()
                x = _rows(b.column(1))
                lo = 0
                while lo < len(cell):
                    if held and (cell[lo] != at or n == block):
                        yield out(at, held)
                        held, n = [], 0
                    at = cell[lo]
                    hi = min(lo + block - n, int(np.searchsorted(cell, at, side="right")))
                    held.append((keys[lo:hi], x[lo:hi], flags[lo:hi], r[lo:hi]))
                    n, lo = n + hi - lo, hi
            if held:
                yield out(at, held)

        laid = celled.repartitionByRange("cell", "r", "key").sortWithinPartitions("cell", "r", "key")
        return laid.mapInArrow(run, "cell int, lo double, hi double, n_given int, tau double, keys binary, x binary, flags binary, kth binary")

    def pairs(self) -> DataFrame:
        """(a, b, tau, bound): which blocks must meet, and how near they can be."""
        k, slack = self.k, self.slack
        reach = np.full(len(self.pivots), np.inf)  # from a pivot: within this are k others of every query, its own distance to the pivot added
        for i in range(len(self.pivots)):
            far = np.where(self.size > 0, self.apart_by[i] + self.reach, np.inf)
            order = np.argsort(far)
            enough = np.searchsorted(np.cumsum(self.size[order]), k + 1)
            if enough < len(order):
                reach[i] = far[order[enough]]
        shared = self.blocks.sparkSession.sparkContext.broadcast((reach, self.apart_by, self.reach))

        def run(batches):
            reach, away, radius = shared.value
            for b in batches:
                for block, cell, lo, hi, tau in zip(*(c.to_pylist() for c in b.columns)):
                    tau = min(tau, hi + reach[cell]) + slack
                    near = np.flatnonzero(away[cell] - hi - radius <= tau)
                    n = len(near)
                    yield pa.record_batch([pa.array([block] * n, pa.int64()), pa.array(near.astype(np.int32)), pa.array(away[cell][near]), *(pa.array([v] * n, pa.float64()) for v in (lo, hi, tau))], ["a", "cell", "away", "lo", "hi", "tau"])

        asks = self.blocks.where("tau is not null").select("block", "cell", "lo", "hi", "tau")
        wanted = asks.mapInArrow(run, "a long, cell int, away double, lo double, hi double, tau double")
        index = self.blocks.where("n_given > 0").select(F.col("block").alias("b"), "cell", F.col("lo").alias("b_lo"), F.col("hi").alias("b_hi"))
        bound = F.greatest(F.lit(0.0), F.col("away") - F.col("hi") - F.col("b_hi"), F.col("b_lo") - F.col("away") - F.col("hi"), F.col("lo") - F.col("away") - F.col("b_hi"))
        return wanted.join(index, "cell").select("a", "b", "tau", bound.alias("bound")).where("bound <= tau")

    def found(self) -> DataFrame:
        """(src, dst, distance) of the k nearest in each run of a team's partners."""
        k, apart, slack, pivots = self.k, self.apart, self.slack, self.shared
        n = self.blocks.count()
        together = min(TOGETHER, -(-n // TEAMS))
        # A row for each block; blocks of a cell follow each other.
        teams = settle(self.blocks.select("block", F.floor((F.row_number().over(Window.orderBy("block")) - 1) / together).alias("team")))
        pairs = settle(self.pairs().join(teams, F.col("a") == F.col("block")).drop("block"))
        met = pairs.groupBy("team", "b").agg(F.min("bound").alias("bound"))
        place = F.row_number().over(Window.partitionBy("team").orderBy("bound", "b"))
        met = settle(met.withColumn("at", place).withColumn("part", F.floor((F.col("at") - 1) / PARTNERS)))
        payload = self.blocks.select("block", "cell", "lo", "hi", "keys", "x", "flags", "kth")
        asking = pairs.groupBy("team", F.col("a").alias("block")).agg(F.max("tau").alias("tau"))
        heads = met.select("team", "part").distinct().join(asking, "team").withColumn("at", F.lit(0)).join(payload, "block")
        rest = met.join(payload.withColumn("kth", F.lit(b"")), F.col("b") == F.col("block")).withColumn("tau", F.lit(None).cast("double"))
        names = ["team", "part", "at", "tau", "cell", "lo", "hi", "keys", "x", "flags", "kth"]
        runs = -(-n // together) * -(-n // PARTNERS)
        tasks = max(int(met.sparkSession.conf.get("spark.sql.shuffle.partitions")), runs)
        rows = heads.select(*names).unionByName(rest.select(*names)).repartition(tasks, "team", "part").sortWithinPartitions("team", "part", "at")

        def run(batches):
            best, of = [], None
            for b in batches:
                for k_, (team, part, at, tau, cell, lo, hi) in enumerate(zip(*(b.column(c).to_pylist() for c in range(7)))):
                    keys = np.frombuffer(b.column(7)[k_].as_py(), np.int64)
                    x = np.frombuffer(b.column(8)[k_].as_py(), float).reshape(len(keys), -1)
                    flags = np.frombuffer(b.column(9)[k_].as_py(), np.uint8)
                    if (team, part) != of:
                        yield from (one.rows() for one in best)
                        best, of = [], (team, part)
                    if at == 0:
                        asks = (flags & ASKS) > 0
                        best.append(Best(keys[asks], x[asks], np.minimum(np.frombuffer(b.column(10)[k_].as_py(), float)[asks], tau), k, apart, slack))
                        continue
                    given = (flags & GIVEN) > 0
                    for one in best:
                        one.meet(keys[given], x[given], pivots.value[cell], lo, hi)
            yield from (one.rows() for one in best)

        return rows.mapInArrow(run, _FOUND)


class Best:
    """The k nearest so far of a block's queries, ties to the smaller key."""

    def __init__(self, keys, x, tau, k, apart, slack):
        self.keys, self.x, self.tau, self.k, self.apart, self.slack = keys, x, tau.copy(), k, apart, slack
        self.at, self.dst, self.d = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)

    def meet(self, keys, y, pivot, lo, hi) -> None:
        away = np.sqrt(((self.x - pivot) ** 2).sum(1))
        near = np.flatnonzero(np.maximum(away - hi, lo - away) <= self.tau + self.slack)
        for s in range(0, len(near), 512):
            rows = near[s : s + 512]
            d2 = _squares(self.x[rows], y)
            i, j = np.nonzero(d2 <= ((self.tau[rows] + self.slack) ** 2)[:, None])
            i = rows[i]
            if not self.apart:
                other = self.keys[i] != keys[j]
                i, j = i[other], j[other]
            exact = np.concatenate([np.sqrt(((self.x[i[c : c + 65536]] - y[j[c : c + 65536]]) ** 2).sum(1)) for c in range(0, max(len(i), 1), 65536)])
            self.at, self.dst, self.d = np.concatenate([self.at, i]), np.concatenate([self.dst, keys[j]]), np.concatenate([self.d, exact])
            self._trim()

    def _trim(self) -> None:
        order = np.lexsort((self.dst, self.d, self.at))
        at = self.at[order]
        place = np.arange(len(at)) - np.searchsorted(at, at)
        keep = order[place < self.k]
        full = order[place == self.k - 1]
        self.tau[self.at[full]] = np.minimum(self.tau[self.at[full]], self.d[full])
        self.at, self.dst, self.d = self.at[keep], self.dst[keep], self.d[keep]

    def rows(self) -> pa.RecordBatch:
        return pa.record_batch([pa.array(self.keys[self.at]), pa.array(self.dst), pa.array(self.d)], ["src", "dst", "distance"])


def _flagged(vectors: DataFrame, key: str, vector: str, flags: int) -> DataFrame:
    return vectors.where(F.col(vector).isNotNull()).select(F.col(key).cast("long").alias("key"), F.col(vector).cast("array<double>").alias("v"), F.lit(flags).alias("flags"))


def _nearest(rows: DataFrame, k: int, block: int, apart: bool) -> DataFrame:
    layout = Layout(rows, k, block, apart)
    if layout.empty:
        return rows.sparkSession.createDataFrame([], _FOUND)
    w = Window.partitionBy("src").orderBy("distance", "dst")
    return layout.found().withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k).drop("_r")


def nearest(vectors: DataFrame, key: str, vector: str, k: int, block: int = BLOCK) -> DataFrame:
    """(src, dst, distance): the exact k nearest others of each vector, smaller key on ties.

    Keys are distinct; rows without a vector are left out.  With fewer than k others
    there are fewer rows."""
    return _nearest(_flagged(vectors, key, vector, ASKS | GIVEN), k, block, apart=False)


def nearest_across(queries: DataFrame, index: DataFrame, key: str, vector: str, k: int, block: int = BLOCK) -> DataFrame:
    """(src, dst, distance): of each vector of ``queries`` the exact k nearest of ``index``.

    A key may stand in both tables; the two rows are then different vectors."""
    return _nearest(_flagged(queries, key, vector, ASKS).unionByName(_flagged(index, key, vector, GIVEN)), k, block, apart=True)
