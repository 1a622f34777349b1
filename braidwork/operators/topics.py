"""Rounds of expectation-maximisation for latent topics.

Entries are dealt into blocks of features, laid out once and kept by Spark.  In a round
each block spreads its entries over the topics in numpy; its features' sums stay with it,
its barcodes' go to the blocks of barcodes, which add them up and answer.  So a round
shuffles sums, k numbers for a row, and no entries, and several rounds make one job.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .communities import _firsts, _lists, hashed
from .staged import settle

#: Rounds of a job; barcodes of their blocks; entries of a block, which grow once there are so many blocks, up to the last.
TOGETHER, BARCODES, ENTRIES, BLOCKS, MOST = 8, 4096, 1 << 18, 64, 1 << 21
# What a row of a message is: a block's features, its barcodes' sums as answered, the sums of
# all features; what is added to barcodes and to all features; what the rounds leave behind.
FEATURES, ANSWER, WHOLE, PART, ADDED, DOCS, CHANGE = range(7)
_SAID = "b int, kind int, of int, x array<long>, y array<double>"
_KEPT = {"features": "long", "barcodes": "long", "ends": "int", "f": "int", "d": "int", "v": "double"}


def _table(rows) -> pa.Table:
    b, kind, of, x, y = zip(*rows) if (rows := list(rows)) else [[]] * 5

    def lists(arrays, t):
        ends = np.cumsum([0, *map(len, arrays)])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, t.to_pandas_dtype()), *arrays]), t))

    return pa.table({"b": pa.array(b, pa.int32()), "kind": pa.array(kind, pa.int32()), "of": pa.array(of, pa.int32()), "x": lists(x, pa.int64()), "y": lists(y, pa.float64())})


def _shares(p: np.ndarray) -> np.ndarray:
    return p / np.maximum(p.sum(1, keepdims=True), 1e-300)


def _start(ids: np.ndarray, k: int, seed: int) -> np.ndarray:
    return np.stack([1.0 + (hashed(ids, seed + j) % 1000) / 1000.0 for j in range(k)], 1)


_NONE = np.zeros(0, np.int64)


class Rounds:
    """Topics of a table of entries (feature_id, barcode_id, value), round by round."""

    def __init__(self, x: DataFrame, k: int, seed: int):
        x = x.select(F.col("feature_id").cast("long").alias("feature_id"), F.col("barcode_id").cast("long").alias("barcode_id"), F.col("value").cast("double").alias("value")).na.drop()
        n, docs = x.agg(F.count("*"), F.count_distinct("barcode_id")).first()
        self.k, self.blocks = k, max(1, min(-(-n // ENTRIES), max(BLOCKS, -(-n // MOST))))
        self.owners = max(1, min(self.blocks, -(-docs // BARCODES)))
        self.jobs, self.change, blocks, owners = [], {}, self.blocks, self.owners

        def lay(t):
            feature, barcode, v = (t.column(c).to_numpy() for c in ("feature_id", "barcode_id", "value"))
            order = np.argsort(feature, kind="stable")
            feature, barcode, v = feature[order], barcode[order], v[order]
            first = _firsts(feature)
            ids, d = np.unique(barcode, return_inverse=True)
            home = hashed(ids) % owners
            laid = np.lexsort((ids, home))
            rank = np.empty(len(laid), np.int64)
            rank[laid] = np.arange(len(laid))
            row = {"features": feature[first], "barcodes": ids[laid], "ends": np.searchsorted(home[laid], np.arange(owners + 1)), "f": first, "d": rank[d], "v": v}
            types = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64()}
            return pa.table({"b": t.column("b").slice(0, 1)} | {c: pa.array([row[c]], pa.list_(types[w])) for c, w in _KEPT.items()})

        dealt = x.withColumn("b", F.pmod(F.xxhash64("feature_id"), F.lit(blocks)).cast("int"))
        kept = f"b int, {', '.join(f'{c} array<{w}>' for c, w in _KEPT.items())}"
        self.layout = settle(dealt.repartition(blocks, "b").groupBy("b").applyInArrow(lay, kept)).repartition(blocks, "b").persist()

        def begin(batches):
            for batch in batches:
                for i in range(batch.num_rows):
                    t = pa.Table.from_batches([batch.slice(i, 1)])
                    b, features, barcodes, ends = t.column("b")[0].as_py(), *(c[0] for c in _lists(t, "features", "barcodes", "ends"))
                    yield from _table(_parts(b, barcodes, ends, _start(features, k, seed), _start(barcodes, k, seed))).to_batches()

        self.last = self._answered(self.layout.mapInArrow(begin, _SAID), 0)

    def _answered(self, said: DataFrame, r: int) -> DataFrame:
        """Messages with the sums of round ``r`` in the place of what was added."""
        k, blocks = self.k, self.blocks

        def run(batches):
            asked, whole, was = {}, [], {}
            for batch in batches:
                t = pa.Table.from_batches([batch])
                kind = t.column("kind").to_numpy()
                add = np.isin(kind, (PART, ADDED))
                yield from t.filter(pa.array(~add)).to_batches()
                t = t.filter(pa.array(add | ((kind == DOCS) & (t.column("of").to_numpy() == r - 1))))
                for b, kind, of, x, y in zip(*(t.column(c).to_pylist() for c in ("b", "kind", "of")), *_lists(t, "x", "y")):
                    if kind == ADDED:
                        whole.append((of, y))
                    elif kind == DOCS:
                        was[b] = _shares(y.reshape(-1, k))
                    else:
                        asked.setdefault(b, []).append((of, x, y.reshape(-1, k)))
            rows = []
            if whole:
                total = sum(y for _, y in sorted(whole, key=lambda p: p[0]))
                rows += [(b, WHOLE, r, _NONE, total) for b in range(blocks)]
            for b, parts in asked.items():
                parts.sort(key=lambda p: p[0])
                ids = np.unique(np.concatenate([x for _, x, _ in parts]))
                p = np.zeros((len(ids), k))
                for _, x, y in parts:
                    at = np.searchsorted(ids, x)
                    # At the start every block names the same numbers.
                    p[at] = p[at] + y if r else y
                rows += [(of, ANSWER, b, _NONE, p[np.searchsorted(ids, x)].ravel()) for of, x, _ in parts]
                rows.append((b, DOCS, r, ids, p.ravel()))
                if r:
                    rows.append((b, CHANGE, r, _NONE, np.array([np.abs(_shares(p) - was[b]).sum(1).max()])))
            yield from _table(rows).to_batches()

        return said.repartition(self.blocks, "b").mapInArrow(run, _SAID)

    def _round(self, said: DataFrame, r: int) -> DataFrame:
        k = self.k

        def run(kept, heard):
            left = heard.filter(pa.array(np.isin(heard.column("kind").to_numpy(), (DOCS, CHANGE))))
            if not kept.num_rows:
                return left
            b, kind, of = kept.column("b")[0].as_py(), heard.column("kind").to_numpy(), heard.column("of").to_numpy()
            features, barcodes, ends, first, d, v = (c[0] for c in _lists(kept, *_KEPT))
            y = _lists(heard, "y")[0]
            w = y[int(np.flatnonzero(kind == FEATURES)[0])].reshape(-1, k) / np.maximum(y[int(np.flatnonzero(kind == WHOLE)[0])], 1e-300)
            shares = _shares(np.concatenate([y[i] for i in sorted(np.flatnonzero(kind == ANSWER), key=lambda i: of[i])]).reshape(-1, k))
            f = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(v))))
            z = [w[f, j] * shares[d, j] for j in range(k)]
            scale = v / np.maximum(sum(z), 1e-300)
            z = [scale * c for c in z]
            p, q = np.stack([np.add.reduceat(c, first) for c in z], 1), np.stack([np.bincount(d, c, len(barcodes)) for c in z], 1)
            return pa.concat_tables([left, _table(_parts(b, barcodes, ends, p, q))])

        met = self.layout.groupBy("b").cogroup(said.repartition(self.blocks, "b").groupBy("b")).applyInArrow(run, _SAID)
        return self._answered(met, r + 1)

    def changed(self, r: int) -> float:
        """The largest change of a barcode's shares in round ``r``, from 1 on."""
        while r not in self.change:
            begun, said = TOGETHER * len(self.jobs), self.last
            for i in range(begun, begun + TOGETHER):
                said = self._round(said, i)
            done = settle(said)
            for row in done.where(F.col("kind") == CHANGE).groupBy("of").agg(F.max(F.col("y")[0]).alias("c")).collect():
                self.change[row["of"]] = row["c"]
            self.jobs.append(done)
            self.last = done.where(F.col("kind").isin(FEATURES, ANSWER, WHOLE) | (F.col("kind") == DOCS) & (F.col("of") == begun + TOGETHER))
        return self.change[r]

    def topics(self, r: int) -> DataFrame:
        """(barcode_id, p): sums by topic after round ``r``; the layout is given up."""
        past = self.jobs[(r - 1) // TOGETHER].where((F.col("kind") == DOCS) & (F.col("of") == r)).select("x", "y")
        at = F.transform(F.sequence(F.lit(0), F.size("x") - 1), lambda i: F.struct(F.get("x", i).alias("barcode_id"), F.slice("y", i * self.k + 1, self.k).alias("p")))
        self.layout.unpersist()
        return past.select(F.inline(at))


def _parts(b: int, barcodes: np.ndarray, ends: np.ndarray, p: np.ndarray, q: np.ndarray):
    """What a block sends: (to, kind, of, x, y)."""
    yield b, FEATURES, b, _NONE, p.ravel()
    yield 0, ADDED, b, _NONE, p.sum(0)
    for o, (i, j) in enumerate(zip(ends[:-1], ends[1:])):
        if i < j:
            yield o, PART, b, barcodes[i:j], q[i:j].ravel()
