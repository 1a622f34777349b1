"""Rounds of local moves of a graph's nodes between communities.

Nodes are dealt into blocks by a hash; a block's edges are laid out once and kept by
Spark.  In a round each block chooses for its nodes in numpy, tells the blocks that hold
their neighbours the new labels, and tells the blocks that a community's name falls into
what it adds to that community; those send the sums to whom they concern.  So a round is
two shuffles of labels and sums, none of edges, and several rounds make one job.  A graph
of one block (the levels above the first soon are) needs no messages between its rounds.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staged import settle

#: Rounds of a job, and of one over a single block.
TOGETHER, ALONE = 8, 64
#: Edges of a block, which grow once there are so many blocks, up to the last.
EDGES, BLOCKS, MOST = 1 << 15, 64, 1 << 20
# What a row of a message is: a block's labels, a neighbour's, what is added to communities
# and whom their sums concern, those sums, and what the rounds leave behind: labels, weights
# inside communities, squares of sums.
OWN, NEAR, ADDED, SUMS, PAST, INNER, SQUARES = range(7)

_P = [np.uint64(v) for v in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)]


def _turned(v: np.ndarray, by: int) -> np.ndarray:
    return (v << np.uint64(by)) | (v >> np.uint64(64 - by))


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * _P[1]
    h = (h ^ (h >> np.uint64(29))) * _P[2]
    return h ^ (h >> np.uint64(32))


def hashed(ids: np.ndarray, number: int | None = None) -> np.ndarray:
    """Spark's ``xxhash64`` of longs, or of longs and one int."""
    h = (np.uint64(42 + 8) + _P[4]) ^ (_turned(ids.astype(np.int64).view(np.uint64) * _P[1], 31) * _P[0])
    h = _mixed(_turned(h, 27) * _P[0] + _P[3])
    if number is not None:
        h = h + _P[4] + np.uint64(4)
        h = _mixed(_turned(h ^ (np.full(len(h), number & 0xFFFFFFFF, np.uint64) * _P[0]), 23) * _P[1] + _P[2])
    return h.view(np.int64)


def _lists(t: pa.Table, *names: str) -> list[list[np.ndarray]]:
    """The rows of list columns, as arrays."""
    out = []
    for name in names:
        rows = []
        for c in t.column(name).chunks:
            flat, at = c.values.to_numpy(zero_copy_only=False), c.offsets.to_numpy()
            rows += [flat[i:j] for i, j in zip(at[:-1], at[1:])]
        out.append(rows)
    return out


def _joined(parts: list[np.ndarray], kind) -> np.ndarray:
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def _firsts(*sorted_keys: np.ndarray) -> np.ndarray:
    """Where a run of equal keys begins."""
    new = np.ones(len(sorted_keys[0]), bool)
    if len(new):
        new[1:] = np.any([k[1:] != k[:-1] for k in sorted_keys], axis=0)
    return np.flatnonzero(new)


class Layout:
    """A block: its nodes, their edges, whose labels it hears and who hears its own."""

    LISTS = {"nodes": "long", "source": "int", "target": "int", "w": None, "degree": None, "heard": "int", "hearer": "int", "told": "int"}

    def __init__(self, t: pa.Table):
        self.block = t.column("b")[0].as_py()
        for name, rows in zip(self.LISTS, _lists(t, *self.LISTS)):
            setattr(self, name, rows[0])

    @classmethod
    def of(cls, t: pa.Table, blocks: int) -> dict:
        b, src, dst, w = t.column("b")[0].as_py(), *(t.column(c).to_numpy() for c in ("src", "dst", "w"))
        order = np.argsort(src, kind="stable")
        src, dst, w = src[order], dst[order], w[order]
        first = _firsts(src)
        nodes, degree = src[first], np.add.reduceat(w, first)
        source, place = np.searchsorted(nodes, src), hashed(dst) % blocks
        # Labels are known in this order: the block's own, then those heard, block by block.
        others = np.unique(dst[place != b])
        home = hashed(others) % blocks
        laid = np.lexsort((others, home))
        rank = np.empty(len(laid), np.int64)
        rank[laid] = np.arange(len(laid))
        target = np.where(place == b, np.searchsorted(nodes, dst), 0)
        target[place != b] = len(nodes) + rank[np.searchsorted(others, dst[place != b])]
        told = np.unique(place[place != b] * len(nodes) + source[place != b])
        return {"b": b, "nodes": nodes, "source": source, "target": target, "w": w, "degree": degree, "heard": home[laid], "hearer": told // len(nodes), "told": told % len(nodes)}


def _says(block: Layout, labels: np.ndarray, blocks: int):
    """What a block sends of its labels: (to, kind, of, x, y, z)."""
    yield block.block, OWN, block.block, labels, None, None
    names, whose = [np.unique(labels)], [block.block]
    cuts = np.append(_firsts(block.hearer), len(block.hearer))
    for i, j in zip(cuts[:-1], cuts[1:]):
        mine = labels[block.told[i:j]]
        yield int(block.hearer[i]), NEAR, block.block, mine, None, None
        names.append(np.unique(mine))
        whose.append(int(block.hearer[i]))
    # A community's weight goes to its own block, with the blocks that have to know the sum.
    order = np.argsort(labels, kind="stable")
    first = _firsts(labels[order])
    c, added = labels[order][first], np.add.reduceat(block.degree[order], first)
    c_home = hashed(c) % blocks
    name, who = np.concatenate(names), np.repeat(whose, [len(n) for n in names])
    home = hashed(name) % blocks
    for o in np.unique(home):
        at, asked = c_home == o, home == o
        # names first with what they add, then again, once for each block that asks
        yield int(o), ADDED, block.block, np.concatenate([c[at], name[asked]]), added[at], who[asked]


def _chosen(block: Layout, labels: np.ndarray, known: np.ndarray, names: np.ndarray, tot: np.ndarray, m2: float, r: int) -> np.ndarray:
    """The labels after round ``r``."""
    n, degree = len(labels), block.degree
    own, apart = np.searchsorted(names, labels), block.source != block.target
    key = block.source[apart].astype(np.int64) * len(names) + np.searchsorted(names, known[block.target[apart]])
    order = np.argsort(key, kind="stable")
    first = _firsts(key[order])
    key, links = key[order][first], np.add.reduceat(block.w[apart][order], first) if len(order) else block.w[:0]
    at, to = key // len(names), key % len(names)
    rest = tot[to] - np.where(to == own[at], degree[at], 0)
    gain = np.rint((links - rest * degree[at] / m2) * 1e9) / 1e9
    # Staying counts even where no neighbour shares the community.
    stay = -(tot[own] - degree) * degree / m2
    at, to, gain, same = np.append(at, np.arange(n)), np.append(to, own), np.append(gain, stay), np.append(to == own[at], np.ones(n, bool))
    order = np.lexsort((-names[to], same, gain, at))
    last = np.append(_firsts(at[order])[1:], len(at)) - 1
    free = hashed(block.nodes, r) % 2 == 0
    return np.where(free, names[to[order][last]], labels)


class Rounds:
    """The labels of a ``symmetric`` graph of numbered nodes, round by round; round 0 is each node by itself."""

    def __init__(self, both: DataFrame):
        self.type = both.schema["src"].dataType
        weight = "long" if both.schema["w"].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint") else "double"
        both = both.select(*[F.col(c).cast("long").alias(c) for c in ("src", "dst")], F.col("w").cast(weight).alias("w")).where("src is not null and dst is not null")
        seen = both.agg(F.count("*").alias("n"), F.sum("w").alias("m2")).first()
        self.m2, self.blocks = seen["m2"] or 0, max(1, min(-(-seen["n"] // EDGES), max(BLOCKS, -(-seen["n"] // MOST))))
        self.kept = f"b int, {', '.join(f'{k} array<{t or weight}>' for k, t in Layout.LISTS.items())}"
        self.said = f"b int, kind int, of int, x array<long>, y array<{weight}>, z array<int>"
        self.float = weight == "double"
        self.together = TOGETHER if self.blocks > 1 else ALONE
        self.jobs, self.inner, self.squares = [], {}, {}
        blocks, table, number = self.blocks, self._table, pa.float64() if self.float else pa.int64()

        def lay(t):
            row = Layout.of(t, blocks)
            types = {k: pa.int64() if v == "long" else pa.int32() if v else number for k, v in Layout.LISTS.items()}
            return pa.table({"b": pa.array([row["b"]], pa.int32())} | {k: pa.array([row[k]], pa.list_(v)) for k, v in types.items()})

        dealt = both.withColumn("b", F.pmod(F.xxhash64("src"), F.lit(blocks)).cast("int"))
        self.layout = settle(dealt.repartition(blocks, "b").groupBy("b").applyInArrow(lay, self.kept)).repartition(blocks, "b").persist()

        def begin(batches):
            for batch in batches:
                for k in range(batch.num_rows):
                    block = Layout(pa.Table.from_batches([batch.slice(k, 1)]))
                    yield from table(_says(block, block.nodes, blocks)).to_batches()

        begun = self.layout.mapInArrow(begin, self.said)
        self.last = self._summed(begun, 0) if blocks > 1 else begun.where(F.col("kind") == OWN)

    @property
    def _table(self):
        weight = pa.float64() if self.float else pa.int64()

        def table(rows) -> pa.Table:
            b, kind, of, x, y, z = zip(*rows) if (rows := list(rows)) else [[]] * 6

            def lists(arrays, t):
                full = [np.zeros(0, t.to_pandas_dtype()) if a is None else a for a in arrays]
                ends = np.cumsum([0, *map(len, full)])
                return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, t.to_pandas_dtype()), *full]), t))

            return pa.table({"b": pa.array(b, pa.int32()), "kind": pa.array(kind, pa.int32()), "of": pa.array(of, pa.int32()), "x": lists(x, pa.int64()), "y": lists(y, weight), "z": lists(z, pa.int32())})

        return table

    def _summed(self, said: DataFrame, r: int) -> DataFrame:
        """Messages with the sums of round ``r``'s communities in the place of what was added."""
        table, weight = self._table, np.float64 if self.float else np.int64

        def run(batches):
            asked = {}
            for batch in batches:
                t = pa.Table.from_batches([batch])
                add = t.column("kind").to_numpy() == ADDED
                yield from t.filter(pa.array(~add)).to_batches()
                t = t.filter(pa.array(add))
                for b, x, y, z in zip(t.column("b").to_pylist(), *_lists(t, "x", "y", "z")):
                    asked.setdefault(b, []).append((x, y, z))
            for b, parts in asked.items():
                c, y = np.concatenate([x[: len(y)] for x, y, _ in parts]), np.concatenate([y for _, y, _ in parts])
                order = np.argsort(c, kind="stable")
                first = _firsts(c[order])
                names, tot = c[order][first], np.add.reduceat(y[order], first)
                c, z = np.concatenate([x[len(y) :] for x, y, _ in parts]), np.concatenate([z for _, _, z in parts])
                order = np.lexsort((c, z))
                once = _firsts(z[order], c[order])
                c, z = c[order][once], z[order][once]
                cuts = np.append(_firsts(z), len(z))
                rows = [(b, SQUARES, r, None, np.array([(tot * tot).sum()], weight), None)]
                rows += [(int(z[i]), SUMS, b, c[i:j], tot[np.searchsorted(names, c[i:j])], None) for i, j in zip(cuts[:-1], cuts[1:])]
                yield from table(rows).to_batches()

        return said.repartition(self.blocks, "b").mapInArrow(run, self.said)

    def _round(self, said: DataFrame, r: int) -> DataFrame:
        """The messages after round ``r``; the labels before it are left behind."""
        table, blocks, m2, weight = self._table, self.blocks, float(self.m2 or 1), np.float64 if self.float else np.int64

        def run(kept, heard):
            block, kind = Layout(kept), heard.column("kind").to_numpy()
            x, y = _lists(heard, "x", "y")
            of = heard.column("of").to_numpy()
            labels = x[int(np.flatnonzero(kind == OWN)[0])]
            near = sorted(np.flatnonzero(kind == NEAR), key=lambda k: of[k])
            known = np.concatenate([labels, *(x[k] for k in near)])
            sums = np.flatnonzero(kind == SUMS)
            names, tot = _joined([x[k] for k in sums], np.int64), _joined([y[k] for k in sums], weight)
            order = np.argsort(names, kind="stable")
            names, tot = names[order], tot[order]
            inner = block.w[labels[block.source] == known[block.target]].sum()
            now = _chosen(block, labels, known, names, tot, m2, r)
            rows = [(block.block, PAST, r, labels, None, None), (block.block, INNER, r, None, np.array([inner], weight), None), *_says(block, now, blocks)]
            return pa.concat_tables([heard.filter(pa.array(kind >= PAST)), table(rows)])

        met = self.layout.groupBy("b").cogroup(said.repartition(self.blocks, "b").groupBy("b")).applyInArrow(run, self.said)
        return self._summed(met, r + 1)

    def _alone(self, said: DataFrame, begun: int) -> DataFrame:
        """The rounds of a job over a single block."""
        table, blocks, m2, together, weight = self._table, self.blocks, float(self.m2), self.together, np.float64 if self.float else np.int64

        def run(kept, heard):
            block, labels, rows = Layout(kept), _lists(heard, "x")[0][0], []
            for r in range(begun, begun + together):
                order = np.argsort(labels, kind="stable")
                first = _firsts(labels[order])
                names, tot = labels[order][first], np.add.reduceat(block.degree[order], first)
                inner = block.w[labels[block.source] == labels[block.target]].sum()
                rows += [(0, PAST, r, labels, None, None), (0, INNER, r, None, np.array([inner], weight), None), (0, SQUARES, r, None, np.array([(tot * tot).sum()], weight), None)]
                labels = _chosen(block, labels, labels, names, tot, m2, r)
            return table([*rows, (0, OWN, 0, labels, None, None)])

        return self.layout.groupBy("b").cogroup(said.repartition(blocks, "b").groupBy("b")).applyInArrow(run, self.said)

    def modularity(self, r: int) -> float:
        """Modularity of the labels after ``r`` rounds, which are run if they weren't yet."""
        if not self.m2:
            return 0.0
        while r not in self.inner:
            begun, said = self.together * len(self.jobs), self.last
            if self.blocks == 1:
                said = self._alone(said, begun)
            else:
                for k in range(begun, begun + self.together):
                    said = self._round(said, k)
            done = settle(said)
            for row in done.where(F.col("kind").isin(INNER, SQUARES)).groupBy("kind", "of").agg(F.sum(F.col("y")[0]).alias("s")).collect():
                (self.inner if row["kind"] == INNER else self.squares)[row["of"]] = row["s"]
            self.jobs.append(done)
            self.last = done.where(F.col("kind").isin(OWN, NEAR, SUMS))
        return self.inner[r] / self.m2 - self.squares[r] / float(self.m2) ** 2

    def labels(self, r: int) -> DataFrame:
        """(node, community) after ``r`` rounds; the layout is given up."""
        if not self.m2:
            found = self.layout.select(F.explode("nodes").alias("node"), F.lit(0).alias("community"))
            return found.select(F.col("node").cast(self.type), F.col("node").cast(self.type).alias("community"))
        past = self.jobs[r // self.together].where((F.col("kind") == PAST) & (F.col("of") == r)).select("b", "x")
        pairs = self.layout.select("b", "nodes").join(past, "b").select(F.inline(F.arrays_zip("nodes", "x")).alias("node", "community"))
        found = settle(pairs.select(F.col("node").cast(self.type), F.col("community").cast(self.type)))
        self.layout.unpersist()
        return found
