"""A similarity join of shingle sets by PartEnum signatures.

Sets of Jaccard similarity s or more differ in a bounded number of elements, so sets
of one band of sizes are vectors within a known Hamming distance ``k``.  The feature
domain is cut into ``(k + 1) / 2`` parts of three cells each: in one part, at least,
such sets differ in one element at most, so two of its three cells agree.  Each part
gives three signatures, hashes of the set's elements in two of its cells, and sets
that are similar enough share one.

Sets that share a signature are chained, chains become candidate groups, and inside
a group shared elements are counted exactly, tile by tile.  No pair is ever listed: a
signature leaves a chain and a compared pair of tiles a spanning forest.

Scale: only 16 bytes a signature are shuffled, over ranges of (signature, set), so a
frequent one spreads over tasks.  Equal sets are one; texts are read again for sets in
candidate groups alone.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shingles import set_name, shingle_set, similar
from .simhash import HOT, by_key, mixed, stars
from .staging import stage

#: Percent of similarity at which texts are linked; words of a shingle.
PERCENT, WIDTH = 90, 3
#: Cells of a part.  A signature is thin below so many elements, or if it has none where
#: an instance has more than so many cells (long sets, which are few).
CELLS, THIN, SHORT = 3, 4, 512


@lru_cache(8)
def bands(percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(first, last) sizes of bands; similar sets lie in one band or in two neighbours.

    Ends where sizes exceed 2**40."""
    first, last = [1], [100 // percent]
    while last[-1] < 1 << 40:
        first.append(last[-1] + 1)
        last.append(first[-1] * 100 // percent)
    return np.array(first), np.array(last)


def instances(n: int, percent: int) -> list[tuple[int, int]]:
    """[(instance, k)]: runs of three bands, each sharing its last with the next one's
    first, that hold size ``n``.  Similar sets have a run in common, in which they
    differ in ``k`` elements at most."""
    first, last = bands(percent)
    at = int(np.searchsorted(first, n, side="right")) - 1
    runs = [at // 2] if at % 2 or not at else [at // 2 - 1, at // 2]
    # |A xor B| <= (|A| + |B|) (100 - p) / (100 + p)
    return [(j, 2 * int(last[min(2 * j + 2, len(last) - 1)]) * (100 - percent) // (100 + percent)) for j in runs]


def cell_signatures(h: np.ndarray, instance: int, k: int, turn: int) -> tuple[np.ndarray, np.ndarray]:
    """(signatures, elements in them) of the set with hashes ``h`` in one instance."""
    parts = (k + 2) // 2
    place = mixed(h + np.uint64(2 * turn + 1))
    order = np.argsort(place)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(h[order] ^ np.uint64(0x9E3779B97F4A7C15 + turn)), dtype=np.uint64)])
    cells = CELLS * parts
    # Even cells of the 64-bit range: the place of each border among the sorted hashes.
    edges = np.searchsorted(place[order], (np.arange(1, cells, dtype=np.uint64) * np.uint64((1 << 64) // cells)))
    edges = np.concatenate([[0], edges, [len(h)]])
    sums = mixed((total[edges[1:]] - total[edges[:-1]])).reshape(parts, CELLS)
    sizes = np.diff(edges).reshape(parts, CELLS)
    name = np.arange(parts, dtype=np.uint64)[:, None] * np.uint64(CELLS) + np.arange(CELLS, dtype=np.uint64) + np.uint64((instance << 34) + (turn << 33))
    a, b = np.array([0, 0, 1]), np.array([1, 2, 2])
    return mixed(mixed(sums[:, a] + np.uint64(1)) + sums[:, b] ^ mixed(name)).ravel(), (sizes[:, a] + sizes[:, b]).ravel()


def signatures(h: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """All signatures of a set, given by its sorted hashes.

    A thin one, which unlike texts may share by chance, is replaced by its combinations
    with all signatures of a second partition of the domain.  Sets that share it have
    equal elements there, so both replace it, and similar sets share one of these."""
    out = []
    for instance, k in instances(len(h), percent) if len(h) else []:
        if not k:
            continue  # only equal sets
        found, sizes = cell_signatures(h, instance, k, 0)
        thin = sizes < (THIN if len(sizes) <= SHORT else min(THIN, 1))
        out.append(found[~thin])
        if thin.any():
            other = cell_signatures(h, instance, k, 1)[0]
            out.append(mixed(found[thin][:, None] ^ mixed(other)[None]).ravel())
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def _signed(values) -> np.ndarray:
    return np.array(values, np.uint64).view(np.int64)


def _told(text):
    """Two independent hashes that tell a text."""
    return F.xxhash64(text).alias("t1"), F.crc32(text.cast("binary")).alias("t2")


def with_signatures(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int) -> DataFrame:
    """(id, t1, t2, name, n, sigs) for every row: the set's name, its size, its signatures."""

    def run(batches):
        for b in batches:
            names, sizes, sigs, ends = [], [], [], [0]
            for t in b.column(3).cast(pa.binary()).to_pylist():
                h = shingle_set(t, width)
                s = signatures(h, percent)
                names.append(set_name(h))
                sizes.append(len(h))
                sigs.append(s)
                ends.append(ends[-1] + len(s))
            flat = np.concatenate([np.empty(0, np.uint64), *sigs]).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
            yield pa.record_batch([b.column(0), b.column(1), b.column(2), pa.array(_signed(names)), pa.array(sizes, pa.int64()), lists], ["id", "t1", "t2", "name", "n", "sigs"])

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    some = docs.select(F.col(id_col).cast("long").alias("id"), *_told(text), text.alias("text"))
    return some.mapInArrow(run, "id long, t1 long, t2 long, name long, n long, sigs array<long>")


def chains(signed: DataFrame) -> DataFrame:
    """(u, v): edges that connect all names with a signature in common.

    ``signed`` (sig, name) is sorted over ranges; a signature that runs on into other
    tasks leaves its first name there, and these are joined afterwards."""

    def run(batches):
        held, edges, opening = None, [], True  # held: (sig, first name, last name)
        for b in batches:
            sig, name = b.column(0).to_numpy(), b.column(1).to_numpy()
            if not len(sig):
                continue
            start = np.concatenate([[held is None or sig[0] != held[0]], sig[1:] != sig[:-1]])
            at = np.flatnonzero(start)
            first = np.empty(len(sig), np.int64)
            run_of = np.cumsum(start) - 1
            if len(at):
                first[run_of >= 0] = name[at][run_of[run_of >= 0]]
            if held is not None:
                first[run_of < 0] = held[1]
            linked = first != name
            if linked.any():
                pair = np.unique(np.stack([first[linked], name[linked]]), axis=1)
                n = pair.shape[1]
                yield pa.record_batch([pa.array([None] * n, pa.int64()), pa.array(pair[0]), pa.array(pair[1])], ["sig", "u", "v"])
            if opening:
                edges.append((int(sig[0]), int(name[0])))
                opening = False
            held = (sig[-1], first[-1])
        if held is not None:
            edges.append((int(held[0]), int(held[1])))
            yield pa.record_batch([pa.array([e[0] for e in edges], pa.int64()), pa.array([e[1] for e in edges], pa.int64()), pa.array([None] * len(edges), pa.int64())], ["sig", "u", "v"])

    found = stage(signed.repartitionByRange("sig", "name").sortWithinPartitions("sig", "name").mapInArrow(run, "sig long, u long, v long"), "chains")
    ends = found.where("v is null")  # two rows a task at most
    over = ends.join(ends.groupBy("sig").agg(F.min("u").alias("m")), "sig").select("u", F.col("m").alias("v"))
    return found.where("v is not null").select("u", "v").unionByName(over).where("u <> v").distinct()


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links): one row for each input row.

    Two rows are linked where 100 * intersection >= ``percent`` * union of their sets of
    ``width``-word shingles (a text of fewer words is one shingle); a row without words
    has an empty set and is linked with none.  ``component_id`` is the smallest id that
    links lead to, the row's own included; ``n_links`` counts the other rows linked with
    it.  Every pair of sets that is similar enough shares a signature, so no link is
    lost; sets and shingles are told apart by 64-bit hashes.

    Repeated rows count as rows.  A row whose id is null gets the smallest id of the
    others in its component, null if there is none.  An empty table gives none.  Texts
    of any length are taken whole, one at a time.  Other columns are not read.  Below 85
    percent signatures would hold too few elements to tell texts apart.
    """
    if not 85 <= percent < 100:
        raise ValueError("a similarity of 85 to 99 percent is needed")
    rows = stage(with_signatures(docs, id_col, text_col, width, percent), "signed")
    filled = rows.where("n > 0")
    nodes = stage(filled.groupBy("name").agg(F.min("id").alias("least"), F.count("*").alias("copies"), F.first("n").alias("n"), F.min(F.struct("t1", "t2")).alias("t")), "sets")
    total = nodes.agg(F.sum("copies")).first()[0] or 0
    # Of a set that very many rows have, only one keeps its signatures.
    hot = nodes.where(F.col("copies") * HOT > total).where("copies > 1").select("name")
    once = filled.join(F.broadcast(hot), "name").groupBy("name").agg(F.first("sigs").alias("sigs")).select("sigs", "name")
    cold = filled.join(F.broadcast(hot), "name", "left_anti").select("sigs", "name")
    signed = cold.unionByName(once).select(F.explode("sigs").alias("sig"), "name")
    group = stage(stars(chains(signed)), "groups")
    wanted = group.select("root", F.col("node").alias("name")).join(nodes, "name").select("root", "name", "copies", "t.t1", "t.t2")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(*_told(text), text.alias("text")).join(wanted, ["t1", "t2"]).dropDuplicates(["name"])
    links = similar(texts, width, percent)
    root = stars(links.where("u is not null").select("u", "v"))
    degree = links.where("node is not null").groupBy("node").agg(F.sum("degree").alias("degree"))
    known = nodes.join(root, nodes["name"] == root["node"], "left").select("name", "least", "copies", F.coalesce("root", "name").alias("root"))
    best = known.groupBy("root").agg(F.min("least").alias("component_id"))
    named = stage(known.join(best, "root").join(degree, F.col("name") == F.col("node"), "left").select("name", F.col("copies").alias("n"), "component_id", (F.coalesce("degree", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "named")
    alone = rows.where("n = 0").select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("id").alias("component_id"), F.lit(0).cast("long").alias("n_links"))
    told = by_key(filled.select("name", "id", F.col("n").alias("n_shingles")), named, "name")
    return told.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "n_links").unionByName(alone)
