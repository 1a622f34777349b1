"""SimHash near-duplicate detection by tiled exact comparison.

Each text becomes a 64-bit fingerprint of its word shingles.  Distinct
fingerprints are laid out by the population counts of their segments and cut into
tiles.  Two fingerprints within ``radius`` bits have segment counts that differ by
``radius`` in all at most, so tile pairs further apart are skipped; all others are
compared exactly with exclusive-or and bit counts in numpy.  Links become
components by alternating star contractions.

Scale: only distinct fingerprints (8 bytes each) are shuffled, each tile goes to
its neighbouring cells alone, and a compared tile pair emits a spanning forest
rather than its links, so a group of copies never yields a quadratic output.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shingles import SEED, forest, shingle_hashes, similar
from .staging import stage, unstage

TILE = 2048


def fingerprint(text: bytes | None, width: int = 3) -> int:
    """A bit is 1 if it is set in over half of the hashes; no words: zero."""
    hashes = shingle_hashes(text or b"", width)
    if not hashes:
        return 0
    counts = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 65536):
        some = np.array(hashes[k : k + 65536], np.uint64)
        counts += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def with_fingerprints(docs: DataFrame, id_col: str, text_col: str, width: int = 3) -> DataFrame:
    """(id, fp): the fingerprint as a signed long for every row."""

    def run(batches):
        for b in batches:
            prints = [fingerprint(t, width) for t in b.column(1).cast(pa.binary()).to_pylist()]
            yield pa.record_batch([b.column(0), pa.array(np.array(prints, np.uint64).view(np.int64))], ["id", "fp"])

    some = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return some.mapInArrow(run, "id long, fp long")


def segments_for(distinct: int) -> int:
    """Segments of a fingerprint, so that a cell holds few tiles at any size."""
    return 4 if distinct < 50_000_000 else 8 if distinct < 5_000_000_000 else 16


def cell_of(fp, segments: int, radius: int):
    """The segments' population counts as the digits of one long.

    Digits have room for ``radius`` on both sides, so neighbours never collide."""
    bits, base = 64 // segments, 64 // segments + 2 * radius + 1
    mask = (1 << bits) - 1
    parts = [(F.bit_count(F.shiftrightunsigned(fp, bits * k).bitwiseAND(F.lit(mask))) + radius).cast("long") * base**k for k in range(segments)]
    return sum(parts[1:], parts[0])


def neighbour_steps(segments: int, radius: int) -> list[int]:
    """Cell distances to visit so that each unordered pair of cells meets once."""
    base = 64 // segments + 2 * radius + 1
    steps = {0: 0}  # step -> sum of absolute digit changes
    for k in range(segments):
        steps = {s + d * base**k: w + abs(d) for (s, w), d in product(steps.items(), range(-radius, radius + 1)) if w + abs(d) <= radius}
    return sorted(s for s in steps if s >= 0)


def cut_tiles(prints: DataFrame, segments: int, radius: int) -> DataFrame:
    """(cell, first, fps): up to TILE fingerprints of one cell, in order.

    A range partitioning on (cell, fp) splits a crowded cell over tasks."""

    def run(batches):
        held, at = [], None
        for b in batches:
            cells, fps = b.column(0).to_numpy(), b.column(1).to_numpy()
            edges = np.flatnonzero(np.diff(cells)) + 1
            for lo, hi in zip([0, *edges], [*edges, len(cells)]):
                if lo == hi:
                    continue
                if held and cells[lo] != at:
                    yield from cut(at, held)
                    held = []
                at = cells[lo]
                held.append(fps[lo:hi])
                if sum(map(len, held)) >= 64 * TILE:
                    yield from cut(at, held)
                    held = []
        if held:
            yield from cut(at, held)

    def cut(cell, parts):
        fps = np.concatenate(parts)
        rows = [fps[k : k + TILE] for k in range(0, len(fps), TILE)]
        yield pa.record_batch(
            [pa.array([int(cell)] * len(rows), pa.int64()), pa.array([int(r[0]) for r in rows], pa.int64()), pa.array([r.tobytes() for r in rows], pa.binary())],
            ["cell", "first", "fps"],
        )

    laid = prints.select(cell_of(F.col("fp"), segments, radius).alias("cell"), "fp")
    return laid.repartitionByRange("cell", "fp").sortWithinPartitions("cell", "fp").mapInArrow(run, "cell long, first long, fps binary")


def compare_tiles(nodes, prints, radius: int, other=None) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between two tiles (``other`` None: within one).

    A tile is its nodes and their prints, a row of 64-bit words each; ``other`` is
    the second tile's pair of these."""
    x = prints.view(np.uint64).reshape(len(nodes), -1)
    y, shift = (x, 0) if other is None else (other[1].view(np.uint64).reshape(len(other[0]), -1), len(nodes))
    every = nodes if other is None else np.concatenate([nodes, other[0]])
    label = np.arange(len(every))
    for k in range(0, len(x), 256):
        away = sum(np.bitwise_count(x[k : k + 256, None, w] ^ y[None, :, w]).astype(np.uint16) for w in range(x.shape[1]))
        i, j = np.nonzero(away <= radius)
        i, j = i + k, j + shift
        if other is None:
            i, j = i[i < j], j[i < j]
        if len(i):
            grown = np.flatnonzero(label != np.arange(len(every)))
            label = forest(len(every), np.concatenate([i, grown]), np.concatenate([j, label[grown]]))
    linked = np.flatnonzero(label != np.arange(len(every)))
    return every[linked], every[label[linked]]


def compared(pairs: DataFrame, radius: int) -> DataFrame:
    """(u, v): forests of tile pairs (a_first, b_first, same, a, a_prints, b, b_prints).

    Pairs are dealt out by their names, so a crowded cell's pairs go to many tasks."""

    def run(batches):
        for batch in batches:
            out_u, out_v = [], []
            for same, *tiles in zip(*(c.to_pylist() for c in batch.columns)):
                a, x, b, y = tiles
                a, b = np.frombuffer(a, np.int64), np.frombuffer(b, np.int64)
                u, v = compare_tiles(a, np.frombuffer(x, np.uint64), radius, None if same else (b, np.frombuffer(y, np.uint64)))
                out_u.append(u)
                out_v.append(v)
            if out_u:
                yield pa.record_batch([pa.array(np.concatenate(out_u)), pa.array(np.concatenate(out_v))], ["u", "v"])

    tasks = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = pairs.repartition(tasks, "a_first", "b_first")
    return dealt.select("same", "a", "a_prints", "b", "b_prints").mapInArrow(run, "u long, v long")


def links(prints: DataFrame, radius: int, segments: int) -> DataFrame:
    """(u, v): edges that connect just what pairs within ``radius`` bits connect."""
    tiles = stage(cut_tiles(prints, segments, radius), "tiles")
    steps = F.array(*[F.lit(s) for s in neighbour_steps(segments, radius)])
    left = tiles.select(F.explode(steps).alias("step"), "cell", F.col("first").alias("a_first"), F.col("fps").alias("a")).select((F.col("cell") + F.col("step")).alias("cell"), "step", "a_first", "a")
    right = tiles.select("cell", F.col("first").alias("b_first"), F.col("fps").alias("b"))
    pairs = left.join(right, "cell").where((F.col("step") != 0) | (F.col("a_first") <= F.col("b_first")))
    same = (F.col("step") == 0) & (F.col("a_first") == F.col("b_first"))
    # A print is its own node.
    return compared(pairs.select("a_first", "b_first", same.alias("same"), "a", F.col("a").alias("a_prints"), "b", F.col("b").alias("b_prints")), radius)


def stars(edges: DataFrame) -> DataFrame:
    """(node, root): connected components by alternating large and small stars.

    Runs until a round changes nothing, a number of rounds that grows with the
    logarithm of the longest path.  Every round is written and read again; the one
    before it is removed.  Nodes without an edge don't appear."""
    now = stage(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "edges")
    mark = None
    while True:
        seen = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h")).first()
        if seen == mark or not seen["n"]:
            break
        mark, before = seen, now
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        now = stage(small.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
        unstage(before)
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


#: Keys that hold over one in so many rows are joined by broadcast; there can be no more of them.
HOT = 10_000


def by_key(rows: DataFrame, named: DataFrame, key: str) -> DataFrame:
    """``rows`` joined with ``named`` (``key``, ``n`` rows that have it, more): hot keys
    by broadcast, as at most HOT keys can be hot, all others by shuffle."""
    least = named.agg(F.sum("n")).first()[0] or 0
    hot, cold = named.where(F.col("n") * HOT > least).drop("n"), named.where(F.col("n") * HOT <= least).drop("n")
    return rows.join(F.broadcast(hot), key).unionByName(rows.join(F.broadcast(hot.select(key)), key, "left_anti").join(cold, key))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 2, width: int = 3, segments: int | None = None) -> DataFrame:
    """(doc_id, fp, component_id): one row for each input row.

    ``component_id`` is the smallest id reachable over links of at most ``radius``
    differing bits.  Null and wordless texts have fingerprint zero and link like
    any other.  Equal fingerprints are one node, so exact copies cost nothing
    extra.  Repeated rows stay repeated; a row whose id is null gets the smallest
    id of the others in its component, null if there is none.  An empty table
    gives an empty result.  Other columns are not read.
    """
    rows = stage(with_fingerprints(docs, id_col, text_col, width), "prints")
    nodes = stage(rows.groupBy("fp").agg(F.min("id").alias("least"), F.count("*").alias("n")), "nodes")
    root = stars(links(nodes, radius, segments or segments_for(nodes.count())))
    named = stage(components(nodes, root, "fp", "least"), "named")
    return by_key(rows, named, "fp").select(F.col("id").alias("doc_id"), "fp", F.col("best").alias("component_id"))


def components(nodes: DataFrame, root: DataFrame, key: str, least: str) -> DataFrame:
    """(key, n, best): for every node the smallest ``least`` of its component."""
    known = nodes.join(root, nodes[key] == root["node"], "left").select(key, "n", least, "root")
    alone = known.where("root is null").select(key, "n", F.col(least).alias("best"))
    joint = stage(known.where("root is not null"), "rooted")
    best = joint.groupBy("root").agg(F.min(least).alias("best"))
    return alone.unionByName(joint.join(best, "root").select(key, "n", "best"))


# --- near copies by similarity

#: Words of a wide fingerprint; smallest hashes taken of a text, so many to a cell's name.
WIDE, SMALLEST, NAME = 4, 64, 4
_MIX = np.random.default_rng(SEED).integers(1, 1 << 63, (2, SMALLEST), dtype=np.uint64) | np.uint64(1)


def mixed(h: np.ndarray) -> np.ndarray:
    """A finaliser of 64-bit hashes (multiply and shift, twice)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def radius_for(similarity: float, bits: int = 64 * WIDE) -> int:
    """Differing bits of two texts whose shingle sets have that Jaccard similarity.

    Their expected number and two and a half standard deviations more, so that texts
    that are just so similar are met with a probability of 0.99."""
    p = np.arccos(2 * similarity / (1 + similarity)) / np.pi
    return int(bits * p + 2.5 * np.sqrt(bits * p * (1 - p)))


def wide_print(text: bytes | None, width: int) -> tuple[int, bytes, list[int]]:
    """(name, print, cells) of a text's set of shingles.

    The name is a hash of the set, the print WIDE words of SimHash over it, and the
    cells are hashes of NAME smallest hashes each: texts of Jaccard similarity s share
    a given cell with probability s**NAME."""
    h = np.unique(np.array(shingle_hashes(text or b"", width), np.uint64))
    if not len(h):
        return 0, bytes(8 * WIDE), [0]
    counts, least = np.zeros(64 * WIDE, np.int64), np.full(SMALLEST, (1 << 64) - 1, np.uint64)
    for k in range(0, len(h), 255):  # as many as bytes can count
        some = h[k : k + 255]
        wide = np.stack([mixed(some + np.uint64(w)) for w in range(WIDE)], 1)
        counts += np.unpackbits(wide.view(np.uint8).reshape(len(some), -1), axis=1, bitorder="little").sum(0, dtype=np.uint8)
        # Multiply and add: the order of the products depends on all bits of a hash.
        least = np.minimum(least, (some[:, None] * _MIX[0] + _MIX[1]).min(0))
    cells = [xxhash.xxh64_intdigest(least[k : k + NAME].tobytes(), k) for k in range(0, SMALLEST, NAME)]
    return xxhash.xxh64_intdigest(h.tobytes(), SEED), np.packbits(2 * counts > len(h), bitorder="little").tobytes(), cells


def _signed(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def with_wide_prints(docs: DataFrame, text_col: str, width: int) -> DataFrame:
    """(doc, name, print, bits, cells): ``doc`` holds the row, ``bits`` counts the print's."""
    from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructType

    kind = StructType().add("name", LongType()).add("print", BinaryType()).add("bits", IntegerType()).add("cells", ArrayType(LongType()))

    @F.arrow_udf(kind)
    def run(texts: pa.Array) -> pa.Array:
        found = [wide_print(t, width) for t in texts.cast(pa.binary()).to_pylist()]
        at = np.cumsum([0, *(len(c) for _, _, c in found)])
        cells = pa.ListArray.from_arrays(pa.array(at, pa.int32()), _signed([x for _, _, c in found for x in c]))
        prints = [p for _, p, _ in found]
        bits = np.bitwise_count(np.frombuffer(b"".join(prints), np.uint64)).reshape(-1, WIDE).sum(1).astype(np.int32)
        return pa.StructArray.from_arrays([_signed([n for n, _, _ in found]), pa.array(prints, pa.binary()), pa.array(bits), cells], ["name", "print", "bits", "cells"])

    own = F.struct(*[F.col(c) for c in docs.columns]).alias("doc")
    return docs.select(own, run.asNondeterministic()(F.col(text_col).cast("string")).alias("w")).select("doc", "w.name", "w.print", "w.bits", "w.cells")


def cells_and_tiles(nodes: DataFrame, radius: int) -> DataFrame:
    """(cell, first, low, high, names, prints, u, v) of cells with two nodes or more.

    A cell that lies whole inside a task and fits into a tile is compared at once and
    leaves its forest (u, v); others leave tiles, in order of the bit counts, which
    ``low`` and ``high`` bound."""
    schema = "cell long, first long, low int, high int, names binary, prints binary, u array<long>, v array<long>"

    def row(cell, at, names, prints, low, high, u, v):
        cols = [pa.array([x], t) for x, t in zip((cell, at, low, high, names, prints, u, v), (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())))]
        return pa.record_batch(cols, ["cell", "first", "low", "high", "names", "prints", "u", "v"])

    def out(cell, parts, edge):
        names = np.concatenate([p[0] for p in parts])
        prints, bits = b"".join(b"".join(p[1]) for p in parts), np.concatenate([p[2] for p in parts])
        if not edge and len(names) <= TILE:
            u, v = compare_tiles(names, np.frombuffer(prints, np.uint64), radius)
            if len(u):
                yield row(cell, None, None, None, None, None, u, v)
            return
        for k in range(0, len(names), TILE):
            some = slice(k, k + TILE)
            yield row(cell, int(names[k]), names[some].tobytes(), prints[8 * WIDE * k : 8 * WIDE * (k + TILE)], int(bits[some][0]), int(bits[some][-1]), None, None)

    def run(batches):
        held, at, edge = [], None, True  # a task's first and last cell may go on in another task
        for b in batches:
            cells, bits, names = (b.column(k).to_numpy() for k in (0, 1, 2))
            prints = b.column(3).to_pylist()
            cuts = np.flatnonzero(np.diff(cells)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(cells)]):
                if lo == hi:
                    continue
                if held and cells[lo] != at:
                    if edge or len(held) > 1 or len(held[0][0]) > 1:
                        yield from out(int(at), held, edge)
                    held, edge = [], False
                at = cells[lo]
                held.append((names[lo:hi], prints[lo:hi], bits[lo:hi]))
                if sum(len(h[0]) for h in held) >= 16 * TILE:
                    yield from out(int(at), held, True)
                    held, edge = [], True
        if held:
            yield from out(int(at), held, True)

    laid = nodes.select(F.explode("cells").alias("cell"), "bits", "name", "print")
    return laid.repartitionByRange("cell", "bits", "name").sortWithinPartitions("cell", "bits", "name").mapInArrow(run, schema)


def similar_links(nodes: DataFrame, radius: int) -> DataFrame:
    """(u, v): edges that connect what pairs of one cell within ``radius`` bits connect."""
    found = stage(cells_and_tiles(nodes, radius), "wide-tiles")
    done = found.where("u is not null").select(F.explode(F.arrays_zip("u", "v")).alias("e")).select("e.u", "e.v")
    tiles = found.where("first is not null")
    a, b = (tiles.select("cell", *[F.col(c).alias(f"{side}_{c}") for c in ("first", "low", "high", "names", "prints")]) for side in "ab")
    pairs = a.join(b, "cell").where(f"(a_low, a_first) <= (b_low, b_first) and b_low - a_high <= {radius}")
    same = (F.col("a_first") == F.col("b_first")).alias("same")
    return done.unionByName(compared(pairs.select("a_first", "b_first", same, F.col("a_names").alias("a"), "a_prints", F.col("b_names").alias("b"), "b_prints"), radius))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group of near copies: that of the smallest id.

    Near copies are texts whose sets of ``width``-word shingles have a Jaccard
    similarity of ``percent`` or more, and those that such links connect.  Candidates
    are texts whose wide fingerprints differ by ``radius_for`` bits at most.  A radius
    that wide would make tiles of bit counts meet nearly all others, so tiles are laid
    out by cells of smallest hashes, which such texts share with a probability of
    0.9998, and compared as above.  Inside the groups that candidates form, shared
    shingles are counted exactly, so no text goes that isn't linked.

    Texts with equal sets are one node.  Rows count as rows: ids may repeat or be null
    (null ids stand last, then the order of reading decides).  Texts without words are
    one group.  An empty table gives an empty one.  Columns of ``docs`` may have any names.
    """
    rows = stage(with_wide_prints(docs, text_col, width).withColumn("row", F.monotonically_increasing_id()), "wide-prints")
    place = F.struct(F.col("doc").getField(id_col).isNull().alias("no"), F.col("doc").getField(id_col).alias("id"), "row")
    nodes = stage(rows.groupBy("name").agg(F.min(place).alias("least"), F.first("print").alias("print"), F.first("bits").alias("bits"), F.first("cells").alias("cells"), F.count("*").alias("n")), "wide-nodes")
    group = stars(similar_links(nodes, radius_for(percent / 100)))
    wanted = group.join(nodes, group["node"] == nodes["name"]).select("root", "name", F.col("n").alias("copies"), "least.row")
    texts = rows.select("row", F.col("doc").getField(text_col).cast("string").alias("text")).join(wanted, "row")
    root = stars(similar(texts, width, percent).where("u is not null").select("u", "v"))
    stay = components(nodes.select("name", "n", "least"), root, "name", "least").select(F.col("best.row").alias("row")).distinct()
    return rows.join(stay, "row", "left_semi").select("doc.*")
