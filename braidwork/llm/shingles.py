"""Shingles of texts, and exact similarity of sets of them, tile by tile.

Sets that may be alike come in groups.  A group is laid out by the sizes of its sets
and cut into tiles; pairs of tiles whose sizes can be similar are compared, each
counting shared elements exactly, and leave a spanning forest of the links rather than
the links.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import stage

SEED = 42
#: Sets in a tile and bytes of their hashes, at most (one larger set is a tile).
TILE, TILE_BYTES = 1024, 4 << 20
#: Columns of the dense blocks in which shared elements are counted.
COLUMNS = 4096


def shingle_hashes(text: bytes, width: int) -> list[int]:
    """XXH64 of each ``width``-word shingle, repeats included."""
    words = text.lower().split()  # bytes: only A-Z change, only ASCII space splits
    if not words:
        return []
    line, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= width:
        return [digest(line, SEED)]
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes) + np.arange(len(words))
    starts = (ends - sizes)[: len(words) - width + 1].tolist()
    return [digest(line[a:b], SEED) for a, b in zip(starts, ends[width - 1 :].tolist())]


def shingle_set(text: bytes | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles."""
    return np.unique(np.array(shingle_hashes(text or b"", width), np.uint64))


def set_name(h: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(h.tobytes(), SEED)


def forest(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The smallest node of each node's component in a graph of ``n`` nodes."""
    label = np.arange(n)
    while len(u):
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, u, low)
        np.minimum.at(new, v, low)
        np.minimum.at(new, label[u], low)
        np.minimum.at(new, label[v], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def shared_counts(x: list[np.ndarray], y: list[np.ndarray] | None = None) -> np.ndarray:
    """How many elements each set of ``x`` shares with each of ``y`` (None: of ``x``).

    An element is a column; those of one set alone can't count and are left out, and
    the others are multiplied in dense blocks."""
    sets = x if y is None else x + y
    flat = np.concatenate([np.empty(0, np.uint64), *sets])
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.concatenate([np.ones(min(1, len(flat)), bool), flat[1:] != flat[:-1]])
    column = np.cumsum(new) - 1
    keep = np.bincount(column, minlength=1)[column] > 1 if len(flat) else np.empty(0, bool)
    owner, column = owner[keep], np.unique(column[keep], return_inverse=True)[1]
    out = np.zeros((len(x), len(sets) - (0 if y is None else len(x))), np.float32)
    exact = np.zeros(out.shape, np.int64)
    for lo in range(0, int(column.max(initial=-1)) + 1, COLUMNS):
        a, b = np.searchsorted(column, [lo, lo + COLUMNS])
        block = np.zeros((len(sets), COLUMNS), np.float32)
        block[owner[a:b], column[a:b] - lo] = 1
        np.matmul(block[: len(x)], (block if y is None else block[len(x) :]).T, out=out)
        exact += out.astype(np.int64)  # at most COLUMNS in a block: exact as floats
    return exact


def tile_links(a, b, percent: int):
    """(u, v, d_name, d): forest of the links of two tiles (``b`` None: within one), and
    how many rows of other sets each of their sets is linked with here.

    A tile is (names, copies, sets)."""
    names, copies, x = a
    shared = shared_counts(x, None if b is None else b[2])
    nx = np.array([len(s) for s in x])
    ny = nx if b is None else np.array([len(s) for s in b[2]])
    linked = 100 * shared >= percent * (nx[:, None] + ny[None] - shared)
    linked &= shared > 0
    if b is None:
        np.fill_diagonal(linked, False)
        every, degree = names, linked @ copies
        i, j = np.nonzero(np.triu(linked))
    else:
        every = np.concatenate([names, b[0]])
        degree = np.concatenate([linked @ b[1], linked.T @ copies])
        i, j = np.nonzero(linked)
        j = j + len(names)
    label = forest(len(every), i, j)
    far = np.flatnonzero(label != np.arange(len(every)))
    seen = np.flatnonzero(degree)
    return every[far], every[label[far]], every[seen], degree[seen]


_TILE = "root long, first long, low long, high long, names binary, copies binary, sizes binary, hashes binary"
_FOUND = "u long, v long, node long, degree long"


def _links_batch(parts) -> pa.RecordBatch:
    """Edges (u, v) and degrees (node, degree) as rows of one table."""
    u, v, node, degree = (np.concatenate(p) for p in zip(*parts))
    none = lambda n: pa.nulls(n, pa.int64())
    columns = [pa.concat_arrays([pa.array(c.astype(np.int64)), none(len(node))]) for c in (u, v)]
    columns += [pa.concat_arrays([none(len(u)), pa.array(c.astype(np.int64))]) for c in (node, degree)]
    return pa.record_batch(columns, ["u", "v", "node", "degree"])


def tiles_of_groups(members: DataFrame, percent: int) -> DataFrame:
    """Rows of _FOUND and _TILE: groups that lie whole in a task and in a tile are
    compared at once; others leave tiles, in order of the sets' sizes."""
    empty = {"u": None, "v": None, "node": None, "degree": None, "root": None, "first": None, "low": None, "high": None, "names": None, "copies": None, "sizes": None, "hashes": None}
    kinds = {c: pa.binary() if c in ("names", "copies", "sizes", "hashes") else pa.int64() for c in empty}

    def full(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.record_batch([batch.column(c) if c in batch.schema.names else pa.nulls(batch.num_rows, kinds[c]) for c in empty], list(empty))

    def cut(rows):
        """Tiles of (name, copies, hashes) rows, which come in order of size."""
        tile, held = [], 0
        for r in rows:
            if tile and (len(tile) == TILE or held + len(r[2]) > TILE_BYTES):
                yield tile
                tile, held = [], 0
            tile.append(r)
            held += len(r[2])
        if tile:
            yield tile

    def out(root, rows, edge):
        tiles = list(cut(rows))
        if not edge and len(tiles) == 1:
            if len(rows) > 1:
                yield full(_links_batch([tile_links(_tile(*zip(*rows)), None, percent)]))
            return
        for t in tiles:
            names, copies, hashes = zip(*t)
            sizes = np.array([len(h) // 8 for h in hashes], np.int64)
            row = {"root": root, "first": names[0], "low": int(sizes[0]), "high": int(sizes[-1]), "names": np.array(names, np.int64).tobytes(), "copies": np.array(copies, np.int64).tobytes(), "sizes": sizes.tobytes(), "hashes": b"".join(hashes)}
            yield full(pa.record_batch([pa.array([v], kinds[c]) for c, v in row.items()], list(row)))

    def run(batches):
        held, at, edge, size = [], None, True, 0  # a task's first and last group may go on in another task
        for b in batches:
            for root, *row in zip(*(b.column(k).to_pylist() for k in range(4))):
                if held and root != at:
                    yield from out(at, held, edge)
                    held, edge, size = [], False, 0
                at = root
                held.append(row)
                size += len(row[2])
                if size > 8 * TILE_BYTES or len(held) >= 8 * TILE:
                    yield from out(at, held, True)
                    held, edge, size = [], True, 0
        if held:
            yield from out(at, held, True)

    laid = members.repartitionByRange("root", "n", "name").sortWithinPartitions("root", "n", "name")
    return laid.select("root", "name", "copies", "hashes").mapInArrow(run, f"{_FOUND}, {_TILE}")


def _tile(names, copies, hashes):
    return np.array(names, np.int64), np.array(copies, np.int64), [np.frombuffer(h, np.uint64) for h in hashes]


def compared_tiles(tiles: DataFrame, percent: int) -> DataFrame:
    """Rows of _FOUND from all pairs of a group's tiles whose sizes can be similar."""
    side = lambda s: tiles.select("root", *[F.col(c).alias(f"{s}_{c}") for c in ("first", "low", "high", "names", "copies", "sizes", "hashes")])
    pairs = side("a").join(side("b"), "root").where(f"(a_low, a_first) <= (b_low, b_first) and {percent} * b_low <= 100 * a_high")
    same = (F.col("a_first") == F.col("b_first")).alias("same")

    def unpacked(names, copies, sizes, hashes):
        ends = np.cumsum(np.frombuffer(sizes, np.int64))
        return np.frombuffer(names, np.int64), np.frombuffer(copies, np.int64), np.split(np.frombuffer(hashes, np.uint64), ends[:-1])

    def run(batches):
        for b in batches:
            for same, *r in zip(*(c.to_pylist() for c in b.columns)):
                yield _links_batch([tile_links(unpacked(*r[:4]), None if same else unpacked(*r[4:]), percent)])

    # Dealt out by the tiles' names, so a crowded group's pairs go to many tasks.
    tasks = int(tiles.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = pairs.repartition(tasks, "a_first", "b_first")
    return dealt.select(same, *[f"{s}_{c}" for s in "ab" for c in ("names", "copies", "sizes", "hashes")]).mapInArrow(run, _FOUND)


def with_sets(texts: DataFrame, width: int) -> DataFrame:
    """(root, name, n, copies, hashes) of (root, name, copies, text)."""

    def run(batches):
        for b in batches:
            sets = [shingle_set(t, width).tobytes() for t in b.column(3).cast(pa.binary()).to_pylist()]
            sizes = pa.array([len(s) // 8 for s in sets], pa.int64())
            yield pa.record_batch([*b.columns[:2], sizes, b.column(2), pa.array(sets, pa.binary())], ["root", "name", "n", "copies", "hashes"])

    return texts.select("root", "name", "copies", "text").mapInArrow(run, "root long, name long, n long, copies long, hashes binary")


def similar(texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Rows of _FOUND for ``texts`` (root, name, copies, text), one for each set.

    Edges (u, v) connect the names that links of at least ``percent`` similarity connect
    inside a group ``root``; (node, degree) add up to the rows that a set is linked with."""
    found = stage(tiles_of_groups(stage(with_sets(texts, width), "members"), percent), "found")
    done = found.where("root is null").select("u", "v", "node", "degree")
    return stage(done.unionByName(compared_tiles(found.where("root is not null"), percent)), "links")
