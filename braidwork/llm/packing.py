"""Packing documents into fixed-length token sequences in bounded space.

Each partition keeps a fixed number of open windows, puts every piece into the one
it fits best, and closes the fullest when it fits into none.  Windows still open at
the end of the partitions are packed again, ever fewer partitions at a time, by
their sizes alone.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .fastbpe import encoder
from .staging import stage

END = 2
WINDOW, OPEN = 4096, 64
#: So many partitions' leftovers meet in one task of the next round.
FAN_IN = 16
#: Broadcast the leftover windows' places (a few numbers each) up to so many.
MOST_BROADCAST = 500_000


class OpenWindows:
    """Up to ``most`` windows of ``room`` tokens; best fit, else the fullest closes."""

    def __init__(self, room: int, most: int):
        self.room, self.most = room, most
        self.free: list[tuple[int, int]] = []  # (free tokens, window), ascending
        self.made = 0
        self.closed: list[int] = []

    def place(self, size: int) -> tuple[int, int]:
        """(window, offset) of a piece of at most ``room`` tokens."""
        at = bisect_left(self.free, (size, -1))
        if at < len(self.free):
            left, window = self.free.pop(at)
        else:
            if len(self.free) >= self.most:
                self.closed.append(self.free.pop(0)[1])
            left, window = self.room, self.made
            self.made += 1
        if left > size:
            insort(self.free, (left - size, window))
        else:
            self.closed.append(window)
        return window, self.room - left


def _pieces(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, lower: bool, window: int, most: int) -> DataFrame:
    """Every piece with its ids and its window in its partition; window -1 of a
    piece row with null ids lists no piece but a window left open and its fill."""
    schema = "part long, window long, at int, doc_id long, start long, ids binary, doc_tokens long, open int"

    def run(batches):
        from pyspark import TaskContext

        part, windows = TaskContext.get().partitionId(), OpenWindows(window, most)
        enc = encoder(tokenizer, lower)
        for b in batches:
            rows = []
            for doc, raw in zip(b.column(0).to_pylist(), enc.each(b.column(1).to_pylist())):
                ids = raw + END.to_bytes(4, "little")
                n = len(ids) // 4
                for k in range(0, n, window):
                    size = min(window, n - k)
                    w, at = windows.place(size)
                    rows.append((part, w, at, doc, k, ids[4 * k : 4 * (k + size)], n, None))
                if len(rows) >= 512:
                    yield batch(rows)
                    rows = []
            if rows:
                yield batch(rows)
        yield batch([(part, w, window - left, None, None, None, None, 1) for left, w in windows.free])

    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int32()]
    names = ["part", "window", "at", "doc_id", "start", "ids", "doc_tokens", "open"]

    def batch(rows):
        cols = list(zip(*rows)) if rows else [[] for _ in types]
        return pa.record_batch([pa.array(c, t) for c, t in zip(cols, types)], names)

    some = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return some.mapInArrow(run, schema)


def _merged(left: DataFrame, window: int, most: int, groups: int) -> DataFrame:
    """Leftover windows (part, window, fill) placed into new ones, ``groups`` tasks."""
    schema = "part long, window long, fill int, to_part long, to_window long, shift int, open int"

    def run(pdfs):
        from pyspark import TaskContext

        part, windows, seen = TaskContext.get().partitionId(), OpenWindows(window, most), []
        for pdf in pdfs:
            # Large first fits best; what a task holds is bounded by its share of the windows.
            for row in pdf.sort_values(["fill", "part", "window"], ascending=[False, True, True]).itertuples(index=False):
                w, at = windows.place(int(row.fill))
                seen.append((row.part, row.window, row.fill, part, w, at))
        import pandas as pd

        still = {w for _, w in windows.free}
        out = pd.DataFrame(seen, columns=["part", "window", "fill", "to_part", "to_window", "shift"])
        out["open"] = [int(w in still) for w in out["to_window"]]
        yield out

    return left.repartition(groups, F.pmod("part", F.lit(groups))).mapInPandas(run, schema)


def pack(docs: DataFrame, tokenizer: str, lower: bool = True, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, most_open: int = OPEN) -> DataFrame:
    """(doc_id, start, length, ids, doc_tokens, sequence_id, offset): a row per piece.

    ``ids`` holds the piece's ids as little-endian unsigned 32-bit integers.  Each
    text is encoded whole and ends with the end id; only documents of over ``window``
    tokens are cut, into full windows and a rest.  A null or empty text is the end
    id alone.  Repeated rows, and rows with a null id, are documents of their own.
    Offsets of a sequence run without gaps from 0.  Other columns are not read.
    """
    rows = stage(_pieces(docs, id_col, text_col, tokenizer, lower, window, most_open), "pieces")
    pieces = rows.where("open is null").drop("open")
    left = rows.where("open = 1").select("part", "window", F.col("at").alias("fill"))
    parts = (left.agg(F.max("part").alias("m")).first()["m"] or 0) + 1
    # origin: where a first-round window has got to so far
    origin = stage(left.select("part", "window", "fill", F.lit(0).cast("long").alias("round"), F.col("part").alias("in_part"), F.col("window").alias("in_window"), F.lit(0).alias("shift")), "origin")
    live, number = left, 0
    while parts > 1 or number == 0:
        parts = -(-parts // FAN_IN)
        number += 1
        moved = stage(_merged(live, window, most_open, parts), "merged")
        step = moved.select(F.col("part").alias("in_part"), F.col("window").alias("in_window"), "to_part", "to_window", F.col("shift").alias("more"))
        there = F.col("to_part").isNotNull()
        origin = stage(
            origin.join(step.withColumn("round", F.lit(number - 1).cast("long")), ["round", "in_part", "in_window"], "left").select(
                "part", "window", "fill", F.when(there, F.lit(number).cast("long")).otherwise(F.col("round")).alias("round"), F.coalesce("to_part", "in_part").alias("in_part"), F.coalesce("to_window", "in_window").alias("in_window"), (F.col("shift") + F.coalesce("more", F.lit(0))).cast("int").alias("shift")
            ),
            "origin",
        )
        live = moved.where("open = 1").groupBy(F.col("to_part").alias("part"), F.col("to_window").alias("window")).agg(F.max(F.col("shift") + F.col("fill")).cast("int").alias("fill"))
    where = origin.select("part", "window", "round", "in_part", "in_window", "shift")
    # At most most_open rows for each partition: broadcast while they are few.
    few = where.count() <= MOST_BROADCAST
    placed = pieces.join(F.broadcast(where) if few else where, ["part", "window"], "left")
    name = F.coalesce("round", F.lit(0)) * (1 << 56) + F.coalesce("in_part", "part") * (1 << 32) + F.coalesce("in_window", "window")
    return placed.select("doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("length"), "ids", "doc_tokens", name.alias("sequence_id"), (F.col("at") + F.coalesce("shift", F.lit(0))).cast("long").alias("offset"))


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids, n_tokens): the packed sequences themselves, pieces in order."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(F.aggregate(ordered, F.lit(b""), lambda acc, p: F.concat(acc, p["ids"])).alias("ids")).withColumn("n_tokens", F.octet_length("ids") / 4)
