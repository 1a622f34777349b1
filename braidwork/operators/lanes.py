"""Copies that lie close together on a sequencing lane.

Reads of one duplicate group meet through a grid whose cells are so small that all
reads of a cell are near each other.  In a cell every read but the first is near an
earlier one; only first reads look into the cells around, so no pairs are listed.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staged import settle

#: Distances of optical copies and of those by diffusion, and the largest share of a
#: lane that the circle of the latter may cover.
OPTICAL, DIFFUSION, MOST_COVERED = 100.0, 25e3, 0.025
#: Fixed form of a read's name: machine, run, flowcell, lane, surface swath tile, x, y.
NAME = r"^[a-zA-Z0-9\-]+:[a-z0-9\-]+:([a-zA-Z0-9\-]+):([0-9]):([0-9])([0-9])([0-9]+):([0-9]+):([0-9]+)$"


def positions(reads: DataFrame, name: str = "qname") -> DataFrame:
    """``reads`` with flowcell, lane, surface, swath, tile, x and y from their names;
    names of another form leave nulls."""
    part = lambda k: F.nullif(F.regexp_extract(name, NAME, k), F.lit(""))
    text = {"flowcell": part(1), "lane": part(2)}
    return reads.withColumns(text | {c: part(k).cast("long") for k, c in enumerate(("surface", "swath", "tile", "x", "y"), 3)})


def layouts(placed: DataFrame) -> DataFrame:
    """(flowcell, lane, width, height, swaths, tiles): the extents that all reads show."""
    return placed.where("flowcell is not null").groupBy("flowcell", "lane").agg(F.max("x").alias("width"), F.max("y").alias("height"), F.max("swath").alias("swaths"), F.max("tile").alias("tiles"))


def on_lane(placed: DataFrame, extents: DataFrame) -> DataFrame:
    """``placed`` with lane_x, lane_y, and ``wide``: whether the lane is large enough to
    tell copies by diffusion from chance."""
    area = F.col("width") * F.col("height") * F.col("swaths") * F.col("tiles")
    wide = F.coalesce(F.try_divide(F.lit(math.pi * DIFFUSION**2), area.cast("double")) < MOST_COVERED, F.lit(False))
    joined = placed.where("flowcell is not null").join(F.broadcast(extents), ["flowcell", "lane"])  # a row for each lane
    at = {"lane_x": (F.col("swath") - 1) * F.col("width") + F.col("x"), "lane_y": (F.col("tile") - 1) * F.col("height") + F.col("y"), "wide": wide}
    return joined.withColumns(at).drop("width", "height", "swaths", "tiles")


def _laid(reads: DataFrame, x: str, y: str, radius: float) -> DataFrame:
    """``reads`` with their cell; a cell's diagonal is under the radius."""
    side = radius / math.sqrt(2) * (1 - 1e-9)
    return reads.withColumns({"_i": F.floor(F.col(x) / side), "_j": F.floor(F.col(y) / side)})


def _near_firsts(laid: DataFrame, by: list[str], x: str, y: str, order: str, radius: float) -> DataFrame:
    """(by, _i, _j) of cells whose first read lies near an earlier one of a cell around.

    One first read of a cell looks into 24 cells; it stops at the first that it finds, and
    reads at one place count once, so nothing grows faster than the reads."""
    first = laid.groupBy(*by, "_i", "_j").agg(F.min(F.struct(F.col(order).alias("o"), F.col(x).alias("x"), F.col(y).alias("y"))).alias("_f"))
    around = [(i, j) for i in range(-2, 3) for j in range(-2, 3) if (i, j) != (0, 0)]
    steps = F.explode(F.array(*[F.struct(F.lit(i).cast("long").alias("i"), F.lit(j).cast("long").alias("j")) for i, j in around])).alias("_s")
    looks = first.select(*by, "_i", "_j", "_f", steps).withColumns({"_at_i": F.col("_i") + F.col("_s.i"), "_at_j": F.col("_j") + F.col("_s.j")})
    places = laid.groupBy(*[F.col(c).alias(f"_by{k}") for k, c in enumerate(by)], F.col("_i").alias("_pi"), F.col("_j").alias("_pj"), F.col(x).alias("_x"), F.col(y).alias("_y")).agg(F.min(order).alias("_o"))
    away = F.pow(F.col("_f.x") - F.col("_x"), F.lit(2)) + F.pow(F.col("_f.y") - F.col("_y"), F.lit(2))
    met = (F.col("_at_i") == F.col("_pi")) & (F.col("_at_j") == F.col("_pj")) & (F.col("_o") < F.col("_f.o")) & (away < radius**2)
    for k, c in enumerate(by):
        met = met & (F.col(c) == F.col(f"_by{k}"))
    return looks.join(places, met, "left_semi").select(*by, "_i", "_j").distinct()


def near_earlier(reads: DataFrame, by: list[str], x: str, y: str, order: str, radius: float) -> DataFrame:
    """Rows that have one before them, in ``order``, less than ``radius`` away inside their
    ``by`` group.  ``order`` tells the rows of a group apart; equal rows count as one."""
    laid, cell = _laid(reads, x, y, radius), [*by, "_i", "_j"]
    told = laid.join(laid.groupBy(*cell).agg(F.min(order).alias("_least")), cell)
    near = _near_firsts(laid, by, x, y, order, radius).withColumn("_near", F.lit(True))
    return told.join(near, cell, "left").where((F.col(order) > F.col("_least")) | F.col("_near")).drop("_i", "_j", "_least", "_near")


def count_near(reads: DataFrame, by: list[str], x: str, y: str, order: str, radius: float, n: str) -> DataFrame:
    """(by, near): the sum of ``n`` over the rows that ``near_earlier`` gives, from sums by cell."""
    laid, cell = _laid(reads, x, y, radius), [*by, "_i", "_j"]
    per = laid.groupBy(*cell).agg(F.sum(n).alias("_all"), F.min_by(n, order).alias("_first"))
    near = _near_firsts(laid, by, x, y, order, radius).withColumn("_near", F.lit(True))
    found = F.col("_all") - F.when(F.col("_near"), F.lit(0)).otherwise(F.col("_first"))
    return per.join(near, cell, "left").groupBy(*by).agg(F.sum(found).alias("near")).where("near > 0")


def lane_copies(reads: DataFrame, group: list[str], name: str = "qname", optical: float = OPTICAL, diffusion: float = DIFFUSION) -> DataFrame:
    """(group, copies, optical, diffusion): reads of each duplicate group, and how many of
    them lie near an earlier one of their lane.

    Reads whose names tell no place count as copies alone; lanes too small for copies by
    diffusion have none.  Reads of one name and group lie at one place, so they are counted
    first and written once."""
    counted = settle(reads.groupBy(*group, name).agg(F.count("*").alias("_n")))
    placed = positions(counted, name)
    at = on_lane(placed, layouts(placed))
    by = [*group, "flowcell", "lane"]
    near = lambda rows, radius, out: count_near(rows, by, "lane_x", "lane_y", name, radius, "_n").groupBy(*group).agg(F.sum("near").alias(out))
    close, far = near(at, optical, "optical"), near(at.where("wide"), diffusion, "diffusion")
    n = counted.groupBy(*group).agg(F.sum("_n").alias("copies"))
    return n.join(close, group, "left").join(far, group, "left").fillna(0, ["optical", "diffusion"])
