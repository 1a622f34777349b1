"""Ranks and running aggregates over a whole table, without a task that sees all rows.

Rows are dealt out by ranges of the order and sorted there; a window inside each
range, and one over the ranges' totals (a row for each), give the same as one window
over everything.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .staged import settle

_FOLD = {"sum": F.sum, "min": F.min, "max": F.max}


def ordered(df: DataFrame, *order) -> DataFrame:
    """``df`` written in order, with its range ``_part`` and its place ``_at`` there."""
    laid = df.repartitionByRange(*order).sortWithinPartitions(*order)
    return settle(laid.withColumn("_id", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_id", 33)).withColumn("_at", F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))).drop("_id"))


def folded(laid: DataFrame, value: Column, out: str, how: str = "sum") -> DataFrame:
    """An ``ordered`` table with ``out``: sum, min or max of ``value`` up to each row."""
    fold = _FOLD[how]
    parts = laid.groupBy("_part").agg(fold(value).alias("_mine"))
    ahead = parts.select("_part", fold("_mine").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)).alias("_ahead"))
    here = fold(value).over(Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0))
    rows = laid.withColumn("_here", here).join(F.broadcast(ahead), "_part")
    both = F.col("_here") + F.coalesce("_ahead", F.lit(0)) if how == "sum" else (F.least if how == "min" else F.greatest)("_here", "_ahead")
    return rows.withColumn(out, both).drop("_here", "_ahead")


def ranked(df: DataFrame, *order, out: str = "rank") -> DataFrame:
    """``df`` with ``out``, the place of each row in the order, from 1."""
    return folded(ordered(df, *order), F.lit(1), out).drop("_part", "_at")
