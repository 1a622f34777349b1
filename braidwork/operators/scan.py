"""Running aggregates over a long ordered axis without one task per key.

A plain window over a contig puts all its rows into one task.  Here positions are cut
into bins: windows run inside a bin, and a second, small window over the bins carries
what lies before each.  A hot contig so spreads over as many tasks as it has bins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .staged import settle

WIDTH = 1 << 16


def _both(how: str, a: Column, b: Column) -> Column:
    if how == "sum":
        return F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))
    return F.greatest(a, b) if how == "max" else F.least(a, b)


def running(df: DataFrame, key: list[str], pos: str, value: Column, out: str, how: str = "max", before: bool = False, then: list | None = None, down: bool = False, width: int = WIDTH) -> DataFrame:
    """``df`` with ``out``: sum, max or min of ``value`` over the rows up to each one.

    The rows are written once, as both windows read them.  They are ordered by ``pos`` (descending if ``down``), ties by ``then``; ``before``
    leaves the row itself out.  Null values don't count; where nothing came before,
    sums are 0 and others null.
    """
    fold = {"sum": F.sum, "max": F.max, "min": F.min}[how]
    turn = (lambda c: F.col(c).desc()) if down else F.col
    binned = settle(df.withColumn("_v", value).withColumn("_bin", F.floor(F.col(pos) / width)))
    local = Window.partitionBy(*key, "_bin").orderBy(turn(pos), *(then or [])).rowsBetween(Window.unboundedPreceding, -1 if before else 0)
    bins = binned.groupBy(*key, "_bin").agg(fold("_v").alias("_b"))
    ahead = bins.withColumn("_b", fold("_b").over(Window.partitionBy(*key).orderBy(turn("_bin")).rowsBetween(Window.unboundedPreceding, -1)))
    same = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in [*key, "_bin"]]
    rows = binned.withColumn("_l", fold("_v").over(local)).alias("l").join(ahead.alias("r"), same, "left")
    return rows.select(*[F.col(f"l.{c}") for c in df.columns], _both(how, F.col("l._l"), F.col("r._b")).alias(out))


def following(df: DataFrame, key: list[str], pos: str, out: str, width: int = WIDTH) -> DataFrame:
    """``df`` with ``out``, the next larger row's ``pos`` (null at the end of a key)."""
    return running(df, key, pos, F.col(pos), out, "min", before=True, down=True, width=width)
