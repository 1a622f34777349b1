"""Run metrics: one aggregation for many figures, a registry of targets, and libraries put together."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: What a registry may ask of a value.
RULES = ("lt", "gt", "range", "exists", "is_true", "is_false", "is_equal", "is_not_equal")


def long(row: DataFrame) -> DataFrame:
    """(key, value) of a one-row table of numbers; what isn't a number is null."""
    pairs = F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).cast("double").alias("value")) for c in row.columns])
    return row.select(F.explode(pairs).alias("p")).select("p.key", F.when(~F.isnan("p.value"), F.col("p.value")).alias("value"))


def judged(values: DataFrame, registry: DataFrame) -> DataFrame:
    """(key, value, status) against (key, rule, acceptable, targeted): pass, warn or error; null without a target or a value.

    With ``lt`` small is good, with ``gt`` large; a range is good between its bounds;
    the other rules look at whether there is a value, or at the value itself."""
    v, a, t = F.col("value"), F.col("acceptable"), F.col("targeted")
    graded = lambda good, fair: F.when(good, "pass").when(fair, "warn").otherwise("error")
    status = (
        F.when(F.col("rule") == "exists", F.when(v.isNotNull(), "pass").otherwise("error"))
        .when(v.isNull() | t.isNull() & F.col("rule").isin("lt", "gt", "range", "is_equal", "is_not_equal"), None)
        .when(F.col("rule") == "lt", graded(v <= t, v <= a))
        .when(F.col("rule") == "gt", graded(v >= t, v >= a))
        .when(F.col("rule") == "range", graded(v.between(F.least(a, t), F.greatest(a, t)), F.lit(False)))
        .when(F.col("rule") == "is_true", graded(v != 0, F.lit(False)))
        .when(F.col("rule") == "is_false", graded(v == 0, F.lit(False)))
        .when(F.col("rule") == "is_equal", graded(v == t, F.lit(False)))
        .when(F.col("rule") == "is_not_equal", graded(v != t, F.lit(False)))
    )
    return values.join(registry, "key").select("key", "value", status.alias("status"))


def last_wins(parts: list[DataFrame]) -> DataFrame:
    """(key, value) of several metric tables; a later one replaces an earlier."""
    out = None
    for k, p in enumerate(parts):
        rows = p.select("key", "value", F.lit(k).alias("_k"))
        out = rows if out is None else out.unionByName(rows)
    return out.groupBy("key").agg(F.max_by("value", "_k").alias("value"))


def library_depth(fragments: DataFrame, cells: DataFrame, kind: str) -> DataFrame:
    """(library, depth, rate): median fragments of a cell, and the share that brings each library to the least."""
    per = fragments.join(cells, ["library", "barcode"], "left_semi").groupBy("library", "barcode").agg((F.count("*") if kind == "unique" else F.sum("dup")).alias("n"))
    med = per.groupBy("library").agg(F.percentile("n", F.lit(0.5)).alias("depth"))
    least = med.agg(F.min("depth").alias("least"))
    return med.join(F.broadcast(least)).select("library", "depth", F.try_divide("least", "depth").alias("rate"))


def combined(fragments: DataFrame, rates: DataFrame, kind: str | None = None, seed: int = 0) -> DataFrame:
    """Libraries as one table: thinned to their rates, barcodes suffixed by library.

    ``unique`` keeps each fragment by a draw; ``total`` draws for every copy and keeps
    the fragments with copies left.  Draws are hashes of the row and the seed, so a
    repeated run, or a repeated task, gives the same rows."""
    j = fragments.join(F.broadcast(rates), "library") if kind else fragments.withColumn("rate", F.lit(1.0))
    draw = lambda *more: (F.pmod(F.xxhash64(F.lit(seed), "library", "contig", "start", "stop", "barcode", *more), F.lit(1 << 40)) / float(1 << 40))
    if kind == "total":
        copies = F.size(F.filter(F.sequence(F.lit(1), F.col("dup").cast("int")), lambda c: draw(c) < F.col("rate")))
        j = j.withColumn("dup", copies.cast(fragments.schema["dup"].dataType)).where("dup > 0")
    elif kind == "unique":
        j = j.where(draw() < F.col("rate"))
    name = F.concat(F.split_part("barcode", F.lit("-"), F.lit(1)), F.lit("-"), F.col("library").cast("string"))
    return j.select("contig", "start", "stop", name.alias("barcode"), "dup")
