"""Summaries that can be merged: distributions as (value, count) rows, and figures of them.

Every function takes counts rather than values, so parts of a data set are counted
where they are, added, and summed up from what is left: distinct values.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def distribution(df: DataFrame, value: str, *by: str, n: Column | None = None) -> DataFrame:
    """(by, value, n): how often each value occurs."""
    return df.groupBy(*by, F.col(value).alias("value")).agg((F.sum(n) if n is not None else F.count("*")).alias("n"))


def merged(parts: list[DataFrame], *by: str) -> DataFrame:
    """Distributions (or any keyed counts) of several parts added up."""
    rows = reduce(DataFrame.unionByName, parts)
    return rows.groupBy(*by, *[c for c in rows.columns if c not in by and c != "n"]).agg(F.sum("n").alias("n"))


def nested_add(parts: list[DataFrame], keys: list[str], value: str) -> DataFrame:
    """Values of equal key paths added, as adding nested dictionaries does."""
    return reduce(DataFrame.unionByName, parts).groupBy(*keys).agg(F.sum(value).alias(value))


def ecdf(counts: DataFrame, *by: str) -> DataFrame:
    """``counts`` with ``share``: of all, those at most as large.  The window holds distinct
    values of a group; without groups, ranges of them."""
    if not by:
        from ..operators.ranks import folded, ordered

        upto = folded(ordered(counts, F.col("value")), F.col("n"), "_to").drop("_part", "_at")
        return upto.join(F.broadcast(counts.agg(F.sum("n").alias("_all")))).withColumn("share", F.col("_to") / F.col("_all")).drop("_to", "_all")
    over = Window.partitionBy(*by)
    return counts.withColumn("share", F.sum("n").over(over.orderBy("value").rowsBetween(Window.unboundedPreceding, 0)) / F.sum("n").over(over))


def percentile(counts: DataFrame, p: float | list[float], *by: str) -> DataFrame:
    """(by, percentile): with linear interpolation between the neighbouring values; null if empty."""
    at = F.array(*[F.lit(x) for x in p]) if isinstance(p, list) else F.lit(p)
    return counts.groupBy(*by).agg(F.percentile("value", at, F.col("n")).alias("percentile"))


def spread(counts: DataFrame, *by: str) -> DataFrame:
    """(by, median, iqr) of (value, n)."""
    q = percentile(counts, [0.25, 0.5, 0.75], *by)
    return q.select(*by, F.get("percentile", F.lit(1)).alias("median"), (F.get("percentile", F.lit(2)) - F.get("percentile", F.lit(0))).alias("iqr"))


def index_spread(counts: DataFrame, left: float = 0.25, right: float = 0.25) -> DataFrame:
    """(low, high, width): values at the places n * left and n - 1 - n * right of the sorted values."""
    from ..operators.ranks import folded, ordered

    total = counts.agg(F.sum("n").alias("_all"))
    # equal values in several rows are one step
    steps = counts.groupBy("value").agg(F.sum("n").alias("n"))
    at = folded(ordered(steps, F.col("value")), F.col("n"), "_to").join(F.broadcast(total))
    low, high = F.floor(F.col("_all") * left), F.col("_all") - 1 - F.floor(F.col("_all") * right)
    inside = lambda k: F.min(F.when((F.col("_to") > k), F.col("value")))
    return at.agg(inside(low).alias("low"), inside(high).alias("high")).withColumn("width", F.col("high") - F.col("low"))


def count_distinct_keys(counts: DataFrame, key: str, value: str) -> DataFrame:
    """(distinct): keys whose values, added over all parts, aren't zero."""
    return counts.groupBy(key).agg(F.sum(value).alias("_n")).where("_n <> 0").agg(F.count("*").alias("distinct"))


def top(counts: DataFrame, key: str, k: int) -> DataFrame:
    """The ``k`` keys of largest ``n``, the smaller key first among equals."""
    return counts.orderBy(F.desc("n"), key).limit(k)


def bin_of(value: Column, cutoffs: list[float]) -> Column:
    """The largest cutoff that is at most ``value``; null below all."""
    return F.array_max(F.filter(F.array(*[F.lit(c) for c in cutoffs]), lambda c: c <= value))


def binned(df: DataFrame, value: str, cutoffs: list[float], *figures: Column) -> DataFrame:
    """(bin, figures): any aggregate per bin of cutoffs."""
    return df.groupBy(bin_of(F.col(value), cutoffs).alias("bin")).agg(*figures)


def summary(df: DataFrame, figures: dict[str, Column], *by: str) -> DataFrame:
    """A named set of aggregates in one pass."""
    return df.groupBy(*by).agg(*[c.alias(n) for n, c in figures.items()])


def log_sum_exp(df: DataFrame, x: str, *by: str) -> DataFrame:
    """(by, log_sum): the log of the sum of exponentials, shifted by the largest."""
    top = df.groupBy(*by).agg(F.max(x).alias("_top"))
    near = df.join(F.broadcast(top)) if not by else df.join(top, list(by))
    return near.groupBy(*by, "_top").agg((F.first("_top") + F.log(F.sum(F.exp(F.col(x) - F.col("_top"))))).alias("log_sum")).drop("_top")


def log_one_minus(log_p: Column) -> Column:
    """log(1 - p) of log p, exact for small p."""
    return F.when(log_p > -0.6931471805599453, F.log(-F.expm1(log_p))).otherwise(F.log1p(-F.exp(log_p)))


def error_of(quality: Column) -> Column:
    """The chance of an error of a Phred quality."""
    return F.pow(F.lit(10.0), -quality / 10)


def quality_of(p_correct: Column) -> Column:
    """The Phred quality of the chance that a base is right; null at 1."""
    return -10 * F.log10(F.nullif(1 - p_correct, F.lit(0.0)))


def deviation_from_iqr(iqr: Column) -> Column:
    """The standard deviation of a normal distribution of that interquartile range."""
    return iqr / 1.3489795003921634
