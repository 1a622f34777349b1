"""Models on counts: cell calls, reduction, clusters and differential features."""

from __future__ import annotations

import math

import numpy as np
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import stats


def classify_two(counts: DataFrame) -> DataFrame:
    """(barcode, c0, c1, call): a multiplet if both counts reach the tenth percentile of their own cells."""
    cut = counts.agg(F.percentile(F.when(F.col("c0") >= F.col("c1"), F.col("c0")), F.lit(0.1)).alias("t0"), F.percentile(F.when(F.col("c1") > F.col("c0"), F.col("c1")), F.lit(0.1)).alias("t1"))
    call = F.when((F.col("c0") >= F.col("t0")) & (F.col("c1") >= F.col("t1")), "multiplet").when(F.col("c0") >= F.col("c1"), "first").otherwise("second")
    return counts.join(F.broadcast(cut)).select("barcode", "c0", "c1", call.alias("call"))


def cell_calls(counts: DataFrame, odds: float = 20.0) -> DataFrame:
    """(barcode, n, is_cell): a two-component mixture on the histogram of counts.

    Only the histogram, one row for each distinct count, reaches the driver."""
    h = counts.groupBy("n").agg(F.count("*").alias("w")).orderBy("n").toPandas()
    if not len(h):
        return counts.withColumn("is_cell", F.lit(False))
    x, w = h["n"].to_numpy(float), h["w"].to_numpy(float)
    fit = stats.fit_two_nb(x, w, np.average(x, weights=w))
    if fit["mu_signal"] < fit["mu_noise"]:
        fit |= {"mu_noise": fit["mu_signal"], "alpha_noise": fit["alpha_signal"], "mu_signal": fit["mu_noise"], "alpha_signal": fit["alpha_noise"], "signal_share": 1 - fit["signal_share"]}
    share = min(max(fit["signal_share"], 1e-12), 1 - 1e-12)
    ratio = stats.log_nb_pmf(x, fit["mu_signal"], fit["alpha_signal"]) + math.log(share) - stats.log_nb_pmf(x, fit["mu_noise"], fit["alpha_noise"]) - math.log(1 - share)
    good = x[(ratio >= math.log(odds)) & (x >= fit["mu_noise"])]
    cut = float(good.min()) if len(good) else math.inf
    return counts.withColumn("is_cell", F.col("n") >= F.lit(cut))


def kmeans(points: DataFrame, k: int, seed: int = 1) -> DataFrame:
    """(barcode_id, label) with labels by falling cluster size from 1."""
    from .matrix import relabel_by_size

    data = points.select("barcode_id", array_to_vector("score").alias("features"))
    model = KMeans(k=k, seed=seed).fit(data)
    return relabel_by_size(model.transform(data).select("barcode_id", "prediction"), "barcode_id", "prediction")


def differential(m: DataFrame, groups: DataFrame, alpha: float = 1e-4) -> DataFrame:
    """(feature_id, mean_in, mean_out, log2_ratio, z): group against rest, depth as offset.

    A log-link count model with two groups has its fit in the group sums, so sums of
    counts and depths are all that is shuffled."""
    depth = m.groupBy("barcode_id").agg(F.sum("value").alias("depth")).join(groups, "barcode_id")
    sizes = depth.groupBy("in_group").agg(F.sum("depth").alias("d"))
    total = sizes.agg(*[F.sum(F.when(F.col("in_group") == g, F.col("d")).otherwise(0)).alias(n) for g, n in ((True, "d1"), (False, "d0"))])
    s = m.join(groups, "barcode_id").groupBy("feature_id").agg(*[F.sum(F.when(F.col("in_group") == g, F.col("value")).otherwise(0)).alias(n) for g, n in ((True, "y1"), (False, "y0"))])
    j = s.join(F.broadcast(total))
    r1, r0 = (F.col("y1") + 0.5) / F.col("d1"), (F.col("y0") + 0.5) / F.col("d0")
    se = F.sqrt(1 / (F.col("y1") + 0.5) + 1 / (F.col("y0") + 0.5) + 2 * alpha)
    return j.select("feature_id", (F.col("y1") / F.col("d1")).alias("mean_in"), (F.col("y0") / F.col("d0")).alias("mean_out"), F.log2(r1 / r0).alias("log2_ratio"), (F.log(r1 / r0) / se).alias("z"))
