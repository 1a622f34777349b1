"""Sparse count matrices as (feature_id, barcode_id, value) rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def select(m: DataFrame, ids: DataFrame, axis: str) -> DataFrame:
    """Entries whose ``axis`` id is listed."""
    return m.join(ids.select(axis).distinct(), axis, "left_semi")


def above_threshold(m: DataFrame, threshold: float = 0) -> DataFrame:
    """Barcodes whose sum exceeds the threshold, then features of what is left."""
    b = m.groupBy("barcode_id").agg(F.sum("value").alias("s")).where(F.col("s") > threshold)
    m = select(m, b, "barcode_id")
    f = m.groupBy("feature_id").agg(F.sum("value").alias("s")).where(F.col("s") > threshold)
    return select(m, f, "feature_id")


def axis_summary(m: DataFrame, axis: str) -> DataFrame:
    """(axis, total, nonzero)."""
    return m.groupBy(axis).agg(F.sum("value").alias("total"), F.count_if(F.col("value") > 0).alias("nonzero"))


def moments(m: DataFrame, axis: str, n: int) -> DataFrame:
    """(axis, mean, var) over ``n`` cells, zeros that have no row included."""
    mean = F.sum("value") / n
    return m.groupBy(axis).agg(mean.alias("mean"), (F.sum(F.col("value") * F.col("value")) / n - mean * mean).alias("var"))


def top_with_ties(m: DataFrame, n: int) -> DataFrame:
    """Barcodes whose sum is at least the n-th largest.

    The cut is the n-th of the sorted sums, found with a top-n sort, not a global window."""
    sums = m.groupBy("barcode_id").agg(F.sum("value").alias("total"))
    cut = sums.orderBy(F.desc("total")).limit(n).agg(F.min("total").alias("cut"))
    return sums.join(F.broadcast(cut), F.col("total") >= F.col("cut")).drop("cut")


def merge_add(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).groupBy("feature_id", "barcode_id").agg(F.sum("value").alias("value"))


def depth_normalise(m: DataFrame) -> DataFrame:
    """Columns scaled to the median column sum, which is at least 1."""
    sums = m.groupBy("barcode_id").agg(F.sum("value").alias("s"))
    median = sums.agg(F.greatest(F.percentile("s", F.lit(0.5)), F.lit(1.0)).alias("med"))
    scaled = sums.join(F.broadcast(median)).select("barcode_id", (F.col("med") / F.col("s")).alias("k"))
    return m.join(scaled, "barcode_id").select("feature_id", "barcode_id", (F.col("value") * F.col("k")).alias("value"))


def idf(m: DataFrame, barcodes: int) -> DataFrame:
    """Rows weighted by ln(barcodes + 1) - ln(1 + barcodes with the feature)."""
    w = m.where("value > 0").groupBy("feature_id").agg((F.log(F.lit(barcodes + 1.0)) - F.log(F.count("*") + 1.0)).alias("w"))
    return m.join(w, "feature_id").select("feature_id", "barcode_id", (F.col("value") * F.col("w")).alias("value"))


def matmul(left: DataFrame, m: DataFrame, out: str) -> DataFrame:
    """(out, barcode_id, value): the product of (out, feature_id, weight) and a matrix."""
    return left.join(m, "feature_id").groupBy(out, "barcode_id").agg(F.sum(F.col("weight") * F.col("value")).alias("value"))


def l2_normalise(m: DataFrame) -> DataFrame:
    norm = m.groupBy("barcode_id").agg(F.sqrt(F.sum(F.col("value") * F.col("value"))).alias("norm")).where("norm > 0")
    return m.join(norm, "barcode_id").select("feature_id", "barcode_id", (F.col("value") / F.col("norm")).alias("value"))


def mad_zscore(m: DataFrame, row: str, value: str = "value") -> DataFrame:
    """Rows centred on their median and scaled by MAD / 0.6745; null where the MAD is 0."""
    med = m.groupBy(row).agg(F.percentile(value, F.lit(0.5)).alias("med"))
    dev = m.join(med, row).withColumn("dev", F.abs(F.col(value) - F.col("med")))
    mad = dev.groupBy(row).agg(F.percentile("dev", F.lit(0.5)).alias("mad"))
    return dev.join(mad, row).withColumn("z", F.try_divide((F.col(value) - F.col("med")) * 0.6745, F.nullif("mad", F.lit(0.0)))).drop("med", "dev", "mad")


def reduce_columns(m: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """(feature_id, label, value): columns with the same label added, rows then shares."""
    s = m.join(labels, "barcode_id").groupBy("feature_id", label).agg(F.sum("value").alias("value"))
    total = s.groupBy("feature_id").agg(F.sum("value").alias("t"))
    return s.join(total, "feature_id").select("feature_id", label, (F.col("value") / (F.col("t") + 1e-28)).alias("value"))


def relabel_by_size(labels: DataFrame, key: str, cluster: str) -> DataFrame:
    """Clusters numbered from 1 by falling size; ties by the old label.

    The window is over one row for each cluster."""
    sizes = labels.groupBy(cluster).agg(F.count("*").alias("n"))
    names = sizes.withColumn("label", F.row_number().over(Window.orderBy(F.desc("n"), cluster)).cast("long"))
    return labels.join(names, cluster).select(key, "label")


def normalised_dispersion(stats: DataFrame, bins: int = 20) -> DataFrame:
    """(feature_id, bin, z): var / mean, centred and scaled by median and MAD in bins of equal mean frequency."""
    bounds = stats.agg(F.percentile("mean", F.array(*[F.lit(k / bins) for k in range(1, bins)])).alias("cuts"))
    at = stats.join(F.broadcast(bounds)).select("feature_id", F.try_divide("var", "mean").alias("disp"), F.size(F.filter("cuts", lambda c: c < F.col("mean"))).alias("bin"))
    med = at.groupBy("bin").agg(F.percentile("disp", F.lit(0.5)).alias("med"))
    dev = at.join(med, "bin").withColumn("dev", F.abs(F.col("disp") - F.col("med")))
    mad = dev.groupBy("bin").agg(F.percentile("dev", F.lit(0.5)).alias("mad"))
    return dev.join(mad, "bin").select("feature_id", "bin", F.try_divide(F.col("disp") - F.col("med"), F.nullif("mad", F.lit(0.0))).alias("z"))


def select_by(m: DataFrame, dimension: DataFrame, axis: str, condition) -> DataFrame:
    """Entries whose row or column has an attribute: a genome, a type, a list of ids."""
    return select(m, dimension.where(condition), axis)


def filter_barcodes(m: DataFrame, sets: list[DataFrame]) -> DataFrame:
    """Entries whose barcode is in any of the sets, such as the cells of each genome."""
    ids = sets[0].select("barcode_id")
    for s in sets[1:]:
        ids = ids.unionByName(s.select("barcode_id"))
    return select(m, ids, "barcode_id")


def count_at_least(m: DataFrame, threshold: float, axis: str, mask=None) -> DataFrame:
    """(axis, n): entries of at least ``threshold`` that the mask lets through."""
    keep = F.col("value") >= threshold
    return m.groupBy(axis).agg(F.count_if(keep if mask is None else keep & mask).alias("n"))


def stacked(top: DataFrame, below: DataFrame) -> DataFrame:
    """Two matrices over the same barcodes, the second's features numbered after the first's."""
    last = top.agg(F.coalesce(F.max("feature_id"), F.lit(0)).alias("_last"))
    moved = below.join(F.broadcast(last)).withColumn("feature_id", F.col("feature_id") + F.col("_last")).drop("_last")
    return top.unionByName(moved)


def join_features(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two feature tables (feature_id, id, more) as one, numbered from 0; an id in both is an error.

    Numbers come from ranges of the order, so no task holds all features."""
    from .ranks import ranked

    again = a.join(b.select("id"), "id", "left_semi").limit(1).collect()
    if again:
        raise ValueError(f"feature {again[0]['id']} is in both tables")
    rows = a.withColumn("_k", F.lit(0)).unionByName(b.withColumn("_k", F.lit(1)))
    return ranked(rows, "_k", "feature_id", out="_rank").withColumn("feature_id", F.col("_rank") - 1).drop("_k", "_rank")


def weighted_mean(m: DataFrame, weights: DataFrame, weight: str) -> DataFrame:
    """(barcode_id, weight): the mean over a barcode's entries of a feature's weight."""
    return m.join(weights.select("feature_id", weight), "feature_id").groupBy("barcode_id").agg((F.sum(F.col(weight) * F.col("value")) / F.sum("value")).alias(weight))
