"""How many different fragments a library holds, from how often they were seen.

Curves of unique over total fragments come from histograms of copies, one for each
cell, at fixed sampling rates; curves are read between their points by pairing each
point with the next, so no join is needed to find the bracket.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .inference import two_pool_fit

#: Rates of the curves of cells and of whole libraries; depths at which medians are told.
CELL_RATES = tuple(np.linspace(1e-5, 0.99, 100).tolist())
BULK_RATES = tuple(np.linspace(1e-5, 0.95, 100).tolist())
DEPTHS = (50_000, 30_000, 10_000)


def curves(fragments: DataFrame, by: list[str], rates: tuple[float, ...] = CELL_RATES, copies: str = "dup") -> DataFrame:
    """(by, rate, total, unique): what each group is expected to hold when every read is
    kept with a probability, and at 1.

    Fragments become a histogram of copies first, so the rates meet few rows."""
    h = fragments.groupBy(*by, F.col(copies).alias("_k")).agg(F.count("*").alias("_n"))
    at = F.explode(F.array(*[F.lit(float(r)) for r in (*[r for r in rates if r <= 1], 1.0)])).alias("rate")
    each = h.select(*by, "_k", "_n", at)
    seen = F.col("_n") * (1 - F.pow(1 - F.col("rate"), F.col("_k")))
    return each.groupBy(*by, "rate").agg((F.col("rate") * F.sum(F.col("_n") * F.col("_k"))).alias("total"), F.sum(seen).alias("unique"))


def typical(cell_curves: DataFrame, by: list[str]) -> DataFrame:
    """(by, rate, mean_total, median_total, unique): mean and median totals and the median
    unique count over the cells of each group, at each rate."""
    half = lambda c: F.percentile(c, F.lit(0.5))
    return cell_curves.groupBy(*by, "rate").agg(F.avg("total").alias("mean_total"), half("total").alias("median_total"), half("unique").alias("unique"))


def at_depths(curve: DataFrame, by: list[str], depths: tuple[float, ...], total: str = "total") -> DataFrame:
    """(by, depth, unique): curves read at depths, linearly between two points.

    Depths under the first point go on along the first segment; a curve isn't read
    beyond its last point, so shallower groups have no row there."""
    w = Window.partitionBy(*by).orderBy(total)
    steps = curve.select(*by, F.col(total).alias("_t0"), F.col("unique").alias("_u0"), F.lead(total).over(w).alias("_t1"), F.lead("unique").over(w).alias("_u1"), F.lag(total).over(w).isNull().alias("_first"), (F.lead(total, 2).over(w).isNull()).alias("_last")).where("_t1 is not null")
    wanted = F.array(*[F.lit(float(d)) for d in depths])
    inside = F.filter(wanted, lambda d: (F.col("_first") | (d >= F.col("_t0"))) & ((d < F.col("_t1")) | (F.col("_last") & (d <= F.col("_t1")))))
    found = steps.select("*", F.explode(inside).alias("depth"))
    return found.select(*by, "depth", ((F.col("depth") - F.col("_t0")) / (F.col("_t1") - F.col("_t0")) * (F.col("_u1") - F.col("_u0")) + F.col("_u0")).alias("unique"))


def matched(fragments: DataFrame, cells: DataFrame, depths: tuple[float, ...], by: str = "barcode", rates: tuple[float, ...] = CELL_RATES) -> DataFrame:
    """(barcode, depth, unique): unique fragments of each cell at the same depths."""
    own = fragments.join(cells.select(by).distinct(), by, "left_semi")
    return at_depths(curves(own, [by], rates), [by], depths)


def pools(total: np.ndarray, unique: np.ndarray) -> dict:
    """``estimated_complexity`` of two pools, ``estimated_complexity1`` and ``2``, and
    ``fraction_pool1``; zeros and NaN where the pools aren't told apart.

    That is so if a size is not positive, the share lies outside 0 to 1, or a size's
    standard error is over a tenth of it."""
    failed = {"estimated_complexity1": 0.0, "estimated_complexity2": 0.0, "fraction_pool1": float("nan"), "estimated_complexity": 0.0}
    total, unique = np.asarray(total, float), np.asarray(unique, float)
    if len(total) < 4 or not unique.max(initial=0) > 0:
        return failed
    p = two_pool_fit(total, unique)
    a, b, f = p
    if not np.isfinite(p).all() or a <= 0 or b <= 0 or not 0 <= f <= 1:
        return failed
    near, far = np.exp(-total * f / a), np.exp(-total * (1 - f) / b)
    slopes = np.stack([1 - near * (1 + total * f / a), 1 - far * (1 + total * (1 - f) / b), total * near - total * far], 1)
    rest = unique - a * (1 - near) - b * (1 - far)
    try:
        error = np.sqrt(np.diag(np.linalg.inv(slopes.T @ slopes)) * (rest @ rest) / (len(total) - 3))
    except np.linalg.LinAlgError:
        return failed
    if not (error[:2] <= 0.1 * p[:2]).all():
        return failed
    return {"estimated_complexity1": float(a), "estimated_complexity2": float(b), "fraction_pool1": float(f), "estimated_complexity": float(a + b)}


def bulk(fragments: DataFrame, rates: tuple[float, ...] = BULK_RATES) -> dict:
    """The curve of a whole library (``total``, ``unique``) and its pools."""
    c = curves(fragments.withColumn("_all", F.lit(0)), ["_all"], rates).toPandas().sort_values("rate")  # a row for each rate
    if not len(c):
        return {"total": None, "unique": None} | pools(np.empty(0), np.empty(0))
    return {"total": c["total"].tolist(), "unique": c["unique"].tolist()} | pools(c["total"].to_numpy(), c["unique"].to_numpy())


def summary(fragments: DataFrame, cells: DataFrame, reads: int, depths: tuple[int, ...] = DEPTHS) -> dict[str, float]:
    """Metrics of cells (species, barcode): the typical cell's complexity and saturation,
    and median unique fragments at fixed read depths, of all reads (``RRPC``) and of
    those in fragments, two each (``HQ_RPC``); a depth that was not reached is left out."""
    own = cells.select("species", "barcode").distinct()
    per = curves(fragments.join(own, "barcode"), ["species", "barcode"])
    n = own.agg(F.count_distinct("barcode")).first()[0]
    if not n:
        return {}
    each = per.dropDuplicates(["barcode", "rate"])
    whole = typical(each.withColumn("species", F.lit(None)), []).toPandas().sort_values("rate")
    out: dict[str, float] = {}
    fit = pools(whole["median_total"].to_numpy(), whole["unique"].to_numpy())
    if not np.isnan(fit["fraction_pool1"]):
        out["median_per_cell_total_library_complexity"] = fit["estimated_complexity"]
        out["median_per_cell_estimated_saturation"] = float(whole["unique"].iloc[-1]) / fit["estimated_complexity"]
    by = typical(per, ["species"])
    several = own.select("species").distinct().count() > 1
    for name, scale in (("HQ_RPC", F.col("mean_total") * 2), ("RRPC", F.col("rate") * (reads / n))):
        found = at_depths(by.withColumn("total", scale), ["species"], tuple(float(d) for d in depths))
        for r in found.collect():  # a row for each species and depth
            out[f"median_per_cell_unique_fragments_at_{int(r['depth'])}_{name}" + (f"_{r['species']}" if several else "")] = r["unique"]
    return out
