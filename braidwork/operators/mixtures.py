"""Two-component mixtures of many groups, and resampled multiplet counts.

Groups become histograms first, so a group's fit sees its distinct values and not its
rows; replicates of a bootstrap are dealt over tasks and share one bounded histogram.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Starts of the means, in steps over the range; a group needs so many distinct values.
STARTS, LEAST_VALUES = 10, 2
#: Distinct pairs of counts in a bootstrap: they are sent to every task.
MOST_PAIRS = 1 << 18


def tied_mixture(x: np.ndarray, w: np.ndarray, low: float, high: float, rounds: int = 200, eps: float = 1e-7) -> tuple[float, np.ndarray]:
    """(log likelihood, [mean, mean, variance, share of the second]) of two Gaussians with
    one variance, from the given means."""
    n = w.sum()
    mean, share = np.array([low, high], float), np.array([0.5, 0.5])
    total = (w * (x - (w * x).sum() / n) ** 2).sum() / n
    var, last = max(total, 1e-12), -np.inf
    for _ in range(rounds):
        logs = np.log(np.maximum(share, 1e-300))[:, None] - 0.5 * ((x[None] - mean[:, None]) ** 2 / var + np.log(2 * np.pi * var))
        top = logs.max(0)
        each = np.exp(logs - top)
        like = float((w * (top + np.log(each.sum(0)))).sum())
        resp = w * each / each.sum(0)
        size = resp.sum(1)
        share = size / n
        mean = np.where(size > 1e-12, (resp @ x) / np.maximum(size, 1e-12), mean)
        var = max(float((resp * (x[None] - mean[:, None]) ** 2).sum() / n), 1e-6 * max(total, 1e-12))
        if like - last <= eps * abs(like):
            break
        last = like
    return like, np.array([*mean, var, share[1]])


def best_mixture(x: np.ndarray, w: np.ndarray, starts: int = STARTS) -> np.ndarray | None:
    """The likeliest of the mixtures from a grid of starting means, the larger mean second."""
    if len(x) < LEAST_VALUES or x[0] == x[-1]:
        return None
    grid = np.linspace(x.min(), x.max(), starts + 1)
    fits = [tied_mixture(x, w, grid[0], g) for g in grid[1:]]
    a, b, var, share = max(fits, key=lambda f: f[0])[1]
    return np.array([a, b, var, share]) if a <= b else np.array([b, a, var, 1 - share])


_FIT = "mean_low double, mean_high double, variance double, share_high double, least double"


def grouped_mixtures(rows: DataFrame, group: str, value: str, starts: int = STARTS) -> DataFrame:
    """(group, mean_low, mean_high, variance, share_high, least): a mixture of the logarithms
    (base 10, of one more than the value) of each group's values above zero.

    ``least`` is the smallest value that is likelier of the higher component; null, like
    the others, where a group has under two distinct values.  Values become histograms
    before they are sent."""
    h = rows.where(F.col(value) > 0).groupBy(group, F.col(value).cast("double").alias("_v")).agg(F.count("*").alias("_w"))
    kind = rows.schema[group].dataType.simpleString()

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_v")
        v, w = pdf["_v"].to_numpy(), pdf["_w"].to_numpy(float)
        found = best_mixture(np.log10(1 + v), w, starts)
        if found is None:
            return pd.DataFrame({group: pdf[group].iloc[:1], "mean_low": [None], "mean_high": [None], "variance": [None], "share_high": [None], "least": [None]})
        a, b, var, share = found
        x = np.log10(1 + v)
        odds = np.log(max(share, 1e-300)) - np.log(max(1 - share, 1e-300)) + ((x - a) ** 2 - (x - b) ** 2) / (2 * var)
        high = v[odds > 0]
        return pd.DataFrame({group: pdf[group].iloc[:1], "mean_low": [a], "mean_high": [b], "variance": [var], "share_high": [share], "least": [high.min() if len(high) else None]})

    return h.groupBy(group).applyInPandas(fit, f"`{group}` {kind}, {_FIT}")


def present(rows: DataFrame, group: str, value: str, starts: int = STARTS) -> DataFrame:
    """Rows whose value belongs to the higher component of their group: guides that a cell has."""
    cut = grouped_mixtures(rows, group, value, starts).select(group, "least")
    return rows.join(F.broadcast(cut), group).where(F.col(value) >= F.col("least")).drop("least")


def calls_by_cell(found: DataFrame, cell: str, guide: str) -> DataFrame:
    """(cell, n, guides): how many guides each cell has, and their names in order."""
    return found.groupBy(cell).agg(F.count_distinct(guide).alias("n"), F.array_join(F.array_sort(F.collect_set(guide)), "|").alias("guides"))


def efficiency(m: DataFrame, groups: DataFrame, targets: DataFrame, control: str, least_cells: int = 10) -> DataFrame:
    """(perturbation, feature_id, cells, mean, mean_control, log2_ratio) of each perturbation's
    target, against the control cells.

    ``groups`` (barcode_id, perturbation) names every cell, ``targets`` (perturbation,
    feature_id) what each is aimed at.  Counts are per 10,000 of a cell's; means are over
    all cells of the group, those without an entry included.  Perturbations of under
    ``least_cells`` cells are left out."""
    depth = m.groupBy("barcode_id").agg(F.sum("value").alias("_d"))
    sized = groups.join(depth, "barcode_id")
    n = sized.groupBy("perturbation").agg(F.count("*").alias("cells"))
    wanted = targets.select("feature_id").distinct()
    sums = m.join(F.broadcast(wanted), "feature_id", "left_semi").join(sized, "barcode_id").groupBy("perturbation", "feature_id").agg(F.sum(1e4 * F.col("value") / F.col("_d")).alias("_s"))
    own = targets.join(n.where(F.col("cells") >= least_cells), "perturbation").where(F.col("perturbation") != control)
    own = own.join(sums, ["perturbation", "feature_id"], "left").withColumn("mean", F.coalesce("_s", F.lit(0.0)) / F.col("cells")).drop("_s")
    base = sums.where(F.col("perturbation") == control).select("feature_id", F.col("_s").alias("_c"))
    size = n.where(F.col("perturbation") == control).select(F.col("cells").alias("_n"))
    out = own.join(base, "feature_id", "left").join(F.broadcast(size)).withColumn("mean_control", F.coalesce("_c", F.lit(0.0)) / F.col("_n")).drop("_c", "_n")
    return out.withColumn("log2_ratio", F.log2((F.col("mean") + 1) / (F.col("mean_control") + 1))).select("perturbation", "feature_id", "cells", "mean", "mean_control", "log2_ratio")


# --- bootstrap of multiplets


def _quantile(v: np.ndarray, w: np.ndarray, q: float) -> float:
    """The linear quantile of values that stand ``w`` times."""
    order = np.argsort(v)
    v, upto = v[order], np.cumsum(w[order])
    at = q * (upto[-1] - 1)
    low, high = v[np.searchsorted(upto, np.floor(at), side="right")], v[np.searchsorted(upto, np.ceil(at), side="right")]
    return float(low + (at - np.floor(at)) * (high - low))


def inferred_multiplets(a: np.ndarray, b: np.ndarray, w: np.ndarray, q: float = 0.1, default: float = 1000.0) -> tuple[float, float]:
    """(observed, inferred) multiplets of ``w`` cells with ``a`` and ``b`` counts of two genomes."""
    seen = w > 0
    a, b, w = a[seen], b[seen], w[seen]
    cut = [default, default]
    if (a > b).any() and (b > a).any():
        cut = [_quantile(a[a > b], w[a > b], q), _quantile(b[b > a], w[b > a], q)]
    both = (a >= cut[0]) & (b >= cut[1])
    n, second = float(w[both].sum()), float(w[~both & (b > a)].sum())
    first = float(w[~both].sum()) - second
    if not first or not second:
        return n, 0.0
    chance = 2 * first * second / (first + second) ** 2
    return n, min(n / chance, n + first + second)


def bootstrap_multiplets(cells: DataFrame, replicates: int = 1000, seed: int = 0, level: float = 0.95) -> DataFrame:
    """(observed, inferred, mean, low, high): multiplets of cells (c0, c1), and the mean and
    the interval of what resampled cells give.

    Cells become a histogram of distinct pairs, which every task gets; more than
    MOST_PAIRS of them are an error, as called cells are far fewer.  A replicate draws as
    many cells as there are, by its own seed, so the result depends on nothing else."""
    h = cells.groupBy("c0", "c1").agg(F.count("*").alias("w")).limit(MOST_PAIRS + 1).toPandas()
    if len(h) > MOST_PAIRS:
        raise ValueError(f"over {MOST_PAIRS} different pairs of counts: select cells first")
    h = h.sort_values(["c0", "c1"])
    a, b, w = (h[c].to_numpy(float) for c in ("c0", "c1", "w"))
    spark = cells.sparkSession
    shared = spark.sparkContext.broadcast((a, b, w))

    def run(pdfs):
        a, b, w = shared.value
        n = int(w.sum())
        for pdf in pdfs:
            drawn = [np.random.default_rng([seed, int(k)]).multinomial(n, w / w.sum()) if n else np.zeros(0) for k in pdf["id"]]
            yield pd.DataFrame({"n": [inferred_multiplets(a, b, d.astype(float))[1] if n else 0.0 for d in drawn]})

    tasks = max(1, min(replicates, 2 * spark.sparkContext.defaultParallelism))
    drawn = spark.range(0, replicates, 1, tasks).mapInPandas(run, "n double")
    tail = (1 - level) / 2
    seen, inferred = inferred_multiplets(a, b, w) if len(w) else (0.0, 0.0)
    return drawn.agg(F.lit(seen).alias("observed"), F.lit(inferred).alias("inferred"), F.avg("n").alias("mean"), F.percentile("n", F.lit(tail)).alias("low"), F.percentile("n", F.lit(1 - tail)).alias("high"))


# --- samples that favour sparse places


def spread_sample(points: DataFrame, n: int, x: str, y: str, key: str, seed: int = 0, grid: float = 0.01, radius: float = 0.1) -> DataFrame:
    """``n`` of the points, fewer where they lie dense.

    Places are standardised logarithms on a grid.  One point of each grid cell, that of
    the smallest hash, stands for it.  If these are too few, others by hash fill up; if
    too many, cells are drawn without replacement by keys -log(u) / weight, the weight
    being one over the number of cells within ``radius``.  Ties fall to the smaller key.
    Keys are distinct."""
    total = points.count()
    if total <= n:
        return points
    logged = {"_x": F.log2(F.col(x) + 1), "_y": F.log2(F.col(y) + 1)}
    s = points.withColumns(logged).agg(*[f(c).alias(f"{c}{k}") for c in ("_x", "_y") for k, f in enumerate((F.avg, F.stddev_pop))]).first()
    z = lambda c, m, d: F.round((c - F.lit(m)) / F.lit(d or 1.0) / grid).cast("long")
    place = F.xxhash64(key, F.lit(seed))
    laid = points.withColumns({"_i": z(logged["_x"], s["_x0"], s["_x1"]), "_j": z(logged["_y"], s["_y0"], s["_y1"]), "_h": place})
    cells = laid.groupBy("_i", "_j").agg(F.min(F.struct("_h", key)).alias("_top"))
    one = cells.select("_i", "_j", F.col("_top._h").alias("_h"), F.col(f"_top.{key}").alias("_key"))
    distinct = one.count()
    if distinct <= n:
        rest = laid.join(one.select(F.col("_key").alias(key)), key, "left_anti").orderBy("_h", key).limit(n - distinct)
        chosen = one.select(F.col("_key").alias(key)).unionByName(rest.select(key))
    else:
        # Cells meet through squares as wide as the radius; a cell has a bounded number of others within it.
        step = int(round(radius / grid))
        squares = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (-1, 0, 1) for b in (-1, 0, 1)])).alias("_s")
        square = lambda c: F.floor(F.col(c) / step)
        other = one.select(F.col("_i").alias("_oi"), F.col("_j").alias("_oj"), squares).select("_oi", "_oj", (square("_oi") + F.col("_s.a")).alias("_a"), (square("_oj") + F.col("_s.b")).alias("_b"))
        near = one.withColumns({"_a": square("_i"), "_b": square("_j")}).join(other, ["_a", "_b"]).where((F.col("_i") - F.col("_oi")) * (F.col("_i") - F.col("_oi")) + (F.col("_j") - F.col("_oj")) * (F.col("_j") - F.col("_oj")) <= step * step)
        weighed = near.groupBy("_key", "_h").agg(F.count("*").alias("_n"))
        u = (F.shiftrightunsigned("_h", 11).cast("double") + 1) / float(1 << 53)
        chosen = weighed.orderBy(-F.log(u) * F.col("_n"), "_key").limit(n).select(F.col("_key").alias(key))
    return points.join(chosen, key, "left_semi")
